"""Tags: a registry of names and sizes, and values in long form (ent_id, handle, value, seq), the last write winning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode, SolidError
from solidspark.operators.entities import category
from solidspark.schema import CATEGORY_NAMES, PRESET_TAGS, TABLES

#: Leads the strings of a packed attribute.
MARKER = "TAGS"


def registry(spark: SparkSession) -> DataFrame:
    """The preset tags, under handles -1, -2 and so on; user tags count from 1."""
    rows = [(-k - 1, name, kind, size, None, True) for k, (name, size, kind) in enumerate(PRESET_TAGS)]
    return spark.createDataFrame(rows, TABLES["tag_def"])


def create_tag(tags: DataFrame, name: str, length: int, value_type: str, default: bytes | None = None) -> tuple[DataFrame, int]:
    """``tags`` with a new one, and its handle; an active name is a conflict, an inactive one gives its handle again."""
    old = tags.where(F.col("name") == name).orderBy(F.desc("is_active")).first()
    if old and old.is_active:
        raise SolidError(ErrorCode.TAG_ALREADY_EXISTS)
    handle = old.handle if old else max(0, tags.agg(F.max("handle")).first()[0] or 0) + 1
    row = tags.sparkSession.createDataFrame([(handle, name, value_type, length, default, True)], TABLES["tag_def"])
    return tags.where(F.col("handle") != handle).unionByName(row), handle


def handles(tags: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, handle, status) of names; 0 and TAG_NOT_FOUND where no active tag has it."""
    active = tags.where("is_active").select("name", "handle")
    found = wanted.join(active, "name", "left")
    return found.select("name", F.coalesce("handle", F.lit(0)).alias("handle"), F.when(F.col("handle").isNull(), int(ErrorCode.TAG_NOT_FOUND)).otherwise(0).alias("status"))


def sizes(tags: DataFrame, wanted: DataFrame) -> DataFrame:
    """(handle, length); null for a handle that is none."""
    return wanted.join(tags.select("handle", "length"), "handle", "left")


def preset_status(handle: Column) -> Column:
    """Of a write: of the preset tags only NAME (-1) can be written."""
    return F.when(handle == -1, int(ErrorCode.SUCCESS)).when(handle < 0, int(ErrorCode.NOT_SUPPORTED)).otherwise(int(ErrorCode.SUCCESS))


def upsert(writes: DataFrame, *order: str, keys: tuple[str, ...] = ("ent_id",)) -> DataFrame:
    """(ent_id, handle, value) after all writes: the last in ``order`` wins. ``keys`` names what a value hangs on: an
    entity, or a set (group_id)."""
    return writes.groupBy(*keys, "handle").agg(F.max_by("value", F.struct(*order)).alias("value"))


def set_array(targets: DataFrame, handle: int, length: int, values: str = "values", ids: str = "ent_ids", null_entity: int = 0) -> DataFrame:
    """(ent_id, handle, value, seq): the values of an array of entities, cut out of one binary by the tag's length; a
    null entity stands for the interface group ``null_entity``."""
    at = targets.select(F.posexplode(ids).alias("seq", "ent_id"), values)
    return at.select(F.coalesce("ent_id", F.lit(null_entity)).cast("long").alias("ent_id"), F.lit(handle).alias("handle"), F.expr(f"substring({values}, seq * {length} + 1, {length})").alias("value"), F.col("seq").cast("long").alias("seq"))


def clear(values: DataFrame, ids: DataFrame) -> DataFrame:
    """Without all values of some entities."""
    return values.join(ids.select("ent_id").distinct(), "ent_id", "left_anti")


def attributes(entities: DataFrame, values: DataFrame) -> DataFrame:
    """(ent_id, n_tags) of every entity: its attribute, made empty where it has none."""
    n = values.groupBy("ent_id").agg(F.count("*").alias("n_tags"))
    return entities.select("ent_id").distinct().join(n, "ent_id", "left").select("ent_id", F.coalesce("n_tags", F.lit(0)).alias("n_tags"))


def export_tags(entities: DataFrame, group_names: DataFrame, faceting_tol: float, resabs: float, file_set: int = 0) -> DataFrame:
    """(handle, GEOM_DIMENSION, GLOBAL_ID, CATEGORY, NAME, FACETING_TOL, GEOMETRY_RESABS): the tags of an export.

    entities: (ent_id, dim, global_id); group_names: (group_id, name). Groups have dimension 4; the tolerances
    hang on the file set alone. What a set has no value for is null."""
    none = lambda kind: F.lit(None).cast(kind)
    row = lambda handle, dim, ident, category, name, tol=None, res=None: [handle.cast("long").alias("handle"), dim.cast("int").alias("GEOM_DIMENSION"), ident.cast("int").alias("GLOBAL_ID"), category.alias("CATEGORY"), name.alias("NAME"),
                                                                          F.lit(tol).cast("double").alias("FACETING_TOL"), F.lit(res).cast("double").alias("GEOMETRY_RESABS")]
    out = entities.select(*row(F.col("ent_id"), F.col("dim"), F.col("global_id"), category(F.col("dim")), none("string")))
    out = out.unionByName(group_names.select(*row(F.col("group_id"), F.lit(4), F.col("group_id"), F.lit(CATEGORY_NAMES[4]), F.col("name"))))
    return out.unionByName(entities.sparkSession.range(1).select(*row(F.lit(file_set), none("int"), none("int"), none("string"), none("string"), faceting_tol, resabs)))


def with_values(values: DataFrame) -> DataFrame:
    """Entities that still have an attribute."""
    return values.groupBy("ent_id").agg(F.count("*").alias("n")).where("n > 0").select("ent_id")


def get_data(values: DataFrame, tags: DataFrame) -> DataFrame:
    """(ent_id, name, value): reading, our extension."""
    return values.join(tags.where("is_active").select("handle", "name"), "handle").select("ent_id", "name", "value")


def words(value: Column) -> Column:
    """A binary as whole 4-byte words, little-endian, zeros after its end."""
    n = F.ceil(F.octet_length(value) / 4).cast("int")
    padded = F.rpad(F.hex(value), n * 8, "0")
    word = lambda k: F.concat(*[F.substring(padded, k * 8 + F.lit(j), F.lit(2)) for j in (7, 5, 3, 1)])
    signed = lambda h: F.when(F.conv(h, 16, 10).cast("long") >= 2**31, F.conv(h, 16, 10).cast("long") - 2**32).otherwise(F.conv(h, 16, 10).cast("long")).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: signed(word(k)))).otherwise(F.array().cast("array<int>"))


def pack(values: DataFrame, tags: DataFrame) -> DataFrame:
    """(ent_id, strings, ints): [marker, name...] and [count, (length, words...)...], in order of handle."""
    named = values.join(tags.select("handle", "name"), "handle").select("ent_id", F.struct("handle", "name", F.octet_length("value").alias("length"), words(F.col("value")).alias("words")).alias("t"))
    sorted_ = named.groupBy("ent_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return sorted_.select(
        "ent_id",
        F.concat(F.array(F.lit(MARKER)), F.transform("ts", lambda t: t.getField("name"))).alias("strings"),
        F.concat(F.array(F.size("ts")), F.flatten(F.transform("ts", lambda t: F.concat(F.array(t.getField("length")), t.getField("words"))))).alias("ints"),
    )


def unpack(packed: DataFrame) -> DataFrame:
    """(ent_id, name, value): the inverse of :func:`pack`."""
    start = F.struct(F.lit(2).alias("at"), F.array().cast("array<struct<at:int,len:int>>").alias("cuts"))
    step = lambda acc, _: F.struct(
        (acc.at + 1 + F.ceil(F.element_at("ints", acc.at) / 4).cast("int")).alias("at"),
        F.concat(acc.cuts, F.array(F.struct((acc.at + 1).alias("at"), F.element_at("ints", acc.at).alias("len")))).alias("cuts"),
    )
    cuts = F.aggregate(F.slice("strings", F.lit(2), F.size("strings")), start, step, lambda acc: acc.cuts)
    rows = packed.select("ent_id", "strings", "ints", F.posexplode(cuts).alias("k", "cut"))
    n = F.ceil(F.col("cut.len") / 4).cast("int")
    le = lambda w: F.concat(*[F.substring(F.lpad(F.hex(F.when(w < 0, w.cast("long") + 2**32).otherwise(w.cast("long"))), 8, "0"), p, 2) for p in (7, 5, 3, 1)])
    text = F.array_join(F.transform(F.slice("ints", F.col("cut.at"), n), le), "")
    return rows.select("ent_id", F.get("strings", F.col("k") + 1).alias("name"), F.unhex(F.substring(text, F.lit(1), F.col("cut.len") * 2)).alias("value"))
