"""Entities: type filters, counts, boxes, copies, deletion. All take and return DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode, SolidError
from solidspark.operators.mesh import running
from solidspark.schema import ALL_TYPES, CATEGORY_NAMES


def check_type(dim: int, code: ErrorCode = ErrorCode.INVALID_ENTITY_TYPE) -> None:
    """0 to 3, or 4 for all; a negative type is out of range too."""
    if not 0 <= dim <= ALL_TYPES:
        raise SolidError(code)


def of_type(entities: DataFrame, dim: int) -> DataFrame:
    """Entities of a dimension; 4: all of them."""
    check_type(dim)
    return entities if dim == ALL_TYPES else entities.where(F.col("dim") == dim)


def in_set(entities: DataFrame, members: DataFrame, group_id: int | None, dim: int = ALL_TYPES) -> DataFrame:
    """Entities of a group by type; no group: the whole model."""
    found = of_type(entities, dim)
    if group_id is None:
        return found
    own = members.where((F.col("group_id") == group_id) & (F.col("member_kind") == "entity")).select(F.col("member_id").alias("ent_id")).distinct()
    return found.join(own, "ent_id", "left_semi")


def not_of_type(entities: DataFrame, others: DataFrame, key: str = "ent_id") -> DataFrame:
    """What is not among ``others`` (groups in a list of entities)."""
    return entities.join(others.select(key).distinct(), key, "left_anti")


def num_of_type(entities: DataFrame, dim: int | None = None) -> DataFrame:
    """(dim, n) of each dimension that the table has, or the count of one; a bad type here is a bad type and topology."""
    if dim is None:
        return entities.groupBy("dim").agg(F.count("*").alias("n"))
    check_type(dim, ErrorCode.BAD_TYPE_AND_TOPO)
    return of_type(entities, dim).agg(F.count("*").alias("n"))


def num_of_type_all(entities: DataFrame) -> DataFrame:
    """Counts by dimension with their total, whose dim is that of all types, 4."""
    return entities.rollup("dim").agg(F.count("*").alias("n")).select(F.coalesce("dim", F.lit(ALL_TYPES)).alias("dim"), "n")


def num_of_type_bodies(entities: DataFrame, body_volume: DataFrame) -> DataFrame:
    """:func:`num_of_type_all` of a model's root: regions are counted as bodies, whatever their volumes; a volume without a body is one."""
    volumes = entities.where("dim = 3").select(F.col("ent_id").alias("volume_id")).join(body_volume, "volume_id", "left")
    bodies = volumes.select(F.when(F.col("body_id").isNull(), F.struct(F.lit("volume").alias("kind"), F.col("volume_id").alias("id"))).otherwise(F.struct(F.lit("body").alias("kind"), F.col("body_id").alias("id"))).alias("b")).distinct()
    return num_of_type_all(entities.where("dim <> 3").select("dim").union(bodies.select(F.lit(3))))


def count_in_list(items: DataFrame, dim: int) -> DataFrame:
    """One row n: how many of a list (kind: entity, body or group; dim) are of a type. Groups are no entities and do not
    count among all types; regions are bodies. A bad type is an invalid entity type here."""
    check_type(dim)
    kind = F.when(F.col("kind") == "body", 3).when(F.col("kind") == "entity", F.when(F.col("dim") < 3, F.col("dim")))
    found = F.col("kind") != "group" if dim == ALL_TYPES else F.coalesce(kind == dim, F.lit(False))
    return items.agg(F.count_if(found).alias("n"))


def category(dim: Column) -> Column:
    out = F.lit(CATEGORY_NAMES[4])
    for k, name in enumerate(CATEGORY_NAMES[:4]):
        out = F.when(dim == k, name).otherwise(out)
    return out


def bounding_boxes(points: DataFrame, *keys: str) -> DataFrame:
    """Corners of the box of each key's points (x, y, z)."""
    return points.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in "xyz"])


def next_id(entities: DataFrame) -> int:
    """After the largest; 1 in an empty model."""
    return (entities.agg(F.max("ent_id")).first()[0] or 0) + 1


def new_ids(ids: DataFrame, base: int, key: str = "ent_id") -> DataFrame:
    """(key, new): ids from ``base`` on, in order of the old ones."""
    return running(ids.select(key).distinct().withColumn("n", F.lit(1)), key).select(key, (F.col("start") + base).alias("new"))


def copy(entities: DataFrame, ids: DataFrame) -> DataFrame:
    """``entities`` and copies of those with ids of ``ids`` (ent_id), under new ids in order of the old ones."""
    known = ids.join(entities.select("ent_id"), "ent_id", "left_semi")
    new = entities.join(new_ids(known, next_id(entities)), "ent_id").withColumn("ent_id", F.col("new"))
    return entities.unionByName(new.select(*entities.columns))


def below(topology: DataFrame, ids: DataFrame) -> DataFrame:
    """(ent_id): ``ids`` and all that they are made of, over the dimensions below."""
    found = ids.select("ent_id")
    for dim in (3, 2, 1):
        down = topology.where(F.col("parent_dim") == dim).join(found.distinct().withColumnRenamed("ent_id", "parent_id"), "parent_id", "left_semi")
        found = found.union(down.select("child_id"))
    return found.distinct()


def delete(entities: DataFrame, ids: DataFrame, body_volume: DataFrame | None = None) -> DataFrame:
    """``entities`` without those of ``ids``; a body takes its volumes with it, a volume its body and that body's volumes."""
    gone = ids.select("ent_id").distinct()
    if body_volume is not None:
        by_volume = body_volume.join(gone, body_volume["volume_id"] == gone["ent_id"]).select("body_id")
        by_body = body_volume.join(gone, body_volume["body_id"] == gone["ent_id"]).select("body_id")
        bodies = by_volume.union(by_body).distinct()
        gone = gone.union(bodies).union(body_volume.join(bodies, "body_id").select("volume_id")).distinct()
    return entities.join(gone, "ent_id", "left_anti")


def file_set(*tables: tuple[DataFrame, str], set_id: int = 0) -> DataFrame:
    """(set_id, handle, kind) of everything an export holds; each table with the name of its key."""
    parts = [t.select(F.lit(set_id).cast("long").alias("set_id"), F.col(key).cast("long").alias("handle"), F.lit(key).alias("kind")) for t, key in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
