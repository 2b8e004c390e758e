"""Groups of entities: creation, membership, names, content, nested expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode, SolidError


def create_set(groups: DataFrame, names: list[str] | None = None) -> tuple[DataFrame, int]:
    """``groups`` with a new one, and its id. There is no list flavour: membership is a set."""
    new = (groups.agg(F.max("group_id")).first()[0] or 0) + 1
    row = groups.sparkSession.createDataFrame([(new, names or [])], "group_id long, names array<string>")
    return groups.unionByName(row), new


def add_to_set(members: DataFrame, group_id: int, member_id: int | None, kind: str = "entity") -> DataFrame:
    if member_id is None:
        raise SolidError(ErrorCode.INVALID_ARGUMENT)
    row = members.sparkSession.createDataFrame([(group_id, member_id, kind)], "group_id long, member_id long, member_kind string")
    return members.unionByName(row).dropDuplicates(["group_id", "member_id", "member_kind"])


def get_or_create(groups: DataFrame, name: str) -> DataFrame:
    """``groups`` with a group of this name, which is added only if it is missing."""
    if groups.where(F.array_contains("names", name)).limit(1).count():
        return groups
    return create_set(groups, [name])[0]


def group_names(groups: DataFrame, size: int = 32) -> DataFrame:
    """(group_id, name, truncated): the first name, cut to size - 1 bytes; groups without names are left out."""
    first = F.element_at("names", 1)
    long = F.octet_length(first) > size - 1
    # a cut inside a character is no text: characters go until the rest fits
    cut = F.element_at(F.filter(F.transform(F.sequence(F.lit(size - 1), F.lit(max(0, (size - 1) // 4)), F.lit(-1)), lambda n: F.left(first, n)), lambda s: F.octet_length(s) <= size - 1), 1)
    return groups.where(F.size("names") > 0).select("group_id", F.when(long, cut).otherwise(first).alias("name"), long.alias("truncated"))


def extra_names(groups: DataFrame) -> DataFrame:
    """(group_id, slot, name) of groups with several names; slot 0 repeats the first."""
    return groups.where(F.size("names") > 1).select("group_id", F.posexplode("names").alias("slot", "name"))


def group_content(members: DataFrame, groups: DataFrame, entities: DataFrame, body_volume: DataFrame) -> DataFrame:
    """(group_id, handle): child groups by their own handle, bodies as their volumes, known entities; each once."""
    kind = lambda k: members.where(F.col("member_kind") == k)
    child = kind("group").join(groups.select(F.col("group_id").alias("member_id")), "member_id", "left_semi").select("group_id", "member_id")
    body = kind("body").join(body_volume, F.col("member_id") == F.col("body_id")).select("group_id", F.col("volume_id").alias("member_id"))
    own = kind("entity").join(entities.select(F.col("ent_id").alias("member_id")), "member_id", "left_semi").select("group_id", "member_id")
    return child.union(body).union(own).distinct().withColumnRenamed("member_id", "handle")


def unmapped(members: DataFrame, groups: DataFrame, entities: DataFrame, body_volume: DataFrame) -> DataFrame:
    """Members that :func:`group_content` knows nothing of: what it would warn about."""
    known = groups.select(F.lit("group").alias("member_kind"), F.col("group_id").alias("member_id"))
    known = known.union(body_volume.select(F.lit("body"), "body_id")).union(entities.select(F.lit("entity"), "ent_id")).distinct()
    return members.join(known, ["member_kind", "member_id"], "left_anti")


def expand(members: DataFrame, hops: int) -> DataFrame:
    """Entities of groups and of groups in them, up to so many hops (our extension); cycles end with the hops."""
    up = members.where("member_kind = 'group'").select(F.col("group_id").alias("top"), F.col("member_id").alias("sub"))
    reach = members.select(F.col("group_id").alias("top"), F.col("group_id").alias("sub")).distinct()
    step = reach
    for _ in range(hops):
        step = step.join(up.select(F.col("top").alias("sub"), F.col("sub").alias("next")), "sub").select("top", F.col("next").alias("sub")).distinct()
        reach = reach.union(step).distinct()
    own = members.where("member_kind <> 'group'")
    return reach.join(own, reach["sub"] == own["group_id"]).select(F.col("top").alias("group_id"), "member_id", "member_kind").distinct()
