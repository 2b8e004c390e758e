"""Parent and child links between dimensions, and senses of a child in its parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode, SolidError
from solidspark.schema import FORWARD, REVERSE


def links(uses: DataFrame, entities: DataFrame) -> DataFrame:
    """(parent_id, child_id, parent_dim) of the pairs (parent_id, child_id) whose both ends exist one dimension apart."""
    parent = entities.select(F.col("ent_id").alias("parent_id"), F.col("dim").alias("parent_dim"))
    child = entities.select(F.col("ent_id").alias("child_id"), F.col("dim").alias("child_dim"))
    both = uses.select("parent_id", "child_id").distinct().join(parent, "parent_id").join(child, "child_id")
    return both.where(F.col("child_dim") == F.col("parent_dim") - 1).select("parent_id", "child_id", "parent_dim")


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent is missing."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def sense_of(use: Column, own: Column) -> Column:
    """Senses of one use: both where it is unknown (U), forward where it equals the geometry's own, else reverse."""
    return F.when(use == "U", F.array(F.lit(FORWARD), F.lit(REVERSE))).when(use == own, F.array(F.lit(FORWARD))).otherwise(F.array(F.lit(REVERSE)))


def senses(uses: DataFrame) -> DataFrame:
    """(child_id, parent_id, sense) of (child_id, parent_id, use_sense, geom_sense)."""
    return uses.select("child_id", "parent_id", F.explode(sense_of(F.col("use_sense"), F.col("geom_sense"))).alias("sense"))


def sense_violations(found: DataFrame) -> DataFrame:
    """Sides of a surface that more than one use of a volume takes; the same volume twice counts."""
    return found.groupBy("child_id", "sense").agg(F.count("*").alias("n_uses")).where("n_uses > 1")


def surface_senses(uses: DataFrame, strict: bool = False) -> DataFrame:
    """Senses of surfaces; strict: a side taken twice is a failure."""
    found = senses(uses)
    if strict and sense_violations(found).limit(1).count():
        raise SolidError(ErrorCode.FAILURE, "more than one volume on one side of a surface")
    return found


def curve_senses(uses: DataFrame) -> DataFrame:
    """(child_id, sense, parents): any number of surfaces on a side of a curve, ordered."""
    return senses(uses).groupBy("child_id", "sense").agg(F.array_sort(F.collect_list("parent_id")).alias("parents"))
