"""Joins on keys that may be very frequent: those keys alone go by broadcast, of a size bounded by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy with more than one of so many of all rows, so there are fewer heavy keys than this.
HEAVY = 10_000


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that goes through a shuffle, however small Spark takes it for.

    Spark guesses sizes from the bytes of compressed files and does not know what ``explode`` adds, so it may broadcast, and
    thus gather on the driver, many times what its threshold allows."""
    return df.hint("merge")


def heavy_keys(counts: DataFrame, total: int, key: str, n: str = "n") -> DataFrame:
    """The heavy keys of a table of keys with their numbers of rows: under ``HEAVY`` of them."""
    return counts.where(F.col(n) * HEAVY > F.lit(total)).select(key)


def join_heavy(left: DataFrame, right: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """The inner join of ``left`` with ``right``, which has one row a key.

    Rows of heavy keys meet their row of ``right`` where they are; no other key has more rows than one task of
    ``HEAVY`` would hold, and those are joined as Spark likes. A null key meets nothing."""
    few = F.broadcast(heavy)
    met = left.join(F.broadcast(right.join(few, key, "left_semi")), key)
    return met.unionByName(left.join(few, key, "left_anti").join(shuffled(right), key))
