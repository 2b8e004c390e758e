"""Repeated runs of consecutive units (lines or sentences), found over the whole corpus.

Runs of units are hashed (96 bits). A run is repeated if its hash occurs more than once; its first occurrence is the
one with the smallest (doc_id, text hash, position), and every unit that any other occurrence covers is removed.
Occurrences of a very frequent run meet its first where they are (:mod:`solidspark.skew`), so no run is one task.

Defined cases
-------------
* null text: no units, the row stays with a null text; empty text: no units, stays empty.
* fewer units than the shortest run: nothing is hashed, the row stays as it is.
* rows that repeat both doc_id and text are one document: none of them is a later copy of
  another, all get the same result. A null doc_id is an id like another and sorts first.
* white space around a unit is not compared.
* other columns pass through, but those that an operator returns itself are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.llm.common import stage, unstage
from solidspark.skew import heavy_keys, join_heavy, shuffled

#: ASCII white space, as :data:`solidspark.llm.common.WORD` has it.
BLANKS = " \t\n\x0b\x0c\r"


def key_of(text: Column) -> Column:
    return F.substring(F.unhex(F.md5(text.cast("binary"))), 1, 12)


def _later(found: DataFrame, *keep: str) -> DataFrame:
    """The rows (_id, _th, _pos, _key, ...) of keys that occur again, with ``_is_later``: not the first with their key."""
    place = F.struct("_id", "_th", "_pos")
    first = stage(found.groupBy("_key").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1"), "first-runs")
    met = join_heavy(found, first.drop("_n"), "_key", heavy_keys(first, found.count(), "_key", "_n"))
    return met.select("_id", "_th", "_pos", "_len", *keep, (~place.eqNullSafe(F.col("_first"))).alias("_is_later"))


def later_runs(found: DataFrame, more: bool = False) -> DataFrame:
    """(_id, _th, _pos, _len) of the runs that are not the first with their key.

    With ``more`` a run also brings longer ones from its start (``_more``): these can only be repeated where it is."""
    cols = ["_id", "_th", "_pos", "_len"]
    if not more:
        return _later(found).where("_is_later").select(*cols)
    met = stage(_later(found, "_more"), "met-runs")
    longer = met.select("_id", "_th", "_pos", F.explode("_more").alias("_m")).select("_id", "_th", "_pos", F.col("_m.len").alias("_len"), F.col("_m.key").alias("_key"))
    again = _later(stage(longer, "longer-runs")).where("_is_later").select(*cols)
    return met.where("_is_later").select(*cols).unionByName(again)


def drop_repeats(docs: DataFrame, split: Column, glue: str, runs: Callable[[DataFrame], DataFrame], more: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``_n_units``, ``_removed`` (sorted positions) and ``_kept`` (text without them).

    ``split`` turns the text column into its units; ``glue`` joins what is kept. ``runs`` makes the runs (_id, _th,
    _pos, _len, _key, with ``more`` also _more) of (_id, _th, _units), whose units are trimmed."""
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    text = F.col("_row").getField(text_col)
    base = base.withColumns({"_id": F.col("_row").getField(id_col), "_th": F.xxhash64(text)})
    # the join moves a row once: its units are cut anew behind it
    in_units = lambda df: df.withColumn("_text", text).withColumn("_units", F.when(F.col("_text") != "", split))
    found = stage(runs(in_units(base).select("_id", "_th", F.transform("_units", lambda u: F.btrim(u, F.lit(BLANKS))).alias("_units"))), "runs")
    covered = later_runs(found, more).groupBy(F.col("_id").alias("_cid"), F.col("_th").alias("_cth")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("_pos", "_len")), lambda r: F.sequence(r.getField("_pos"), r.getField("_pos") + r.getField("_len") - 1))))).alias("_removed")
    )
    covered = stage(covered, "covered-units")
    unstage(found)
    hit = in_units(base.join(shuffled(covered), base["_id"].eqNullSafe(covered["_cid"]) & base["_th"].eqNullSafe(covered["_cth"]), "left"))
    gone = F.coalesce(F.col("_removed"), F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_units") - 1), gone)
    kept = F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(left, lambda i: F.element_at("_units", i + 1)), glue))
    return hit.select("_row", F.when(F.col("_units").isNull(), 0).otherwise(F.size("_units")).cast("long").alias("_n_units"), gone.alias("_removed"), kept.alias("_kept"))


def cleaned(docs: DataFrame, found: DataFrame, text_col: str, n_units: str) -> DataFrame:
    """The columns of ``docs`` with the text cleaned, then the number of units and the removed ones."""
    cols = [F.col("_kept").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns if c not in (n_units, "removed")]
    return found.select(*cols, F.col("_n_units").alias(n_units), F.col("_removed").alias("removed"))
