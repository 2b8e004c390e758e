"""Line dedup: overlapping windows of three lines, found repeated over the whole corpus; later occurrences go.

Native: DataFrame functions only. See :mod:`solidspark.llm.repeats` for nulls, ties, short and repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solidspark.llm.repeats import BLANKS, cleaned, drop_repeats, key_of


def dedup_lines(docs: DataFrame, window: int = 3, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with the text cleaned, then ``n_lines``, ``removed`` (0-based line numbers).

    Lines end at ``\\n``. A window of ``window`` consecutive lines that occurs elsewhere earlier
    is removed; overlapping windows merge. Windows with under ``min_chars`` characters besides
    white space at the ends (blank lines) are left alone."""
    joined = lambda i: F.array_join(F.slice("_units", i + 1, window), "\n")
    key = lambda i: F.when(F.length(F.btrim(joined(i), F.lit(BLANKS))) >= min_chars, key_of(joined(i)))

    def runs(units: DataFrame) -> DataFrame:
        keyed = F.when(F.size("_units") >= window, F.transform(F.sequence(F.lit(0), F.size("_units") - window), key))
        # outer: the filter that Spark infers for a plain explode would compute the windows twice
        return units.select("_id", "_th", F.posexplode_outer(keyed).alias("_pos", "_key")).where(F.col("_key").isNotNull()).withColumn("_len", F.lit(window))

    return cleaned(docs, drop_repeats(docs, F.split("_text", "\n", -1), "\n", runs, id_col=id_col, text_col=text_col), text_col, "n_lines")
