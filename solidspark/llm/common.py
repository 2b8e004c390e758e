"""What the operators of this subpackage share: staged tables, words in ASCII lower case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solidspark.staging import stage, unstage

__all__ = ["WORD", "as_long", "as_text", "lower_words", "stage", "stage_frames", "table", "unstage"]

_FRAME_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: A word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def lower_words(text: str | None) -> list[bytes]:
    """The words of a text in ASCII lower case, in UTF-8: lower() of bytes touches A-Z only, and their
    split() knows exactly the white space of WORD."""
    return text.encode("utf-8").lower().split() if text else []


def as_text(column: Column | str) -> Column:
    """A whole number in decimal, for steps that take frames of pandas: there, whole numbers beside nulls become doubles, which
    keep 53 bits."""
    return (F.col(column) if isinstance(column, str) else column).cast("long").cast("string")


def as_long(df: DataFrame, column: str) -> DataFrame:
    """The number again."""
    return df.withColumn(column, F.col(column).cast("long"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_frames(df: DataFrame, name: str, rows: int = 500) -> DataFrame:
    """:func:`stage` of a plan with Python steps that take whole texts: they get frames of ``rows`` rows.

    Both the executor and its Python worker hold a frame at once, outside the executor's heap."""
    conf = df.sparkSession.conf
    before = conf.get(_FRAME_ROWS)
    conf.set(_FRAME_ROWS, str(rows))
    try:
        return stage(df, name)
    finally:
        conf.set(_FRAME_ROWS, before)
