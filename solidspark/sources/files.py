"""File types, option strings, and saving of model tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode, SolidError

# Names of file types.
FILE_TYPES = (
    "ACIS", "ACIS_SAT", "ACIS_SAB", "ACIS_DEBUG", "IGES", "CATIA", "STEP", "PROE", "GRANITE", "GRANITE_G", "GRANITE_SAT",
    "GRANITE_PROE_PART", "GRANITE_PROE_ASM", "GRANITE_NEUTRAL", "NCGM", "CATIA_NCGM", "CATPART", "CATPRODUCT", "FACET", "SOLIDWORKS", "OCC",
)
# What a name holds, anywhere, for each type, in order; in small or capital letters.
EXTENSIONS = {"IGES": (".igs", ".iges"), "STEP": (".stp", ".step"), "ACIS_SAT": (".sat",), "OCC": (".occ", ".brep")}


def known_type(name: Column) -> Column:
    """The name if it is a file type (case matters), else NOT_DEFINED."""
    return F.when(name.isin(*FILE_TYPES), name).otherwise("NOT_DEFINED")


def type_of_name(name: Column) -> Column:
    """The file type by what the name holds; null if it holds nothing known."""
    out = F.lit(None).cast("string")
    for kind, parts in reversed(EXTENSIONS.items()):
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(name, F.lit(p)) | F.contains(name, F.lit(p.upper()))
        out = F.when(hit, kind).otherwise(out)
    return out


def tokenize(options: Column) -> Column:
    """Tokens of an option string whose first character is the delimiter; what follows the last one is dropped."""
    parts = F.split(F.substring(options, 2, 1_000_000), F.concat(F.lit(r"\Q"), F.left(options, F.lit(1)), F.lit(r"\E")), -1)
    return F.when(F.length(options) > 1, F.filter(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda t: t != "")).otherwise(F.array().cast("array<string>"))


def match_option(option: Column, name: str) -> Column:
    """The value of NAME=VALUE, case matters; null for another option."""
    return F.when(F.startswith(option, F.lit(f"{name}=")), F.substring(option, F.lit(len(name) + 2), F.length(option))).otherwise(F.lit(None))


def save_status(name: Column, option: Column) -> tuple[Column, Column]:
    """:func:`resolve_save` for tables of names with one option (null: none): the file type and the status."""
    other = option.isNotNull() & ~F.startswith(option, F.lit("TYPE="))
    wanted = F.when(F.length(option) > 5, known_type(F.substring(option, 6, 1_000_000)))
    kind = F.when(~F.coalesce(other, F.lit(False)), F.coalesce(wanted, type_of_name(name)))
    status = F.when(other, int(ErrorCode.INVALID_ARGUMENT)).when(kind.isNull(), int(ErrorCode.FAILURE)).otherwise(int(ErrorCode.SUCCESS))
    return kind, status


def resolve_save(name: str, options: list[str] | tuple[str, ...] = ()) -> str:
    """The file type of a save: TYPE= of the options, else by the name. Other options are invalid arguments."""
    kind = None
    for o in options:
        if not o.startswith("TYPE="):
            raise SolidError(ErrorCode.INVALID_ARGUMENT, f"unknown option {o}")
        kind = o[5:]
    if kind:
        return kind if kind in FILE_TYPES else "NOT_DEFINED"
    for kind, parts in EXTENSIONS.items():
        if any(p in name or p.upper() in name for p in parts):
            return kind
    raise SolidError(ErrorCode.FAILURE, "unknown file extension and no file type")


def save_tables(tables: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> None:
    """One Parquet table each under ``path``; entities clustered by dimension."""
    for name, df in tables.items():
        out = df.sortWithinPartitions("dim") if "dim" in df.columns else df
        writer = out.write.mode(mode)
        (writer.partitionBy("model_id") if "model_id" in df.columns and len(df.columns) > 1 else writer).parquet(f"{path}/{name}")
