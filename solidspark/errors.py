"""Error codes of the modelling operations. State is per call: an exception on the driver, a status column in batches."""

from __future__ import annotations

from enum import IntEnum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Code names in order, with their texts.
TEXTS = {
    "SUCCESS": "",
    "MESH_ALREADY_LOADED": "Mesh already loaded",
    "FILE_NOT_FOUND": "Could not read file",
    "FILE_WRITE_ERROR": "File write failed",
    "NIL_ARRAY": "NULL or empty array",
    "BAD_ARRAY_SIZE": "Invalid array size",
    "BAD_ARRAY_DIMENSION": "Invalid array dimension",
    "INVALID_ENTITY_HANDLE": "Invalid entity handle",
    "INVALID_ENTITY_COUNT": "Invalid entity count",
    "INVALID_ENTITY_TYPE": "Invalid entity type",
    "INVALID_ENTITY_TOPOLOGY": "Invalid entity topology",
    "BAD_TYPE_AND_TOPO": "Bad type and/or topology",
    "ENTITY_CREATION_ERROR": "Entity creation failed",
    "INVALID_TAG_HANDLE": "Invalid Tag",
    "TAG_NOT_FOUND": "Tag does not exist",
    "TAG_ALREADY_EXISTS": "Tag name conflict",
    "TAG_IN_USE": "Tag name conflict",
    "INVALID_ENTITYSET_HANDLE": "Invalid entity set handle",
    "INVALID_ITERATOR_HANDLE": "Invalid iterator handle",
    "INVALID_ARGUMENT": "Invalid argument",
    "MEMORY_ALLOCATION_FAILED": "Out of memory",
    "NOT_SUPPORTED": "Feature not supported",
    "FAILURE": "Unknown failure or internal error",
}

ErrorCode = IntEnum("ErrorCode", {name: k for k, name in enumerate(TEXTS)})


class SolidError(ValueError):
    def __init__(self, code: ErrorCode, text: str | None = None):
        self.code = code
        super().__init__(text or describe(code))


def describe(code: int) -> str:
    return TEXTS[ErrorCode(code).name]


class LastError:
    """The last error of one model; success over success is ignored."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.code, self.text = ErrorCode.SUCCESS, ""

    def set(self, code: ErrorCode, text: str | None = None) -> None:
        if code != ErrorCode.SUCCESS or self.code != ErrorCode.SUCCESS:
            self.code, self.text = ErrorCode(code), text or describe(code)


def error_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(int(ErrorCode[n]), n, t) for n, t in TEXTS.items()], "code int, name string, text string")


def text_of(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, text in TEXTS.items():
        out = F.when(code == int(ErrorCode[name]), text).otherwise(out)
    return out
