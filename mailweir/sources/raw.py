"""Landed raw messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mailweir.schemas import RAW

CORRUPT = "_corrupt_record"


def read_raw(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """Raw messages, one JSON object per line, any number of files.

    A line that is no JSON object gives a row of NULLs; with ``rejects`` its text
    is in ``_corrupt_record``, so that it can be set aside instead of lost.
    """
    schema = RAW
    if rejects:
        schema = T.StructType([*RAW.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def write_raw(raw: DataFrame, path: str, file_rows: int = 0) -> None:
    """Land raw messages, one JSON object per line.

    Every task writes its own rows, in files of ``file_rows`` at most if that is given.
    """
    raw.select(*RAW.fieldNames()).write.mode("append").option("maxRecordsPerFile", file_rows).json(path)
