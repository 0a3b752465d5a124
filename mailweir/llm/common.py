"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but a space, tab or line end.
WORD = r"[^\x20\x09-\x0D]+"

#: The columns of ``documents``, which the pipeline's stages pass on.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

# Lower-cases A-Z and turns every other ASCII character but a digit or letter into a space.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words made of digits, letters and anything beyond ASCII, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_PLAIN).split() if text else []


def spaced_words(text: str | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased, as UTF-8.

    ``bytes.split`` and ``bytes.lower`` know ASCII only, which is what is wanted.
    """
    return text.encode("utf-8", "replace").lower().split() if text else []


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, list] | None], schema: str,
    types: pa.Schema,
) -> DataFrame:
    """``mapInArrow`` for a function that turns a batch into columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = work(batch) if batch.num_rows else None
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in types], schema=types
                )

    return df.mapInArrow(run, schema)
