"""JSON arrays of objects, however they are laid out, read and written by many tasks.

A file is cut behind every closing brace, wherever it stands, which Spark's text reader does for
any part of a file by itself. What a piece means follows from what is before it: an odd number of
quotes puts its beginning inside a string, and the braces outside strings give the depth. Both
are running sums, taken per part of the file and carried over from part to part by one row each.
A brace that closes the outermost object ends a record; the pieces since the last such brace
are joined again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mailweir.session import stage

# Quotes that begin or end a string are those left without escapes; a string ends at its quote
# or with the piece.
_ESCAPED = r"(?s)\\."
_STRING = r'(?s)"[^"]*(?:"|\z)'


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.translate(text, what, ""))


def _before(column: str) -> Column:
    """Sum of a column over a file's part, before the row."""
    rows = Window.partitionBy("file", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(rows), F.lit(0))


def _carried(rows: DataFrame, column: str) -> DataFrame:
    """Sum of a column over a file's earlier parts, one row per part: ``file, part, _carry``."""
    earlier = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file", "part").agg(F.sum(column).alias("_sum"))
    return totals.select("file", "part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carry"))


def _running(rows: DataFrame, column: str) -> DataFrame:
    """The rows with ``_at``: the column's sum over all that is before in the file."""
    local = rows.withColumn("_local", _before(column))
    joined = local.join(_carried(rows, column), ["file", "part"])
    return joined.withColumn("_at", F.col("_local") + F.col("_carry")).drop("_local", "_carry")


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of every object of the arrays in the files of a path.

    Works for one object a line as well. Text that is no JSON gives pieces that do not parse.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("row"), "value",
    )
    # Written once: what follows is joined by the places given here.
    pieces = stage(pieces, "json-pieces")
    bare = F.regexp_replace("value", _ESCAPED, "")
    quoted = _running(pieces.withColumn("quotes", _count(bare, '"')), "quotes")
    inside = F.col("_at") % 2 == 1
    outside = F.regexp_replace(F.concat(F.when(inside, '"').otherwise(""), bare), _STRING, "")
    # The brace the piece ends at closes an object unless it is part of a string.
    closes = ((F.col("_at") + F.col("quotes")) % 2 == 0).cast("int")
    marked = stage(
        quoted.select("file", "part", "row", closes.alias("closes"), (_count(outside, "{") - closes).alias("change")),
        "json-depths",
    )
    depths = _running(marked, "change")
    last = (F.col("closes") == 1) & (F.col("_at") + F.col("change") == 0)
    ends = stage(depths.select("file", "part", "row", last.cast("int").alias("ends")), "json-ends")
    numbered = _running(ends, "ends").select("file", "part", "row", F.col("_at").alias("record"))
    together = F.transform(
        F.array_sort(F.collect_list(F.struct("part", "row", "value"))), lambda p: p["value"]
    )
    texts = (
        pieces.join(numbered, ["file", "part", "row"]).groupBy("file", "record")
        .agg(F.concat(F.array_join(together, "}"), F.lit("}")).alias("value"))
    )
    record = F.regexp_replace("value", r"\A[\s,\[]+", "")
    # What follows the last object is the array's end.
    return texts.select(record.alias("value")).filter(~F.col("value").rlike(r"\A\s*\]?\s*\}?\z"))


def write_objects(rows: DataFrame, path: str) -> None:
    """Write rows of one column ``value``, texts of objects, as one array per ``file=<n>``, in their order."""
    ordered = rows.withColumns({"file": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    # As many rows as a file has records, which is what its task holds anyway.
    of_file = Window.partitionBy("file").orderBy("_row")
    first = F.when(F.lag("_row").over(of_file).isNull(), "[").otherwise(",")
    last = F.when(F.lead("_row").over(of_file).isNull(), "]").otherwise("")
    lines = ordered.select("file", F.concat(first, "value", last).alias("value"))
    lines.write.mode("overwrite").partitionBy("file").text(path)
