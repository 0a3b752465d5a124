"""Mail tables: Parquet partitioned by day, and the JSON interchange layout."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mailweir.functions.dates import iso_instant, utc_day
from mailweir.functions.text import nullish_default
from mailweir.schemas import BODY, MAIL, MAIL_JSON
from mailweir.sources.files import create, file_system, move, path_exists, read_text, remove

DAY = "mail_date"
#: An empty file in a table that has snapshots: what follows names the table's contents since
#: they were last replaced. Readers of the table skip it.
GENERATION = "_generation-"


def generation(spark: SparkSession, table: str, create: bool = False) -> str | None:
    """The name of a table's contents since they were last replaced, given when first asked
    for with ``create``."""
    if path_exists(spark, table):
        fs, folder = file_system(spark, table)
        for status in fs.listStatus(folder):
            if status.getPath().getName().startswith(GENERATION):
                return status.getPath().getName()[len(GENERATION):]
    if not create:
        return None
    name = uuid.uuid4().hex
    fs, mark = file_system(spark, f"{table}/{GENERATION}{name}")
    fs.create(mark).close()
    return name


def aside(table: str, name: str) -> str:
    """Where a replaced table with snapshots is kept."""
    return f"{table.rstrip('/')}-replaced/{name}"


def id_home(table: str) -> str:
    """Where the index of a table's ids is, if it has one."""
    return f"{table.rstrip('/')}-ids"


def _mark(table: str) -> str:
    """The file that says which folder is about to become the table."""
    return f"{table.rstrip('/')}-replacing"


def live(spark: SparkSession, table: str) -> str | None:
    """The folder that holds the table's rows now; None if there is no table.

    Between a replaced table's leaving and the new one's coming that is the new one's own folder.
    """
    if path_exists(spark, table):
        return table
    coming = read_text(spark, _mark(table))
    return coming if coming and path_exists(spark, coming) else None


def settle(spark: SparkSession, table: str) -> None:
    """Finish a replacement that has been announced, from whatever step it was left at.

    A table that snapshots name is moved aside for them, another one is deleted. The index of
    ids goes first, as it speaks of rows that leave.
    """
    coming = read_text(spark, _mark(table))
    if coming and path_exists(spark, coming):
        remove(spark, id_home(table))
        if path_exists(spark, table):
            name = generation(spark, table)
            gone = aside(table, name) if name else f"{coming}-before"
            move(spark, table, gone)
        move(spark, coming, table)
        remove(spark, f"{coming}-before")
    remove(spark, _mark(table))


def replace(spark: SparkSession, table: str, coming: str) -> None:
    """Let a folder that is completely written take the table's place."""
    create(spark, _mark(table), coming)
    settle(spark, table)


def empty_mail(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MAIL)


def conform(mail: DataFrame) -> DataFrame:
    """Bring columns into table order; a column the input lacks is NULL."""
    missing_day = DAY not in mail.columns
    if missing_day:
        mail = mail.withColumn(DAY, utc_day("parsed_ts"))
    have = set(mail.columns)
    return mail.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MAIL.fields
        ]
    )


def read_mail(spark: SparkSession, path: str) -> DataFrame:
    """A mail table; a path that does not exist yet is an empty table."""
    folder = live(spark, path)
    return spark.read.schema(MAIL).parquet(folder) if folder else empty_mail(spark)


def spread_by_day(mail: DataFrame) -> DataFrame:
    """One partition per day, except that small days share one and large days are split.

    The rebalance is adaptive: a day with a third of all rows, or the rows
    without a day, are written by many tasks.
    """
    return mail.hint("rebalance", F.col(DAY)).sortWithinPartitions(
        F.col(DAY), F.col("parsed_ts").desc_nulls_last(), F.col("id")
    )


def write_mail(mail: DataFrame, path: str, mode: str = "overwrite", ids: DataFrame | None = None) -> int:
    """Write a table partitioned by day, latest first inside each file; the rows written.

    The rows are counted by the writing tasks themselves, after the last shuffle,
    where Spark counts a task once however often it is tried. Neither the input
    nor the table has to be read again to know the number. A table is replaced by writing
    beside it and then taking its place, so that there is the old or the new one at any time;
    it loses its index of ids. Appending to a table with
    an index files the ids first: ``ids`` if they are at hand in a cheaper form.
    """
    from mailweir.sources import idindex

    spark = mail.sparkSession
    settle(spark, path)

    def write(folder: str) -> int:
        written = Observation()
        counted = spread_by_day(conform(mail)).observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.mode(mode).partitionBy(DAY).parquet(folder)
        return written.get["rows"]

    if mode == "append" and idindex.exists(spark, path):
        return idindex.appended(spark, path, mail.select("id") if ids is None else ids, lambda: write(path))
    if mode != "overwrite":
        return write(path)
    # The rows may come from the table itself, which stays until all are written.
    coming = f"{path.rstrip('/')}-coming-{uuid.uuid4().hex}"
    rows = write(coming)
    replace(spark, path, coming)
    return rows


def _from_json_layout(rows: DataFrame) -> DataFrame:
    offset = F.regexp_extract("parsedDate", r"([+-])(\d{2}):(\d{2})", 0)
    minutes = (
        F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int")
    )
    dated = rows.withColumn("parsed_ts", iso_instant(F.col("parsedDate")))
    return conform(
        dated.select(
            "id", "threadId", "internalDate", "date", "parsed_ts",
            F.when(
                F.col("parsed_ts").isNotNull(),
                F.when(F.startswith(offset, F.lit("-")), -minutes)
                .otherwise(nullish_default(minutes, 0)),
            ).alias("tz_offset_min"),
            F.col("parsedDate").alias("parsed_iso"),
            "from", "subject",
            F.when(F.startswith("body", F.lit("{")), F.from_json("body", BODY)).alias("body"),
            "status", "snippet", "labelIds",
            iso_instant(F.col("_imported_at")).alias("_imported_at"),
        )
    )


def read_mail_json(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Mail records in the JSON interchange layout; a missing path is an empty table.

    ``lines``: one object per line. ``indented``: one array, four spaces per
    level, as the standard library writes it with ``indent=4``; its records are
    told apart by their line breaks, so a large file is read by many tasks.
    ``array``: an array in any layout, taken apart by its quotes and braces, which many tasks
    can do as well, in more steps. A body that is the empty string is NULL.
    """
    if not path_exists(spark, path):
        return empty_mail(spark)
    if layout == "lines":
        return _from_json_layout(spark.read.schema(MAIL_JSON).json(path))
    if layout == "array":
        from mailweir.sources.jsonarray import read_objects

        objects = read_objects(spark, path).select(F.from_json("value", MAIL_JSON, {"mode": "FAILFAST"}).alias("r"))
        return _from_json_layout(objects.select("r.*"))
    if layout != "indented":
        raise ValueError(f"unknown layout: {layout}")
    # A string cannot hold a raw line break, so this separator only occurs between records.
    pieces = spark.read.option("lineSep", "\n    {\n").text(path)
    # What follows the object is its closing bracket, a comma or the end of the array.
    inner = F.regexp_replace("value", r"\n    \},?\s*\]?\s*\z", "")
    records = pieces.filter(~F.col("value").rlike(r"\A\s*\[\s*\]?\s*\z"))
    parsed = F.from_json(F.concat(F.lit("{"), inner, F.lit("}")), MAIL_JSON, {"mode": "FAILFAST"})
    return _from_json_layout(records.select(parsed.alias("r")).select("r.*"))


def write_mail_json(mail: DataFrame, path: str, layout: str = "lines") -> None:
    """Export in the interchange layout, latest first over all files.

    ``lines``: one object per line. ``array``: every file is one array.
    """
    rows = conform(mail).orderBy(F.col("parsed_ts").desc_nulls_last(), F.col("id")).select(
        "id", "threadId", "internalDate", "date", F.col("parsed_iso").alias("parsedDate"),
        "from", "subject", "body", "status", "snippet", "labelIds", "_imported_at",
    )
    if layout == "lines":
        rows.write.mode("overwrite").json(path)
        return
    if layout != "array":
        raise ValueError(f"unknown layout: {layout}")
    from mailweir.sources.jsonarray import write_objects

    write_objects(rows.select(F.to_json(F.struct(*rows.columns)).alias("value")), path)


__all__ = [
    "aside", "conform", "empty_mail", "file_system", "generation", "id_home", "live", "path_exists",
    "read_mail", "read_mail_json", "replace", "settle", "spread_by_day", "write_mail", "write_mail_json",
]
