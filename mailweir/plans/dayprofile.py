"""The profile of a mail table, kept beside it as partial figures per day.

Files of a mail table never change, a load only adds some. So a profile is a set of parts: each
covers the files it lists and holds, per day, figures that can be merged (counts, sums, extremes)
and exact counts of senders, subject keywords and whatever else is to be counted. ``refresh``
adds a part for the files no part covers. It reads the bodies of these alone; only the id column
is read in all files, to see which ids have come again. Reports merge parts and read no mail.

``<table>-profile/part-<name>`` holds a part, which counts from the moment its mark
``ready-<generation>-<name>`` is there. Of the marks only those of the latest generation count:
``compact`` merges all parts into one of the next generation, and where a file has gone, because
the table was replaced, a part of the next generation covers all files anew. Broken off at any
step, the parts before count. As the table, a profile has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.functions.dates import utc_day
from mailweir.functions.text import code_points, is_keyword, long_words, size_or_zero
from mailweir.operators.order import sample_subjects, top_k
from mailweir.schemas import MAIL
from mailweir.session import stage
from mailweir.sources.files import create, file_system, names, path_exists, read_text, remove
from mailweir.sources.tables import read_mail, settle

#: Subjects that a part keeps for the report's sample.
SAMPLE = 5

_COUNTS = ("total", "lengths", "length_sum", "urls", "missing_dates", "missing_bodies", "missing_subjects",
           "empty_texts", "missing_ids")
_LEAST, _MOST = ("earliest", "min_length"), ("latest", "max_length")
_SCHEMAS = {
    "figures": "day date, earliest timestamp, latest timestamp, min_length bigint, max_length bigint, "
               + ", ".join(f"{c} bigint" for c in _COUNTS),
    "items": "day date, kind string, item string, n bigint",
    "sample": "id string, subject string",
    "repeats": "ids bigint",
    "files": "file string",
}

Counted = Mapping[str, Column]


def home(table: str) -> str:
    """Where a table's profile is."""
    return f"{table.rstrip('/')}-profile"


def _parts(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """The latest generation and the names of its parts."""
    ready = [m.split("-") for m in names(spark, home(table), "ready-")]
    last = max((int(generation) for generation, _ in ready), default=0)
    return last, sorted(name for generation, name in ready if int(generation) == last)


def _read(spark: SparkSession, table: str, what: str) -> DataFrame:
    paths = [f"{home(table)}/part-{name}/{what}" for name in _parts(spark, table)[1]]
    schema = _SCHEMAS[what]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _kinds(counted: Counted) -> str:
    """What a profile counts, by name and expression."""
    return "\n".join(f"{name}: {counted[name]}" for name in sorted(counted))


def _stored_files(spark: SparkSession, table: str) -> DataFrame:
    """The table's files, by their place in it. Spark lists the folders and reads no file."""
    if not path_exists(spark, table):
        return spark.createDataFrame([], _SCHEMAS["files"])
    fs, folder = file_system(spark, table)
    start = len(fs.makeQualified(folder).toString()) + 2
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(table)
    )
    return found.select(F.substring("path", F.lit(start), F.length("path")).alias("file"))


def figures_by_day(mail: DataFrame) -> DataFrame:
    """Figures of each day that can be merged, from one scan."""
    length, links = code_points(F.col("body.clean_text")), size_or_zero(F.col("body.urls"))
    none = lambda c: F.count_if(F.col(c).isNull())
    return mail.groupBy(utc_day("parsed_ts").alias("day")).agg(
        F.min("parsed_ts").alias("earliest"), F.max("parsed_ts").alias("latest"),
        F.min(length).cast("bigint").alias("min_length"), F.max(length).cast("bigint").alias("max_length"),
        F.count(F.lit(1)).alias("total"), F.count(length).alias("lengths"),
        F.coalesce(F.sum(length), F.lit(0)).cast("bigint").alias("length_sum"),
        F.sum(links).cast("bigint").alias("urls"),
        none("parsed_ts").alias("missing_dates"), none("body").alias("missing_bodies"),
        none("subject").alias("missing_subjects"),
        F.count_if(F.col("body.clean_text") == "").alias("empty_texts"), none("id").alias("missing_ids"),
    )


def items_by_day(mail: DataFrame, counted: Counted) -> DataFrame:
    """How often each sender, keyword and entry of a ``counted`` array occurs on each day."""
    day = utc_day("parsed_ts").alias("day")
    rows = mail.select(day, F.lit("sender").alias("kind"), F.col("from").alias("item"))
    words = mail.select(day, F.lit("keyword").alias("kind"), F.explode(long_words(F.col("subject"))).alias("item"))
    rows = rows.unionByName(words.filter(is_keyword(F.col("item"))))
    for name in sorted(counted):
        rows = rows.unionByName(mail.select(day, F.lit(name).alias("kind"), F.explode(counted[name]).alias("item")))
    return rows.groupBy("day", "kind", "item").agg(F.count(F.lit(1)).alias("n"))


def _repeats(new: DataFrame, stored: DataFrame | None) -> DataFrame:
    """How many ids have come to occur more than once by the new rows; ``stored`` holds these and
    those before, None if there were none before."""
    counts = new.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    if stored is None:
        return counts.agg(F.count_if(F.col("n") > 1).alias("ids"))
    # The new ids are staged, so that a small load is broadcast to the scan of the id column.
    counts = stage(counts, "profile-ids")
    now = stored.select("id").join(counts, "id", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("now"))
    return now.join(counts, "id").agg(F.count_if((F.col("now") > 1) & (F.col("now") - F.col("n") <= 1)).alias("ids"))


def _publish(spark: SparkSession, table: str, generation: int, kinds: str, contents: Mapping[str, DataFrame]) -> None:
    """Write a part, let it count, and remove parts of earlier generations."""
    name = uuid.uuid4().hex
    for what, rows in contents.items():
        rows.write.parquet(f"{home(table)}/part-{name}/{what}")
    create(spark, f"{home(table)}/ready-{generation}-{name}", kinds)
    for mark in names(spark, home(table), "ready-"):
        if int(mark.split("-")[0]) < generation:
            remove(spark, f"{home(table)}/ready-{mark}")
    # What has no mark now is of an earlier generation, or was never finished.
    for part in names(spark, home(table), "part-") - set(_parts(spark, table)[1]):
        remove(spark, f"{home(table)}/part-{part}")


def pending(spark: SparkSession, table: str) -> list[str]:
    """Files that the profile does not cover yet. The driver takes their names, as for any scan."""
    covered = _read(spark, table, "files")
    return sorted(r[0] for r in _stored_files(spark, table).join(covered, "file", "left_anti").collect())


def refresh(spark: SparkSession, table: str, counted: Counted | None = None) -> int:
    """Bring the profile up to the table; the number of files that were read for it.

    ``counted`` names arrays of strings over the mail's columns whose entries are counted per
    day, such as themes or categories. A profile that has counted something else is made anew.
    """
    settle(spark, table)
    counted = dict(counted or {})
    if {"sender", "keyword"} & set(counted):
        raise ValueError("sender and keyword are counted anyway")
    kinds = _kinds(counted)
    generation, parts = _parts(spark, table)
    stored = stage(_stored_files(spark, table), "profile-stored")
    covered = _read(spark, table, "files")
    same = bool(parts) and read_text(spark, f"{home(table)}/ready-{generation}-{parts[0]}") == kinds
    anew = not same or not covered.join(stored, "file", "left_anti").isEmpty()
    if anew:
        generation, files, mail = generation + 1, stored, read_mail(spark, table)
    else:
        files = stage(stored.join(covered, "file", "left_anti"), "profile-files")
        paths = [f"{table.rstrip('/')}/{r[0]}" for r in files.collect()]
        if not paths:
            return 0
        mail = spark.read.schema(MAIL).option("basePath", table).parquet(*paths)
    _publish(spark, table, generation, kinds, {
        "figures": figures_by_day(mail),
        "items": items_by_day(mail, counted),
        "sample": sample_subjects(mail, SAMPLE),
        "repeats": _repeats(mail, None if anew else read_mail(spark, table)),
        "files": files,
    })
    return files.count()


def _merged(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in _LEAST], *[F.max(c).alias(c) for c in _MOST],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS],
    )


def _item_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys, "item").agg(F.sum("n").alias("n"))


def compact(spark: SparkSession, table: str) -> None:
    """Merge all parts into one."""
    generation, parts = _parts(spark, table)
    if len(parts) < 2:
        return
    kinds = read_text(spark, f"{home(table)}/ready-{generation}-{parts[0]}")
    of = lambda what: _read(spark, table, what)
    _publish(spark, table, generation + 1, kinds, {
        "figures": _merged(of("figures"), "day").select(*of("figures").columns),
        "items": _item_counts(of("items"), "day", "kind").select("day", "kind", "item", "n"),
        "sample": of("sample").orderBy("id", "subject").limit(SAMPLE),
        "repeats": of("repeats").agg(F.sum("ids").alias("ids")),
        "files": of("files"),
    })


def days(spark: SparkSession, table: str) -> DataFrame:
    """One row of figures per day, from the profile as it was last refreshed."""
    return _merged(_read(spark, table, "figures"), "day")


def counts(spark: SparkSession, table: str, kind: str, by_day: bool = False) -> DataFrame:
    """``item, n`` of senders, keywords or another counted kind, over all days or by day."""
    rows = _read(spark, table, "items").filter(F.col("kind") == kind)
    return _item_counts(rows, *(["day"] if by_day else []))


def report(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """The sections of ``quality_report``, from the profile as it was last refreshed."""
    sums = _merged(_read(spark, table, "figures"))
    again = _read(spark, table, "repeats").agg(F.coalesce(F.sum("ids"), F.lit(0)).alias("ids"))
    # Rows without an id form one group, as for ``dup_id_count``. Both sides are one row.
    nameless = sums.select((F.col("missing_ids") > 1).cast("bigint").alias("ids"))
    return {
        "summary": sums.select(
            "total", "earliest", "latest",
            F.try_divide("length_sum", "lengths").alias("avg_length"), "min_length", "max_length",
            F.col("urls").alias("total_urls"), F.try_divide("urls", "total").alias("avg_urls"),
            "missing_dates", "missing_bodies", "missing_subjects", "empty_texts",
        ),
        "daily": days(spark, table).select("day", F.col("total").alias("n")).orderBy(F.col("day").asc_nulls_first()),
        "top_senders": top_k(
            counts(spark, table, "sender").withColumnRenamed("item", "from"), 5, "n", F.col("from").asc_nulls_first()
        ),
        "keywords": top_k(
            counts(spark, table, "keyword").withColumnRenamed("item", "keyword"), 10, "n", F.col("keyword").asc()
        ),
        "sample": _read(spark, table, "sample").orderBy("id", "subject").limit(SAMPLE),
        "duplicates": again.unionAll(nameless).agg(F.sum("ids").alias("duplicate_ids")),
    }
