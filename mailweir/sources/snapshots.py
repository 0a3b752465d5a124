"""Snapshots of a mail table.

Files of a mail table never change: a load only adds some. A snapshot is therefore a
list of file names, made without reading or copying a row. Only replacing a table would
remove files that a snapshot names, so ``write_mail`` and ``restore`` move the
replaced table aside, as one folder. A table keeps its snapshots under one root.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailweir.schemas import MAIL
from mailweir.sources.tables import (
    aside, empty_mail, file_system, generation, path_exists, settle, write_mail,
)

STAMP = "snapshot_ts"
MANIFEST = "file string, bytes bigint, home string, generation string"


def stamp(moment: dt.datetime) -> str:
    """Name of a snapshot: sortable, to the second, and finer if the moment is."""
    return moment.strftime("%Y%m%d_%H%M%S_%f" if moment.microsecond else "%Y%m%d_%H%M%S")


def moment_of(name: str) -> dt.datetime:
    """The moment a snapshot's name stands for."""
    form = "%Y%m%d_%H%M%S_%f" if name.count("_") == 2 else "%Y%m%d_%H%M%S"
    return dt.datetime.strptime(name, form).replace(tzinfo=dt.timezone.utc)


def snapshot(
    spark: SparkSession, table: str, root: str, at: dt.datetime | None = None
) -> str | None:
    """List a table's files under ``root/snapshot_ts=<time>``; None if there is no table yet.

    Spark lists the folders in parallel and notes each file's name and size; what is in the
    files is not read.
    """
    settle(spark, table)
    if not path_exists(spark, table):
        return None
    name = stamp(at or dt.datetime.now(dt.timezone.utc))
    fs, folder = file_system(spark, table)
    home = fs.makeQualified(folder).toString()
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(table)
    )
    files.select(
        F.substring("path", F.lit(len(home) + 2), F.length("path")).alias("file"),
        F.col("length").alias("bytes"), F.lit(home).alias("home"),
        F.lit(generation(spark, table, create=True)).alias("generation"),
    ).write.mode("errorifexists").parquet(f"{root}/{STAMP}={name}")
    return name


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """Names of the snapshots, oldest first. Lists folders, reads no data."""
    if not path_exists(spark, root):
        return []
    fs, folder = file_system(spark, root)
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{STAMP}="))


def manifest(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """The files of one snapshot, by default the latest."""
    names = snapshots(spark, root)
    if not names or (name or names[-1]) not in names:
        raise FileNotFoundError(f"no snapshot {name or ''} under {root}")
    return spark.read.schema(MANIFEST).parquet(f"{root}/{STAMP}={name or names[-1]}")


def _homes(listed: DataFrame) -> list[tuple[str, str]]:
    """Table and generation of manifests; one pair per snapshot at most."""
    return [tuple(r) for r in listed.select("home", "generation").distinct().collect()]


def read_snapshot(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """One snapshot, by default the latest.

    The driver takes the file names, as it does for the scan of any table. A file that is
    gone, because something else than this package replaced the table, is an error.
    """
    listed = manifest(spark, root, name)
    homes = _homes(listed)
    if not homes:
        return empty_mail(spark)
    (home, made), = homes
    base = home if generation(spark, home) == made else aside(home, made)
    files = [f"{base}/{r[0]}" for r in listed.select("file").collect()]
    return spark.read.schema(MAIL).option("basePath", base).parquet(*files)


def restore(spark: SparkSession, root: str, table: str, name: str | None = None) -> None:
    """Write a snapshot back as the table; what the table held stays for its other snapshots."""
    name = name or (snapshots(spark, root) or [None])[-1]
    manifest(spark, root, name)
    write_mail(read_snapshot(spark, root, name), table)


def retain(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Forget all but the ``keep`` latest snapshots; the names of those forgotten.

    A table that was moved aside goes with the last snapshot that names it. Files of the
    live table are never touched.
    """
    names = snapshots(spark, root)
    old, kept = names[: max(len(names) - keep, 0)], names[max(len(names) - keep, 0):]
    needed = {pair for n in kept for pair in _homes(manifest(spark, root, n))}
    dropped = {pair for n in old for pair in _homes(manifest(spark, root, n))} - needed
    # Manifests go first: an interrupted call leaves unnamed files, not names without files.
    for path in [f"{root}/{STAMP}={n}" for n in old] + [aside(*pair) for pair in dropped]:
        fs, folder = file_system(spark, path)
        fs.delete(folder, True)
    return old


def due(last: dt.datetime | None, now: dt.datetime, every: dt.timedelta, force: bool) -> bool:
    """Whether a snapshot is due; forcing makes it so."""
    return force or last is None or now - last >= every


__all__ = [
    "due", "manifest", "moment_of", "read_snapshot", "restore", "retain", "snapshot", "snapshots",
    "stamp",
]
