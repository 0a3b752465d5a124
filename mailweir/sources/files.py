"""Single files and folders on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system a path names, and the path in its terms."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = file_system(spark, path)
    return fs.exists(folder)


def names(spark: SparkSession, path: str, prefix: str = "") -> set[str]:
    """Names in a folder that begin so, without the beginning."""
    if not path_exists(spark, path):
        return set()
    fs, folder = file_system(spark, path)
    found = (f.getPath().getName() for f in fs.listStatus(folder))
    return {n[len(prefix):] for n in found if n.startswith(prefix)}


def create(spark: SparkSession, path: str, text: str = "") -> bool:
    """Write a small file that is not there yet; False if it is."""
    fs, name = file_system(spark, path)
    if fs.exists(name):
        return False
    try:
        out = fs.create(name, False)
    except Exception as error:
        # Another writer was first.
        if fs.exists(name):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text; of a file that is not there, nothing."""
    fs, name = file_system(spark, path)
    if not fs.exists(name):
        return ""
    data = fs.open(name)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, name = file_system(spark, path)
    target = file_system(spark, to)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(name, target):
        raise OSError(f"cannot move {path} to {to}")


def remove(spark: SparkSession, path: str) -> None:
    fs, name = file_system(spark, path)
    fs.delete(name, True)
