"""Small files beside published tables, through the Hadoop file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if it does not exist."""
    files, location = _opened(spark, folder)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def sizes_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes of every file at any depth below a folder, by path."""
    files, location = _opened(spark, folder)
    found, sizes = files.listFiles(location, True), {}
    while found.hasNext():
        status = found.next()
        sizes[status.getPath().toString()] = status.getLen()
    return sizes


def read_text(spark: SparkSession, path: str) -> str:
    files, location = _opened(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, location = _opened(spark, path)
    stream = files.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def create_marker(spark: SparkSession, path: str) -> None:
    """Create an empty file; it appears at once, and its name is all it says."""
    files, location = _opened(spark, path)
    if not files.createNewFile(location):
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    files, location = _opened(spark, path)
    files.delete(location, True)
