"""Listing of the files under a location."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stockweek.functions.dates import as_date


def list_files(spark: SparkSession, location: str) -> DataFrame:
    """Path, length and modification time of every file below; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(location)
        .select("path", "length", "modificationTime")
    )


# Fixed value: the file that a finished write leaves in its folder.
COMMITTED = "_SUCCESS"


def list_committed(spark: SparkSession, location: str, day: date | str) -> DataFrame:
    """Path of every snapshot of one day directly at a location that is there as a whole.

    A file counts as it is, a folder once its write has left the commit marker.
    Only names of that day are listed, and of a folder only the marker is looked
    for, so history and part files cost nothing. No such place is empty.
    """
    files = spark._jvm.org.apache.hadoop.fs
    pattern = files.Path(f"{location.rstrip('/')}/*_{as_date(day).isoformat()}.csv")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(pattern) or []:
        if status.isFile() or system.exists(files.Path(status.getPath(), COMMITTED)):
            found.append((status.getPath().toString(),))
    return spark.createDataFrame(found, "path string")
