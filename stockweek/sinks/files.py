"""Parquet facts, CSV dimensions and dated CSV snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.functions.dates import as_date, snapshot_name
from stockweek.functions.sizes import size_of
from stockweek.operators.hot_keys import HotKeys, hot_key_sketch, read_sketch
from stockweek.operators.weekly import WEEK_KEYS
from stockweek.session import settings
from stockweek.sources.csv import CSV_FORMAT
from stockweek.sources.listing import COMMITTED, list_files
from stockweek.sources.schemas import FACT_DATES

# Fixed value: largest file of a snapshot, in bytes.
MAX_FILE_BYTES = 107_772_160

# A fact takes a fifth less room than with Spark's default.
FACT_COMPRESSION = "zstd"

# What a write has shuffled is dropped once it is done, not when the driver's collector gets to it.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Tasks for each core that list the folders of a fact.
LISTING_WAVES = 4


def write_fact(
    fact: DataFrame,
    path: str,
    partition_column: str,
    partition_overwrite: str = "static",
    finish: Callable[[DataFrame], DataFrame] | None = None,
    laid_out: bool = False,
) -> None:
    """Overwrite the fact as parquet, one folder per value of the partition column.

    A fact ``laid_out`` has the rows of each value in few tasks, and is not shuffled. Of any other, rebalancing brings a value's rows together so that it gets few files, and
    splits a value too large for one task. ``partition_overwrite="dynamic"``
    replaces only the values present in ``fact``. ``finish`` adds columns that need not
    be shuffled, as they follow from the others of their row.
    """
    column = partition_column.upper()
    order = [column] + [key for key in WEEK_KEYS if key != column]
    dealt = fact if laid_out else fact.hint("rebalance", column)
    rows = dealt.sortWithinPartitions(*order)
    with settings(fact.sparkSession, DROP_SHUFFLES):
        (
            (finish(rows) if finish else rows)
            .write.partitionBy(column)
            .mode("overwrite")
            .option("partitionOverwriteMode", partition_overwrite)
            .option("compression", FACT_COMPRESSION)
            .parquet(path)
        )


def open_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact as it lies on disk, where the partition column comes last.

    Its folders may be many. A few tasks for each core list them all, instead of a task for each.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = LISTING_WAVES * spark.sparkContext.defaultParallelism
    with settings(spark, {name: str(min(int(spark.conf.get(name)), tasks))}):
        return spark.read.parquet(path)


def read_fact(spark, path: str, columns: list[str]) -> DataFrame:
    """The fact with its columns in order; on disk the partition column comes last."""
    return open_fact(spark, path).select(*columns)


def _few_files(df: DataFrame) -> DataFrame:
    """One partition if the table is measured to fit one file, else as many as its size needs."""
    if size_of(df).bytes <= MAX_FILE_BYTES:
        return df.repartition(1)
    return df.hint("rebalance")


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV dataset with header lines.

    A table measured to fit ``MAX_FILE_BYTES`` makes one file, a larger one several;
    the rows are the same. Spaces around a text are trimmed, as Spark does by default.
    """
    _few_files(df).write.mode("overwrite").options(**CSV_FORMAT).csv(path)


def _widest_row(schema: T.StructType) -> int | None:
    """Most bytes a row without text can take as CSV, or None if it holds text."""
    widest = {T.IntegerType: 11, T.LongType: 20, T.DoubleType: 25, T.DateType: 13, T.BooleanType: 5}
    total = 0
    for field in schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            total += field.dataType.precision + 3
        elif type(field.dataType) in widest:
            total += widest[type(field.dataType)]
        else:
            return None
        total += 1
    return total


# Kept in a snapshot's folder, where scans do not look: its files, and the keys of most stock rows.
MANIFEST, HOT_KEYS = "_manifest", "_hot_keys"


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _files_written(spark: SparkSession, folder: str) -> DataFrame:
    """Name, rows and bytes of every file of a snapshot, as they are found on disk."""
    lines = spark.read.text(folder).select(F.col("_metadata.file_name").alias("FILE"))
    rows = lines.groupBy("FILE").agg((F.count(F.lit(1)) - 1).alias("ROWS"))
    name = F.element_at(F.split("path", "/"), -1).alias("FILE")
    files = list_files(spark, folder).select(name, F.col("length").alias("BYTES"))
    return files.join(rows, "FILE", "left").select("FILE", F.coalesce("ROWS", F.lit(0)).alias("ROWS"), "BYTES")


def write_snapshot(
    df: DataFrame, table: str, location: str, day: date | str, null_value: str = ""
) -> int:
    """Write a table's dated snapshot in place of an older one; returns the rows written.

    The rows are counted as they are written, in the last stage, where a task that
    is run again does not count twice. Facts are written by the tasks that read
    them, without a shuffle, in files below the size limit; dimensions make one
    file if they fit. A null is an empty field, or the given text.

    The folder is written under another name, with a manifest of its files at last, and
    takes the place of an older one as a whole. If the write fails, the older one stays. A
    line break in a text, which no scan would read back, raises. The pass that writes the
    inventory also finds the keys with most rows, which the mart job reads.
    """
    spark, base = df.sparkSession, location.rstrip("/")
    path, fresh = f"{base}/{snapshot_name(table, as_date(day))}", f"{base}/_writing-{uuid.uuid4().hex}"
    counted = Observation(f"{table}-{as_date(day)}")
    laid_out = df if table in FACT_DATES else _few_files(df)
    counts = [F.count(F.lit(1)).alias("rows")]
    if table == "inventory":
        counts.append(hot_key_sketch().alias("hot"))
    writer = (
        laid_out.observe(counted, *counts)
        .write.options(**CSV_FORMAT)
        .option("compression", "none")
        .option("nullValue", null_value)
        # A dump leaves a text as it is; by default the writer would trim it.
        .options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    )
    width = _widest_row(df.schema)
    if width is not None:
        writer = writer.option("maxRecordsPerFile", MAX_FILE_BYTES // width)
    system, target = _file_system(spark, path)
    temporary = _file_system(spark, fresh)[1]
    try:
        writer.csv(fresh)
        rows = int(counted.get["rows"])
        if table == "inventory":
            sketch = [(rows, counted.get["hot"])]
            spark.createDataFrame(sketch, "TOTAL bigint, SKETCH string").coalesce(1).write.parquet(f"{fresh}/{HOT_KEYS}")
        _files_written(spark, fresh).write.parquet(f"{fresh}/{MANIFEST}")
        found = spark.read.parquet(f"{fresh}/{MANIFEST}").agg(F.sum("ROWS")).first()[0] or 0
        if found != rows:
            raise ValueError(f"{table}: {rows} rows written make {found} lines")
        if system.exists(target):
            system.delete(target, True)
        if not system.rename(temporary, target):
            raise OSError(f"{fresh} could not be renamed to {path}")
    except BaseException:
        system.delete(temporary, True)
        raise
    return rows


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """Name, rows and bytes of a snapshot's files, or None if it has no manifest."""
    system, folder = _file_system(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if not system.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, COMMITTED)):
        return None
    return spark.read.parquet(f"{path.rstrip('/')}/{MANIFEST}")


def lost_files(spark: SparkSession, path: str) -> DataFrame | None:
    """What the manifest names and the folder lacks or has in another size; None without a manifest."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        return None
    name = F.element_at(F.split("path", "/"), -1).alias("FILE")
    present = list_files(spark, path).select(name, F.col("length").alias("BYTES"))
    return manifest.join(present, ["FILE", "BYTES"], "left_anti")


def read_hot_keys(spark: SparkSession, path: str | list[str]) -> HotKeys | None:
    """The keys with most rows as found when the inventory was written; None if that is not known."""
    paths = [path] if isinstance(path, str) else path
    total, keys = 0, {}
    for one in paths:
        system, folder = _file_system(spark, f"{one.rstrip('/')}/{HOT_KEYS}")
        if not system.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, COMMITTED)):
            return None
        rows, sketch = spark.read.parquet(f"{one.rstrip('/')}/{HOT_KEYS}").first()
        total += rows
        for *key, n in read_sketch(rows, sketch).keys:
            keys[tuple(key)] = keys.get(tuple(key), 0) + n
    return HotKeys(total, [(*key, n) for key, n in keys.items()])
