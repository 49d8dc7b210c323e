"""Raw tables: definition and staged load."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.session import drop_dir, settings
from stockweek.sources.csv import CSV_FORMAT
from stockweek.sources.schemas import RAW_SCHEMAS, raw_ddl, required_columns


def create_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if it is new, and use it."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    spark.sql(f"USE {database}")


def create_raw_table(
    spark: SparkSession, table: str, database: str, location: str | None = None
) -> str:
    """Define the raw table anew, empty; returns its qualified name."""
    name = f"{database}.{table}"
    folder = f"{_loads(spark, table, database, location)}/load-{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({raw_ddl(table)}) USING parquet LOCATION '{folder}'")
    return name


# Raw tables take less room than with Spark's default.
COMPRESSED = {"spark.sql.parquet.compression.codec": "zstd"}

# Fixed value: the text a warehouse reads as null, besides the empty field.
RAW_NULL = "\\N"


def read_staged_csv(spark: SparkSession, table: str, path: str | list[str]) -> DataFrame:
    """Rows of a staged CSV in raw types; a bad field or a missing required value fails the job."""
    staged = (
        spark.read.options(**CSV_FORMAT)
        .option("mode", "FAILFAST")
        .option("nullValue", RAW_NULL)
        .schema(RAW_SCHEMAS[table])
        .csv(path)
    )
    checks = {
        name: F.coalesce(F.col(name), F.raise_error(F.lit(f"{table}.{name} is null")))
        for name in required_columns(table)
    }
    return staged.withColumns(checks) if checks else staged


class StagedLoad(NamedTuple):
    """Rows of a staged CSV that lie in a folder of their own, checked, but not served yet."""

    table: str
    folder: str
    rows: int


def _loads(spark: SparkSession, table: str, database: str, location: str | None) -> str:
    """Where the loads of a table lie: beside any folder that a table has by its name."""
    base = location or spark.catalog.getDatabase(database).locationUri
    return f"{base.rstrip('/')}/loads/{table}"


def stage_raw_table(
    spark: SparkSession,
    table: str,
    path: str | list[str],
    database: str,
    location: str | None = None,
) -> StagedLoad:
    """Write the rows of the staged CSV into a new folder, and check them there.

    A bad field, a missing required value or too long a text fails the load, and so
    does a folder that holds other than the rows written. What it has written is then
    removed, and the table keeps its rows.
    """
    load = uuid.uuid4().hex
    folder = f"{_loads(spark, table, database, location)}/load-{load}"
    name = f"{database}.{table}__{load}"
    spark.sql(f"CREATE TABLE {name} ({raw_ddl(table)}) USING parquet LOCATION '{folder}'")
    try:
        counted = Observation()
        rows = read_staged_csv(spark, table, path)
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        with settings(spark, COMPRESSED):
            rows.write.insertInto(name, overwrite=True)
        written, found = int(counted.get["rows"]), spark.table(name).count()
        if written != found:
            raise ValueError(f"{table}: {written} rows written, {found} found in {folder}")
    except BaseException:
        drop_dir(spark, folder)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the rows stay, they lie outside
    return StagedLoad(table, folder, written)


def drop_staged(spark: SparkSession, staged: StagedLoad) -> None:
    """Remove a load that is not going to be served."""
    drop_dir(spark, staged.folder)


def _types(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(field.name, field.dataType) for field in schema.fields]


def _drop_old_loads(spark: SparkSession, folders: str, keep: set[str]) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folders)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("load-") and name not in keep:
            system.delete(status.getPath(), True)


def switch_raw_table(
    spark: SparkSession, staged: StagedLoad, database: str, location: str | None = None
) -> DataFrame:
    """Let the table serve a staged load from now on.

    The catalog entry gets another location, in one step, so that a reader finds the old rows
    or the new ones. The load before this one stays for readers that have begun with it; older
    ones are removed. Only a table whose columns are not those of today is defined anew.
    """
    name = f"{database}.{staged.table}"
    ddl = raw_ddl(staged.table)
    before = None
    if spark.catalog.tableExists(name):
        described = spark.sql(f"DESCRIBE EXTENDED {name}").collect()
        before = next((r["data_type"] for r in described if r["col_name"] == "Location"), None)
        if _types(spark.table(name).schema) != _types(RAW_SCHEMAS[staged.table]):
            spark.sql(f"DROP TABLE {name}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{staged.folder}'")
    else:
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{staged.folder}'")
    spark.catalog.refreshTable(name)
    keep = {folder.rstrip("/").rsplit("/", 1)[-1] for folder in (staged.folder, before) if folder}
    _drop_old_loads(spark, staged.folder.rsplit("/", 1)[0], keep)
    return spark.table(name)


def load_raw_table(
    spark: SparkSession,
    table: str,
    path: str | list[str],
    database: str,
    location: str | None = None,
) -> DataFrame:
    """Replace the rows of the raw table by those of the staged CSV, or leave it as it is and fail."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        create_raw_table(spark, table, database, location)
    staged = stage_raw_table(spark, table, path, database, location)
    return switch_raw_table(spark, staged, database, location)
