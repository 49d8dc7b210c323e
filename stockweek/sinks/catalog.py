"""Output registered as SQL tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockweek.functions.sizes import Size
from stockweek.sources.schemas import JOB_SCHEMAS

# What reports show of a store and a product.
STORE_NAMES = ["STORE_DESC", "CITY", "REGION", "CNTRY_NM", "MARKET_NAME"]
PRODUCT_NAMES = ["PROD_NAME", "BRAND_NAME", "CATEGORY_NAME", "SUBCATEGORY_NAME"]


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table, besides its columns."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").collect()
    names = [row["col_name"] for row in rows]
    start = names.index("# Detailed Table Information") if "# Detailed Table Information" in names else 0
    return {row["col_name"]: row["data_type"] for row in rows[start:]}


def _is_at(spark: SparkSession, name: str, path: str) -> bool:
    """Whether the table lies in that folder, however the two are written."""
    known = _described(spark, name).get("Location")
    plain = [spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in (known, path) if p]
    return len(plain) == 2 and plain[0].rstrip("/") == plain[1].rstrip("/")


def _folders(spark: SparkSession, path: str, column: str) -> set[str]:
    """The values of the partition column that have a folder, as they are written there."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}=*")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName().split("=", 1)[1] for s in system.globStatus(pattern) or []}


# Partitions named in one statement.
_AT_ONCE = 500


def sync_partitions(spark: SparkSession, name: str, path: str, column: str) -> tuple[set[str], set[str]]:
    """Add the partitions that are new on disk and drop those that are gone; returns both.

    The table stays in place. A partition that is known already keeps its entry, so an
    update of a few partitions changes a few entries.
    """
    known = {row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    there = _folders(spark, path, column)
    for values, what, clause in (
        (sorted(there - known), "ADD IF NOT EXISTS", " "),
        (sorted(known - there), "DROP IF EXISTS", ", "),
    ):
        for at in range(0, len(values), _AT_ONCE):
            named = clause.join(f"PARTITION ({column} = '{v}')" for v in values[at : at + _AT_ONCE])
            spark.sql(f"ALTER TABLE {name} {what} {named}")
    spark.catalog.refreshTable(name)
    return there - known, known - there


def _replace(spark: SparkSession, name: str, make) -> None:
    """Let a table that is made under another name take the place of the old one."""
    fresh, old = f"{name}__{uuid.uuid4().hex}", f"{name}__{uuid.uuid4().hex}"
    make(fresh)
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")


def register_fact(
    spark: SparkSession, name: str, path: str, partition_column: str, schema: T.StructType
) -> DataFrame:
    """An external table over the partitioned fact, with its partitions found.

    A table of that folder and partition column stays in place: it gets the columns and
    partitions that it lacks. Any other is made beside the old one, with all its partitions, and
    then renamed, so that a reader finds the old table or the new one whole.
    """
    column = partition_column.upper()

    def make(fresh: str) -> None:
        spark.sql(
            f"CREATE TABLE {fresh} ({_ddl(schema)}) USING parquet "
            f"PARTITIONED BY ({column}) LOCATION '{path}'"
        )
        sync_partitions(spark, fresh, path, column)

    if not spark.catalog.tableExists(name):
        make(name)
    else:
        held = spark.table(name).schema
        plain = [f for f in schema.fields if f.name != column]
        same = [f.name for f in held.fields if f.name != column] == [f.name for f in plain[: len(held) - 1]]
        if same and held.fields[-1].name == column and _is_at(spark, name, path):
            if more := plain[len(held) - 1 :]:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(T.StructType(more))})")
            sync_partitions(spark, name, path, column)
        else:
            _replace(spark, name, make)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    return spark.table(name)


def register_dimension(spark: SparkSession, name: str, table: str, path: str) -> DataFrame:
    """An external table over a dimension's CSV copy, with its rows and bytes in the catalog."""

    def make(fresh: str) -> None:
        spark.sql(
            f"CREATE TABLE {fresh} ({_ddl(JOB_SCHEMAS[table])}) USING csv "
            f"OPTIONS (header 'true', sep ',') LOCATION '{path}'"
        )

    if not spark.catalog.tableExists(name):
        make(name)
    elif spark.table(name).columns != JOB_SCHEMAS[table].fieldNames() or not _is_at(spark, name, path):
        _replace(spark, name, make)
    spark.catalog.refreshTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    return spark.table(name)


def known_size(spark: SparkSession, name: str) -> Size | None:
    """Rows and bytes of a table by the statistics in the catalog, or None without any."""
    found = re.fullmatch(r"(\d+) bytes, (\d+) rows", _described(spark, name).get("Statistics", ""))
    return Size(int(found[2]), int(found[1])) if found else None


def register_star_view(spark: SparkSession, database: str, fact: str) -> DataFrame:
    """A view of the fact with the names of its stores and products; every fact row is kept."""
    name = f"{database}.{fact}_star"
    store = ", ".join(f"s.{c}" for c in STORE_NAMES)
    product = ", ".join(f"p.{c}" for c in PRODUCT_NAMES)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT f.*, {store}, {product} FROM {database}.{fact} f "
        f"LEFT JOIN {database}.store s ON f.STORE_KEY = s.STORE_KEY "
        f"LEFT JOIN {database}.product p ON f.PROD_KEY = p.PROD_KEY"
    )
    return spark.table(name)
