"""The mart's output as SQL tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockweek.functions.sizes import fits_broadcast
from stockweek.operators.star import pairs_repeat, star_report
from stockweek.operators.weekly import MART_COLUMNS, METRIC_COLUMNS
from stockweek.plans.weekly_mart import DIMENSIONS, FACT
from stockweek.sinks.catalog import (
    known_size,
    register_dimension,
    register_fact,
    register_star_view,
)
from stockweek.sinks.files import open_fact
from stockweek.sources.raw import create_namespace


def register_output(
    spark: SparkSession,
    output_path: str,
    partition_column: str,
    database: str,
    location: str | None = None,
    columns: list[str] | None = None,
) -> None:
    """Register fact, dimensions and their star view of one output folder in a database.

    The fact is served with all columns found on disk, its metrics included, in
    the order of the mart; or with the given ones.
    """
    base = output_path.rstrip("/")
    create_namespace(spark, database, location)
    path = f"{base}/{FACT}"
    stored = open_fact(spark, path)
    order = MART_COLUMNS + METRIC_COLUMNS
    known = [name for name in order if name in stored.columns]
    every = known + [name for name in stored.columns if name not in order]
    schema = stored.select(*(columns or every)).schema
    register_fact(spark, f"{database}.{FACT}", path, partition_column, schema)
    for table in DIMENSIONS:
        register_dimension(spark, f"{database}.{table}", table, f"{base}/{table}")
    register_star_view(spark, database, FACT)


def served_star_report(spark: SparkSession, database: str) -> DataFrame:
    """``star_report`` on the served tables; the catalog says which dimensions are small.

    If one is not, the keys of the fact are read once more, to see if its pairs have several weeks.
    """
    fact, *dimensions = (f"{database}.{name}" for name in (FACT, "store", "product"))
    sizes = tuple(known_size(spark, name) for name in dimensions)
    store, product = map(spark.table, dimensions)
    served = spark.table(fact)
    small = all(fits_broadcast(df, size) for df, size in zip((store, product), sizes, strict=True))
    return star_report(served, store, product, sizes, small or pairs_repeat(served))
