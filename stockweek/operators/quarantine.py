"""Rows that would join by an unknown key, set apart with the reason."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.session import settings
from stockweek.sources.schemas import FACT_DATES

KEPT = "kept"

# Files that a task may have open at once, more than there are reasons; beyond it rows are sorted first.
SIDE_BY_SIDE = {"spark.sql.maxConcurrentOutputFileWriters": "8"}

# Rows set apart, and those kept, take less room than with Spark's default.
COMPRESSION = "zstd"


class Split(NamedTuple):
    """The rows that stay, and those that do not, with their ``REASON``."""

    kept: DataFrame
    rejected: DataFrame


def reject_reason(table: str) -> Column:
    """Why a row of a fact is set apart, the first reason that holds; null if none does."""
    unknown = lambda name: F.col(name).isNull() | (F.col(name) == 0)
    return (
        F.when(F.col(FACT_DATES[table]).isNull(), F.lit("no date"))
        .when(unknown("STORE_KEY"), F.lit("no store"))
        .when(unknown("PROD_KEY"), F.lit("no product"))
    )


def split_unknown_keys(df: DataFrame, table: str, path: str) -> Split:
    """Divide a fact, with or without its nulls filled, in one pass that writes both parts to ``path``.

    Kept and rejected rows together are the input. A reason is a folder, so a read of the
    kept rows does not touch the others. A null or zero key is unknown, as both join alike
    after null normalisation. A task writes the rows of all reasons side by side, so it sorts none.
    """
    reason = F.coalesce(reject_reason(table), F.lit(KEPT))
    with settings(df.sparkSession, SIDE_BY_SIDE):
        writer = df.withColumn("REASON", reason).write.partitionBy("REASON")
        writer.option("compression", COMPRESSION).parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("REASON", T.StringType())])
    rows = df.sparkSession.read.schema(schema).parquet(path)
    return Split(rows.filter(F.col("REASON") == KEPT).drop("REASON"), rows.filter(F.col("REASON") != KEPT))
