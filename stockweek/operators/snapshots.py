"""As-of snapshots: which rows they hold, and whether a day's set is complete."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweek.functions.dates import SNAPSHOT_PATTERN, as_date, snapshot_name
from stockweek.sources.schemas import FACT_DATES, TABLES


def snapshot_as_of(
    df: DataFrame, table: str, as_of: date | str, horizon_days: int = 0
) -> DataFrame:
    """Rows up to the day, or that many days beyond it; dimensions are not limited.

    The limit is a literal, so the filter reaches the scan. Rows without a date
    are left out.
    """
    if table not in FACT_DATES:
        return df
    last = as_date(as_of) + timedelta(days=horizon_days)
    return df.filter(F.col(FACT_DATES[table]) <= F.lit(last))


def snapshot_files(listing: DataFrame) -> DataFrame:
    """Table, day and location of every snapshot in a listing; other files are ignored.

    A snapshot is one file, or a folder of that name, listed itself or by its part
    files. Whether a folder is whole is for the listing to say.
    """
    path = F.col("path")
    return (
        listing.select(
            F.regexp_extract(path, SNAPSHOT_PATTERN, 1).alias("TABLE_NAME"),
            F.regexp_extract(path, SNAPSHOT_PATTERN, 2).alias("SNAPSHOT_DATE"),
            F.regexp_replace(path, r"\.csv/part-[^/]*$", ".csv").alias("URI"),
        )
        .filter(F.col("TABLE_NAME") != "")
        .distinct()
    )


@dataclass(frozen=True)
class Readiness:
    """Whether a day's set is complete, where its tables lie, and which are missing."""

    ready: bool
    manifest: DataFrame
    missing: DataFrame


def required_snapshots(spark: SparkSession, location: str, day: date | str) -> DataFrame:
    """The five snapshots a day needs, with the location each is expected at."""
    base = location.rstrip("/")
    day = as_date(day)
    rows = [(t, day.isoformat(), f"{base}/{snapshot_name(t, day)}") for t in TABLES]
    return spark.createDataFrame(rows, "TABLE_NAME string, SNAPSHOT_DATE string, URI string")


def missing_snapshots(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required snapshots that are not present; extra files do not matter."""
    return required.join(
        present.select("TABLE_NAME", "SNAPSHOT_DATE").distinct(),
        ["TABLE_NAME", "SNAPSHOT_DATE"],
        "left_anti",
    )


def readiness(listing: DataFrame, location: str, day: date | str) -> Readiness:
    """Check a day's set against a listing of committed snapshots made now.

    The manifest is empty unless all are there.
    """
    required = required_snapshots(listing.sparkSession, location, day)
    missing = missing_snapshots(required, snapshot_files(listing))
    ready = missing.isEmpty()
    manifest = required.select(F.col("TABLE_NAME").alias("table"), F.col("URI").alias("uri"))
    if not ready:
        manifest = manifest.filter(F.lit(False))
    return Readiness(ready, manifest, missing.select("TABLE_NAME"))


def all_present(required: DataFrame, present: DataFrame) -> DataFrame:
    """The verdict as one row: true when every required snapshot is present."""
    seen = present.select("TABLE_NAME", "SNAPSHOT_DATE", F.lit(True).alias("SEEN")).distinct()
    return required.join(seen, ["TABLE_NAME", "SNAPSHOT_DATE"], "left").agg(
        F.bool_and(F.coalesce("SEEN", F.lit(False))).alias("READY")
    )
