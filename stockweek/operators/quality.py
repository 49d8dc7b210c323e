"""Report on the keys and dates that change the mart silently."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweek.operators.hot_keys import DAY_KEYS
from stockweek.operators.weekly import DAYS_PER_WEEK, END_OF_WEEK


def _no_key(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == 0)


def _per_day(rows: DataFrame, day: str) -> DataFrame:
    """Rows per day, and those among them without a store or product."""
    return rows.groupBy(F.col(day).alias("DAY")).agg(
        F.count_if(_no_key("STORE_KEY")).alias("store"),
        F.count_if(_no_key("PROD_KEY")).alias("product"),
        F.count(F.lit(1)).alias("n"),
        F.lit(0).cast("bigint").alias("several"),
    )


def _per_day_by_key(rows: DataFrame) -> DataFrame:
    """The same from one count per key, with the keys that have several rows."""
    per_key = rows.groupBy(*DAY_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(F.col("CAL_DT").alias("DAY")).agg(
        F.sum(F.when(_no_key("STORE_KEY"), F.col("n"))).alias("store"),
        F.sum(F.when(_no_key("PROD_KEY"), F.col("n"))).alias("product"),
        F.sum("n").alias("n"),
        F.count_if(F.col("n") > 1).alias("several"),
    )


def _key_counts(table: str, per_day: DataFrame, dates: DataFrame, several: bool) -> DataFrame:
    # Counted per day before the calendar is looked at, so the join sees only dates.
    undated, unknown = F.col("DAY").isNull(), F.col("KNOWN_DT").isNull()
    counts = per_day.join(dates, F.col("DAY") == F.col("KNOWN_DT"), "left").agg(
        F.sum("store").alias("store"),
        F.sum("product").alias("product"),
        F.sum(F.when(undated, F.col("n"))).alias("date"),
        F.sum(F.when(~undated & unknown, F.col("n"))).alias("calendar"),
        F.sum("several").alias("several"),
    )
    checks = {
        f"{table}: store key null or 0": "store",
        f"{table}: product key null or 0": "product",
        f"{table}: no date": "date",
        f"{table}: date not in calendar": "calendar",
    }
    if several:
        checks[f"{table}: keys with several rows"] = "several"
    pairs = [[F.lit(check), F.coalesce(name, F.lit(0))] for check, name in checks.items()]
    return counts.select(F.explode(F.create_map(*sum(pairs, []))).alias("CHECK_NAME", "N"))


def _one(check: str, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(check).alias("CHECK_NAME"), "N")


def key_quality(sales: DataFrame, inventory: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows behind each check; 0 everywhere means the mart holds no surprises.

    Each table is read once. Counts are combined before every shuffle, so a hot key
    costs no more than another.
    """
    dates = calendar.select(F.col("CAL_DT").alias("KNOWN_DT")).distinct()
    repeated = F.count_if(F.col("n") > 1).alias("N")
    per_date = calendar.groupBy("CAL_DT").agg(F.count(F.lit(1)).alias("n"))
    per_week = calendar.groupBy("YR_NUM", "WK_NUM").agg(
        F.count_distinct("CAL_DT").alias("days"),
        F.count_if(F.col("DAY_OF_WK_NUM") == END_OF_WEEK).alias("ends"),
    )
    parts = [
        _key_counts("sales", _per_day(sales, "TRANS_DT"), dates, several=False),
        _key_counts("inventory", _per_day_by_key(inventory), dates, several=True),
        _one("calendar: dates with several rows", per_date.agg(repeated)),
        _one(
            "calendar: weeks of other than 7 days",
            per_week.agg(F.count_if(F.col("days") != DAYS_PER_WEEK).alias("N")),
        ),
        _one(
            "calendar: weeks without a last day",
            per_week.agg(F.count_if(F.col("ends") == 0).alias("N")),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
