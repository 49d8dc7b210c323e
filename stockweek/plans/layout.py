"""Facts stored so that the daily join needs no shuffle: bucketed by week, store and product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweek.functions.sizes import broadcast_if_small
from stockweek.operators.daily import (
    daily_inventory,
    daily_sales,
    daily_sales_in_place,
    deal_days,
    fact_columns,
    join_dealt,
)
from stockweek.operators.hot_keys import HotKeys, sampled_hot_keys, split_parts
from stockweek.operators.weekly import (
    CALENDAR_COLUMNS,
    has_plain_weeks,
    roll_up_weeks,
    sales_inv_store_wk,
    shape_of,
    sums_in_place,
)

BUCKET_KEYS = ["WEEK_HASH", "STORE_KEY", "PROD_KEY", "PART"]
SALES, STOCK, CALENDAR = "staged_sales", "staged_inventory", "staged_calendar"


def _keys(df: DataFrame) -> list[str]:
    return [key for key in BUCKET_KEYS if key in df.columns]


def _laid_out(df: DataFrame, buckets: int) -> DataFrame:
    return df.repartition(buckets, *_keys(df))


def _store(df: DataFrame, name: str, buckets: int) -> None:
    """Rows ``_laid_out`` as a table. Each bucket comes from one task, so it is one sorted file."""
    writer = df.write.bucketBy(buckets, *_keys(df))
    writer.sortBy(*_keys(df)).mode("overwrite").format("parquet").saveAsTable(name)


def _whole_weeks(sales: DataFrame, week: DataFrame, buckets: int) -> DataFrame:
    """Daily sales laid out by week; without hot keys they are shuffled once."""
    dated = sales.withColumnRenamed("TRANS_DT", "CAL_DT")
    if split_parts(sampled_hot_keys(dated)):
        return _laid_out(daily_sales(sales).join(week, "CAL_DT"), buckets)
    return daily_sales_in_place(_laid_out(dated.join(week, "CAL_DT"), buckets), "WEEK_HASH")


def stage_facts(
    sales: DataFrame,
    inventory: DataFrame,
    calendar: DataFrame,
    database: str,
    buckets: int,
    hot: HotKeys | None = None,
) -> None:
    """Store daily sales, stock rows and calendar, all null-normalised, as tables of ``database``.

    The facts lie by week, store, product and the part that hot keys are split into; by day
    instead of week with a calendar that holds dates twice or is large, and with one of longer
    weeks (``has_plain_weeks`` denies both) if stock has hot keys. With longer weeks and
    no hot key there is no column ``PART``. Days outside the calendar are left out.
    Choose ``buckets`` so that one holds 128 to 256 MB. Marts can then be made
    again and again, with and without metrics, and the facts are not shuffled for it.
    """
    spark = sales.sparkSession
    slim = calendar.select(*CALENDAR_COLUMNS).filter(F.col("CAL_DT").isNotNull())
    stock, shape = daily_inventory(inventory), shape_of(slim)
    hot = sampled_hot_keys(stock) if hot is None else hot
    long_weeks = shape.single and not shape.plain and not split_parts(hot)
    shared = ["YR_NUM", "WK_NUM"] if shape.plain or long_weeks else ["CAL_DT"]
    week = slim.select("CAL_DT", F.hash(*shared).alias("WEEK_HASH")).distinct()
    week = broadcast_if_small(week.dropDuplicates(["CAL_DT"]))
    held = stock.join(week, "CAL_DT")
    if long_weeks:
        laid_out = [_whole_weeks(sales, week, buckets), _laid_out(held, buckets)]
    else:
        sold = daily_sales(sales).join(week, "CAL_DT")
        dealt = deal_days(sold, held, hot)
        if dealt is None:
            whole = F.lit(0).cast("bigint").alias("PART")
            dealt = sold.select("*", F.lit(False).alias("COPIED"), whole), held.select("*", whole)
        laid_out = [_laid_out(df, buckets) for df in dealt]
    for df, name in zip(laid_out, (SALES, STOCK), strict=True):
        _store(df, f"{database}.{name}", buckets)
    spark.sql(f"DROP TABLE IF EXISTS {database}.{CALENDAR}")
    slim.write.saveAsTable(f"{database}.{CALENDAR}")


def weekly_mart_from_staged(spark: SparkSession, database: str, metrics: bool = False) -> DataFrame:
    """The weekly mart from what ``stage_facts`` has stored; rows as those of ``weekly_mart``."""
    sold, held = (spark.table(f"{database}.{name}") for name in (SALES, STOCK))
    calendar = spark.table(f"{database}.{CALENDAR}")
    if "PART" not in sold.columns:
        return sums_in_place(sold, held, calendar, metrics, "WEEK_HASH")
    days = join_dealt(sold, held, by_week=True).select(*fact_columns())
    if has_plain_weeks(calendar):
        return roll_up_weeks(days, calendar, metrics)
    return sales_inv_store_wk(days, calendar, metrics)
