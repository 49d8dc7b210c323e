"""The weekly mart and the metrics built on it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.functions import sizes
from stockweek.functions.measures import days_with, mean, total
from stockweek.operators.daily import (
    daily_inventory,
    daily_sales,
    fact_columns,
    match_days,
    meet_in_place,
    meet_in_places,
    meet_in_weeks,
    sales_inv_store_dy,
)
from stockweek.operators.hot_keys import DAY_KEYS, HotKeys, sampled_hot_keys, split_parts
from stockweek.operators.places import PLACED_BY, placed, places_of

WEEK_KEYS = ["YR_NUM", "WK_NUM", "STORE_KEY", "PROD_KEY"]
CALENDAR_COLUMNS = ["CAL_DT", "YR_NUM", "WK_NUM", "DAY_OF_WK_NUM"]

# The last day of a week, and the days of a week.
END_OF_WEEK = 6
DAYS_PER_WEEK = 7

MART_COLUMNS = WEEK_KEYS + [
    "WK_SALES_QTY",
    "AVG_SALES_PRICE",
    "WK_SALES_AMT",
    "WK_DISCOUNT",
    "WK_SALES_COST",
    "WK_SALES_MGRN",
    "EOP_STOCK_ON_HAND_QTY",
    "EOP_ORDERED_STOCK_QTY",
    "OUT_OF_STOCK_TIMES",
    "IN_STOCK_TIMES",
    "LOW_STOCK_TIMES",
]
METRIC_COLUMNS = [
    "AVG_UNIT_PRICE",
    "OUT_OF_STOCK_DAY_RATIO",
    "IN_STOCK_DAY_RATIO",
    "TOTAL_LOW_STOCK_IMPACT",
    "POTENTIAL_LOW_STOCK_IMPACT",
    "NO_STOCK_IMPACT",
    "WEEKS_OF_SUPPLY",
]
# Metrics that are sums of days; the others follow from the sums of a week.
SUMMED_METRICS = ["POTENTIAL_LOW_STOCK_IMPACT", "NO_STOCK_IMPACT"]


def _at_week_end(quantity: str) -> Column:
    return total(F.when(F.col("DAY_OF_WK_NUM") == END_OF_WEEK, F.col(quantity)).otherwise(0.0))


def _roll_up(days: DataFrame, *more: str) -> DataFrame:
    """Daily rows that carry their calendar columns, per week, store and product (and ``more``)."""
    stock_value = F.col("STOCK_ON_HAND_QTY") * F.col("SALES_PRICE")
    gap = F.when(F.col("LOW_STOCK_FLG"), F.col("SALES_AMT") - stock_value).otherwise(0.0)
    lost = F.when(F.col("OUT_OF_STOCK_FLG"), F.col("SALES_AMT")).otherwise(0.0)
    return days.groupBy(*WEEK_KEYS, *more).agg(
        total("SALES_QTY").alias("WK_SALES_QTY"),
        mean("SALES_PRICE").alias("AVG_SALES_PRICE"),
        total("SALES_AMT").alias("WK_SALES_AMT"),
        total("DISCOUNT").alias("WK_DISCOUNT"),
        total("SALES_COST").alias("WK_SALES_COST"),
        total("SALES_MGRN").alias("WK_SALES_MGRN"),
        _at_week_end("STOCK_ON_HAND_QTY").alias("EOP_STOCK_ON_HAND_QTY"),
        _at_week_end("ORDERED_STOCK_QTY").alias("EOP_ORDERED_STOCK_QTY"),
        days_with(F.col("OUT_OF_STOCK_FLG")).alias("OUT_OF_STOCK_TIMES"),
        days_with(F.col("IN_STOCK_FLG")).alias("IN_STOCK_TIMES"),
        days_with(F.col("LOW_STOCK_FLG")).alias("LOW_STOCK_TIMES"),
        total(gap).alias("POTENTIAL_LOW_STOCK_IMPACT"),
        total(lost).alias("NO_STOCK_IMPACT"),
    )


def _with_ratios(weeks: DataFrame) -> DataFrame:
    """The metrics that follow from weekly totals; null where nothing was sold."""
    out, low = F.col("OUT_OF_STOCK_TIMES"), F.col("LOW_STOCK_TIMES")
    return weeks.withColumns(
        {
            "AVG_UNIT_PRICE": F.try_divide("WK_SALES_AMT", "WK_SALES_QTY"),
            "OUT_OF_STOCK_DAY_RATIO": out / F.lit(DAYS_PER_WEEK),
            "IN_STOCK_DAY_RATIO": F.col("IN_STOCK_TIMES") / F.lit(DAYS_PER_WEEK),
            "TOTAL_LOW_STOCK_IMPACT": out + low,
            "WEEKS_OF_SUPPLY": F.try_divide("EOP_STOCK_ON_HAND_QTY", "WK_SALES_QTY"),
        }
    )


def roll_up_weeks(days: DataFrame, calendar: DataFrame, metrics: bool = False) -> DataFrame:
    """The weekly mart from daily rows (``fact_columns``), by a small calendar."""
    return _chosen(_roll_up(days.join(F.broadcast(calendar), "CAL_DT")), metrics)


def _chosen(weeks: DataFrame, metrics: bool) -> DataFrame:
    if metrics:
        return _with_ratios(weeks).select(*MART_COLUMNS, *METRIC_COLUMNS)
    return weeks.select(*MART_COLUMNS)


def sales_inv_store_wk(
    sales_inv_day: DataFrame, calendar: DataFrame, metrics: bool = False
) -> DataFrame:
    """The weekly mart from a daily fact and any calendar.

    A date the calendar holds twice counts twice; days it lacks are left out. A
    calendar beyond the broadcast bound is joined by shuffling, where adaptive
    execution splits a hot date.
    """
    slim = sizes.broadcast_if_small(calendar.select(*CALENDAR_COLUMNS))
    return _chosen(_roll_up(sales_inv_day.join(slim, "CAL_DT")), metrics)


class Shape(NamedTuple):
    """Of a calendar: whether it is small and holds each date once; and, besides, its weeks are no longer than weeks."""

    single: bool
    plain: bool


def shape_of(slim: DataFrame) -> Shape:
    """One pass over a calendar."""
    per_date = slim.groupBy("CAL_DT").agg(
        F.count(F.lit(1)).alias("n"), F.min("YR_NUM").alias("year"), F.min("WK_NUM").alias("week")
    )
    per_week = per_date.groupBy("year", "week").agg(
        F.count(F.lit(1)).alias("days"), F.max("n").alias("most")
    )
    dates, most, days = per_week.agg(F.sum("days"), F.max("most"), F.max("days")).first()
    single = (dates or 0) <= sizes.BROADCAST_ROWS and (most or 0) <= 1
    return Shape(single, single and (days or 0) <= DAYS_PER_WEEK)


def has_plain_weeks(slim: DataFrame) -> bool:
    """Whether a calendar is small, holds each date once, and its weeks are no longer than weeks."""
    return shape_of(slim).plain


def sums_in_place(
    sold: DataFrame, held: DataFrame, calendar: DataFrame, metrics: bool, *more: str
) -> DataFrame:
    """The weekly mart from daily sales and stock rows that lie by the columns ``more``, store and product.

    Equal weeks of the calendar, which is small and holds each date once, agree in ``more``. Weeks may
    be of any length, as rows do not meet in pairs.
    """
    days = meet_in_place(sold, held, *more).join(F.broadcast(calendar), "CAL_DT")
    return _chosen(_roll_up(days, *more), metrics)


def weekly_mart(
    sales: DataFrame,
    inventory: DataFrame,
    calendar: DataFrame,
    metrics: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The weekly mart straight from null-normalised sales, inventory and calendar.

    Same rows as ``sales_inv_store_wk(sales_inv_store_dy(...), calendar)``. With one
    calendar row per date and at most seven dates per week, which is checked, both
    sides learn their week before they meet, and are joined by week, store and
    product. The days of a week then sit in one task, so the weekly aggregate
    shrinks its rows about sevenfold before its own shuffle. Days outside the
    calendar never shuffle. Any other calendar takes the plan by days, as many
    days with one key would meet in pairs. ``hot`` are keys known to hold many of
    the inventory rows; by default a sample tells, which reads them once more.
    """
    slim = calendar.select(*CALENDAR_COLUMNS).filter(F.col("CAL_DT").isNotNull())
    sales_day, stock_day = daily_sales(sales), daily_inventory(inventory)
    if not has_plain_weeks(slim):
        return sales_inv_store_wk(sales_inv_store_dy(sales_day, stock_day, hot), calendar, metrics)
    # Equal weeks have equal hashes, and a hash is never null. Only the hash
    # travels through the shuffle; the calendar's columns are joined on after it.
    week = slim.select("CAL_DT", F.hash("YR_NUM", "WK_NUM").alias("WEEK_HASH"))
    joined = match_days(
        sales_day.join(F.broadcast(week), "CAL_DT"),
        stock_day.join(F.broadcast(week), "CAL_DT"),
        sampled_hot_keys(stock_day) if hot is None else hot,
        by_week=True,
    )
    return roll_up_weeks(joined.select(*fact_columns()), slim, metrics)


def weekly_sums(
    sales: DataFrame,
    inventory: DataFrame,
    calendar: DataFrame,
    metrics: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The rows of ``weekly_mart``, of the metrics only the ``SUMMED_METRICS``; ``with_metrics`` adds the rest.

    Sales and stock rows are shuffled once, by week, store and product, and neither the
    daily nor the weekly sums shuffle again. That needs a calendar with plain weeks and
    no key with many of the rows of either fact; otherwise this is the plan of ``weekly_mart``.
    """
    slim = calendar.select(*CALENDAR_COLUMNS).filter(F.col("CAL_DT").isNotNull())
    sold, held = sales.withColumnRenamed("TRANS_DT", "CAL_DT"), daily_inventory(inventory)
    hot = sampled_hot_keys(held) if hot is None else hot
    columns = MART_COLUMNS + (SUMMED_METRICS if metrics else [])
    if split_parts(hot) or split_parts(sampled_hot_keys(sold)) or not has_plain_weeks(slim):
        return weekly_mart(sales, inventory, calendar, metrics, hot).select(*columns)
    # Two bytes of the hash: weeks that share them may share a task, and stay apart by their days.
    short = F.pmod(F.hash("YR_NUM", "WK_NUM"), F.lit(1 << 16)).alias("WEEK_HASH")
    week = F.broadcast(slim.select("CAL_DT", short))
    days = meet_in_weeks(sold.join(week, "CAL_DT"), held.join(week, "CAL_DT"))
    # A week has one hash, so to group by it as well changes no row, and nothing is shuffled.
    return _roll_up(days.join(F.broadcast(slim), "CAL_DT"), "WEEK_HASH").select(*columns)


def placed_sums(
    sales: DataFrame,
    inventory: DataFrame,
    calendar: DataFrame,
    column: str,
    metrics: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame | None:
    """The rows of ``weekly_sums``, laid out for a fact with a folder for each value of ``column``; or None.

    The one shuffle of sales and stock rows brings the rows of a value to few tasks, so that the
    fact needs no shuffle for its layout. That is possible with a column of the calendar, and a
    calendar with plain weeks; otherwise the answer is None. The weeks, stores and products of hot keys
    of either fact are few, and take the plan of ``weekly_mart``, apart from all others.
    """
    slim = calendar.select(*CALENDAR_COLUMNS).filter(F.col("CAL_DT").isNotNull())
    if column not in PLACED_BY or not has_plain_weeks(slim):
        return None
    columns = MART_COLUMNS + (SUMMED_METRICS if metrics else [])
    sold, held = sales.withColumnRenamed("TRANS_DT", "CAL_DT"), daily_inventory(inventory)
    found = sampled_hot_keys(held) if hot is None else hot
    places = places_of(sold, held, slim, column, None if hot is None else hot.total)
    cells = _days_of_hot_cells(inventory, slim, [*split_parts(found), *split_parts(sampled_hot_keys(sold))])
    if cells is not None:
        apart = [df.join(cells, DAY_KEYS, "left_semi") for df in (sold, inventory)]
        sold, held = (df.join(cells, DAY_KEYS, "left_anti") for df in (sold, held))
    days = meet_in_places(placed(sold, places), placed(held, places), places.tasks)
    # A week of a store and product has one place, so to group by it as well changes no row.
    sums = _roll_up(days.join(F.broadcast(slim), "CAL_DT"), "PLACE").select(*columns)
    if cells is None:
        return sums
    hot_sales = apart[0].withColumnRenamed("CAL_DT", "TRANS_DT")
    rest = weekly_mart(hot_sales, apart[1], calendar, metrics, found).select(*columns)
    return sums.unionByName(rest.repartition(1))  # a row for each hot key at most


def _days_of_hot_cells(inventory: DataFrame, slim: DataFrame, keys: list[tuple]) -> DataFrame | None:
    """The days of all weeks, stores and products that hold a hot key, to be broadcast; None if there are none."""
    known = [key[:3] for key in keys if key[0] is not None]
    if not known:
        return None
    schema = T.StructType([inventory.schema[key] for key in DAY_KEYS])
    # Weeks that share a hash are taken together, which is as well.
    week = slim.select("CAL_DT", F.hash("YR_NUM", "WK_NUM").alias("WEEK_HASH"))
    hot = inventory.sparkSession.createDataFrame(known, schema)
    cells = hot.join(week, "CAL_DT").select("WEEK_HASH", "STORE_KEY", "PROD_KEY").distinct()
    return F.broadcast(cells.join(week, "WEEK_HASH").select(*DAY_KEYS))


def with_metrics(sums: DataFrame) -> DataFrame:
    """All columns of the mart with metrics, from those of ``weekly_sums``."""
    return _chosen(sums, metrics=True)


def week_keys_and(mart: DataFrame, *names: str) -> DataFrame:
    """The week keys and the named columns of a mart."""
    return mart.select(*WEEK_KEYS, *names)
