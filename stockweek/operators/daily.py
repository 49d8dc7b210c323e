"""Daily sales, daily inventory, and the daily fact that joins them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.functions.measures import mean, total
from stockweek.operators.hot_keys import DAY_KEYS, HotKeys, sampled_hot_keys, split_parts

SALES_MEASURES = ["SALES_QTY", "SALES_PRICE", "SALES_AMT", "DISCOUNT", "SALES_COST", "SALES_MGRN"]
STOCK_MEASURES = ["STOCK_ON_HAND_QTY", "ORDERED_STOCK", "OUT_OF_STOCK_FLG"]


# How a measure is summed up to a day, if not by its total.
_PER_DAY = {"SALES_PRICE": mean, "DISCOUNT": mean}


def _day_sums() -> list[Column]:
    return [
        total("SALES_QTY").alias("SALES_QTY"),
        total("SALES_AMT").alias("SALES_AMT"),
        mean("SALES_PRICE").alias("SALES_PRICE"),
        total("SALES_COST").alias("SALES_COST"),
        total("SALES_MGRN").alias("SALES_MGRN"),
        mean("DISCOUNT").alias("DISCOUNT"),
        total("SHIP_COST").alias("SHIP_COST"),
    ]


def daily_sales(sales: DataFrame) -> DataFrame:
    """Transactions rolled up to date, store and product.

    The rows are combined before the shuffle, so a hot key sends one row per task.
    """
    keys = [F.col("TRANS_DT").alias("CAL_DT"), "STORE_KEY", "PROD_KEY"]
    return sales.groupBy(*keys).agg(*_day_sums())


def daily_sales_in_place(sales: DataFrame, *more: str) -> DataFrame:
    """``daily_sales`` of transactions dated ``CAL_DT`` that lie by the columns ``more``, store and product.

    Nothing is shuffled for it. All rows of a key are in one task, so it is for sales without hot keys.
    """
    return sales.groupBy(*DAY_KEYS, *more).agg(*_day_sums())


def daily_inventory(inventory: DataFrame) -> DataFrame:
    """Daily stock under the names of the fact; one row per input row."""
    return inventory.withColumnsRenamed(
        {"INVENTORY_ON_HAND_QTY": "STOCK_ON_HAND_QTY", "INVENTORY_ON_ORDER_QTY": "ORDERED_STOCK"}
    )


def _same_day(left: str, right: str) -> Column:
    return (
        (F.col(f"{left}.CAL_DT") == F.col(f"{right}.CAL_DT"))
        & (F.col(f"{left}.STORE_KEY") == F.col(f"{right}.STORE_KEY"))
        & (F.col(f"{left}.PROD_KEY") == F.col(f"{right}.PROD_KEY"))
    )


def _same_week_then_day(left: str, right: str) -> Column:
    # Only week, store and product are join keys here. The date is compared as a
    # computed value, so it does not become part of the shuffle key.
    return (
        (F.col(f"{left}.WEEK_HASH") == F.col(f"{right}.WEEK_HASH"))
        & (F.col(f"{left}.STORE_KEY") == F.col(f"{right}.STORE_KEY"))
        & (F.col(f"{left}.PROD_KEY") == F.col(f"{right}.PROD_KEY"))
        & (F.datediff(F.col(f"{left}.CAL_DT"), F.col(f"{right}.CAL_DT")) == 0)
    )


def _parts(inventory: DataFrame, hot: HotKeys) -> DataFrame | None:
    """The hot keys in the types of the inventory, with the parts that each is split into."""
    rows = split_parts(hot)
    fields = [inventory.schema[key] for key in DAY_KEYS]
    schema = T.StructType([*fields, T.StructField("PARTS", T.LongType())])
    return inventory.sparkSession.createDataFrame(rows, schema) if rows else None


def _dealt(sales: DataFrame, inventory: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the part of its key that each row goes to; hot sales go to all parts.

    The part of a stock row follows from its values, so that a task which is run again
    deals its rows as before, in whatever order they come. Equal rows share a part.
    """
    hot = F.broadcast(hot.alias("h"))
    # Null-safe for the inventory: rows without a date match nothing, but may be many.
    same = [F.col(f"i.{key}").eqNullSafe(F.col(f"h.{key}")) for key in DAY_KEYS]
    values = F.xxhash64(*(F.col(f"i.{c}") for c in inventory.columns))
    part = F.pmod(values, F.coalesce("h.PARTS", F.lit(1)))
    held = inventory.alias("i").join(hot, same, "left").select("i.*", part.alias("PART"))
    last = F.coalesce("h.PARTS", F.lit(1)) - 1
    sold = sales.alias("s").join(hot, _same_day("s", "h"), "left").select(
        "s.*",
        F.col("h.PARTS").isNotNull().alias("COPIED"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("PART"),
    )
    return sold, held


def deal_days(
    sales: DataFrame, inventory: DataFrame, hot: HotKeys
) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with the ``PART`` of its key that each row goes to; None if no key is hot."""
    parts = _parts(inventory, hot)
    return None if parts is None else _dealt(sales, inventory, parts)


def join_dealt(sold: DataFrame, held: DataFrame, by_week: bool = False) -> DataFrame:
    """Full outer join of sides that ``deal_days`` has dealt, as ``match_days`` gives it."""
    on = _same_week_then_day("s", "i") if by_week else _same_day("s", "i")
    joined = sold.alias("s").join(held.alias("i"), on & (F.col("s.PART") == F.col("i.PART")), "full")
    spare = F.coalesce("s.COPIED", F.lit(False)) & F.col("i.PART").isNull()
    return joined.filter(~spare).select(*_side_columns(sold, held))


def _side_columns(sales: DataFrame, inventory: DataFrame) -> list[Column]:
    names = [F.col(f"s.{c}").alias(f"s_{c}") for c in sales.columns]
    return names + [F.col(f"i.{c}").alias(f"i_{c}") for c in inventory.columns]


def match_days(
    sales: DataFrame, inventory: DataFrame, hot: HotKeys, by_week: bool = False
) -> DataFrame:
    """Full outer join of daily sales (columns ``s_...``) and inventory rows (``i_...``).

    A full outer join cannot be split at run time, so the inventory rows of hot keys
    are dealt to several parts, and the one sales row of such a key is copied to
    each. A key of ``hot`` must occur in the inventory, where it was found, so copies that
    match nothing are left out. Sales without a date match nothing and stay.
    """
    dealt = deal_days(sales, inventory, hot)
    if dealt is not None:
        return join_dealt(*dealt, by_week)
    on = _same_week_then_day("s", "i") if by_week else _same_day("s", "i")
    joined = sales.alias("s").join(inventory.alias("i"), on, "full")
    return joined.select(*_side_columns(sales, inventory))


def meet_in_weeks(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """The daily fact with ``WEEK_HASH``, from one shuffle of sales and of stock rows by week, store and product.

    Sales are single transactions here, dated ``CAL_DT``; both sides carry ``WEEK_HASH``,
    and no key is null. The result is still partitioned by week, store and product. All rows
    of a key meet in one task, so it is for tables without hot keys.
    """
    week, keys = ["WEEK_HASH", "STORE_KEY", "PROD_KEY"], ["WEEK_HASH", *DAY_KEYS]
    sums = [_PER_DAY.get(name, total)(name).alias(name) for name in SALES_MEASURES]
    sold = sales.select(*keys, *SALES_MEASURES).repartition(*week).groupBy(*keys).agg(*sums)
    held = inventory.select(*keys, *STOCK_MEASURES).repartition(*week)
    return meet_in_place(sold, held, "WEEK_HASH")


def meet_in_places(sales: DataFrame, inventory: DataFrame, places: int) -> DataFrame:
    """``meet_in_weeks`` with one shuffle by ``PLACE``, which both sides carry and which follows from week, store and product.

    There are ``places`` tasks. The rows of a place are in one of them, and stay there.
    """
    keys = ["PLACE", *DAY_KEYS]
    sums = [_PER_DAY.get(name, total)(name).alias(name) for name in SALES_MEASURES]
    sold = sales.select(*keys, *SALES_MEASURES).repartition(places, "PLACE").groupBy(*keys).agg(*sums)
    held = inventory.select(*keys, *STOCK_MEASURES).repartition(places, "PLACE")
    return meet_in_place(sold, held, "PLACE")


def meet_in_place(sold: DataFrame, held: DataFrame, *more: str) -> DataFrame:
    """The daily fact with the columns ``more``, from daily sales and stock rows that lie by these, store and product.

    No key is null. Rows of a day do not meet in pairs, and nothing is shuffled for it.
    """
    keys = [*more, *DAY_KEYS]
    # Spark sees that both sides lie alike by names that are made here, not by those of two stored tables.
    named = [F.col(key).alias(f"K_{key}") for key in keys]
    sold = sold.select(*named, F.struct(*SALES_MEASURES).alias("SOLD"))
    held = held.select(*named, F.struct(*STOCK_MEASURES).alias("HELD"))
    both = sold.unionByName(held, allowMissingColumns=True)
    # A day has one row of sales at most; it stays as a row if no stock row takes it.
    day = Window.partitionBy(*(f"K_{key}" for key in keys))
    sale, stocked = F.max("SOLD").over(day).alias("s"), F.count("HELD").over(day).alias("STOCKED")
    days = both.select("*", sale, stocked).filter(F.col("HELD").isNotNull() | (F.col("STOCKED") == 0))
    found = [F.col(f"K_{key}").alias(key) for key in keys]
    s_columns = [F.col(f"s.{name}").alias(f"s_{name}") for name in SALES_MEASURES]
    i_columns = [F.col(f"HELD.{name}").alias(f"i_{name}") for name in STOCK_MEASURES]
    return days.select(*found, *s_columns, *i_columns).select(*keys, *fact_values())


def fact_columns() -> list[Column]:
    """The daily fact's columns, from those of ``match_days``."""
    return [F.coalesce(f"s_{key}", f"i_{key}").alias(key) for key in DAY_KEYS] + fact_values()


def fact_values() -> list[Column]:
    """The daily fact's columns besides its keys."""
    zero = F.lit(0.0)
    sold = [F.coalesce(f"s_{name}", zero).alias(name) for name in SALES_MEASURES]
    stock = [
        F.coalesce("i_STOCK_ON_HAND_QTY", zero).alias("STOCK_ON_HAND_QTY"),
        F.coalesce("i_ORDERED_STOCK", zero).alias("ORDERED_STOCK_QTY"),
    ]
    # The flags look at the joined columns before any default: without an
    # inventory row a day counts as in stock, and never as low.
    out = F.coalesce(F.col("i_OUT_OF_STOCK_FLG") == 1, F.lit(False))
    low = F.coalesce(F.col("i_STOCK_ON_HAND_QTY") < F.col("s_SALES_QTY"), F.lit(False))
    flags = [
        out.alias("OUT_OF_STOCK_FLG"),
        (~out).alias("IN_STOCK_FLG"),
        low.alias("LOW_STOCK_FLG"),
    ]
    return sold + stock + flags


def sales_inv_store_dy(
    sales_day: DataFrame, inventory_day: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """The daily fact: one row per inventory row, plus one per sales day without inventory.

    Several inventory rows of one key repeat the sales of that key. ``hot`` are keys
    known to hold many of these rows; by default a sample tells.
    """
    hot = sampled_hot_keys(inventory_day) if hot is None else hot
    return match_days(sales_day, inventory_day, hot).select(*fact_columns())
