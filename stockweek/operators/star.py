"""Fact and dimensions joined for reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweek.functions.measures import total
from stockweek.functions.sizes import Size, fits_broadcast

# What a report sums before it looks at dimensions that are not small.
PAIR = ["YR_NUM", "STORE_KEY", "PROD_KEY"]


def _dimension(
    table: DataFrame, key: str, columns: list[str], size: Size | None = None
) -> tuple[DataFrame, bool]:
    """The columns needed, with a broadcast hint if they are known or measured to be small, and whether so."""
    picked = table.select(key, *columns)
    small = fits_broadcast(picked, size)
    return (F.broadcast(picked) if small else picked), small


def star(
    fact: DataFrame,
    store: DataFrame,
    product: DataFrame,
    store_columns: list[str],
    product_columns: list[str],
) -> DataFrame:
    """Fact rows with columns of their store and product.

    Every fact row is kept: key 0, which stands for an unknown store or product,
    has no dimension row.
    """
    stores, _ = _dimension(store, "STORE_KEY", store_columns)
    products, _ = _dimension(product, "PROD_KEY", product_columns)
    return fact.join(stores, "STORE_KEY", "left").join(products, "PROD_KEY", "left")


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        total("SALES_QTY").alias("SALES_QTY"),
        total("SALES_AMT").alias("SALES_AMT"),
        F.sum("OUT_OF_STOCK_TIMES").alias("OUT_OF_STOCK_TIMES"),
        F.sum("LOW_STOCK_TIMES").alias("LOW_STOCK_TIMES"),
    )


def star_report(
    fact: DataFrame,
    store: DataFrame,
    product: DataFrame,
    sizes: tuple[Size | None, Size | None] = (None, None),
    repeated: bool = True,
) -> DataFrame:
    """Sales and stock-outs per year, market and product category.

    With small dimensions the fact meets them where it is read, and only the sums
    are shuffled. Otherwise it is summed per year, store and product first, so that
    the joins shuffle one row per pair instead of one per week; unless ``repeated`` says
    that hardly a pair has several weeks, when that would be one shuffle more for nothing.
    ``sizes`` are those of store and product where they are known, else they are measured.
    """
    stores, few_stores = _dimension(store, "STORE_KEY", ["MARKET_NAME"], sizes[0])
    products, few_products = _dimension(product, "PROD_KEY", ["CATEGORY_NAME"], sizes[1])
    rows = fact.withColumnsRenamed({"WK_SALES_QTY": "SALES_QTY", "WK_SALES_AMT": "SALES_AMT"})
    if repeated and not (few_stores and few_products):
        rows = _summed(rows, *PAIR)
    joins = [(stores, "STORE_KEY", few_stores), (products, "PROD_KEY", few_products)]
    # Large dimensions first, so that names from small ones are not shuffled.
    for dimension, key, _ in sorted(joins, key=lambda join: join[2]):
        rows = rows.join(dimension, key, "left")
    return _summed(rows, "YR_NUM", "MARKET_NAME", "CATEGORY_NAME")


def pairs_repeat(fact: DataFrame) -> bool:
    """Whether the rows of a stored fact are at least twice its pairs of a year, store and product.

    One pass over the keys. The number of pairs is estimated, which decides only the plan.
    """
    rows, pairs = fact.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*PAIR))).first()
    return rows >= 2 * pairs
