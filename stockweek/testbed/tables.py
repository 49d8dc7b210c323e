"""The five retail tables as Spark derives them from the star-schema test data.

Every row of ``lineitem`` becomes one sale and two stock counts, so the work grows
with the data. Three grains: ``item`` keys stores by supplier and products by part,
``brand`` keys them by region and brand, which puts many rows into each key, and
``hot`` is ``item`` with a third of all rows on one day, store and product. Some
fields are left null, so that null handling shows in every result. All arithmetic
is on integers or cents, so that SQL engines agree on it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweek.functions.nulls import fill_nulls
from stockweek.sources.schemas import JOB_SCHEMAS

EPOCH = "1995-01-01"  # a Sunday
HOT_DAY = "1997-06-07"
ALL = "calendar inventory product sales store"
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


Read = Callable[[str], DataFrame]


def reader(spark: SparkSession, sf_dir: str) -> Read:
    """Finds a source table by name; each is opened once."""
    return cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _null_if(divisor: int, value: Column) -> Column:
    return F.when(F.col("l_orderkey") % divisor != 0, value)


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in JOB_SCHEMAS[table].fields]
    )


def _lines(read: Read, grain: str) -> DataFrame:
    lines = read("lineitem").withColumn("SHIP_DT", F.to_date("l_shipdate"))
    if grain in ("item", "hot"):
        store, product = F.col("l_suppkey"), F.col("l_partkey")
        if grain == "hot":
            hot = F.col("l_orderkey") % 3 == 0
            store = F.when(hot, 1).otherwise(store)
            product = F.when(hot, 1).otherwise(product)
            day = F.when(hot, F.lit(HOT_DAY).cast("date")).otherwise(F.col("SHIP_DT"))
            lines = lines.withColumn("SHIP_DT", day)
    else:
        part = read("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("BRAND"),
        )
        region = (
            read("supplier")
            .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("l_suppkey"), "n_regionkey")
        )
        lines = lines.join(part, "l_partkey").join(region, "l_suppkey")
        store, product = F.col("n_regionkey"), F.col("BRAND")
    return lines.withColumns({"STORE_KEY": _null_if(97, store), "PROD_KEY": product})


def calendar(read: Read) -> DataFrame:
    """Every day from the first to the last shipment; weeks start on Sunday and on 1 January."""
    span = read("lineitem").agg(
        F.min(F.to_date("l_shipdate")).alias("a"), F.max(F.to_date("l_shipdate")).alias("z")
    )
    days = span.select(F.explode(F.sequence("a", "z")).alias("CAL_DT"))
    day, year = F.datediff("CAL_DT", F.lit(EPOCH).cast("date")), F.year("CAL_DT")
    of_year = F.dayofyear("CAL_DT") - 1
    week = (1 + F.floor((of_year + (day - of_year) % 7) / 7)).cast("int")
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    month, quarter = F.month("CAL_DT"), F.quarter("CAL_DT")
    return _typed(
        days.select(
            "CAL_DT",
            F.lit("Fiscal").alias("CAL_TYPE_DESC"),
            (day % 7).alias("DAY_OF_WK_NUM"),
            F.element_at(names, day % 7 + 1).alias("DAY_OF_WK_DESC"),
            year.alias("YR_NUM"),
            week.alias("WK_NUM"),
            (year * 100 + week).alias("YR_WK_NUM"),
            month.alias("MNTH_NUM"),
            (year * 100 + month).alias("YR_MNTH_NUM"),
            quarter.alias("QTR_NUM"),
            (year * 100 + quarter).alias("YR_QTR_NUM"),
        ),
        "calendar",
    )


def sales(read: Read, grain: str = "item") -> DataFrame:
    price = read("part").select(
        F.col("p_partkey").alias("l_partkey"), "p_retailprice"
    )
    cost = F.col("l_quantity") * 10
    return _typed(
        _lines(read, grain)
        .join(price, "l_partkey")
        .select(
            ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) % 2147483647).alias("TRANS_ID"),
            "PROD_KEY",
            "STORE_KEY",
            _null_if(89, F.col("SHIP_DT")).alias("TRANS_DT"),
            F.col("l_linenumber").alias("TRANS_TIME"),
            F.col("l_quantity").alias("SALES_QTY"),
            F.col("p_retailprice").alias("SALES_PRICE"),
            F.col("l_extendedprice").alias("SALES_AMT"),
            _null_if(83, F.col("l_discount")).alias("DISCOUNT"),
            cost.alias("SALES_COST"),
            (F.rint((F.col("l_extendedprice") - cost) * 100) / 100).alias("SALES_MGRN"),
            F.col("l_tax").alias("SHIP_COST"),
        ),
        "sales",
    )


def inventory(read: Read, grain: str = "item") -> DataFrame:
    """Per line one count on the day or the next, and one on the Saturday that ends the week."""
    to_saturday = 6 - F.datediff("SHIP_DT", F.lit(EPOCH).cast("date")) % 7
    counts = _lines(read, grain).withColumn("K", F.explode(F.array(F.lit(0), F.lit(1))))
    shift = F.when(F.col("K") == 0, F.col("l_linenumber") % 2).otherwise(to_saturday)
    order, line, k = F.col("l_orderkey"), F.col("l_linenumber"), F.col("K")
    on_hand = (order * 7 + line * 13 + k * 5) % 60
    return _typed(
        counts.withColumns(
            {
                "CAL_DT": _null_if(101, F.date_add("SHIP_DT", shift)),
                "ON_HAND": on_hand,
                "ON_ORDER": (order + line * 3 + k) % 25,
            }
        ).select(
            "CAL_DT",
            "STORE_KEY",
            "PROD_KEY",
            _null_if(79, F.col("ON_HAND")).alias("INVENTORY_ON_HAND_QTY"),
            F.col("ON_ORDER").alias("INVENTORY_ON_ORDER_QTY"),
            _null_if(73, (F.col("ON_HAND") < 6).cast("int")).alias("OUT_OF_STOCK_FLG"),
            (order % 3).alias("WASTE_QTY"),
            (k == 0).alias("PROMOTION_FLG"),
            F.date_add("CAL_DT", 3).alias("NEXT_DELIVERY_DT"),
        ),
        "inventory",
    )


def store(read: Read) -> DataFrame:
    """One row per supplier, with its nation as market; the other columns are null."""
    wide = (
        read("supplier")
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key = F.col("s_suppkey")
    known = {
        "STORE_KEY": key,
        "STORE_NUM": key + 100,
        "STORE_DESC": F.col("s_name"),
        "REGION": F.col("r_name"),
        "CNTRY_NM": F.col("n_name"),
        "MARKET_KEY": F.col("s_nationkey"),
        "MARKET_NAME": F.col("n_name"),
        "LATITUDE": key % 90,
        "LONGITUDE": key % 180,
    }
    return _with_nulls(wide, "store", known)


def product(read: Read) -> DataFrame:
    """One row per part; the other columns are null."""
    known = {
        "PROD_KEY": F.col("p_partkey"),
        "PROD_NAME": F.col("p_name"),
        "VOL": F.col("p_retailprice"),
        "BRAND_NAME": F.col("p_brand"),
        "CATEGORY_KEY": F.col("p_size"),
        "CATEGORY_NAME": F.col("p_type"),
    }
    return _with_nulls(read("part"), "product", known)


def _with_nulls(df: DataFrame, table: str, known: dict[str, Column]) -> DataFrame:
    return df.select(
        *[
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in JOB_SCHEMAS[table].fields
        ]
    )


def full_store(read: Read) -> DataFrame:
    """Stores with a value in every column; those of text hold commas, quotes and spaces."""
    key, name = F.col("s_suppkey"), F.col("s_name")
    city = F.concat(F.lit("City, "), key.cast("string"))
    known = {
        "ADDR": F.concat(name, F.lit(' Street, 5')),
        "CITY": city,
        "CNTRY_CD": F.concat(F.lit("C"), F.col("s_nationkey").cast("string")),
        "POSTAL_ZIP_CD": F.concat(F.lit('Z'), key.cast('string')),
        "PROV_STATE_DESC": F.concat(F.lit('the "'), F.col("s_nationkey").cast("string"), F.lit('"')),
        "PROV_STATE_CD": F.col("s_nationkey").cast("string"),
        "STORE_TYPE_CD": F.when(key % 2 == 0, "A").otherwise("B"),
        "STORE_TYPE_DESC": F.when(key % 2 == 0, " even ").otherwise("odd"),
        "FRNCHS_FLG": F.when(key % 3 == 0, "true").otherwise("false"),
        "STORE_SIZE": F.concat((key % 1000).cast("string"), F.lit(".125")),
        "SUBMARKET_KEY": key % 7,
        "SUBMARKET_NAME": F.concat(F.lit("S"), (key % 7).cast("string")),
    }
    rest = store(read).drop(*known)
    added = read("supplier").select(key.cast("int").alias("STORE_KEY"), *(c.alias(n) for n, c in known.items()))
    return _typed(rest.join(added, "STORE_KEY"), "store")


def full_product(read: Read) -> DataFrame:
    """Products with a value in every column."""
    key = F.col("p_partkey")
    known = {
        "WGT": F.col("p_size") / 4,
        "STATUS_CODE": key % 5,
        "STATUS_CODE_NAME": F.concat(F.lit("status, "), (key % 5).cast("string")),
        "SUBCATEGORY_KEY": key % 11,
        "SUBCATEGORY_NAME": F.concat(F.col('p_type'), F.lit('; sub')),
    }
    rest = product(read).drop(*known)
    added = read("part").select(key.cast("int").alias("PROD_KEY"), *(c.alias(n) for n, c in known.items()))
    return _typed(rest.join(added, "PROD_KEY"), "product")


def loose_weeks(calendar: DataFrame) -> DataFrame:
    """A calendar that does not tell the weeks of summer apart."""
    known = ~F.col("MNTH_NUM").isin(6, 7)
    return calendar.withColumns({c: F.when(known, F.col(c)).otherwise(0) for c in ("YR_NUM", "WK_NUM")})


def repeated_dates(calendar: DataFrame) -> DataFrame:
    """A calendar that holds the dates of December twice."""
    return calendar.unionAll(calendar.filter(F.col("MNTH_NUM") == 12))


# Folders of tables written by ``store_tables``, by source folder and grain.
_stored: dict[tuple[str, str], str] = {}


def store_tables(spark: SparkSession, sf_dir: str, base: str, grain: str = "item") -> None:
    """Write the tables once; from then on ``tables`` reads them from there."""
    for name, df in tables(spark, sf_dir, grain=grain).items():
        df.write.parquet(f"{base}/{grain}/{name}")
    _stored[sf_dir, grain] = f"{base}/{grain}"


def tables(
    spark: SparkSession, sf_dir: str, names: str = ALL, grain: str = "item"
) -> dict[str, DataFrame]:
    """The named tables with their nulls, as a warehouse would dump them."""
    if base := _stored.get((sf_dir, grain)):
        return {name: spark.read.parquet(f"{base}/{name}") for name in names.split()}
    read = reader(spark, sf_dir)
    make = {
        "calendar": lambda: calendar(read),
        "inventory": lambda: inventory(read, grain),
        "product": lambda: product(read),
        "sales": lambda: sales(read, grain),
        "store": lambda: store(read),
    }
    return {name: make[name]() for name in names.split()}


def clean_tables(
    spark: SparkSession, sf_dir: str, names: str = ALL, grain: str = "item"
) -> dict[str, DataFrame]:
    """The named tables after null normalisation, as the mart job sees them."""
    return {name: fill_nulls(df) for name, df in tables(spark, sf_dir, names, grain).items()}
