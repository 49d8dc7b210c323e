"""The plan of the job: one shuffle of each fact, and none for the sums of days and weeks."""

import random
from datetime import date, timedelta

import golden
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import exchanges, keys, plan

from stockweek.functions import sizes
from stockweek.functions.nulls import fill_nulls
from stockweek.operators import hot_keys
from stockweek.operators.hot_keys import HotKeys
from stockweek.operators.star import pairs_repeat, star_report
from stockweek.operators.weekly import (
    MART_COLUMNS,
    METRIC_COLUMNS,
    SUMMED_METRICS,
    weekly_mart,
    weekly_sums,
    with_metrics,
)
from stockweek.plans.layout import stage_facts, weekly_mart_from_staged
from stockweek.sources.schemas import JOB_SCHEMAS

FACTS = "TRANS_DT STORE_KEY PROD_KEY SALES_QTY SALES_PRICE SALES_AMT DISCOUNT SALES_COST SALES_MGRN".split()
STOCK = "CAL_DT STORE_KEY PROD_KEY INVENTORY_ON_HAND_QTY INVENTORY_ON_ORDER_QTY OUT_OF_STOCK_FLG".split()


def frame(spark, table, columns, made):
    schema = JOB_SCHEMAS[table]
    at = {c: i for i, c in enumerate(columns)}
    full = [tuple(r[at[f.name]] if f.name in at else None for f in schema.fields) for r in made]
    return fill_nulls(spark.createDataFrame(full, schema).repartition(5))


@pytest.fixture(scope="module")
def facts(spark):
    """Few keys, so that days have several sales, several stock rows, both, or one of them."""
    pick, first = random.Random(3), date(2022, 1, 2)

    def key(days):
        day = None if pick.random() < 0.05 else first + timedelta(days=pick.randrange(days))
        return day, pick.choice([None, 1, 2]), pick.choice([None, *range(1, 30)])

    def number():
        return pick.choice([None, float("nan"), -0.0, 2.5, 1 / 3, 1e9, pick.randrange(10_000) / 100])

    sales = [(*key(40), *(number() for _ in FACTS[3:])) for _ in range(4000)]
    stock = [(*key(45), number(), number(), pick.choice([None, 0, 1])) for _ in range(4000)]
    days = [(first + timedelta(days=n), n % 7, 2022, n // 7) for n in range(42)]
    calendar = frame(spark, "calendar", ["CAL_DT", "DAY_OF_WK_NUM", "YR_NUM", "WK_NUM"], days)
    return frame(spark, "sales", FACTS, sales), frame(spark, "inventory", STOCK, stock), calendar


@pytest.mark.parametrize("partitions", ["1", "8", "300"])
def test_sums_are_those_of_the_mart(spark, facts, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found, wanted = with_metrics(weekly_sums(*facts, metrics=True)), weekly_mart(*facts, metrics=True)
        assert found.columns == wanted.columns == MART_COLUMNS + METRIC_COLUMNS
        assert [f.dataType for f in found.schema] == [f.dataType for f in wanted.schema]
        assert rows(found) == rows(wanted) and found.count() > 300
        assert rows(weekly_sums(*facts)) == rows(weekly_mart(*facts))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_other_calendars_take_the_other_plan(facts):
    sales, stock, calendar = facts
    twice = calendar.unionAll(calendar.filter("WK_NUM = 2"))
    assert rows(weekly_sums(sales, stock, twice)) == rows(weekly_mart(sales, stock, twice))


@pytest.mark.parametrize("hot_side", ["sales", "stock"])
def test_hot_keys_of_either_fact_take_the_other_plan(facts, monkeypatch, hot_side):
    sales, stock, calendar = facts
    monkeypatch.setattr(hot_keys, "HOT_HITS", 2)
    monkeypatch.setattr(hot_keys, "HOT_SAMPLE", 1.0)
    held = stock if hot_side == "stock" else stock.limit(0)
    sold = sales if hot_side == "sales" else sales.limit(0)
    found = weekly_sums(sold, held, calendar, metrics=True)
    assert "Window" not in plan(found)
    wanted = weekly_mart(sold, held, calendar, metrics=True).select(*MART_COLUMNS, *SUMMED_METRICS)
    assert rows(found) == rows(wanted)


def test_each_fact_is_shuffled_once(spark, tmp_path):
    stored = []
    for make in (golden.sales, golden.inventory, golden.calendar):
        make(spark).write.parquet(f"{tmp_path}/{make.__name__}")
        stored.append(fill_nulls(spark.read.parquet(f"{tmp_path}/{make.__name__}")))
    text = plan(weekly_sums(*stored))
    assert [keys(e) for e in exchanges(text)] == ["WEEK_HASH, STORE_KEY, PROD_KEY"] * 2
    assert "SortMergeJoin" not in text and "Union" in text


@pytest.mark.parametrize("weeks", [1, 3])
def test_pairs_are_summed_first_if_they_repeat(spark, monkeypatch, weeks):
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    made = [(2022, w, s, p, 1.5 * w, 2.0, w, 1) for w in range(weeks) for s in range(3) for p in range(20)]
    fact = spark.createDataFrame(
        made, "YR_NUM int, WK_NUM int, STORE_KEY int, PROD_KEY int, WK_SALES_QTY double,"
        " WK_SALES_AMT double, OUT_OF_STOCK_TIMES long, LOW_STOCK_TIMES long",
    )
    store = spark.createDataFrame([(1, "m"), (2, None)], "STORE_KEY int, MARKET_NAME string")
    product = spark.createDataFrame([(p, f"c{p % 4}") for p in range(15)], "PROD_KEY int, CATEGORY_NAME string")
    assert pairs_repeat(fact) == (weeks > 1)
    found, wanted = (star_report(fact, store, product, repeated=r) for r in (pairs_repeat(fact), True))
    assert rows(found) == rows(wanted) and found.count() == 10
    summed = [e for e in exchanges(plan(found)) if keys(e) == "YR_NUM, STORE_KEY, PROD_KEY"]
    assert bool(summed) == (weeks > 1)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot_side", [None, "sales", "stock"])
def test_long_weeks_are_staged_by_week_and_not_shuffled_again(spark, facts, tmp_path, monkeypatch, hot_side):
    sales, stock, calendar = facts
    loose = {c: F.when(F.col("WK_NUM") != 5, F.floor(F.col(c) / 4).cast("int")) for c in ("YR_NUM", "WK_NUM")}
    calendar, database = calendar.withColumns(loose), f"long_weeks_{hot_side}"
    wanted = rows(weekly_mart(sales, stock, calendar, metrics=True))
    hot = HotKeys(0, [])
    if hot_side == "stock":
        key = stock.filter("CAL_DT IS NOT NULL").select(*hot_keys.DAY_KEYS).first()
        hot = HotKeys(10, [(*key, 5)])
    elif hot_side == "sales":
        monkeypatch.setattr(hot_keys, "HOT_HITS", 2)
        monkeypatch.setattr(hot_keys, "HOT_SAMPLE", 1.0)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    stage_facts(sales, stock, calendar, database, 4, hot)
    sold = spark.table(f"{database}.staged_sales")
    assert len(sold.inputFiles()) <= 4 and ("PART" in sold.columns) == (hot_side == "stock")
    found = weekly_mart_from_staged(spark, database, metrics=True)
    assert rows(found) == wanted and len(wanted) > 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(weekly_mart_from_staged(spark, database))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Bucketed: true") == 2
    assert len(exchanges(text)) == (1 if hot_side == "stock" else 0)
