"""The physical plans: what is broadcast, shuffled, pushed down and pruned."""

import re

import golden
import pytest

from stockweek.functions import sizes
from stockweek.operators import hot_keys, weekly
from stockweek.operators.daily import (
    daily_inventory,
    daily_sales,
    sales_inv_store_dy,
)
from stockweek.operators.snapshots import snapshot_as_of
from stockweek.operators.star import star
from stockweek.operators.weekly import sales_inv_store_wk, weekly_mart


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    found = []
    for make in (golden.sales, golden.inventory, golden.calendar):
        make(spark).write.parquet(f"{base}/{make.__name__}")
        found.append(spark.read.parquet(f"{base}/{make.__name__}"))
    return found


@pytest.fixture(autouse=True)
def no_size_based_broadcast(spark):
    """Tables of the example are tiny; without this Spark would broadcast them all."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def keys(exchange):
    return re.sub(r"#\d+|, \d+$", "", exchange)


def test_fused_weekly_plan(stored):
    text = plan(weekly_mart(*stored))
    week = "WEEK_HASH, STORE_KEY, PROD_KEY"
    assert sorted(keys(e) for e in exchanges(text)) == sorted(
        ["TRANS_DT, STORE_KEY, PROD_KEY", week, week, "YR_NUM, WK_NUM, STORE_KEY, PROD_KEY"]
    )
    assert text.count("BroadcastHashJoin") == 3 and text.count("SortMergeJoin") == 1
    assert "FullOuter" in text and "rangepartitioning" not in text
    assert "partial_sum" in text
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert not any("SHIP_COST" in s or "WASTE_QTY" in s or "TRANS_ID" in s for s in scans)


def test_daily_join_reuses_the_sales_exchange(stored):
    sales, stock, _ = stored
    text = plan(sales_inv_store_dy(daily_sales(sales), daily_inventory(stock)))
    assert sorted(keys(e) for e in exchanges(text)) == [
        "CAL_DT, STORE_KEY, PROD_KEY",
        "TRANS_DT, STORE_KEY, PROD_KEY",
    ]


def test_hot_keys_are_dealt_within_one_join(stored, monkeypatch):
    sales, stock, calendar = stored
    monkeypatch.setattr(hot_keys, "HOT_HITS", 2)
    monkeypatch.setattr(hot_keys, "HOT_SAMPLE", 1.0)
    text = plan(weekly_mart(sales, stock, calendar))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("SortMergeJoin") == 1 and len(exchanges(text)) == 4
    assert sum("PART" in e for e in exchanges(text)) == 2
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert sum("INVENTORY_ON_HAND_QTY" in s for s in scans) == 1


def test_known_hot_keys_leave_one_scan_of_the_inventory(stored, monkeypatch):
    sales, stock, calendar = stored
    monkeypatch.setattr(weekly, "sampled_hot_keys", None)  # it would fail if it were called
    key = tuple(stock.select(*hot_keys.DAY_KEYS).first())
    text = plan(weekly_mart(sales, stock, calendar, hot=hot_keys.HotKeys(10, [(*key, 5)])))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert sum("INVENTORY_ON_HAND_QTY" in s for s in scans) == 1
    assert sum("PART" in e for e in exchanges(text)) == 2


def test_large_calendar_is_not_broadcast(stored, monkeypatch):
    sales, stock, calendar = stored
    day = sales_inv_store_dy(daily_sales(sales), daily_inventory(stock))
    assert "BroadcastHashJoin" in plan(sales_inv_store_wk(day, calendar))
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", 3)
    assert "BroadcastHashJoin" not in plan(sales_inv_store_wk(day, calendar))
    assert "BroadcastHashJoin" not in plan(weekly_mart(sales, stock, calendar))


def test_dimensions_are_measured_before_a_broadcast(spark, stored, monkeypatch):
    fact = weekly_mart(*stored)
    store = spark.createDataFrame([(1, "m")], "STORE_KEY int, MARKET_NAME string")
    product = spark.createDataFrame([(1, "c")], "PROD_KEY int, CATEGORY_NAME string")

    def broadcast_joins():
        text = plan(star(fact, store, product, ["MARKET_NAME"], ["CATEGORY_NAME"]))
        return len(re.findall(r"BroadcastHashJoin \[[^\]]*\], \[[^\]]*\], LeftOuter", text))

    assert broadcast_joins() == 2
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", 10)
    assert broadcast_joins() == 0


def test_as_of_filter_reaches_the_scan(stored):
    text = plan(snapshot_as_of(stored[0], "sales", "2022-01-05", 1))
    assert "LessThanOrEqual(TRANS_DT,2022-01-06)" in text
