"""Daily fact, weekly mart and metrics on a worked example and against brute force."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal
from math import fsum

import golden
import pytest
from conftest import rows

from pyspark.sql import Observation
from pyspark.sql import functions as F

from stockweek.functions import sizes
from stockweek.functions.measures import total
from stockweek.functions.nulls import fill_nulls
from stockweek.operators import hot_keys
from stockweek.operators import weekly as weekly_module
from stockweek.operators.daily import (
    daily_inventory,
    daily_sales,
    sales_inv_store_dy,
)
from stockweek.operators.weekly import (
    MART_COLUMNS,
    METRIC_COLUMNS,
    sales_inv_store_wk,
    week_keys_and,
    weekly_mart,
)
from stockweek.sources.schemas import JOB_SCHEMAS


@pytest.fixture(scope="module")
def example(spark):
    return tuple(fill_nulls(f(spark)) for f in (golden.sales, golden.inventory, golden.calendar))


def day_fact(sales, inventory, hot=None):
    return sales_inv_store_dy(daily_sales(sales), daily_inventory(inventory), hot)


def test_daily_fact(example):
    sales, inventory, _ = example
    fact = {(r.CAL_DT, r.STORE_KEY): r for r in day_fact(sales, inventory).collect()}
    assert day_fact(sales, inventory).count() == 11
    first = fact[date(2022, 1, 3), 1]
    assert first[3:9] == (3, 15, 40, 0.5, 24, 16)
    assert first[9:] == (2, 4, False, True, True)
    sold_only = fact[date(2022, 1, 5), 2]
    assert sold_only[9:] == (0, 0, False, True, False)
    stock_only = fact[date(2022, 1, 4), 1]
    assert stock_only[3:9] == (0,) * 6 and stock_only[11:] == (True, False, False)


@pytest.fixture(params=["no hot keys", "hot keys"])
def hot(request, monkeypatch):
    """Whether keys of a few rows count as hot."""
    if request.param == "hot keys":
        monkeypatch.setattr(hot_keys, "HOT_HITS", 2)
        monkeypatch.setattr(hot_keys, "HOT_SAMPLE", 1.0)


@pytest.mark.parametrize("stepwise", [True, False])
def test_weekly_mart(example, stepwise, hot):
    sales, inventory, calendar = example
    if stepwise:
        mart = sales_inv_store_wk(day_fact(sales, inventory), calendar, metrics=True)
    else:
        mart = weekly_mart(sales, inventory, calendar, metrics=True)
    assert mart.columns == MART_COLUMNS + METRIC_COLUMNS
    got = {r.STORE_KEY: r for r in mart.collect()}
    assert got.keys() == golden.MART.keys()
    for store, row in got.items():
        assert (row.YR_NUM, row.WK_NUM, row.PROD_KEY) == (2022, 2, 1)
        assert row[4:15] == golden.MART[store]
        assert row[15:] == pytest.approx(golden.METRICS[store])


def test_types(example):
    mart = weekly_mart(*example, metrics=True)
    kinds = [f.dataType.simpleString() for f in mart.schema.fields]
    assert kinds[:15] == ["int"] * 4 + ["double"] * 8 + ["bigint"] * 3
    assert kinds[15:] == ["double"] * 3 + ["bigint"] + ["double"] * 3
    assert week_keys_and(mart, "NO_STOCK_IMPACT").columns[-1] == "NO_STOCK_IMPACT"


# --- brute force ------------------------------------------------------------

START = date(2021, 12, 20)


def random_tables(spark, seed, double_dates, parts=(100, 700, 90_000)):
    """Random sales, stock and calendar; values have two decimals, or no end of them."""
    rnd = random.Random(seed)
    days = [START + timedelta(n) for n in range(21)]

    def day():
        return rnd.choice(days + [None, date(2023, 1, 1)])

    def key(top):
        return rnd.choice([None, 0, *range(1, top)])

    sales = [
        (n, key(4), key(3), day(), 0, *[rnd.randrange(0, 9000) / rnd.choice(parts) for _ in range(7)])
        for n in range(400)
    ]
    stock = [
        (day(), key(3), key(4), rnd.choice([None, rnd.randrange(0, 200) / 1.0]),
         float(rnd.randrange(9)), rnd.choice([None, 0, 1]), 0.0, True, None)
        for _ in range(300)
    ]
    # one key with a third of the stock rows, many of them copies
    stock += [
        (days[5], 1, 1, float(rnd.randrange(3) * 60), 1.0, rnd.randrange(2), 0.0, True, None)
        for _ in range(150)
    ]
    calendar = []
    for d in days[:18]:
        year, number = d.year, (d.weekday() + 1) % 7
        week = None if d == days[3] else d.isocalendar().week
        row = (d, "x", number, "x", year, week, 0, d.month, 0, 1, 0)
        calendar += [row] * (2 if double_dates and d.day == 25 else 1)
    make = spark.createDataFrame
    return (
        make(sales, JOB_SCHEMAS["sales"]),
        make(stock, JOB_SCHEMAS["inventory"]),
        make(calendar, JOB_SCHEMAS["calendar"]),
    )


def brute_force(sales, stock, calendar):
    """The mart by plain loops over the collected rows."""
    sold = defaultdict(list)
    for r in sales.collect():
        sold[r.TRANS_DT, r.STORE_KEY, r.PROD_KEY].append(r)
    held = defaultdict(list)
    for r in stock.collect():
        held[r.CAL_DT, r.STORE_KEY, r.PROD_KEY].append(r)
    weeks = defaultdict(list)
    for c in calendar.collect():
        for key in {k for k in [*sold, *held] if k[0] == c.CAL_DT}:
            s, n = sold.get(key), len(sold.get(key, []))
            qty = fsum(r.SALES_QTY for r in s) if s else None
            for i in held.get(key) or [None]:
                out = i is not None and i.OUT_OF_STOCK_FLG == 1
                low = i is not None and s is not None and i.INVENTORY_ON_HAND_QTY < qty
                hand = i.INVENTORY_ON_HAND_QTY if i else 0
                order = i.INVENTORY_ON_ORDER_QTY if i else 0
                end = c.DAY_OF_WK_NUM == 6
                amount = fsum(r.SALES_AMT for r in s) if s else 0
                price = fsum(r.SALES_PRICE for r in s) / n if s else 0
                weeks[c.YR_NUM, c.WK_NUM, *key[1:]].append(
                    (
                        qty or 0, price, amount, fsum(r.DISCOUNT for r in s) / n if s else 0,
                        fsum(r.SALES_COST for r in s) if s else 0,
                        fsum(r.SALES_MGRN for r in s) if s else 0,
                        hand * end, order * end, int(out), int(not out), int(low),
                        (amount - hand * price) * low, amount * out,
                    )
                )
    result = {}
    for key, found in weeks.items():
        total = [fsum(column) for column in zip(*found)]
        total[1] /= len(found)
        result[key] = total
    return result


@pytest.mark.parametrize("seed,double_dates", [(1, False), (2, True)])
@pytest.mark.parametrize("how", ["fused", "stepwise", "shuffled"])
def test_against_brute_force(spark, monkeypatch, seed, double_dates, how, hot):
    sales, stock, calendar = (fill_nulls(t) for t in random_tables(spark, seed, double_dates))
    if how == "shuffled":
        monkeypatch.setattr(sizes, "BROADCAST_ROWS", 3)
    if how == "fused":
        mart = weekly_mart(sales, stock, calendar, metrics=True)
    else:
        mart = sales_inv_store_wk(day_fact(sales, stock), calendar, metrics=True)
    want = brute_force(sales, stock, calendar)
    got = {tuple(r[:4]): r for r in mart.collect()}
    assert got.keys() == want.keys() and len(got) == mart.count()
    for key, row in got.items():
        measures = [*row[4:15], row.POTENTIAL_LOW_STOCK_IMPACT, row.NO_STOCK_IMPACT]
        assert measures == pytest.approx(want[key], rel=1e-12, abs=1e-9)


def _takes_the_plan_by_days(monkeypatch, tables):
    called = []
    step = weekly_module.sales_inv_store_wk
    monkeypatch.setattr(
        weekly_module, "sales_inv_store_wk", lambda *a: called.append(1) or step(*a)
    )
    weekly_mart(*tables)
    return bool(called)


def test_weekly_falls_back_without_unique_dates(spark, monkeypatch):
    tables = [fill_nulls(t) for t in random_tables(spark, 3, True)]
    assert _takes_the_plan_by_days(monkeypatch, tables)


def test_weekly_falls_back_with_weeks_that_are_none(spark, monkeypatch):
    sales, stock, calendar = (fill_nulls(t) for t in random_tables(spark, 3, False))
    assert not _takes_the_plan_by_days(monkeypatch, (sales, stock, calendar))
    loose = calendar.withColumns({"YR_NUM": F.lit(0), "WK_NUM": F.lit(0)})
    assert _takes_the_plan_by_days(monkeypatch, (sales, stock, loose))
    week = F.expr("DAY(CAL_DT) > 24 OR MONTH(CAL_DT) = 1")
    mixed = calendar.withColumn("WK_NUM", F.when(week, 0).otherwise(F.col("WK_NUM")))
    want = brute_force(sales, stock, mixed)
    got = {tuple(r[:4]): r.WK_SALES_AMT for r in weekly_mart(sales, stock, mixed).collect()}
    assert got == {key: pytest.approx(row[2], rel=1e-12, abs=1e-9) for key, row in want.items()}


def test_sales_of_days_without_stock_stay(example, hot):
    sales, inventory, _ = example
    fact = day_fact(sales, inventory.filter("STORE_KEY <> 3"))
    assert fact.filter("STORE_KEY = 3").select("SALES_QTY").collect() == [(5.0,)]
    assert day_fact(sales, inventory.limit(0)).count() == daily_sales(sales).count()


def test_no_digit_is_dropped(spark):
    def added(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(total("x")).first()[0]

    assert added(0.00004, 0.00004, 0.00004) == pytest.approx(0.00012, rel=1e-12)
    assert added(1 / 3, 1 / 3, 1 / 3) == pytest.approx(1.0, rel=1e-15)
    assert added(1e-300, None) == 1e-300 and added(None) is None
    assert added(1e308, -1e308, 2.5) == pytest.approx(2.5) or added(1e308, -1e308, 2.5) == 0
    assert added(float("inf"), 1.0) == float("inf")


def test_hot_keys_are_those_with_a_share(spark, monkeypatch):
    _, stock, _ = (fill_nulls(t) for t in random_tables(spark, 4, False))
    found = hot_keys.sampled_hot_keys
    assert found(stock).keys == []
    monkeypatch.setattr(hot_keys, "HOT_HITS", 2)
    monkeypatch.setattr(hot_keys, "HOT_SAMPLE", 1.0)
    monkeypatch.setattr(hot_keys, "HOT_SHARE", 4)
    assert hot_keys.split_parts(found(stock)) == [(START + timedelta(5), 1, 1, 2)]
    monkeypatch.setattr(hot_keys, "HOT_SHARE", 10_000)
    many = hot_keys.split_parts(found(stock))
    assert any(key[0] is None for key in many) and len(many) > 5


def sketched(stock):
    """The hot keys as the pass that writes the rows finds them."""
    seen = Observation()
    rows = stock.observe(seen, F.count(F.lit(1)).alias("rows"), hot_keys.hot_key_sketch().alias("hot"))
    rows.write.format("noop").mode("overwrite").save()
    return hot_keys.read_sketch(seen.get["rows"], seen.get["hot"])


def test_the_sketch_finds_what_the_sample_finds(spark, monkeypatch):
    sales, stock, calendar = random_tables(spark, 4, False)
    monkeypatch.setattr(hot_keys, "HOT_HITS", 2)
    monkeypatch.setattr(hot_keys, "HOT_SAMPLE", 1.0)
    filled = [fill_nulls(t) for t in (sales, stock, calendar)]
    hot = sketched(stock.repartition(5))
    sample = hot_keys.sampled_hot_keys(filled[1])
    assert hot.total == sample.total and sorted(hot.keys, key=str) == sorted(sample.keys, key=str)
    assert rows(weekly_mart(*filled, hot=hot)) == rows(weekly_mart(*filled, hot=hot_keys.HotKeys(0, [])))


def test_the_sketch_of_many_keys_keeps_the_hot_ones(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "TRACKED", 256)
    stock = spark.range(0, 200_000, 1, 16).selectExpr(
        "DATE'2022-01-01' AS CAL_DT", "CAST(IF(id % 20 = 0, NULL, id) AS INT) AS STORE_KEY", "1 AS PROD_KEY"
    )
    monkeypatch.setattr(hot_keys, "HOT_HITS", 10)
    hot = sketched(stock)
    assert [key[:3] for key in hot.keys] == [(date(2022, 1, 1), 0, 1)]
    assert hot.keys[0][3] == pytest.approx(10_000, rel=0.35)


def test_parts_follow_from_the_values(spark, monkeypatch, example):
    """Whatever the order of the rows, and with equal ones among them."""
    monkeypatch.setattr(hot_keys, "HOT_HITS", 2)
    monkeypatch.setattr(hot_keys, "HOT_SAMPLE", 1.0)
    sales, stock, calendar = (fill_nulls(t) for t in random_tables(spark, 6, False))
    stock = stock.unionAll(stock).unionAll(stock)
    none = hot_keys.HotKeys(0, [])
    want = rows(day_fact(sales, stock, none))
    assert rows(day_fact(sales, stock)) == want
    assert rows(day_fact(sales, stock.repartition(5).orderBy(F.rand(3)))) == want


def test_invariants(spark, hot):
    sales, stock, calendar = (fill_nulls(t) for t in random_tables(spark, 5, False))
    fact = day_fact(sales, stock).join(calendar.select("CAL_DT"), "CAL_DT")
    mart = weekly_mart(sales, stock, calendar)
    days = mart.selectExpr("sum(OUT_OF_STOCK_TIMES + IN_STOCK_TIMES)").first()[0]
    assert days == fact.count()
    sold = fact.selectExpr("sum(SALES_QTY)").first()[0]
    assert mart.selectExpr("sum(WK_SALES_QTY)").first()[0] == pytest.approx(sold)
    unique = stock.dropDuplicates(["CAL_DT", "STORE_KEY", "PROD_KEY"])
    plain = sales.join(calendar, sales.TRANS_DT == calendar.CAL_DT)
    total = weekly_mart(sales, unique, calendar).selectExpr("sum(WK_SALES_QTY)").first()
    assert total[0] == pytest.approx(plain.selectExpr("sum(SALES_QTY)").first()[0])


def test_sums_do_not_depend_on_the_order(spark):
    df = spark.range(0, 300_000, 1, 16).selectExpr("(id * 7919 % 1000003) / 100 AS x", "id")
    shuffled = df.repartition(7, "id").sortWithinPartitions((F.col("id") * 31) % 997)
    exact = sum(n * 7919 % 1000003 for n in range(300_000)) / 100
    for frame in (df, shuffled, df.coalesce(1)):
        assert frame.agg(total("x")).first()[0] == exact
    # Beyond 2^53 units, in any order.
    wide = spark.range(0, 100_000, 1, 8).selectExpr("729182399.17 * (id % 3 + 1) * 977 AS x", "id")
    exact = float(sum(Decimal("729182399.17") * (n % 3 + 1) * 977 for n in range(100_000)))
    for frame in (wide, wide.orderBy(F.desc("id")), wide.coalesce(1)):
        assert frame.select(F.col("x").cast("double").alias("x")).agg(total("x")).first()[0] == exact
    huge = spark.range(1000).selectExpr("CAST(1e20 AS DOUBLE) AS x")
    assert huge.agg(total("x")).first()[0] == pytest.approx(1e23)


def test_week_cut_by_new_year_has_no_end(spark):
    d = [date(2022, 12, 30), date(2022, 12, 31), date(2023, 1, 1)]
    calendar = [(x, "x", n, "x", x.year, 1, 0, 1, 0, 1, 0) for x, n in zip(d, (4, 5, 6))]
    stock = [(x, 1, 1, 5.0, 1.0, 0, 0.0, True, None) for x in d]
    make = spark.createDataFrame
    mart = weekly_mart(
        make([], JOB_SCHEMAS["sales"]),
        make(stock, JOB_SCHEMAS["inventory"]),
        make(calendar, JOB_SCHEMAS["calendar"]),
    )
    ends = {r.YR_NUM: (r.EOP_STOCK_ON_HAND_QTY, r.IN_STOCK_TIMES) for r in mart.collect()}
    assert ends == {2022: (0, 2), 2023: (5, 1)}
