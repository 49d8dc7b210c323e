"""Marts brought up to a new day, facts stored in buckets, rows set apart, tables served in place."""

import glob
import os
import re
from datetime import date, timedelta

import golden
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stockweek.functions.nulls import fill_nulls
from stockweek.operators import hot_keys, star
from stockweek.operators.changes import changed_groups, touched_weeks
from stockweek.operators.quarantine import split_unknown_keys
from stockweek.operators.weekly import weekly_mart
from stockweek.plans import serving
from stockweek.plans.incremental import update_weekly_mart
from stockweek.plans.commands import run_command
from stockweek.plans.layout import stage_facts, weekly_mart_from_staged
from stockweek.plans.weekly_mart import FACT, run_weekly_mart
from stockweek.sinks import catalog
from stockweek.sources.schemas import JOB_SCHEMAS

START = date(2022, 12, 18)


def tables(spark, change=None):
    """Four weeks over New Year, with few keys, undated rows and nulls."""
    days = [START + timedelta(n) for n in range(28)]
    sold = [
        (n, n % 3 if n % 11 else None, n % 4 if n % 7 else None, days[n * 5 % 28] if n % 13 else None, 0,
         float(n % 6), 2.5, n * 0.25, 0.0, 1.0, 1.0, 0.0)
        for n in range(200)
    ]
    stock = [
        (days[n * 3 % 28] if n % 17 else None, n % 4, n % 3, float(n % 9), 1.0, n % 2, 0.0, True, None)
        for n in range(150)
    ]
    weeks = [
        (d, "x", (d - START).days % 7, "day", d.year, 1 + (d - START).days // 7, 0, 1, 0, 1, 0) for d in days
    ]
    given = {"sales": sold, "inventory": stock, "calendar": weeks}
    given.update({"store": [(1, *[None] * 20)], "product": [(1, *[None] * 10)]})
    if change:
        change(given, days)
    return {name: spark.createDataFrame(r, JOB_SCHEMAS[name]) for name, r in given.items()}


def stored(spark, base, change=None):
    paths = {}
    for name, df in tables(spark, change).items():
        paths[name] = f"{base}/{name}"
        df.coalesce(1).write.mode("overwrite").csv(paths[name], header=True)
    return paths


def sale(given, n, **changes):
    fields = JOB_SCHEMAS["sales"].fieldNames()
    row = dict(zip(fields, given["sales"][n], strict=True)) | changes
    given["sales"][n] = tuple(row.values())


def nothing(given, days):
    given["sales"].reverse()


def one_sale(given, days):
    sale(given, 5, SALES_QTY=77.0)


def new_days(given, days):
    given["sales"] = [r for r in given["sales"] if r[3] is None or r[3] < days[15]]
    given["inventory"] = [r for r in given["inventory"] if r[0] is None or r[0] < days[15]]


def a_year_goes(given, days):
    given["sales"] = [r for r in given["sales"] if r[3] is None or r[3].year == 2022]
    given["inventory"] = [r for r in given["inventory"] if r[0] is None or r[0].year == 2022]


def a_store_goes(given, days):
    given["sales"] = [r for r in given["sales"] if r[2] != 3]
    given["inventory"] = [r for r in given["inventory"] if r[1] != 3]


def a_week_moves(given, days):
    given["calendar"] = [(*r[:5], 9 if r[0] == days[9] else r[5], *r[6:]) for r in given["calendar"]]


def a_date_twice(given, days):
    given["calendar"].append((*given["calendar"][9][:5], 9, *given["calendar"][9][6:]))


CHANGES = [nothing, one_sale, new_days, a_year_goes, a_store_goes, a_week_moves, a_date_twice]


@pytest.mark.parametrize("back", [False, True])
@pytest.mark.parametrize("change", CHANGES, ids=lambda c: c.__name__)
def test_an_update_equals_a_run_from_scratch(spark, tmp_path, change, back):
    """With a partition column that is of the week and one that is a key, in one direction of time each."""
    old, new = stored(spark, f"{tmp_path}/a"), stored(spark, f"{tmp_path}/b", change)
    if back:
        old, new = new, old
    for column, metrics in [("STORE_KEY", False)] if back else [("wk_num", True)]:
        run_weekly_mart(spark, old, f"{tmp_path}/{column}", column, metrics)
        run_weekly_mart(spark, new, f"{tmp_path}/{column}-want", column, metrics)
        before = files(f"{tmp_path}/{column}")
        done = update_weekly_mart(spark, old, new, f"{tmp_path}/{column}", column, metrics)
        got = spark.read.parquet(f"{tmp_path}/{column}/{FACT}")
        want = spark.read.parquet(f"{tmp_path}/{column}-want/{FACT}")
        assert rows(got) == rows(want.select(*got.columns))
        kept = {f for f in before if int(re.search(r"=(\d+)", f)[1]) not in done.written + done.removed}
        assert kept <= files(f"{tmp_path}/{column}")
        if change is nothing:
            assert done == (0, [], []) and files(f"{tmp_path}/{column}") == before
        if change is one_sale:
            assert done.weeks == 1 and len(done.written) == 1 and kept


def files(out):
    return set(glob.glob(f"{out}/{FACT}/*/*.parquet"))


def test_update_command_and_wrong_columns(spark, tmp_path):
    old, new = stored(spark, f"{tmp_path}/a"), stored(spark, f"{tmp_path}/b", one_sale)
    run_weekly_mart(spark, old, f"{tmp_path}/out", "YR_NUM")
    params = {"name": "n", "old_input_path": old, "input_path": new, "output_path": f"{tmp_path}/out"}
    said = run_command("update", {**params, "partition_column": "YR_NUM"})
    assert said == [f"1 weeks computed anew, 1 partitions written to {tmp_path}/out"]
    for wrong in ({"partition_column": "WK_NUM"}, {"partition_column": "YR_NUM", "metrics": True}):
        with pytest.raises(ValueError, match="has the columns"):
            run_command("update", {**params, **wrong})


def test_fingerprints_are_of_multisets(spark):
    make = lambda *r: spark.createDataFrame(list(r), "k int, a int, b int")
    same = make((1, 1, 2), (1, 3, 4), (2, 1, None), (None, 5, 5))
    for other, differ in (
        (make((None, 5, 5), (1, 3, 4), (2, 1, None), (1, 1, 2)), []),
        (make((1, 1, 2), (1, 3, 4), (2, None, 1), (None, 5, 5)), [(2,)]),
        (make((1, 1, 2), (1, 3, 4), (1, 3, 4), (2, 1, None)), [(1,), (None,)]),
        (make((1, 1, 4), (1, 3, 2), (2, 1, None), (None, 5, 5)), [(1,)]),
        (make(), [(1,), (2,), (None,)]),
    ):
        assert rows(changed_groups(same, other, ["k"], ["a", "b"])) == differ
    assert rows(changed_groups(same.unionAll(same), same, ["k"], ["a", "b"])) == [(1,), (2,), (None,)]


def test_rows_are_combined_before_they_are_compared(spark, tmp_path):
    for name, df in tables(spark).items():
        df.write.parquet(f"{tmp_path}/{name}")
    read = {n: fill_nulls(spark.read.parquet(f"{tmp_path}/{n}")) for n in ("sales", "inventory", "calendar")}
    text = touched_weeks(read, read)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and "SortMergeJoin" not in text and "Cartesian" not in text
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert not any("SHIP_COST" in s or "WASTE_QTY" in s for s in scans)


@pytest.mark.parametrize("known", [False, True])
@pytest.mark.parametrize("change", [nothing, a_date_twice], ids=lambda c: c.__name__)
def test_staged_facts_join_without_a_shuffle(spark, tmp_path, monkeypatch, change, known):
    if known:
        monkeypatch.setattr(hot_keys, "HOT_HITS", 2)
        monkeypatch.setattr(hot_keys, "HOT_SAMPLE", 1.0)
    t = {name: fill_nulls(df) for name, df in tables(spark, change).items()}
    database = f"staged_{change.__name__}_{known}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    stage_facts(t["sales"], t["inventory"], t["calendar"], database, 4)
    monkeypatch.setattr(hot_keys, "HOT_HITS", 10**9)
    mart = weekly_mart_from_staged(spark, database, metrics=True)
    assert rows(mart) == rows(weekly_mart(t["sales"], t["inventory"], t["calendar"], metrics=True))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = weekly_mart_from_staged(spark, database)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 1 and "FullOuter" in text
    below = text[text.index("SortMergeJoin") :]
    assert not re.search(r"(?<!Broadcast)Exchange", below) and below.count("Bucketed: true") == 2
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_rows_are_set_apart_with_a_reason(spark, tmp_path):
    t = tables(spark)
    for n, (table, df) in enumerate((x, y) for x in ("sales", "inventory") for y in (t[x], fill_nulls(t[x]))):
        split = split_unknown_keys(df, table, f"{tmp_path}/{n}")
        assert rows(split.kept.unionAll(split.rejected.drop("REASON"))) == rows(df)
        date_column = {"sales": "TRANS_DT", "inventory": "CAL_DT"}[table]
        for r in split.rejected.collect():
            day, store = r[date_column], r["STORE_KEY"]
            assert r["REASON"] == ("no date" if day is None else "no product" if store else "no store")
            assert r["REASON"] != "no product" or not r["PROD_KEY"]
        assert split.kept.filter(f"{date_column} IS NULL OR STORE_KEY = 0 OR PROD_KEY = 0").isEmpty()
    empty = split_unknown_keys(t["sales"].limit(0), "sales", f"{tmp_path}/empty")
    assert empty.kept.isEmpty() and empty.rejected.isEmpty()
    text = split.kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(REASON" in text


def test_the_job_sets_rows_apart(spark, tmp_path):
    paths = stored(spark, f"{tmp_path}/in")
    run_weekly_mart(spark, paths, f"{tmp_path}/out", "YR_NUM", quarantine=True)
    fact = spark.read.parquet(f"{tmp_path}/out/{FACT}")
    assert fact.filter("STORE_KEY = 0 OR PROD_KEY = 0").isEmpty() and not fact.isEmpty()
    rejected = spark.read.parquet(f"{tmp_path}/out/rejected/sales")
    assert {r[0] for r in rejected.select("REASON").distinct().collect()} == {"no date", "no store", "no product"}


def served(spark, base, out, **options):
    run_weekly_mart(spark, base, out, "STORE_KEY", **options)
    serving.register_output(spark, out, "STORE_KEY", "kept_in_place", f"{out}-db")
    spark.catalog.setCurrentDatabase("default")
    return spark.table(f"kept_in_place.{FACT}")


def test_a_served_table_stays_in_place(spark, tmp_path, monkeypatch):
    out, said = f"{tmp_path}/out", []
    first = served(spark, stored(spark, f"{tmp_path}/a", a_store_goes), out)
    partitions = {r[0] for r in spark.sql(f"SHOW PARTITIONS kept_in_place.{FACT}").collect()}
    assert "STORE_KEY=3" not in partitions and first.count() > 0
    sql = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (said.append(q), sql(q, *a, **k))[1])
    fact = served(spark, stored(spark, f"{tmp_path}/b"), out, metrics=True)
    changes = [q for q in said if re.match("DROP|CREATE TABLE|ALTER|MSCK", q)]
    assert [q.split(" (")[0].split(" PARTITION")[0] for q in changes] == [
        f"ALTER TABLE kept_in_place.{FACT} ADD COLUMNS",
        f"ALTER TABLE kept_in_place.{FACT} ADD IF NOT EXISTS",
    ]
    assert rows(fact) == rows(spark.read.parquet(f"{out}/{FACT}").select(*fact.columns))
    assert "NO_STOCK_IMPACT" in fact.columns and "STORE_KEY=3" in changes[1].replace("'", "").replace(" = ", "=")
    said.clear()
    back = served(spark, stored(spark, f"{tmp_path}/a", a_store_goes), out, metrics=True)
    assert [q for q in said if re.match("DROP|CREATE TABLE|MSCK|ALTER", q)] == [
        f"ALTER TABLE kept_in_place.{FACT} DROP IF EXISTS PARTITION (STORE_KEY = '3')"
    ]
    assert rows(back) == rows(spark.read.parquet(f"{out}/{FACT}").select(*back.columns))


def test_a_table_of_another_folder_is_swapped_whole(spark, tmp_path):
    paths = stored(spark, f"{tmp_path}/in")
    first = served(spark, paths, f"{tmp_path}/one")
    assert rows(served(spark, paths, f"{tmp_path}/two")) == rows(first)
    names = {t.name for t in spark.catalog.listTables("kept_in_place")}
    assert names == {FACT, f"{FACT}_star", "store", "product", "calendar"}
    location = spark.sql(f"DESCRIBE EXTENDED kept_in_place.{FACT}").filter("col_name = 'Location'").first()[1]
    assert location.endswith("/two/" + FACT)


def test_reports_take_sizes_from_the_catalog(spark, tmp_path, monkeypatch):
    paths = stored(spark, f"{tmp_path}/in")
    fact = served(spark, paths, f"{tmp_path}/out")
    store = spark.table("kept_in_place.store")
    want = rows(star.star_report(fact, store, spark.table("kept_in_place.product")))
    size = catalog.known_size(spark, "kept_in_place.store")
    assert size.rows == 1 and size.bytes == sum(map(os.path.getsize, glob.glob(f"{tmp_path}/out/store/part-*")))
    assert catalog.known_size(spark, f"kept_in_place.{FACT}_star") is None
    monkeypatch.setattr("stockweek.functions.sizes.size_of", None)  # no pass over the dimensions
    report = serving.served_star_report(spark, "kept_in_place")
    text = report._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 2 and rows(report) == want
    pruned = spark.sql(
        f"""SELECT sum(f.WK_SALES_QTY) FROM kept_in_place.{FACT} f
            JOIN kept_in_place.store s ON f.STORE_KEY = s.STORE_KEY WHERE s.REGION = 'None'"""
    )
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    assert pruned.first()[0] == fact.filter("STORE_KEY = 1").agg(F.sum("WK_SALES_QTY")).first()[0]


def test_the_example_is_a_mart_from_buckets(spark, tmp_path):
    t = [fill_nulls(f(spark)) for f in (golden.sales, golden.inventory, golden.calendar)]
    spark.sql(f"CREATE DATABASE staged_golden LOCATION '{tmp_path}/db'")
    for _ in range(2):  # staging again takes the place of what was staged
        stage_facts(*t, "staged_golden", 2)
        assert rows(weekly_mart_from_staged(spark, "staged_golden")) == rows(weekly_mart(*t))
