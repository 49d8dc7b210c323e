"""Scans, null normalisation, raw load, sinks and serving tables."""

import glob
import os
from datetime import date
from decimal import Decimal

import golden
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from stockweek.functions.nulls import fill_nulls
from stockweek.operators.weekly import MART_COLUMNS, METRIC_COLUMNS, weekly_mart
from stockweek.plans.commands import run_command
from stockweek.plans.raw_load import load_raw
from stockweek.plans.serving import register_output
from stockweek.plans.weekly_mart import as_mapping, read_inputs, run_weekly_mart
from stockweek.sinks import files
from stockweek.sinks.files import read_fact, write_csv, write_fact
from stockweek.sources.csv import ObservedScan, parse_report, read_csv, read_table
from stockweek.sources.schemas import JOB_SCHEMAS, RAW_SCHEMAS, TABLES, raw_ddl


def put(path, text):
    path.write_text(text)
    return str(path)


def test_column_counts():
    counts = {"calendar": 11, "inventory": 9, "product": 11, "sales": 12, "store": 21}
    assert {t: len(JOB_SCHEMAS[t]) for t in TABLES} == counts
    assert {t: len(RAW_SCHEMAS[t]) for t in TABLES} == counts
    assert JOB_SCHEMAS["store"]["STORE_NUM"].dataType == T.IntegerType()
    assert "STORE_NUM varchar(30)" in raw_ddl("store")
    assert RAW_SCHEMAS["sales"]["SALES_AMT"].dataType == T.DecimalType(38, 2)


SCAN = r"""wrong,names,here,x,x,x,x,x,x
2022-01-03,1,2,3.5,4,1,0.5,true,2022-01-05
2022-13-03,abc,5.00,oops,\N,\N,,1,01/02/2022
2022-01-04,7
2022-01-05,1,2,3,4,0,0,FALSE,2022-01-06,extra,more
"""


def test_csv_scan(spark, tmp_path):
    scan = read_csv(spark, "inventory", put(tmp_path / "i.csv", SCAN))
    assert scan.columns == JOB_SCHEMAS["inventory"].fieldNames()
    d = date
    assert [tuple(r) for r in scan.collect()] == [
        (d(2022, 1, 3), 1, 2, 3.5, 4.0, 1, 0.5, True, d(2022, 1, 5)),
        (None,) * 9,
        (d(2022, 1, 4), 7, *[None] * 7),
        (d(2022, 1, 5), 1, 2, 3.0, 4.0, 0, 0.0, False, d(2022, 1, 6)),
    ]


def test_csv_text_fields(spark, tmp_path):
    text = 'h\n1,"a, b",1,1,\\N,0,x\n2,a\\,b,1,1,z,0,x\n3,,1,1,"",0,x\n'
    path = put(tmp_path / "p.csv", text)
    got = [tuple(r)[:5] for r in read_csv(spark, "product", path).collect()]
    assert got[0] == (1, "a, b", 1.0, 1.0, "\\N")
    assert got[1][:3] == (2, "a\\", None)
    assert got[2][1] is None
    with_null = read_csv(spark, "product", path, null_value="\\N")
    assert with_null.first()["BRAND_NAME"] is None


def test_fill_nulls(spark):
    kinds = "i int, d double, m decimal(10,6), s string, b boolean, t date"
    data = [(None,) * 6, (1, float("nan"), Decimal("2.5"), "x", True, date(2022, 1, 1))]
    empty, full = fill_nulls(spark.createDataFrame(data, kinds)).collect()
    assert tuple(empty) == (0, 0.0, Decimal("0.000000"), "None", None, None)
    assert tuple(full) == (1, 0.0, Decimal("2.500000"), "x", True, date(2022, 1, 1))


# --- raw load ---------------------------------------------------------------

CALENDAR = "h\n2022-01-02,Fiscal,0,Sunday,2022,2,202202,1,202201,1,202201\n"
STORE_ROW = "1,A-7,name,addr,city,reg,c,n,{zip},p,p,t,t,true,12.345,1,m,1,s,12345.5,-1\n"


def test_raw_load(spark, tmp_path):
    staged = {
        "calendar": put(tmp_path / "c.csv", CALENDAR),
        "store": put(tmp_path / "s.csv", "h\n" + STORE_ROW.format(zip="A1B2C3")),
    }
    loaded = load_raw(spark, staged, "raw_a", f"{tmp_path}/db")
    store = loaded["store"].first()
    assert (store.STORE_NUM, store.FRNCHS_FLG) == ("A-7", True)
    assert (store.STORE_SIZE, store.LATITUDE) == (Decimal("12.345"), Decimal("12345.500000"))
    assert loaded["calendar"].first().DAY_OF_WK_NUM == "0"
    text = "h\n" + STORE_ROW.format(zip="\\N").replace("12.345", "12.3456").replace("A-7", "")
    staged["store"] = put(tmp_path / "s2.csv", text)
    again = load_raw(spark, staged, "raw_a", f"{tmp_path}/db")
    store = again["store"].first()
    assert (store.STORE_NUM, store.POSTAL_ZIP_CD) == (None, None)
    assert store.STORE_SIZE == Decimal("12.346")
    assert again["store"].count() == 1
    spark.catalog.setCurrentDatabase("default")


def test_raw_integers_are_wide(spark, tmp_path):
    text = "h\n3000000000,1,5000000000,2022-01-03,1,1,1,1,0,1,1,1\n"
    loaded = load_raw(spark, {"sales": put(tmp_path / "w.csv", text)}, "raw_w", f"{tmp_path}/db")
    row = loaded["sales"].first()
    spark.catalog.setCurrentDatabase("default")
    assert (row.TRANS_ID, row.STORE_KEY) == (3_000_000_000, 5_000_000_000)


@pytest.mark.parametrize(
    "table,text",
    [
        ("store", "h\n" + STORE_ROW.format(zip="longer than ten")),
        ("calendar", CALENDAR + "2022-01-03,Fiscal,1,Monday,oops,2,1,1,1,1,1\n"),
        ("calendar", CALENDAR + ",Fiscal,1,Monday,2022,2,1,1,1,1,1\n"),
    ],
)
def test_raw_load_stops_at_a_bad_row(spark, tmp_path, table, text):
    path = put(tmp_path / "bad.csv", text)
    with pytest.raises(Exception, match="(?i)malformed|exceeds|is null|length"):
        load_raw(spark, {table: path}, "raw_b", f"{tmp_path}/db")
    spark.catalog.setCurrentDatabase("default")
    assert spark.table(f"raw_b.{table}").count() == 0


# --- sinks ------------------------------------------------------------------


@pytest.fixture(scope="module")
def mart(spark):
    tables = [fill_nulls(f(spark)) for f in (golden.sales, golden.inventory, golden.calendar)]
    return weekly_mart(*tables)


def test_fact_round_trip(spark, mart, tmp_path):
    path = f"{tmp_path}/fact"
    write_fact(mart, path, "store_key")
    back = read_fact(spark, path, MART_COLUMNS)
    assert rows(back) == rows(mart) and back.schema.simpleString() == mart.schema.simpleString()
    assert len(glob.glob(f"{path}/STORE_KEY=*")) == 6
    with pytest.raises(AnalysisException):
        write_fact(mart, path, "store_id")


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LISTING_WAVES", 1)
    path, name = f"{tmp_path}/fact", "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    made = spark.range(0, 40, 1, 1).selectExpr("id AS N", "CAST(id AS INT) AS STORE_KEY")
    made.write.partitionBy("STORE_KEY").parquet(path)
    context, before = spark.sparkContext, spark.conf.get(name)
    context.setJobGroup("open a fact", "")
    try:
        fact = read_fact(spark, path, ["N", "STORE_KEY"])
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup("open a fact")]
    tasks = [status.getStageInfo(s).numTasks for job in jobs for s in job.stageIds]
    assert max(tasks) == context.defaultParallelism < 40 and spark.conf.get(name) == before
    assert rows(fact) == rows(made)


def test_observed_scan(spark, tmp_path):
    scan = ObservedScan(spark, "inventory", put(tmp_path / "i.csv", SCAN))
    assert rows(scan.rows) == rows(read_table(spark, "inventory", str(tmp_path / "i.csv")))
    assert {tuple(r[:3]): r[3] for r in scan.report() if r[3]} == FAULTS


@pytest.mark.parametrize("mode,left", [("static", {2}), ("dynamic", {1, 2, 3})])
def test_partition_overwrite(spark, mart, tmp_path, mode, left):
    path = f"{tmp_path}/fact"
    write_fact(mart.filter("STORE_KEY IN (1, 2, 3)"), path, "STORE_KEY")
    write_fact(mart.filter("STORE_KEY = 2"), path, "STORE_KEY", mode)
    assert {r.STORE_KEY for r in spark.read.parquet(path).collect()} == left


def test_few_files_per_partition_and_sorted(spark, tmp_path):
    cells = spark.range(0, 40000, 1, 16).selectExpr(
        "2022 AS YR_NUM", "CAST(id % 52 AS INT) AS WK_NUM", "CAST(id % 10 AS INT) AS STORE_KEY",
        "CAST(id AS INT) AS PROD_KEY", "rand(1) AS X",
    )
    path = f"{tmp_path}/fact"
    write_fact(cells, path, "STORE_KEY")
    assert len(glob.glob(f"{path}/*/*.parquet")) == 10
    for file in glob.glob(f"{path}/*/*.parquet"):
        order = [(r.WK_NUM, r.PROD_KEY) for r in spark.read.parquet(file).collect()]
        assert order == sorted(order)


def test_hot_partition_is_split(spark, tmp_path):
    cells = spark.range(0, 400000, 1, 16).selectExpr(
        "2022 AS YR_NUM", "CAST(id % 52 AS INT) AS WK_NUM",
        "CAST(IF(id % 3 > 0, 1, id % 7) AS INT) AS STORE_KEY", "CAST(id AS INT) AS PROD_KEY",
        "rand(1) AS X",
    )
    path = f"{tmp_path}/fact"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    write_fact(cells, path, "STORE_KEY")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{path}/STORE_KEY=1/*.parquet")) > 2
    assert spark.read.parquet(path).count() == 400000


def test_csv_sink(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, None, ""), (2, "a,b", "x")], "a int, b string, c string")
    write_csv(df.repartition(7), f"{tmp_path}/out")
    (part,) = glob.glob(f"{tmp_path}/out/part-*.csv")
    assert sorted(open(part).read().split("\n")) == sorted(["a,b,c", '1,,""', '2,"a,b",x', ""])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    monkeypatch.setattr(files, "MAX_FILE_BYTES", 2_000_000)
    large = spark.range(0, 500000, 1, 8).selectExpr("id", "uuid() AS u")
    write_csv(large, f"{tmp_path}/large")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/large/part-*.csv")) > 1


# --- job and serving tables -------------------------------------------------


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("inputs")
    frames = {
        "sales": golden.sales(spark),
        "inventory": golden.inventory(spark),
        "calendar": golden.calendar(spark),
        "store": spark.createDataFrame([(1, None, "s")], "k int, n int, d string"),
        "product": spark.createDataFrame([(1, "p")], "k int, n string"),
    }
    for name, df in frames.items():
        df.coalesce(1).write.csv(f"{base}/{name}", header=True)
    return {name: f"{base}/{name}" for name in frames}


def test_job(spark, mart, inputs, tmp_path):
    run_weekly_mart(spark, inputs, f"{tmp_path}/out/", "prod_key")
    fact = read_fact(spark, f"{tmp_path}/out/sales_inv_store_wk", MART_COLUMNS)
    assert rows(fact) == rows(mart)
    store = read_csv(spark, "store", f"{tmp_path}/out/store").first()
    assert (store.STORE_KEY, store.STORE_NUM, store.STORE_DESC, store.ADDR) == (1, 0, "s", "None")
    assert sorted(os.listdir(tmp_path / "out")) == [
        "calendar", "product", "sales_inv_store_wk", "store",
    ]
    tables = read_inputs(spark, inputs)
    assert rows(read_table(spark, "calendar", f"{tmp_path}/out/calendar")) == rows(
        tables["calendar"]
    )


def test_job_with_metrics(spark, inputs, tmp_path):
    run_weekly_mart(spark, inputs, f"{tmp_path}/out", "yr_num", metrics=True)
    fact = read_fact(spark, f"{tmp_path}/out/sales_inv_store_wk", MART_COLUMNS + METRIC_COLUMNS)
    assert fact.count() == 6


def test_job_parameters(spark, mart, inputs, tmp_path):
    assert as_mapping('{"a": true}') == as_mapping("{'a': True}") == as_mapping({"a": True})
    text = (
        f'{{"name": "n", "input_path": "{inputs}", "output_path": "{tmp_path}/o",'
        ' "partition_column": "STORE_KEY"}'
    )
    run_command("mart", text)
    path = f"{tmp_path}/o/sales_inv_store_wk"
    assert rows(read_fact(spark, path, MART_COLUMNS)) == rows(mart)
    assert "NO_STOCK_IMPACT" not in spark.read.parquet(path).columns
    run_command("mart", text[:-1] + ', "metrics": true, "partition_overwrite": "dynamic"}')
    assert read_fact(spark, path, MART_COLUMNS + METRIC_COLUMNS).count() == 6


def test_commands_from_load_to_mart(spark, tmp_path):
    from stockweek.sources.schemas import RAW_SCHEMAS

    frames = {"sales": golden.sales(spark), "inventory": golden.inventory(spark), "calendar": golden.calendar(spark)}
    for table in ("store", "product"):
        frames[table] = spark.createDataFrame([(1, *[None] * (len(RAW_SCHEMAS[table]) - 1))], RAW_SCHEMAS[table])
    for name, df in frames.items():
        df.write.csv(f"{tmp_path}/in/{name}", header=True)
    staged = {name: f"{tmp_path}/in/{name}" for name in frames}
    base = {"name": "n", "database": "raw_c", "location": f"{tmp_path}/db"}
    loaded = run_command("load", {**base, "staged": staged})
    spark.catalog.setCurrentDatabase("default")
    assert "sales: 9 rows loaded" in loaded
    day = {"name": "n", "location": f"{tmp_path}/day", "day": "2022-01-09"}
    report = run_command("export", {**base, **day, "as_of": "2022-01-08"})
    assert "sales: 7 rows unloaded" in report
    run = {**day, "output_path": f"{tmp_path}/out", "partition_column": "STORE_KEY", "metrics": True}
    assert run_command("run-if-ready", run) == [f"written to {tmp_path}/out"]
    assert spark.read.parquet(f"{tmp_path}/out/sales_inv_store_wk").count() == 6
    with pytest.raises(SystemExit, match="missing: calendar, inventory"):
        run_command("run-if-ready", {**run, "day": "2022-01-10"})


def test_serving_tables(spark, mart, inputs, tmp_path):
    run_weekly_mart(spark, inputs, f"{tmp_path}/out", "STORE_KEY")
    register_output(spark, f"{tmp_path}/out", "STORE_KEY", "serving", f"{tmp_path}/db")
    spark.catalog.setCurrentDatabase("default")
    fact = spark.table("serving.sales_inv_store_wk").select(*MART_COLUMNS)
    assert rows(fact) == rows(mart)
    one = fact.filter(F.col("STORE_KEY") == 3)
    assert "PartitionFilters: [isnotnull(STORE_KEY" in one._jdf.queryExecution().toString()
    assert spark.table("serving.store").first().STORE_DESC == "s"
    assert spark.table("serving.calendar").count() == 7
    run_weekly_mart(spark, inputs, f"{tmp_path}/wide", "STORE_KEY", metrics=True)
    register_output(spark, f"{tmp_path}/wide", "STORE_KEY", "serving", f"{tmp_path}/db")
    spark.catalog.setCurrentDatabase("default")
    served = spark.sql("SELECT NO_STOCK_IMPACT FROM serving.sales_inv_store_wk WHERE STORE_KEY = 5")
    assert served.collect() == [(24.0,)]


# --- reloads and faults -----------------------------------------------------


def sales_rows(*ids):
    return "h\n" + "".join(f"{i},1,1,2022-01-03,1,1,1,1,0,1,1,1\n" for i in ids)


def test_a_failed_reload_leaves_every_table_as_it_was(spark, tmp_path):
    staged = {"calendar": put(tmp_path / "c.csv", CALENDAR), "sales": put(tmp_path / "s.csv", sales_rows(1, 2))}
    load_raw(spark, staged, "raw_r", f"{tmp_path}/db")
    reader = spark.table("raw_r.sales")
    later = {
        "sales": put(tmp_path / "s2.csv", sales_rows(3)),
        "calendar": put(tmp_path / "bad.csv", CALENDAR + "2022-01-03,Fiscal,1,Monday,oops,2,1,1,1,1,1\n"),
    }
    with pytest.raises(Exception, match="(?i)malformed"):
        load_raw(spark, later, "raw_r", f"{tmp_path}/db")
    assert rows(spark.table("raw_r.sales").select("TRANS_ID")) == [(1,), (2,)]
    assert spark.table("raw_r.calendar").count() == 1
    assert len(glob.glob(f"{tmp_path}/db/loads/sales/load-*")) == 1
    assert {t.name for t in spark.catalog.listTables("raw_r")} == {"calendar", "sales"}
    later["calendar"] = staged["calendar"]
    load_raw(spark, later, "raw_r", f"{tmp_path}/db")
    assert rows(spark.table("raw_r.sales").select("TRANS_ID")) == [(3,)]
    assert reader.count() == 2  # one that began before still has its rows
    load_raw(spark, {"sales": put(tmp_path / "s3.csv", sales_rows(4))}, "raw_r", f"{tmp_path}/db")
    assert len(glob.glob(f"{tmp_path}/db/loads/sales/load-*")) == 2
    spark.catalog.setCurrentDatabase("default")


def test_a_table_of_other_columns_is_defined_anew(spark, tmp_path):
    spark.sql("CREATE DATABASE raw_o")
    spark.sql("CREATE TABLE raw_o.sales (TRANS_ID string) USING parquet")
    load_raw(spark, {"sales": put(tmp_path / "s.csv", sales_rows(1))}, "raw_o")
    spark.catalog.setCurrentDatabase("default")
    assert spark.table("raw_o.sales").columns == RAW_SCHEMAS["sales"].fieldNames()
    assert spark.table("raw_o.sales").count() == 1


FAULTS = {
    ("inventory", "CAL_DT", "does not parse"): 1,
    ("inventory", "STORE_KEY", "does not parse"): 1,
    ("inventory", "PROD_KEY", "does not parse"): 1,
    ("inventory", "INVENTORY_ON_HAND_QTY", "does not parse"): 1,
    ("inventory", "INVENTORY_ON_ORDER_QTY", "does not parse"): 1,
    ("inventory", "OUT_OF_STOCK_FLG", "does not parse"): 1,
    ("inventory", "PROMOTION_FLG", "does not parse"): 1,
    ("inventory", "NEXT_DELIVERY_DT", "does not parse"): 1,
    ("inventory", None, "too few fields"): 1,
    ("inventory", None, "too many fields"): 1,
}


def test_parse_report(spark, tmp_path):
    path = put(tmp_path / "i.csv", SCAN)
    found = {tuple(r[:3]): r[3] for r in parse_report(spark, "inventory", path).collect() if r[3]}
    assert found == FAULTS
    with_null = parse_report(spark, "inventory", path, "\\N").collect()
    assert {r[1] for r in with_null if r[3]} & {"INVENTORY_ON_ORDER_QTY", "OUT_OF_STOCK_FLG"} == set()
    end = ",1,1,x,0,x,1,x,1,"
    lines = ['1,"a, b,c"' + end + "x", '"x","y\\",z"' + end + "x", "1,a" + end + "x,", "1,a" + end + "x,,,", "1,a" + end[:-1]]
    quoted = put(tmp_path / "p.csv", "h\n" + "\n".join(lines) + "\n")
    found = {tuple(r[1:3]): r[3] for r in parse_report(spark, "product", quoted).collect() if r[3]}
    assert found == {("PROD_KEY", "does not parse"): 1, (None, "too many fields"): 2, (None, "too few fields"): 1}
    empty = put(tmp_path / "e.csv", "h\n")
    assert not any(r[3] for r in parse_report(spark, "inventory", empty).collect())


def test_faults_counted_by_the_job(spark, inputs, mart, tmp_path):
    given = {**inputs, "inventory": [inputs["inventory"], put(tmp_path / "i.csv", SCAN)]}
    run_weekly_mart(spark, given, f"{tmp_path}/out", "YR_NUM", parse_report=True)
    report = spark.read.csv(f"{tmp_path}/out/parse_report", header=True)
    found = {tuple(r[:3]): int(r[3]) for r in report.collect() if r[3] != "0"}
    assert {k: n for k, n in found.items() if k[0] == "inventory"} == FAULTS
    run_weekly_mart(spark, given, f"{tmp_path}/plain", "YR_NUM")
    assert rows(spark.read.parquet(f"{tmp_path}/out/sales_inv_store_wk")) == rows(
        spark.read.parquet(f"{tmp_path}/plain/sales_inv_store_wk")
    )
