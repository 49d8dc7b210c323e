"""The registered queries: each runs an operator or a job over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.functions.dates import SNAPSHOT_PATTERN, snapshot_day
from stockweek.functions.nulls import fill_nulls
from stockweek.operators.daily import (
    daily_inventory,
    daily_sales,
    sales_inv_store_dy,
)
from stockweek.operators.changes import FACT_COLUMNS, changed_groups
from stockweek.operators.quality import key_quality
from stockweek.operators.quarantine import KEPT, split_unknown_keys
from stockweek.operators.snapshots import (
    all_present,
    required_snapshots,
    snapshot_as_of,
    snapshot_files,
)
from stockweek.operators.star import star_report
from stockweek.operators.weekly import (
    MART_COLUMNS,
    METRIC_COLUMNS,
    sales_inv_store_wk,
    week_keys_and,
    weekly_mart,
)
from stockweek.plans.incremental import update_weekly_mart
from stockweek.plans.layout import stage_facts, weekly_mart_from_staged
from stockweek.plans.raw_load import load_raw
from stockweek.plans.serving import register_output, served_star_report
from stockweek.plans.snapshots import (
    audit_files,
    check_snapshots,
    export_snapshots,
    list_whole,
    run_if_ready,
)
from stockweek.plans.weekly_mart import FACT, run_weekly_mart
from stockweek.session import drop_dir, scratch_database, scratch_dir, settings
from stockweek.sinks.files import read_fact, write_csv, write_fact, write_snapshot
from stockweek.sources.csv import NO_VALUE, TOO_FEW, TOO_MANY, parse_report, read_csv, read_table
from stockweek.sources.listing import list_committed, list_files
from stockweek.sources.schemas import JOB_SCHEMAS, TABLES
from stockweek.testbed import oracle, tables

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "1998-12-01"
ALL_DAYS = "2100-01-01"
FACT_TABLES = "sales inventory calendar"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, which every client shows alike."""
    as_plain = {T.DateType: "string", T.DecimalType: "double"}
    return df.select(
        *[F.col(f.name).cast(as_plain.get(type(f.dataType), f.dataType)) for f in df.schema.fields]
    )


def _plain_sql(select: str, dates: str = "", grain: str = "item", weeks: str = "plain") -> str:
    replaced = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates.split())
    every = f"* REPLACE ({replaced})" if replaced else "*"
    return oracle.query(select.format(all=every), grain, weeks)


# Columns that hold means, or follow from them: their last digits depend on the engine.
FROM_MEANS = ("AVG_SALES_PRICE", "WK_DISCOUNT", "POTENTIAL_LOW_STOCK_IMPACT")


def _settled(df: DataFrame, columns=FROM_MEANS) -> DataFrame:
    """The same as ``oracle.settled`` for the columns that are there."""
    shown = {c: F.floor(F.col(c) * 1e6 + 0.4373) / 1e6 for c in columns if c in df.columns}
    return df.withColumns(shown) if shown else df


def _shown(columns: list[str]) -> str:
    return ", ".join(f"{oracle.settled(c)} AS {c}" if c in FROM_MEANS else c for c in columns)


def _names(columns: list[str]) -> str:
    return ", ".join(columns)


def _dumped(spark: SparkSession, sf_dir: str, table: str, grain: str = "item") -> DataFrame:
    return tables.tables(spark, sf_dir, table, grain)[table]


def _clean(spark: SparkSession, sf_dir: str, table: str, grain: str = "item") -> DataFrame:
    return tables.clean_tables(spark, sf_dir, table, grain)[table]


def _mart(spark, sf_dir, metrics=False, grain="item", weeks=lambda calendar: calendar) -> DataFrame:
    t = tables.clean_tables(spark, sf_dir, FACT_TABLES, grain)
    return weekly_mart(t["sales"], t["inventory"], weeks(t["calendar"]), metrics)


# A compressed file is read by one task, so none holds more lines than this.
DUMP_LINES = 100_000

# What a task that dumps reads at most, so that it sorts its lines in memory.
DUMP_TASK_BYTES = "32m"


def _write_dump(df: DataFrame, path: str) -> None:
    """A table as compressed CSV files with header lines.

    Every task writes its lines by date, store and product, as equal fields close to each other
    take less room, here and where the lines are shuffled. Nothing is shuffled for it.
    """
    options = {"header": "true", "compression": "lz4", "maxRecordsPerFile": DUMP_LINES}
    order = [c for c in ("TRANS_DT", "CAL_DT", "STORE_KEY", "PROD_KEY") if c in df.columns]
    with settings(df.sparkSession, {"spark.sql.files.maxPartitionBytes": DUMP_TASK_BYTES}):
        df.sortWithinPartitions(*order).write.options(**options).csv(path)


def _write_inputs(spark: SparkSession, sf_dir: str, base: str) -> dict[str, str]:
    paths = {name: f"{base}/{name}" for name in TABLES}
    for name, df in tables.tables(spark, sf_dir).items():
        _write_dump(df, paths[name])
    return paths


# --- sources ----------------------------------------------------------------


@_register("q_fill_nulls", _plain_sql("SELECT {all} FROM inventory", "CAL_DT NEXT_DELIVERY_DT"))
def q_fill_nulls(spark, sf_dir):
    return _plain(fill_nulls(_dumped(spark, sf_dir, "inventory")))


@_register("q_csv_scan", _plain_sql("SELECT {all} FROM sales", "TRANS_DT"))
def q_csv_scan(spark, sf_dir):
    path = scratch_dir(spark, "scan")
    _dumped(spark, sf_dir, "sales").write.options(header="true").csv(path)
    return _plain(read_table(spark, "sales", path))


@_register(
    "q_csv_scan_inventory", _plain_sql("SELECT {all} FROM inventory", "CAL_DT NEXT_DELIVERY_DT")
)
def q_csv_scan_inventory(spark, sf_dir):
    path = scratch_dir(spark, "scan")
    _dumped(spark, sf_dir, "inventory").write.options(header="true").csv(path)
    return _plain(read_table(spark, "inventory", path))


@_register(
    "q_raw_load",
    oracle.query(
        "SELECT 'calendar' AS TABLE_NAME, count(*) AS N_ROWS FROM calendar"
        " UNION ALL SELECT 'inventory', count(*) FROM inventory"
        " UNION ALL SELECT 'product', count(*) FROM product"
        " UNION ALL SELECT 'sales', count(*) FROM sales"
        " UNION ALL SELECT 'store', count(*) FROM store"
    ),
)
def q_raw_load(spark, sf_dir):
    loaded = _load_raw(spark, sf_dir)
    counts = [
        df.agg(F.count(F.lit(1)).alias("N_ROWS")).select(F.lit(name).alias("TABLE_NAME"), "N_ROWS")
        for name, df in loaded.items()
    ]
    first, *rest = counts
    for part in rest:
        first = first.unionAll(part)
    return first


def _load_raw(spark, sf_dir, base=None):
    base = base or scratch_dir(spark, "raw")
    current = spark.catalog.currentDatabase()
    staged = _write_inputs(spark, sf_dir, f"{base}/staged")
    loaded = load_raw(spark, staged, scratch_database("raw"), f"{base}/tables")
    spark.catalog.setCurrentDatabase(current)
    drop_dir(spark, f"{base}/staged")  # as a stage is purged, once its files are loaded
    return loaded


def _raw_query(table: str, integers: str, others: str = "") -> None:
    """Values of a raw table, nulls filled; its integers are wider than the job's."""
    wide = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in integers.split())
    replaced = f"{wide}, {others}" if others else wide

    @_register(
        f"q_raw_load_{table}", oracle.query(f"SELECT * REPLACE ({replaced}) FROM {table}")
    )
    def run(spark, sf_dir):
        return _plain(fill_nulls(_load_raw(spark, sf_dir)[table]))


_raw_query(
    "sales",
    "TRANS_ID PROD_KEY STORE_KEY TRANS_TIME",
    "CAST(TRANS_DT AS VARCHAR) AS TRANS_DT",
)
_raw_query(
    "inventory",
    "STORE_KEY PROD_KEY OUT_OF_STOCK_FLG",
    "CAST(CAL_DT AS VARCHAR) AS CAL_DT, CAST(NEXT_DELIVERY_DT AS VARCHAR) AS NEXT_DELIVERY_DT",
)
_raw_query(
    "calendar",
    "YR_NUM WK_NUM YR_WK_NUM MNTH_NUM YR_MNTH_NUM QTR_NUM YR_QTR_NUM",
    "CAST(CAL_DT AS VARCHAR) AS CAL_DT, CAST(DAY_OF_WK_NUM AS VARCHAR) AS DAY_OF_WK_NUM",
)
_raw_query("product", "PROD_KEY STATUS_CODE CATEGORY_KEY SUBCATEGORY_KEY")
_raw_query(
    "store",
    "STORE_KEY MARKET_KEY SUBMARKET_KEY",
    "CAST(STORE_NUM AS VARCHAR) AS STORE_NUM, CAST(NULL AS BOOLEAN) AS FRNCHS_FLG,"
    " CAST(0 AS DOUBLE) AS STORE_SIZE",
)


def _reload(spark, sf_dir, change):
    """Raw tables loaded, and then once more with the sales that ``change`` makes of the staged ones."""
    base = scratch_dir(spark, "raw")
    current, database = spark.catalog.currentDatabase(), scratch_database("raw")
    staged = _write_inputs(spark, sf_dir, f"{base}/staged")
    changed = change(_dumped(spark, sf_dir, "sales"))
    _write_dump(changed, f"{base}/staged/changed")
    try:
        first = {**staged, "sales": f"{base}/staged/changed"}
        load_raw(spark, staged, database, f"{base}/tables")
        load_raw(spark, first, database, f"{base}/tables")
    finally:
        spark.catalog.setCurrentDatabase(current)
    return database


_RAW_SALES = (
    "SELECT * REPLACE (CAST(TRANS_ID AS BIGINT) AS TRANS_ID, CAST(PROD_KEY AS BIGINT) AS PROD_KEY,"
    " CAST(STORE_KEY AS BIGINT) AS STORE_KEY, CAST(TRANS_TIME AS BIGINT) AS TRANS_TIME,"
    " CAST(TRANS_DT AS VARCHAR) AS TRANS_DT) FROM sales"
)


@_register("q_raw_reload_failed", oracle.query(_RAW_SALES))
def q_raw_reload_failed(spark, sf_dir):
    """What the sales table serves after a second load that a bad field has stopped."""
    base = scratch_dir(spark, "raw")
    current, database = spark.catalog.currentDatabase(), scratch_database("raw")
    staged = _write_inputs(spark, sf_dir, f"{base}/staged")
    bad = F.when(F.col("TRANS_ID") % 100 == 7, F.lit("oops")).otherwise(F.col("TRANS_ID").cast("string"))
    sales = _dumped(spark, sf_dir, "sales").withColumn("TRANS_ID", bad)
    _write_dump(sales, f"{base}/bad")
    load_raw(spark, staged, database, f"{base}/tables")
    try:
        load_raw(spark, {**staged, "sales": f"{base}/bad"}, database, f"{base}/tables")
    except Exception as error:
        if "MALFORMED_RECORD" not in str(error):
            raise
    else:
        raise AssertionError("a bad field did not stop the load")
    finally:
        spark.catalog.setCurrentDatabase(current)
    return _plain(fill_nulls(spark.table(f"{database}.sales")))


@_register("q_raw_reload", oracle.query(_RAW_SALES + " WHERE TRANS_ID % 3 <> 0"))
def q_raw_reload(spark, sf_dir):
    """What it serves after a second load with other rows."""
    database = _reload(spark, sf_dir, lambda sales: sales.filter("TRANS_ID % 3 <> 0"))
    return _plain(fill_nulls(spark.table(f"{database}.sales")))


def _bad_lines(sales: DataFrame) -> DataFrame:
    """Lines of sales, one in five of them with a fault."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sales.columns]
    fault = F.col("TRANS_ID") % 25
    fields[0] = F.when(fault == 0, F.lit("1e3")).otherwise(fields[0])
    fields[3] = F.when(fault == 5, F.lit("1997-02-30")).otherwise(fields[3])
    fields[5] = F.when(fault == 10, F.lit('"many, many"')).otherwise(fields[5])
    fields[11] = F.when(fault == 10, F.lit("?")).otherwise(fields[11])
    line = F.concat_ws(",", *fields)
    line = F.when(fault == 15, F.concat_ws(",", *fields[:5])).otherwise(line)
    return sales.select(F.when(fault == 20, F.concat(line, F.lit(",x"))).otherwise(line).alias("line"))


@_register(
    "q_parse_report",
    oracle.query(
        ", faults AS (SELECT TRANS_ID % 25 AS fault FROM sales) "
        + " UNION ALL ".join(
            f"SELECT 'sales' AS TABLE_NAME, {column} AS COLUMN_NAME, '{problem}' AS PROBLEM,"
            f" count(*) AS N FROM faults WHERE fault = {fault}"
            for column, problem, fault in [
                ("NULL", TOO_FEW, 15),
                ("NULL", TOO_MANY, 20),
                *(
                    (f"'{c}'", NO_VALUE, {"TRANS_ID": 0, "TRANS_DT": 5, "SALES_QTY": 10, "SHIP_COST": 10}.get(c, -1))
                    for c in JOB_SCHEMAS["sales"].fieldNames()
                ),
            ]
        )
    ),
)
def q_parse_report(spark, sf_dir):
    path = scratch_dir(spark, "lines")
    lines = _bad_lines(_dumped(spark, sf_dir, "sales"))
    # Lines as they are: no text in them is quoted again.
    lines.write.options(header="true", quote="", sep="\u0001").csv(path)
    return parse_report(spark, "sales", path)


_FULL_STORE = """
    SELECT STORE_KEY, STORE_NUM, STORE_DESC, s_name || ' Street, 5' AS ADDR, 'City, ' || s_suppkey AS CITY, REGION,
           'C' || s_nationkey AS CNTRY_CD, CNTRY_NM, 'Z' || s_suppkey AS POSTAL_ZIP_CD,
           'the "' || s_nationkey || '"' AS PROV_STATE_DESC, CAST(s_nationkey AS VARCHAR) AS PROV_STATE_CD,
           CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS STORE_TYPE_CD,
           CASE WHEN s_suppkey % 2 = 0 THEN ' even ' ELSE 'odd' END AS STORE_TYPE_DESC,
           CASE WHEN s_suppkey % 3 = 0 THEN 'true' ELSE 'false' END AS FRNCHS_FLG,
           (s_suppkey % 1000) || '.125' AS STORE_SIZE, MARKET_KEY, MARKET_NAME,
           CAST(s_suppkey % 7 AS INTEGER) AS SUBMARKET_KEY, 'S' || (s_suppkey % 7) AS SUBMARKET_NAME,
           LATITUDE, LONGITUDE
    FROM store JOIN supplier ON s_suppkey = STORE_KEY"""

_FULL_PRODUCT = """
    SELECT PROD_KEY, PROD_NAME, VOL, p_size / 4.0::DOUBLE AS WGT, BRAND_NAME,
           CAST(p_partkey % 5 AS INTEGER) AS STATUS_CODE, 'status, ' || (p_partkey % 5) AS STATUS_CODE_NAME,
           CATEGORY_KEY, CATEGORY_NAME, CAST(p_partkey % 11 AS INTEGER) AS SUBCATEGORY_KEY,
           p_type || '; sub' AS SUBCATEGORY_NAME
    FROM product JOIN part ON p_partkey = PROD_KEY"""


def _full_dimension(table: str, make, sql: str) -> None:
    @_register(f"q_csv_scan_{table}_full", oracle.query(sql))
    def run(spark, sf_dir):
        base = scratch_dir(spark, "full")
        write_snapshot(make(tables.reader(spark, sf_dir)), table, base, AS_OF)
        return _plain(read_table(spark, table, f"{base}/{table}_{AS_OF}.csv"))


_full_dimension("store", tables.full_store, _FULL_STORE)
_full_dimension("product", tables.full_product, _FULL_PRODUCT)


@_register(
    "q_raw_wide_ids",
    oracle.query(
        "SELECT CAST(TRANS_ID AS BIGINT) + 3000000000 AS TRANS_ID, count(*) AS N_ROWS,"
        " CAST(sum(SALES_QTY) AS DOUBLE) AS SALES_QTY FROM sales GROUP BY ALL"
    ),
)
def q_raw_wide_ids(spark, sf_dir):
    """Raw sales whose ids no 32 bits hold."""
    base, database = scratch_dir(spark, "raw"), scratch_database("raw")
    current, sales = spark.catalog.currentDatabase(), _dumped(spark, sf_dir, "sales")
    wide = sales.withColumn("TRANS_ID", F.col("TRANS_ID").cast("bigint") + 3_000_000_000)
    wide.write.options(header="true").csv(f"{base}/staged")
    loaded = load_raw(spark, {"sales": f"{base}/staged"}, database, f"{base}/tables")
    spark.catalog.setCurrentDatabase(current)
    sums = F.sum("SALES_QTY").cast("double").alias("SALES_QTY")
    return loaded["sales"].groupBy("TRANS_ID").agg(F.count(F.lit(1)).alias("N_ROWS"), sums)


# --- daily and weekly -------------------------------------------------------


@_register("q_daily_sales", _plain_sql("SELECT {all} FROM daily_sales", "CAL_DT"))
def q_daily_sales(spark, sf_dir):
    return _plain(daily_sales(_clean(spark, sf_dir, "sales")))


@_register("q_daily_sales_brand", _plain_sql("SELECT {all} FROM daily_sales", "CAL_DT", "brand"))
def q_daily_sales_brand(spark, sf_dir):
    return _plain(daily_sales(_clean(spark, sf_dir, "sales", "brand")))


@_register(
    "q_daily_inventory",
    _plain_sql(
        "SELECT CAST(CAL_DT AS VARCHAR) AS CAL_DT, STORE_KEY, PROD_KEY,"
        " INVENTORY_ON_HAND_QTY AS STOCK_ON_HAND_QTY, INVENTORY_ON_ORDER_QTY AS ORDERED_STOCK,"
        " OUT_OF_STOCK_FLG, WASTE_QTY, PROMOTION_FLG,"
        " CAST(NEXT_DELIVERY_DT AS VARCHAR) AS NEXT_DELIVERY_DT FROM inventory"
    ),
)
def q_daily_inventory(spark, sf_dir):
    return _plain(daily_inventory(_clean(spark, sf_dir, "inventory")))


def _sevenths(sales: DataFrame) -> DataFrame:
    """Sales whose measures have no end of decimals."""
    measures = ("SALES_QTY", "SALES_PRICE", "SALES_AMT", "DISCOUNT", "SALES_COST")
    return sales.withColumns({c: F.col(c) / 7 for c in measures})


def _seventh(function: str, column: str) -> str:
    return f"{oracle.settled(f'{function}({column} / 7)')} AS {column}"


@_register(
    "q_daily_sales_sevenths",
    oracle.query(
        "SELECT CAST(TRANS_DT AS VARCHAR) AS CAL_DT, STORE_KEY, PROD_KEY,"
        f" {_seventh('sum', 'SALES_QTY')}, {_seventh('sum', 'SALES_AMT')},"
        f" {_seventh('avg', 'SALES_PRICE')}, {_seventh('sum', 'SALES_COST')},"
        f" {_seventh('avg', 'DISCOUNT')} FROM sales GROUP BY ALL",
        "brand",
    ),
)
def q_daily_sales_sevenths(spark, sf_dir):
    daily = daily_sales(_sevenths(_clean(spark, sf_dir, "sales", "brand")))
    daily = _plain(daily.drop("SALES_MGRN", "SHIP_COST"))
    return _settled(daily, daily.columns[3:])


def _daily_fact(spark, sf_dir, grain="item"):
    t = tables.clean_tables(spark, sf_dir, "sales inventory", grain)
    return sales_inv_store_dy(daily_sales(t["sales"]), daily_inventory(t["inventory"]))


@_register("q_daily_fact", _plain_sql("SELECT {all} FROM daily_fact", "CAL_DT"))
def q_daily_fact(spark, sf_dir):
    return _plain(_daily_fact(spark, sf_dir))


@_register("q_daily_fact_hot_keys", _plain_sql("SELECT {all} FROM daily_fact", "CAL_DT", "hot"))
def q_daily_fact_hot_keys(spark, sf_dir):
    return _plain(_daily_fact(spark, sf_dir, "hot"))


MART_SQL = f"SELECT {_shown(MART_COLUMNS)} FROM weekly"


@_register("q_weekly_mart", _plain_sql(MART_SQL))
def q_weekly_mart(spark, sf_dir):
    return _settled(_mart(spark, sf_dir))


@_register("q_weekly_mart_brand", _plain_sql(MART_SQL, grain="brand"))
def q_weekly_mart_brand(spark, sf_dir):
    return _settled(_mart(spark, sf_dir, grain="brand"))


@_register("q_weekly_mart_stepwise", _plain_sql(MART_SQL))
def q_weekly_mart_stepwise(spark, sf_dir):
    calendar = _dumped(spark, sf_dir, "calendar")
    return _settled(sales_inv_store_wk(_daily_fact(spark, sf_dir), calendar))


@_register("q_weekly_mart_hot_keys", _plain_sql(MART_SQL, grain="hot"))
def q_weekly_mart_hot_keys(spark, sf_dir):
    return _settled(_mart(spark, sf_dir, grain="hot"))


@_register("q_weekly_mart_loose_weeks", _plain_sql(MART_SQL, weeks="loose"))
def q_weekly_mart_loose_weeks(spark, sf_dir):
    return _settled(_mart(spark, sf_dir, weeks=tables.loose_weeks))


@_register("q_weekly_mart_repeated_dates", _plain_sql(MART_SQL, weeks="repeated"))
def q_weekly_mart_repeated_dates(spark, sf_dir):
    return _settled(_mart(spark, sf_dir, weeks=tables.repeated_dates))


METRICS_SQL = f"SELECT {_shown(MART_COLUMNS + METRIC_COLUMNS)} FROM metrics"


@_register("q_weekly_metrics_brand", _plain_sql(METRICS_SQL, grain="brand"))
def q_weekly_metrics_brand(spark, sf_dir):
    return _settled(_mart(spark, sf_dir, metrics=True, grain="brand"))


def _metric_query(name: str, *columns: str) -> None:
    @_register(
        name,
        _plain_sql(f"SELECT YR_NUM, WK_NUM, STORE_KEY, PROD_KEY, {_shown(columns)} FROM metrics"),
    )
    def run(spark, sf_dir):
        return _settled(week_keys_and(_mart(spark, sf_dir, metrics=True), *columns))


_metric_query("q_unit_price", "AVG_UNIT_PRICE")
_metric_query("q_stock_day_ratio", "OUT_OF_STOCK_DAY_RATIO", "IN_STOCK_DAY_RATIO")
_metric_query("q_total_low_stock_impact", "TOTAL_LOW_STOCK_IMPACT")
_metric_query("q_potential_low_stock_impact", "POTENTIAL_LOW_STOCK_IMPACT")
_metric_query("q_no_stock_impact", "NO_STOCK_IMPACT")
_metric_query("q_weeks_of_supply", "WEEKS_OF_SUPPLY")


# --- sinks and serving ------------------------------------------------------


@_register("q_fact_parquet_roundtrip", _plain_sql(MART_SQL))
def q_fact_parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "fact")
    write_fact(_mart(spark, sf_dir), path, "yr_num")
    return _settled(read_fact(spark, path, MART_COLUMNS))


def _dimension_query(table: str, dates: str = "") -> None:
    """A dimension as the sink writes it, and as the job leaves it beside the fact."""
    sql = _plain_sql(f"SELECT {{all}} FROM {table}", dates)

    @_register(f"q_dim_export_{table}", sql)
    def export(spark, sf_dir):
        path = scratch_dir(spark, table)
        write_csv(_clean(spark, sf_dir, table), path)
        return _plain(read_csv(spark, table, path))

    @_register(f"q_job_{table}", sql)
    def job(spark, sf_dir):
        return _plain(read_csv(spark, table, f"{_job_output(spark, sf_dir)}/{table}"))


_dimension_query("store")
_dimension_query("product")
_dimension_query("calendar", "CAL_DT")


def _job_output(spark: SparkSession, sf_dir: str, metrics: bool = False) -> str:
    base = scratch_dir(spark, "job")
    inputs = _write_inputs(spark, sf_dir, f"{base}/in")
    run_weekly_mart(spark, inputs, f"{base}/out", "YR_NUM", metrics)
    return f"{base}/out"


@_register("q_weekly_mart_job", _plain_sql(MART_SQL))
def q_weekly_mart_job(spark, sf_dir):
    return _settled(read_fact(spark, f"{_job_output(spark, sf_dir)}/{FACT}", MART_COLUMNS))


@_register("q_weekly_metrics_job", _plain_sql(METRICS_SQL))
def q_weekly_metrics_job(spark, sf_dir):
    out = _job_output(spark, sf_dir, metrics=True)
    return _settled(read_fact(spark, f"{out}/{FACT}", MART_COLUMNS + METRIC_COLUMNS))


def _exact(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(28,2))) AS DOUBLE)"


def _served(spark: SparkSession, sf_dir: str, metrics: bool = False) -> str:
    out = _job_output(spark, sf_dir, metrics)
    database = scratch_database("mart")
    current = spark.catalog.currentDatabase()
    register_output(spark, out, "YR_NUM", database, f"{out}/db")
    spark.catalog.setCurrentDatabase(current)
    return database


@_register(
    "q_serving_partition_scan",
    oracle.query(
        "SELECT YR_NUM, count(*) AS N_CELLS,"
        " CAST(sum(CAST(WK_SALES_QTY AS DECIMAL(18,2))) AS DOUBLE) AS SALES_QTY,"
        " CAST(sum(OUT_OF_STOCK_TIMES) AS BIGINT) AS OUT_OF_STOCK_TIMES"
        " FROM weekly GROUP BY YR_NUM"
    ),
)
def q_serving_partition_scan(spark, sf_dir):
    return spark.sql(
        f"""SELECT YR_NUM, count(*) AS N_CELLS, {_exact("WK_SALES_QTY")} AS SALES_QTY,
                   sum(OUT_OF_STOCK_TIMES) AS OUT_OF_STOCK_TIMES
            FROM {_served(spark, sf_dir)}.{FACT} GROUP BY YR_NUM"""
    )


@_register("q_served_metrics", _plain_sql(METRICS_SQL))
def q_served_metrics(spark, sf_dir):
    database = _served(spark, sf_dir, metrics=True)
    return _settled(
        spark.sql(f"SELECT {_names(MART_COLUMNS + METRIC_COLUMNS)} FROM {database}.{FACT}")
    )


STAR_SQL = oracle.query(
    "SELECT YR_NUM, MARKET_NAME, CATEGORY_NAME,"
    " CAST(sum(CAST(WK_SALES_QTY AS DECIMAL(18,2))) AS DOUBLE) AS SALES_QTY,"
    " CAST(sum(CAST(WK_SALES_AMT AS DECIMAL(18,2))) AS DOUBLE) AS SALES_AMT,"
    " CAST(sum(OUT_OF_STOCK_TIMES) AS BIGINT) AS OUT_OF_STOCK_TIMES,"
    " CAST(sum(LOW_STOCK_TIMES) AS BIGINT) AS LOW_STOCK_TIMES"
    " FROM weekly LEFT JOIN store USING (STORE_KEY) LEFT JOIN product USING (PROD_KEY)"
    " GROUP BY YR_NUM, MARKET_NAME, CATEGORY_NAME"
)


@_register("q_star_report", STAR_SQL)
def q_star_report(spark, sf_dir):
    t = tables.clean_tables(spark, sf_dir, "store product")
    return star_report(_mart(spark, sf_dir), t["store"], t["product"])


@_register("q_star_report_served", STAR_SQL)
def q_star_report_served(spark, sf_dir):
    return served_star_report(spark, _served(spark, sf_dir))


@_register("q_star_view", STAR_SQL)
def q_star_view(spark, sf_dir):
    return spark.sql(
        f"""SELECT YR_NUM, MARKET_NAME, CATEGORY_NAME,
                   {_exact("WK_SALES_QTY")} AS SALES_QTY,
                   {_exact("WK_SALES_AMT")} AS SALES_AMT,
                   sum(OUT_OF_STOCK_TIMES) AS OUT_OF_STOCK_TIMES,
                   sum(LOW_STOCK_TIMES) AS LOW_STOCK_TIMES
            FROM {_served(spark, sf_dir)}.{FACT}_star
            GROUP BY YR_NUM, MARKET_NAME, CATEGORY_NAME"""
    )


# --- other ways to the mart -------------------------------------------------


def _staged(spark: SparkSession, sf_dir: str, grain: str, weeks=lambda calendar: calendar) -> str:
    database = scratch_database("staged")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(spark, 'staged')}'")
    t = tables.clean_tables(spark, sf_dir, FACT_TABLES, grain)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stage_facts(t["sales"], t["inventory"], weeks(t["calendar"]), database, buckets)
    return database


@_register("q_weekly_mart_staged", _plain_sql(METRICS_SQL, grain="brand"))
def q_weekly_mart_staged(spark, sf_dir):
    return _settled(weekly_mart_from_staged(spark, _staged(spark, sf_dir, "brand"), metrics=True))


@_register("q_weekly_mart_staged_hot_keys", _plain_sql(MART_SQL, grain="hot"))
def q_weekly_mart_staged_hot_keys(spark, sf_dir):
    return _settled(weekly_mart_from_staged(spark, _staged(spark, sf_dir, "hot")))


@_register("q_weekly_mart_staged_loose_weeks", _plain_sql(MART_SQL, weeks="loose"))
def q_weekly_mart_staged_loose_weeks(spark, sf_dir):
    return _settled(weekly_mart_from_staged(spark, _staged(spark, sf_dir, "item", tables.loose_weeks)))


def _day_before(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """An older dump: nothing after a day, some sales missing, some stock counted differently."""
    sales = snapshot_as_of(t["sales"], "sales", AS_OF).filter("TRANS_ID % 5000 <> 7")
    stock = snapshot_as_of(t["inventory"], "inventory", AS_OF)
    recount = F.col("INVENTORY_ON_HAND_QTY") + F.when(F.col("PROD_KEY") % 500 == 3, 1).otherwise(0)
    return {**t, "sales": sales, "inventory": stock.withColumn("INVENTORY_ON_HAND_QTY", recount)}


def _updated_mart(spark, sf_dir, column: str, metrics: bool) -> DataFrame:
    """The mart of an older dump, brought up to the one of today."""
    base, t = scratch_dir(spark, "update"), tables.tables(spark, sf_dir)
    export_snapshots(spark, _day_before(t), base, AS_OF)
    export_snapshots(spark, t, base, ALL_DAYS)
    days = [{name: f"{base}/{name}_{day}.csv" for name in TABLES} for day in (AS_OF, ALL_DAYS)]
    run_weekly_mart(spark, days[0], f"{base}/out", column, metrics)
    update_weekly_mart(spark, *days, f"{base}/out", column, metrics)
    columns = MART_COLUMNS + (METRIC_COLUMNS if metrics else [])
    return _settled(read_fact(spark, f"{base}/out/{FACT}", columns))


@_register("q_incremental_mart", _plain_sql(METRICS_SQL))
def q_incremental_mart(spark, sf_dir):
    return _updated_mart(spark, sf_dir, "YR_NUM", metrics=True)


@_register("q_incremental_mart_store", _plain_sql(MART_SQL))
def q_incremental_mart_store(spark, sf_dir):
    return _updated_mart(spark, sf_dir, "STORE_KEY", metrics=False)


@_register(
    "q_changed_days",
    _plain_sql(
        f"""SELECT DISTINCT CAST(TRANS_DT AS VARCHAR) AS DAY, STORE_KEY FROM sales
            WHERE TRANS_ID % 5000 = 7 OR TRANS_DT > DATE '{AS_OF}'
               OR (TRANS_DT IS NULL AND STORE_KEY IN
                   (SELECT STORE_KEY FROM sales WHERE TRANS_DT IS NULL))"""
    ),
)
def q_changed_days(spark, sf_dir):
    """Days and stores whose sales differ between two dumps; the older one has no undated sales."""
    sales = _clean(spark, sf_dir, "sales")
    older = snapshot_as_of(sales, "sales", AS_OF).filter("TRANS_ID % 5000 <> 7")
    dated = [df.withColumn("DAY", F.col("TRANS_DT")) for df in (older, sales)]
    return _plain(changed_groups(*dated, ["DAY", "STORE_KEY"], FACT_COLUMNS["sales"]))


def _quarantined(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_dir(spark, "job")
    inputs = _write_inputs(spark, sf_dir, f"{base}/in")
    run_weekly_mart(spark, inputs, f"{base}/out", "YR_NUM", quarantine=True)
    return f"{base}/out"


@_register("q_mart_known_keys", oracle.query(MART_SQL, known=True))
def q_mart_known_keys(spark, sf_dir):
    return _settled(read_fact(spark, f"{_quarantined(spark, sf_dir)}/{FACT}", MART_COLUMNS))


_REASON = (
    "CASE WHEN {0} IS NULL THEN 'no date' WHEN STORE_KEY = 0 THEN 'no store'"
    " WHEN PROD_KEY = 0 THEN 'no product' ELSE 'kept' END"
)


@_register(
    "q_quarantine",
    oracle.query(
        " UNION ALL ".join(
            f"SELECT '{t}' AS TABLE_NAME, {_REASON.format(d)} AS REASON, count(*) AS N_ROWS,"
            f" CAST(sum(PROD_KEY) AS BIGINT) AS PROD_KEYS FROM {t} GROUP BY ALL"
            for t, d in (("sales", "TRANS_DT"), ("inventory", "CAL_DT"))
        )
    ),
)
def q_quarantine(spark, sf_dir):
    """Kept and rejected rows by reason; together they are the table."""
    parts = []
    for table, df in tables.clean_tables(spark, sf_dir, "sales inventory").items():
        split = split_unknown_keys(df, table, scratch_dir(spark, table))
        both = split.kept.withColumn("REASON", F.lit(KEPT)).unionByName(split.rejected)
        counts = both.groupBy("REASON").agg(
            F.count(F.lit(1)).alias("N_ROWS"), F.sum("PROD_KEY").alias("PROD_KEYS")
        )
        parts.append(counts.select(F.lit(table).alias("TABLE_NAME"), "REASON", "N_ROWS", "PROD_KEYS"))
    return reduce(DataFrame.unionAll, parts)


@_register("q_served_after_update", _plain_sql(METRICS_SQL))
def q_served_after_update(spark, sf_dir):
    """The served fact, registered without metrics at first and then again, in place."""
    database = scratch_database("mart")
    current, base = spark.catalog.currentDatabase(), scratch_dir(spark, "serve")
    inputs = _write_inputs(spark, sf_dir, f"{base}/in")
    older = {**inputs, "sales": f"{base}/older"}
    _write_dump(_dumped(spark, sf_dir, "sales").filter("TRANS_DT < DATE '1995-01-01'"), f"{base}/older")
    for given, metrics in ((older, False), (inputs, True)):
        run_weekly_mart(spark, given, f"{base}/out", "YR_NUM", metrics)
        register_output(spark, f"{base}/out", "YR_NUM", database, f"{base}/db")
    spark.catalog.setCurrentDatabase(current)
    return _settled(spark.table(f"{database}.{FACT}").select(*MART_COLUMNS, *METRIC_COLUMNS))


# --- snapshots --------------------------------------------------------------


@_register(
    "q_snapshot_sales_asof",
    _plain_sql(f"SELECT {{all}} FROM sales WHERE TRANS_DT <= DATE '{AS_OF}'", "TRANS_DT"),
)
def q_snapshot_sales_asof(spark, sf_dir):
    base = scratch_dir(spark, "snap")
    rows = snapshot_as_of(_dumped(spark, sf_dir, "sales"), "sales", AS_OF)
    write_snapshot(rows, "sales", base, AS_OF)
    return _plain(read_table(spark, "sales", f"{base}/sales_{AS_OF}.csv"))


@_register(
    "q_snapshot_inventory_next_day",
    _plain_sql(
        f"SELECT {{all}} FROM inventory WHERE CAL_DT <= DATE '{AS_OF}' + 1",
        "CAL_DT NEXT_DELIVERY_DT",
    ),
)
def q_snapshot_inventory_next_day(spark, sf_dir):
    base = scratch_dir(spark, "snap")
    rows = snapshot_as_of(_dumped(spark, sf_dir, "inventory"), "inventory", AS_OF, horizon_days=1)
    write_snapshot(rows, "inventory", base, AS_OF)
    return _plain(read_table(spark, "inventory", f"{base}/inventory_{AS_OF}.csv"))


@_register(
    "q_export_audit",
    oracle.query(
        f"SELECT 'inventory' AS \"table\", count(*) AS rows_unloaded FROM inventory"
        f" WHERE CAL_DT <= DATE '{AS_OF}'"
        f" UNION ALL SELECT 'sales', count(*) FROM sales WHERE TRANS_DT <= DATE '{AS_OF}'"
        " UNION ALL SELECT 'store', count(*) FROM store"
        " UNION ALL SELECT 'product', count(*) FROM product"
        " UNION ALL SELECT 'calendar', count(*) FROM calendar"
    ),
)
def q_export_audit(spark, sf_dir):
    return export_snapshots(spark, tables.tables(spark, sf_dir), scratch_dir(spark, "day"), AS_OF)


LATE = "1998-12-12"


def _rows_of(spark: SparkSession, found: DataFrame) -> DataFrame:
    """Of a few snapshots (table, date, URI): the rows read through each one's own URI."""
    counts = [
        read_csv(spark, r["TABLE_NAME"], r["URI"])
        .agg(F.count(F.lit(1)).alias("N_ROWS"))
        .select(F.lit(r["TABLE_NAME"]).alias("TABLE_NAME"), F.lit(r["SNAPSHOT_DATE"]).alias("SNAPSHOT_DATE"), "N_ROWS")
        for r in found.collect()
    ]
    none = spark.createDataFrame([], "TABLE_NAME string, SNAPSHOT_DATE string, N_ROWS bigint")
    return reduce(DataFrame.unionByName, counts, none)


def _snapshot_counts(dates: dict[str, str] | None = None, missing: tuple[str, ...] = ()) -> str:
    """SQL for the rows of each table's snapshot; 0 for one that is not there."""
    limits = {"sales": f" WHERE TRANS_DT <= DATE '{AS_OF}'", "inventory": f" WHERE CAL_DT <= DATE '{AS_OF}'"}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS TABLE_NAME, '{(dates or {}).get(t, AS_OF)}' AS SNAPSHOT_DATE,"
        f" {'CAST(0 AS BIGINT)' if t in missing else 'count(*)'} AS N_ROWS,"
        f" {str(t in missing).lower()} AS MISSING FROM {t}{limits.get(t, '')}"
        + (" LIMIT 1" if t in missing else "")
        for t in TABLES
    )


def _incomplete_day(spark: SparkSession, sf_dir: str) -> str:
    """A location whose store snapshot carries a later date than the other four."""
    base = scratch_dir(spark, "day")
    for name, df in tables.tables(spark, sf_dir).items():
        rows = snapshot_as_of(df, name, AS_OF)
        write_snapshot(rows, name, base, LATE if name == "store" else AS_OF)
    return base


@_register(
    "q_file_listing",
    oracle.query(
        f"SELECT TABLE_NAME, SNAPSHOT_DATE, N_ROWS FROM ({_snapshot_counts({'store': LATE})})"
    ),
)
def q_file_listing(spark, sf_dir):
    listing = list_files(spark, _incomplete_day(spark, sf_dir))
    return _rows_of(spark, snapshot_files(listing.filter(F.col("length") > 0)))


# All events fall in January, when US Eastern time is five hours behind UTC.
@_register(
    "q_snapshot_day",
    "SELECT event_id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS SNAPSHOT_DATE FROM events",
)
def q_snapshot_day(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", snapshot_day(F.col("ts"), "UTC").alias("SNAPSHOT_DATE"))


@_register(
    "q_snapshot_day_summer",
    "SELECT event_id, strftime(ts + INTERVAL 181 DAY - INTERVAL 4 HOUR, '%Y-%m-%d') AS SNAPSHOT_DATE"
    " FROM events",
)
def q_snapshot_day_summer(spark, sf_dir):
    """The same events half a year later, when Eastern time is four hours behind."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    later = F.col("ts").cast("timestamp_ntz") + F.expr("INTERVAL 181 DAY")
    return events.select("event_id", snapshot_day(later, "UTC").alias("SNAPSHOT_DATE"))


def _state_of(spark: SparkSession, base: str) -> DataFrame:
    """Of each snapshot that a day needs: whether it is missing, and the rows that are there."""
    found = check_snapshots(spark, base, AS_OF)
    there = _rows_of(spark, snapshot_files(list_whole(spark, base, AS_OF)))
    missing = found.missing.withColumn("MISSING", F.lit(True))
    return (
        required_snapshots(spark, base, AS_OF)
        .join(missing, "TABLE_NAME", "left")
        .join(there, ["TABLE_NAME", "SNAPSHOT_DATE"], "left")
        .select(
            "TABLE_NAME",
            "SNAPSHOT_DATE",
            F.coalesce("N_ROWS", F.lit(0)).alias("N_ROWS"),
            F.coalesce("MISSING", F.lit(False)).alias("MISSING"),
        )
    )


def _one_missing_sql(table: str) -> str:
    parts = _snapshot_counts(missing=(table,)).split(" UNION ALL ")
    return oracle.query(" UNION ALL ".join(f"({part})" for part in parts))


@_register("q_missing_snapshots", _one_missing_sql("store"))
def q_missing_snapshots(spark, sf_dir):
    return _state_of(spark, _incomplete_day(spark, sf_dir))


@_register("q_half_written_snapshot", _one_missing_sql("sales"))
def q_half_written_snapshot(spark, sf_dir):
    """All five are there, but the one of sales has not been committed."""
    base = scratch_dir(spark, "day")
    everything = tables.tables(spark, sf_dir)
    for name, df in everything.items():
        if name != "sales":
            write_snapshot(snapshot_as_of(df, name, AS_OF), name, base, AS_OF)
    unmarked = snapshot_as_of(everything["sales"], "sales", AS_OF).write.options(header="true")
    unmarked = unmarked.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    unmarked.csv(f"{base}/sales_{AS_OF}.csv")
    return _state_of(spark, base)


@_register(
    "q_readiness_verdict",
    oracle.query(
        "SELECT false AS READY, CAST(sum(N_ROWS) AS BIGINT) AS N_ROWS FROM"
        f" ({_snapshot_counts()}) WHERE TABLE_NAME <> 'store'"
    ),
)
def q_readiness_verdict(spark, sf_dir):
    base = _incomplete_day(spark, sf_dir)
    present = snapshot_files(list_committed(spark, base, AS_OF))
    verdict = all_present(required_snapshots(spark, base, AS_OF), present).first()["READY"]
    rows = _rows_of(spark, present).agg(F.sum("N_ROWS").alias("N_ROWS"))
    return rows.select(F.lit(verdict).alias("READY"), "N_ROWS")


@_register(
    "q_readiness_ready",
    oracle.query(f"SELECT true AS READY, CAST(sum(N_ROWS) AS BIGINT) AS N_ROWS FROM ({_snapshot_counts()})"),
)
def q_readiness_ready(spark, sf_dir):
    """The verdict on a day that is complete, with the rows of its snapshots."""
    base = scratch_dir(spark, "day")
    export_snapshots(spark, tables.tables(spark, sf_dir), base, AS_OF)
    present = snapshot_files(list_whole(spark, base, AS_OF))
    verdict = all_present(required_snapshots(spark, base, AS_OF), present).first()["READY"]
    rows = _rows_of(spark, present).agg(F.sum("N_ROWS").alias("N_ROWS"))
    return rows.select(F.lit(verdict).alias("READY"), "N_ROWS")


@_register(
    "q_manifest",
    oracle.query(f"SELECT TABLE_NAME, SNAPSHOT_DATE, N_ROWS FROM ({_snapshot_counts()})"),
)
def q_manifest(spark, sf_dir):
    base = scratch_dir(spark, "day")
    export_snapshots(spark, tables.tables(spark, sf_dir), base, AS_OF)
    manifest = check_snapshots(spark, base, AS_OF).manifest
    return _rows_of(
        spark, manifest.selectExpr("table AS TABLE_NAME", f"'{AS_OF}' AS SNAPSHOT_DATE", "uri AS URI")
    )


@_register(
    "q_export_files",
    oracle.query(
        "SELECT TABLE_NAME, N_ROWS, true AS WITHIN_LIMIT, true AS AS_LISTED"
        f" FROM ({_snapshot_counts()})"
    ),
)
def q_export_files(spark, sf_dir):
    """The files of a day as its manifests have them, against a listing."""
    base = scratch_dir(spark, "day")
    export_snapshots(spark, tables.tables(spark, sf_dir), base, AS_OF)
    path = F.regexp_replace("path", r"/part-[^/]*$", "").alias("URI")
    listed = list_files(spark, base).groupBy(path).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.max("length").alias("most")
    )
    listed = listed.select(F.regexp_extract("URI", SNAPSHOT_PATTERN, 1).alias("TABLE_NAME"), "n", "size", "most")
    same = (F.col("n") == F.col("FILES")) & (F.col("size") == F.col("BYTES")) & (F.col("most") == F.col("LARGEST"))
    audit = audit_files(spark, base, AS_OF).join(listed, "TABLE_NAME")
    return audit.select("TABLE_NAME", "N_ROWS", "WITHIN_LIMIT", same.alias("AS_LISTED"))


@_register("q_lost_part_file", _one_missing_sql("inventory"))
def q_lost_part_file(spark, sf_dir):
    """All five are committed, but one of the inventory's files is gone since."""
    base = scratch_dir(spark, "day")
    export_snapshots(spark, tables.tables(spark, sf_dir), base, AS_OF)
    gone = list_files(spark, f"{base}/inventory_{AS_OF}.csv").orderBy(F.desc("length")).first()["path"]
    path = spark._jvm.org.apache.hadoop.fs.Path(gone)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    return _state_of(spark, base)


@_register("q_job_hot_keys", _plain_sql(MART_SQL, grain="hot"))
def q_job_hot_keys(spark, sf_dir):
    """The job on snapshots whose export has found the hot keys."""
    base = scratch_dir(spark, "day")
    export_snapshots(spark, tables.tables(spark, sf_dir, grain="hot"), base, ALL_DAYS)
    run_if_ready(spark, base, f"{base}/out", "yr_num", ALL_DAYS)
    return _settled(read_fact(spark, f"{base}/out/{FACT}", MART_COLUMNS))


@_register("q_export_to_mart", _plain_sql(MART_SQL))
def q_export_to_mart(spark, sf_dir):
    base = scratch_dir(spark, "day")
    export_snapshots(spark, tables.tables(spark, sf_dir), base, ALL_DAYS)
    run_if_ready(spark, base, f"{base}/out", "yr_num", ALL_DAYS)
    return _settled(read_fact(spark, f"{base}/out/{FACT}", MART_COLUMNS))


@_register("q_raw_load_to_mart", _plain_sql(MART_SQL))
def q_raw_load_to_mart(spark, sf_dir):
    base = scratch_dir(spark, "chain")
    raw = _load_raw(spark, sf_dir, base)
    export_snapshots(spark, raw, f"{base}/day", ALL_DAYS)
    run_if_ready(spark, f"{base}/day", f"{base}/out", "yr_num", ALL_DAYS)
    return _settled(read_fact(spark, f"{base}/out/{FACT}", MART_COLUMNS))


@_register(
    "q_key_quality",
    oracle.query(
        """, per_key AS (SELECT count(*) AS n FROM inventory GROUP BY CAL_DT, STORE_KEY, PROD_KEY),
        per_week AS (SELECT count(DISTINCT CAL_DT) AS days,
                            count(*) FILTER (WHERE DAY_OF_WK_NUM = 6) AS ends
                     FROM calendar GROUP BY YR_NUM, WK_NUM)
        SELECT 'sales: store key null or 0' AS CHECK_NAME, count(*) AS N
          FROM sales WHERE STORE_KEY = 0
        UNION ALL SELECT 'sales: product key null or 0', count(*) FROM sales WHERE PROD_KEY = 0
        UNION ALL SELECT 'sales: no date', count(*) FROM sales WHERE TRANS_DT IS NULL
        UNION ALL SELECT 'sales: date not in calendar', count(*) FROM sales
          WHERE TRANS_DT NOT IN (SELECT CAL_DT FROM calendar)
        UNION ALL SELECT 'inventory: store key null or 0', count(*)
          FROM inventory WHERE STORE_KEY = 0
        UNION ALL SELECT 'inventory: product key null or 0', count(*)
          FROM inventory WHERE PROD_KEY = 0
        UNION ALL SELECT 'inventory: no date', count(*) FROM inventory WHERE CAL_DT IS NULL
        UNION ALL SELECT 'inventory: date not in calendar', count(*) FROM inventory
          WHERE CAL_DT NOT IN (SELECT CAL_DT FROM calendar)
        UNION ALL SELECT 'inventory: keys with several rows', count(*) FROM per_key WHERE n > 1
        UNION ALL SELECT 'calendar: dates with several rows', count(*)
          FROM (SELECT CAL_DT FROM calendar GROUP BY CAL_DT HAVING count(*) > 1)
        UNION ALL SELECT 'calendar: weeks of other than 7 days', count(*)
          FROM per_week WHERE days <> 7
        UNION ALL SELECT 'calendar: weeks without a last day', count(*)
          FROM per_week WHERE ends = 0
        """,
        weeks="repeated",
    ),
)
def q_key_quality(spark, sf_dir):
    t = tables.clean_tables(spark, sf_dir, FACT_TABLES)
    return key_quality(t["sales"], t["inventory"], tables.repeated_dates(t["calendar"]))
