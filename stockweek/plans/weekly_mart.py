"""The weekly-mart job: five CSV snapshots in, one fact and three dimensions out.

    spark-submit weekly_mart_job.py -p '{"name": ..., "input_path": {"calendar": ..., ...},
                                         "output_path": ..., "partition_column": "STORE_KEY",
                                         "metrics": true}'

``metrics``, ``partition_overwrite``, ``null_value``, ``parse_report`` and
``quarantine`` may be left out.
"""

from __future__ import annotations

import ast
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stockweek.operators.hot_keys import HotKeys
from stockweek.operators.quarantine import split_unknown_keys
from stockweek.operators.weekly import placed_sums, weekly_sums, with_metrics
from stockweek.session import scratch_dir
from stockweek.sinks.files import read_hot_keys, write_csv, write_fact
from stockweek.sources.csv import ObservedScan, read_table, report_table
from stockweek.sources.schemas import FACT_DATES, TABLES

# Names of the outputs.
FACT = "sales_inv_store_wk"
DIMENSIONS = ("store", "product", "calendar")

PARSE_REPORT, REJECTED = "parse_report", "rejected"


def as_mapping(text: str | Mapping) -> dict:
    """Parameters given as a mapping, as JSON, or as the text of a Python dict."""
    if isinstance(text, Mapping):
        return dict(text)
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        return dict(ast.literal_eval(text))


def read_inputs(
    spark: SparkSession, inputs: Mapping[str, str], null_value: str | None = None
) -> dict[str, DataFrame]:
    """The five inputs, typed and null-normalised."""
    return {table: read_table(spark, table, inputs[table], null_value) for table in TABLES}


def run_weekly_mart(
    spark: SparkSession,
    inputs: Mapping[str, str],
    output_path: str,
    partition_column: str,
    metrics: bool = False,
    partition_overwrite: str = "static",
    null_value: str | None = None,
    parse_report: bool = False,
    quarantine: bool = False,
) -> None:
    """Build the mart from the CSV snapshots and write it beside copies of the dimensions.

    An inventory written as a snapshot tells its hot keys; of any other, a sample of the
    keys is read first. ``parse_report`` adds a table of the fields that did not parse, counted as they are read.
    ``quarantine`` leaves out rows of the facts without a date, store or product, and writes
    them beside the mart with the reason.
    """
    scans: list[ObservedScan] = []
    if parse_report:
        scans = [ObservedScan(spark, table, inputs[table], null_value) for table in TABLES]
        tables = {table: scan.rows for table, scan in zip(TABLES, scans, strict=True)}
    else:
        tables = read_inputs(spark, inputs, null_value)
    base = output_path.rstrip("/")
    if quarantine:
        for table in FACT_DATES:
            split = split_unknown_keys(tables[table], table, scratch_dir(spark, table))
            split.rejected.write.mode("overwrite").parquet(f"{base}/{REJECTED}/{table}")
            tables[table] = split.kept
    hot = read_hot_keys(spark, inputs["inventory"])
    if quarantine and hot:
        hot = HotKeys(hot.total, [key for key in hot.keys if all(key[:3])])
    facts = tables["sales"], tables["inventory"], tables["calendar"]
    fact = placed_sums(*facts, partition_column.upper(), metrics, hot)
    laid_out = fact is not None
    if fact is None:
        fact = weekly_sums(*facts, metrics, hot)
    finish = with_metrics if metrics else None
    write_fact(fact, f"{base}/{FACT}", partition_column, partition_overwrite, finish, laid_out)
    for table in DIMENSIONS:
        write_csv(tables[table], f"{base}/{table}")
    if scans:
        write_csv(report_table(spark, scans), f"{base}/{PARSE_REPORT}")


# Parameters of the job besides the required ones, passed on as they are.
OPTIONS = ("metrics", "partition_overwrite", "null_value", "parse_report", "quarantine")
