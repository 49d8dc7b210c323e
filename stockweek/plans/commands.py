"""The jobs as commands: their parameters as a mapping, what they report as lines."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

from stockweek.plans.incremental import update_weekly_mart
from stockweek.plans.raw_load import load_raw
from stockweek.plans.snapshots import export_snapshots, run_if_ready
from stockweek.plans.weekly_mart import OPTIONS, as_mapping, run_weekly_mart
from stockweek.session import get_session
from stockweek.sources.schemas import TABLES


def _given(params: Mapping, *names: str) -> dict:
    return {name: params[name] for name in names if name in params}


def _mart(spark: SparkSession, params: Mapping) -> list[str]:
    run_weekly_mart(
        spark,
        as_mapping(params["input_path"]),
        params["output_path"],
        params["partition_column"],
        **_given(params, *OPTIONS),
    )
    return [f"written to {params['output_path']}"]


def _load(spark: SparkSession, params: Mapping) -> list[str]:
    staged = as_mapping(params["staged"])
    loaded = load_raw(spark, staged, params["database"], params.get("location"))
    return [f"{table}: {df.count()} rows loaded" for table, df in loaded.items()]


def _export(spark: SparkSession, params: Mapping) -> list[str]:
    raw = {table: spark.table(f"{params['database']}.{table}") for table in TABLES}
    options = _given(params, "as_of", "horizon_days", "day", "null_value")
    audit = export_snapshots(spark, raw, params["location"], **options)
    return [f"{r['table']}: {r['rows_unloaded']} rows unloaded" for r in audit.collect()]


def _run_if_ready(spark: SparkSession, params: Mapping) -> list[str]:
    status = run_if_ready(
        spark,
        params["location"],
        params["output_path"],
        params["partition_column"],
        **_given(params, "day", *OPTIONS),
    )
    if not status.ready:
        missing = sorted(r["TABLE_NAME"] for r in status.missing.collect())
        raise SystemExit(f"not ready, missing: {', '.join(missing)}")
    return [f"written to {params['output_path']}"]


def _update(spark: SparkSession, params: Mapping) -> list[str]:
    done = update_weekly_mart(
        spark,
        as_mapping(params["old_input_path"]),
        as_mapping(params["input_path"]),
        params["output_path"],
        params["partition_column"],
        **_given(params, "metrics", "null_value"),
    )
    return [f"{done.weeks} weeks computed anew, {len(done.written)} partitions written to {params['output_path']}"]


COMMANDS: dict[str, Callable[[SparkSession, Mapping], list[str]]] = {
    "mart": _mart,
    "load": _load,
    "export": _export,
    "run-if-ready": _run_if_ready,
    "update": _update,
}


def run_command(command: str, params: str | Mapping) -> list[str]:
    """Run a command in the session it names; a day that is not ready ends with a message."""
    given = as_mapping(params)
    return COMMANDS[command](get_session(given["name"]), given)
