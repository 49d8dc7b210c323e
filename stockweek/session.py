"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles, splits skewed partitions of splittable
# joins and of rebalanced writes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def get_session(name: str = "stockweek", settings: dict[str, str] | None = None) -> SparkSession:
    """The running session, or a new one with the settings above."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, given: Mapping[str, str]) -> Iterator[None]:
    """The session with other settings for a while."""
    before = {name: spark.conf.get(name) for name in given}
    for name, value in given.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# Folders and databases that this process has made for single runs.
_folders: list[str] = []
_databases: list[str] = []


def scratch_database(label: str) -> str:
    """A name for a database of one run."""
    _databases.append(f"{label}_{uuid.uuid4().hex}")
    return _databases[-1]


def drop_dir(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all that it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clean_up(spark: SparkSession) -> None:
    """Drop the databases and folders of this process's runs; call it when no result is read any more."""
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")
    while _folders:
        drop_dir(spark, _folders.pop())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for one run, under the shared folder the cluster names.

    Only a session whose executors are this very process, without
    ``spark.checkpoint.dir``, gets a folder on this machine: other executors could
    not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="stockweek-")
    _folders.append(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _folders[-1]
