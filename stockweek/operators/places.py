"""Which task a row of the facts goes to, so that a fact partitioned by a calendar column needs no shuffle of its own."""

from __future__ import annotations

from math import ceil
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the mart that the calendar gives.
PLACED_BY = ("YR_NUM", "WK_NUM")

# Rows of both facts that a task gets on average: so many at most, so that it sorts them in memory, and
# so many at least where the session asks for more tasks.
TASK_ROWS, LEAST_ROWS = 1_500_000, 100_000

# Part of the tasks that is dealt to all weeks alike, as stock may be of weeks without sales.
EVEN = 0.2

# Stores and products are told apart by so many values of a hash, where a week goes to several tasks.
_STEPS = 1 << 20


class Places(NamedTuple):
    """How many tasks there are; and for each day where its week begins among them, and over how many it extends."""

    tasks: int
    days: DataFrame


def _tasks_for(spark: SparkSession, rows: int) -> int:
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, ceil(rows / TASK_ROWS), min(asked, ceil(rows / LEAST_ROWS)))


def _line_up(weeks: list[tuple], tasks: int) -> list[tuple]:
    """For weeks with their rows, in the order of their values, where each begins among the tasks, and its extent."""
    total, begin, found = sum(rows for *_, rows in weeks), 0.0, []
    for *week, rows in weeks:
        share = EVEN / len(weeks) + (1 - EVEN) * rows / total if total else 1 / len(weeks)
        found.append((*week, begin * tasks, share * tasks))
        begin += share
    return found


def places_of(
    sold: DataFrame, held: DataFrame, slim: DataFrame, column: str, held_rows: int | None = None
) -> Places:
    """Deal the weeks of a calendar to tasks, in the order of a column; one pass over the dates of the sales.

    A task gets neighbouring weeks, and a week of many rows several tasks, by store and product. The values
    of the column thus lie in few tasks. ``held_rows`` is the number of stock rows; by default they are counted.
    """
    spark, week = sold.sparkSession, ["YR_NUM", "WK_NUM"]
    counts = sold.join(F.broadcast(slim), "CAL_DT").groupBy(*week).agg(F.count(F.lit(1)).alias("N"))
    same = [F.col(f"w.{name}").eqNullSafe(F.col(f"c.{name}")) for name in week]
    every = slim.select(*week).distinct().alias("w").join(counts.alias("c"), same, "left")
    order = [column] + [name for name in week if name != column]
    found = every.select("w.YR_NUM", "w.WK_NUM", F.coalesce("c.N", F.lit(0)).alias("N")).orderBy(*order).collect()
    rows = sum(row["N"] for row in found) + (held.count() if held_rows is None else held_rows)
    tasks = _tasks_for(spark, rows)
    types = ", ".join(f"{name} {slim.schema[name].dataType.simpleString()}" for name in week)
    lined_up = spark.createDataFrame(_line_up(found, tasks), f"{types}, BEGIN double, EXTENT double")
    same = [F.col(f"s.{name}").eqNullSafe(F.col(f"w.{name}")) for name in week]
    days = slim.alias("s").join(F.broadcast(lined_up).alias("w"), same)
    return Places(tasks, days.select("s.CAL_DT", "w.BEGIN", "w.EXTENT"))


def _one_for_each_task(spark: SparkSession, tasks: int) -> list[int]:
    """A number for each task that Spark's partitioning by its hash sends there."""
    numbers = spark.range(64 * tasks).select(F.col("id").cast("int").alias("N"))
    first = numbers.groupBy(F.pmod(F.hash("N"), F.lit(tasks)).alias("TASK")).agg(F.min("N"))
    found = dict(map(tuple, first.collect()))
    return [found.get(task, task) for task in range(tasks)]


def placed(facts: DataFrame, places: Places) -> DataFrame:
    """Rows dated ``CAL_DT`` with their ``PLACE``; days outside the calendar are left out.

    The place follows from week, store and product. Any two places go to different tasks when the rows are
    repartitioned by it to as many tasks.
    """
    among = F.pmod(F.xxhash64("STORE_KEY", "PROD_KEY"), F.lit(_STEPS)) / F.lit(_STEPS)
    task = F.floor(F.col("BEGIN") + among * F.col("EXTENT")).cast("int")
    numbers = _one_for_each_task(facts.sparkSession, places.tasks)
    known = F.expr(f"array({', '.join(map(str, numbers))})")
    rows = facts.join(F.broadcast(places.days), "CAL_DT")
    return rows.withColumn("PLACE", F.get(known, F.least(task, F.lit(places.tasks - 1)))).drop("BEGIN", "EXTENT")
