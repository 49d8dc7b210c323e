"""Keys that hold many of the stock rows: found in a sample, or by a sketch kept with a snapshot.

What is found decides only how the rows of a key are dealt to tasks.
"""

from __future__ import annotations

import json
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DAY_KEYS = ["CAL_DT", "STORE_KEY", "PROD_KEY"]

# A key with one in so many of all stock rows is hot. It is split into parts of that
# size, so no task gets more of one key.
HOT_SHARE = 10_000

# The sample, and the rows of it that make a key worth splitting.
HOT_SAMPLE = 0.01
HOT_HITS = 2_000

# Keys that the sketch of a task holds at most. It finds every key with more than
# 7 / TRACKED of all rows, one in 1,170; each task sends the driver less than 250 KB.
TRACKED = 8192


class HotKeys(NamedTuple):
    """How many stock rows there are, and the keys that hold many: date, store, product, rows."""

    total: int
    keys: list[tuple[date | None, int, int, int]]


def sampled_hot_keys(inventory: DataFrame) -> HotKeys:
    """The hot keys by a sample of the rows; it reads the keys once more.

    There are at most ``HOT_SHARE`` of them, so asking for that many loses none.
    """
    seen = Observation()
    keys = inventory.select(*DAY_KEYS).sample(fraction=HOT_SAMPLE, seed=17)
    found = (
        keys.observe(seen, F.count(F.lit(1)).alias("rows"))
        .groupBy(*DAY_KEYS)
        .agg(F.count(F.lit(1)).alias("hits"))
        .filter(F.col("hits") >= HOT_HITS)
        .orderBy(F.desc("hits"))
        .limit(HOT_SHARE)
        .collect()
    )
    # Without a hot key the plan may be cut to nothing, and its rows are not counted.
    return HotKeys(seen.get["rows"] if found else 0, [tuple(row) for row in found])


def hot_key_sketch() -> Column:
    """The keys with most rows as JSON: an aggregate for the pass that writes the stock rows.

    A missing store or product counts as key 0, as the job reads it.
    """
    day = F.coalesce(F.col("CAL_DT").cast("string"), F.lit(""))
    keys = [F.coalesce(F.col(k).cast("string"), F.lit("0")) for k in DAY_KEYS[1:]]
    text = F.concat_ws("|", day, *keys)
    return F.to_json(F.call_function("approx_top_k", text, F.lit(TRACKED), F.lit(TRACKED)))


def read_sketch(total: int, sketch: str | None) -> HotKeys:
    """What ``hot_key_sketch`` found among ``total`` rows; ``HOT_HITS`` are as many as in a sample."""
    found = []
    for entry in json.loads(sketch or "[]"):
        day, store, product = entry["item"].split("|")
        if entry["count"] >= HOT_HITS / HOT_SAMPLE and entry["count"] * HOT_SHARE >= total:
            key = (date.fromisoformat(day) if day else None, int(store), int(product))
            found.append((*key, entry["count"]))
    return HotKeys(total, found)


def split_parts(hot: HotKeys) -> list[tuple[date | None, int, int, int]]:
    """The hot keys, and into how many parts their rows are dealt."""
    return [
        (*key, max(2, HOT_SHARE * rows // hot.total))
        for *key, rows in hot.keys
        if rows * HOT_SHARE >= hot.total
    ]
