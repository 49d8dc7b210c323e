"""Labelled samples of bounded size, and training on them in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweek.llm.columns import col, give_back

# Documents per class that a classifier learns from, about.
SAMPLE_DOCS = 4000


class Sample(NamedTuple):
    """Distinct (label, text) rows, and how much rarer label 1 is in them than in all, as log odds."""

    rows: DataFrame
    shift: float


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    text: str = "text",
    doc_id: str = "doc_id",
    usable: Column | None = None,
    per_class: int = SAMPLE_DOCS,
) -> Sample | None:
    """About ``per_class`` documents of either class, or all of a class that has fewer.

    Rows are chosen by a hash of their id; exact copies count once. Rows without a
    label, an id or a text teach nothing. None unless both classes are there.
    """
    known = labels.filter(F.lit(True) if usable is None else usable)
    known = known.select(col(doc_id).alias("id"), col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull()).distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    parts = 1 << 20
    share = {k: min(parts, parts * per_class // n + 1) for k, n in counts.items()}
    drawn = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(parts))
    chosen = known.filter(drawn < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    texts = docs.select(col(doc_id).alias("id"), col(text).alias("text"))
    rows = texts.filter(F.col("text").isNotNull()).join(F.broadcast(chosen), "id")
    shift = log(counts[1] / counts[0]) - log(
        min(counts[1], per_class) / min(counts[0], per_class)
    )
    return Sample(rows.select("label", "text").distinct(), shift)


def fit_in_one_task(sample: DataFrame, fit: Callable[[list[bytes], list[int]], bytes]) -> bytes:
    """What ``fit`` makes of a bounded sample, in one task; rows come in a fixed order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"label": [], "text": []}), *batches])
        rows = rows.sort_values(["text", "label"])
        texts = [t.encode() for t in rows["text"]]
        model = fit(texts, rows["label"].astype(int).tolist())
        del rows, texts
        give_back()
        yield pd.DataFrame({"model": [model]})

    return bytes(sample.repartition(1).mapInPandas(run, "model binary").first()["model"])
