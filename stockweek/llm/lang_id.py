"""Language of a text, by a bidirectional gated recurrent network over its bytes.

The network labels every byte of fixed windows that cover the whole text; a
document's probabilities are the mean over its bytes. It is trained on windows
drawn from a bounded sample of documents with a known language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweek.llm.columns import (
    TextWork,
    as_bytes,
    bound_batches,
    col,
    free_name,
    give_back,
    map_texts,
    without,
)
from stockweek.llm.gru import BLANK, BiGru, train
from stockweek.session import scratch_dir

UNKNOWN = "und"

# Documents per language that the network learns from, about; and windows from each.
SAMPLE_DOCS = 500
SAMPLE_WINDOWS = 8
TRAIN_BYTES = 64

# Languages that a network may tell apart.
MAX_LANGUAGES = 1000

# Bytes in a window when predicting, and windows worked on at a time.
WINDOW = 128
WINDOWS = 2048


def has_letter(text: str | Column) -> Column:
    """Whether a text has any letter; false for a null one."""
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows at random places of each text, which follow from the text; with its language."""
    for batch in batches:
        langs, windows = [], []
        for lang, raw in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            rng = np.random.default_rng(xxhash.xxh64_intdigest(raw))
            for at in rng.integers(0, max(1, len(raw) - TRAIN_BYTES + 1), SAMPLE_WINDOWS).tolist():
                langs.append(lang)
                windows.append(raw[at : at + TRAIN_BYTES].ljust(TRAIN_BYTES, bytes([BLANK])))
        arrays = [pa.array(langs, pa.string()), pa.array(windows, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "window"])


def _fit(names: list[str], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One network, from windows in a fixed order, whatever the partitions."""
    sample = pd.concat([pd.DataFrame({"lang": [], "window": []}, dtype=object), *batches])
    sample = sample.sort_values(["lang", "window"])
    windows = np.frombuffer(b"".join(map(bytes, sample["window"])), np.uint8).reshape(-1, TRAIN_BYTES)
    labels = np.array([names.index(lang) for lang in sample["lang"]])
    model = train(windows, labels, names).to_bytes()
    del sample, windows, labels
    give_back()
    yield pd.DataFrame({"model": [model]})


def learn_languages(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    usable: Column | None = None,
) -> bytes | None:
    """A network for the languages of the usable rows, or None when there are none.

    Rows without a language or a letter teach nothing. About ``SAMPLE_DOCS`` rows
    per language are used, chosen by a hash of their id; of a language with
    fewer, all. Their windows come from anywhere in the text. One task trains, and gets
    windows only, never texts. More than ``MAX_LANGUAGES`` languages raise. Repeated rows
    are drawn together or not at all; an empty table has no languages.
    """
    known = df.filter(F.lit(True) if usable is None else usable)
    known = known.select(
        col(doc_id).cast("string").alias("id"), col(lang).alias("lang"), col(text).alias("text")
    ).filter(F.col("lang").isNotNull())
    found = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    counts = {r["lang"]: r["count"] for r in found}
    if not counts:
        return None
    names = sorted(counts)
    parts = 1 << 20
    share = F.create_map(
        *(F.lit(x) for n in names for x in (n, min(parts, parts * SAMPLE_DOCS // counts[n] + 1)))
    )
    drawn = F.pmod(F.xxhash64("id", F.lit(8)), F.lit(parts)) < share[F.col("lang")]
    sample = known.filter(drawn).filter(has_letter("text")).select("lang", F.col("text").cast("string").cast("binary"))
    bound_batches(df.sparkSession)
    sample = sample.mapInArrow(_windows, "lang string, window binary")
    path = scratch_dir(df.sparkSession, "windows")
    sample.write.parquet(path)
    sample = df.sparkSession.read.parquet(path)
    seen = {r["lang"] for r in sample.select("lang").distinct().collect()}
    names = [n for n in names if n in seen]
    if not names:
        return None
    fitted = sample.repartition(1).mapInPandas(partial(_fit, names), "model binary")
    return bytes(fitted.first()["model"])


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """Texts in pieces of at most one round of windows."""
    most = WINDOW * WINDOWS
    for number, raw in enumerate(texts):
        for at in range(0, len(raw), most):
            yield number, raw[at : at + most]


def _round(model: BiGru, pieces: list[tuple[int, bytes]], pooled: np.ndarray) -> None:
    """Add up label probabilities over the bytes of each piece, by its text."""
    owners, sizes, padded = [], [], []
    for number, raw in pieces:
        full, rest = divmod(len(raw), WINDOW)
        owners += [number] * (full + (rest > 0))
        sizes += [WINDOW] * full + [rest] * (rest > 0)
        padded.append(raw.ljust((full + (rest > 0)) * WINDOW, bytes([BLANK])))
    inputs = np.frombuffer(b"".join(padded), np.uint8).reshape(-1, WINDOW)
    found = model.probabilities(np.ascontiguousarray(inputs.T, dtype=np.intp))
    found *= np.arange(WINDOW)[:, None] < np.array(sizes)
    for total, part in zip(pooled, found.sum(axis=1), strict=True):
        total += np.bincount(owners, part, len(total))


def _predict_work(broadcast) -> TextWork:
    model = BiGru.from_bytes(broadcast.value)

    def work(texts: pa.Array) -> list[pa.Array]:
        raws = as_bytes(texts)
        pooled = np.zeros((len(model.labels), len(raws)))
        waiting, windows = [], 0
        for number, raw in _pieces(raws):
            need = -(-len(raw) // WINDOW)
            if windows + need > WINDOWS and waiting:
                _round(model, waiting, pooled)
                waiting, windows = [], 0
            waiting.append((number, raw))
            windows += need
        if waiting:
            _round(model, waiting, pooled)
        pooled /= np.maximum(1, [len(raw) for raw in raws])
        best = pooled.argmax(axis=0)
        return [
            pa.array([model.labels[k] for k in best.tolist()], pa.string()),
            pa.array(np.clip(pooled.max(axis=0), 0, 1), pa.float64()),
        ]

    return work


def predict_languages(
    df: DataFrame, model: bytes | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` (0 to 1) of every row.

    A null or empty text, or one without a letter, is ``und`` with score 0; so is
    every text without a model. Of equal probabilities the first label wins. Repeated
    rows stay and score alike, an empty table gives an empty result, and a long text is
    worked on in pieces.
    """
    keep = without(keep, ["lang_pred", "score"])
    if model is None:
        none = F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        return df.select(*map(col, keep), *none)
    shared = df.sparkSession.sparkContext.broadcast(model)
    letter = free_name([*df.columns, "lang_pred", "score"], "letter")
    found = map_texts(
        df.withColumn(letter, has_letter(col(text))),
        text,
        [*keep, letter],
        "lang_pred string, score double",
        partial(_predict_work, shared),
    )
    return found.select(
        *map(col, keep),
        F.when(col(letter), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(col(letter), F.col("score")).otherwise(0.0).alias("score"),
    )
