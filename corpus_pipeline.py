"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage takes the columns of documents, of which ``doc_id`` is an integer, and others
beside them, by whatever names. Nulls in any column, empty and very long texts, repeated rows and
empty tables are as the operators' docstrings say; each stage says what it makes of them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweek.llm.bpe import ByteBpe
from stockweek.llm.columns import col, own_names
from stockweek.llm.decontaminate import cut_spans, find_contamination
from stockweek.llm.gru import BiGru
from stockweek.llm.lang_id import UNKNOWN, learn_languages, predict_languages
from stockweek.llm.line_dedup import dedup_lines
from stockweek.llm.simhash import drop_near_duplicates
from stockweek.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A document goes whose score is below so many times that of an even mixture of all
# labels, and below so much: known languages were measured down to just above it, see the README.
LEAST_SHARE, LEAST_SCORE = 1.04, 0.26

# Only part of it can be written as SQL.
ORACLE_SQL = None


def _with_text(df: DataFrame, names: dict[str, str], text: str) -> DataFrame:
    """The columns of documents under their names, with a new text and its length."""
    length = F.coalesce(F.length(text).cast("bigint"), col(names["n_chars"]))
    new = {"text": F.col(text), "n_chars": length} if "n_chars" in names else {"text": F.col(text)}
    return df.select(*(new.get(n, col(own)).alias(n) for n, own in names.items()))


def least_score(model: bytes | None) -> float:
    """The least score that a document needs, by the number of labels."""
    labels = len(BiGru.from_bytes(model).labels) if model else 1
    return min(LEAST_SCORE, LEAST_SHARE / labels)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those without a letter, or with an even mixture of the known languages.

    A language that was never learned mostly gets the label of a known one and stays. A null
    or empty text has no letter and goes; a repeated row gets what the first one gets. All
    columns stay, and an empty table stays empty.
    """
    usable = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    model = learn_languages(docs, usable=usable)
    rows, names = own_names(docs)
    found = predict_languages(rows, model, text=names["text"], keep=tuple(names.values()))
    sure = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score(model))
    return found.filter(sure).select(*(col(own).alias(n) for n, own in names.items()))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one holds.

    ``n_chars`` follows the new text. A null text stays null; rows of one id are one document,
    so are those without an id, which come first and lose nothing. All columns stay.
    """
    rows, names = own_names(docs)
    found = dedup_lines(rows, names["text"], names["doc_id"], tuple(names.values()))
    return _with_text(found, names, "kept_text")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Null and empty texts are a group of their own kind, of which one stays, and so does one
    of repeated rows. All columns stay.
    """
    return drop_near_duplicates(docs, width=4, bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words inside benchmark phrases.

    ``n_chars`` follows the new text. A null text stays null, repeated rows are cut alike, and
    an empty benchmark leaves all as they are. All columns stay.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, names = own_names(docs)
    found = find_contamination(rows, items, names["text"], tuple(names.values()))
    cut = cut_spans(found, names["text"], "hit_spans", tuple(names.values()))
    return _with_text(cut, names, "cut_text")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, with the digest of what they decode to.

    ``doc_id``, ``lang`` and ``source`` stay, other columns do not. A null text has no tokens,
    repeated rows stay.
    """
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    bpe = ByteBpe(docs, path, public_tokenizers.PATTERN)
    kept = ("doc_id", "lang", "source")
    found = bpe.round_trip(docs, keep=kept)
    digest = F.sha2("decoded", 256).alias("decoded_sha256")
    return found.select(*kept, "n_tokens", "token_bytes", digest)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
