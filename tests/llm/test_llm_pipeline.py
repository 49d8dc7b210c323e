import hashlib

import corpus_pipeline as pipeline
import numpy as np
import odd
import pytest
from pyspark.sql import functions as F
from stockweek.llm.gru import train
from test_llm_decontaminate import expected as expected_hits
from test_llm_line_dedup import expected as expected_lines
from test_llm_simhash import brute_fingerprint, brute_groups

GERMAN = "Die Katze sitzt auf der Matte und schaut hinaus in den Garten, wo der Hund schläft."
ENGLISH = "The cat sits on the mat and looks out into the garden where the dog is sleeping."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables on which each stage has something to do."""
    base = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, f"{i} {GERMAN} {i * 7919}\nfür alle gleich, diese Zeile") for i in range(0, 40)]
    rows += [(i, f"{i} {ENGLISH} {i * 7919}\n{' '.join(odd.WORDS)}") for i in range(40, 80)]
    rows += [(80, rows[3][1]), (81, "12345 ..."), (82, None), (83, ""), (84, f"x {' '.join(odd.WORDS)}")]
    full = [(i, t, "de" if i < 40 else "en", "s", len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(4).write.parquet(f"{base}/documents.parquet")
    items = [(1, " ".join(odd.WORDS[:12])), (2, "schaut hinaus in")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def stage(name):
    return dict(pipeline.STAGES)[name]


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]


def test_stages(spark, folder):
    """Each stage by brute force, on what the one before it kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns

    known = stage("language_id")(spark, docs, folder)
    assert known.columns == names
    before = texts(known)
    assert {i for i, _ in texts(docs)} - {i for i, _ in before} == {81, 82, 83}
    known = spark.createDataFrame(known.collect(), known.schema)

    unique = stage("line_dedup")(spark, known, folder)
    assert unique.columns == names
    after = texts(unique)
    assert after == sorted((r[0], r[1]) for r in expected_lines(before))
    assert all(r["n_chars"] == len(r["text"]) for r in unique.collect())
    unique = spark.createDataFrame(unique.collect(), unique.schema)

    single = stage("simhash_near_dedup")(spark, unique, folder)
    assert single.columns == names
    group = brute_groups([brute_fingerprint(t) for _, t in after], 4)
    kept = texts(single)
    assert kept == [after[g] for g in sorted(set(group))]
    single = spark.createDataFrame(single.collect(), single.schema)

    clean = stage("decontaminate")(spark, single, folder)
    assert clean.columns == names
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = {i: hit for i, _, hit, _ in expected_hits(kept, items)}
    assert any(hits.values())
    found = texts(clean)
    assert [i for i, _ in found] == [i for i, _ in kept]
    assert not any(hit for _, _, hit, _ in expected_hits(found, items))
    assert all(t == dict(kept)[i] for i, t in found if not hits[i])

    ids = stage("byte_bpe")(spark, spark.createDataFrame(clean.collect(), clean.schema), folder)
    sha = {r["doc_id"]: r["decoded_sha256"] for r in ids.collect()}
    assert sha == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in found}


@pytest.mark.parametrize(
    "labels,goes,stays", [(1, None, 0.99), (2, None, 0.505), (4, 0.2599, 0.2601), (10, 0.1039, 0.1041)]
)
def test_least_score_goes_by_the_number_of_labels(spark, monkeypatch, labels, goes, stays):
    names = [f"l{i}" for i in range(labels)]
    windows = np.arange(97, 97 + labels, dtype=np.uint8)[:, None].repeat(16, axis=1)
    model = train(windows, np.arange(labels), names, rounds=1).to_bytes()
    scored = spark.createDataFrame(
        [("1", "l0", stays)] + ([("2", "l0", goes)] if goes else []), "c0 string, lang_pred string, score double"
    )
    monkeypatch.setattr(pipeline, "learn_languages", lambda *a, **k: model)
    monkeypatch.setattr(pipeline, "predict_languages", lambda *a, **k: scored)
    docs = spark.createDataFrame([("1",)], "doc_id string").withColumn("text", F.lit("x"))
    monkeypatch.setattr(pipeline, "own_names", lambda df: (df.select(F.col("doc_id").alias("c0")), {"doc_id": "c0", "text": "c0"}))
    kept = stage("language_id")(spark, docs, "")
    assert [r["doc_id"] for r in kept.collect()] == ["1"]


def test_run(spark, folder):
    found = pipeline.run(spark, folder)
    assert found.count() > 40
    assert found.filter(F.col("n_tokens") * 4 != F.length("token_bytes")).count() == 0


def test_stages_on_odd_documents(spark, folder):
    """Nulls, repeated rows and clashing names; all but the last keep the columns."""
    for rows in (None, []):
        docs = odd.documents(spark, rows)
        for name, f in pipeline.STAGES:
            out = f(spark, docs, folder)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            assert out.count() <= docs.count()
