"""Quality, toxicity and language: held-out accuracy, odd rows, and no labels at all."""

import zlib

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from stockweek.llm import lang_id, quality_model, toxicity
from stockweek.llm.gru import BiGru, train
from stockweek.llm.lang_id import learn_languages, predict_languages
from stockweek.llm.queries import QUERIES
from stockweek.llm.words import SEGMENT

SF_DIR = "/root/testdata/sf0.01"
BIG = "/root/testdata/sf0.1"


def part(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.mark.parametrize(
    "name,label,least,most_false", [
        ("op3_quality_classifier", "quality", 0.95, 0.2), ("op4_toxicity", "toxic", 0.7, 0.02),
    ],
)
def test_held_out_accuracy(spark, name, label, least, most_false):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    scored = QUERIES[name](spark, BIG)
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (part(r["doc_id"], 5) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows) and len(held) > 500
    hit = [r["predicted"] for r in held if r[label] == 1]
    false = [r["predicted"] for r in held if r[label] == 0]
    assert sum(hit) / len(hit) >= least
    assert sum(false) / len(false) <= most_false


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = QUERIES["op8_language_id"](spark, SF_DIR).join(docs, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (part(r["doc_id"], 3) == 1) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


@pytest.fixture(scope="module")
def weights():
    rng = np.random.default_rng(1)
    words = ["good", "fine", "text", "here", "about", "things"]
    good = [" ".join(rng.choice(words, 30)).encode() for _ in range(60)]
    bad = [" ".join(rng.choice([*words, "awful###", "horrid"], 30)).encode() for _ in range(60)]
    texts, labels = good + bad, [1] * 60 + [0] * 60
    return quality_model.train(texts, labels), toxicity.train(texts, [1 - x for x in labels])


def scores(df, rows):
    found = df.collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 and set(r.asDict()) == {"doc_id", "text", "score"} for r in found)
    return {(r["doc_id"], r["text"]): r["score"] for r in found}


def test_odd_documents(spark, weights):
    """Nulls, empty and long texts get a score; a kept column named score is replaced."""
    docs, keep = odd.documents(spark), ("doc_id", "text", "score")
    quality = scores(quality_model.score_quality(docs, weights[0], keep=keep), odd.texts())
    toxic = scores(toxicity.score_toxicity(docs, weights[1], keep=keep), odd.texts())
    assert quality[1, None] == quality[2, ""] and toxic[1, None] == toxic[2, ""]


def brute_quality(raw, weights):
    import re

    from stockweek.llm.words import range_hashes

    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x00-\x20\x7f]+", raw)
    one = lambda t: int(range_hashes(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))[0])
    hashes = [one(t) for t in tokens]
    pairs = [
        int(quality_model.TWICE) if a == b
        else int(quality_model.mix(np.array([(a * 3 + b) % (1 << 64)], np.uint64))[0])
        for a, b in zip(hashes, hashes[1:], strict=False)
    ]
    buckets = [h >> (64 - quality_model.BUCKET_BITS) for h in hashes + pairs]
    total = sum(float(weights[b]) for b in buckets) / max(1, len(buckets)) ** 0.5
    return 1 / (1 + np.exp(-(total + weights[-1])))


def test_scores_by_brute_force(weights):
    import pyarrow as pa

    class Shared:
        value = weights[0]

    texts = ["", "good text", "awful### horrid a a a", "ö ## ö", "x " * 50]
    got = quality_model._score_work(Shared)(pa.array(texts).cast(pa.large_binary()))[0].to_pylist()
    assert got == pytest.approx([brute_quality(t.encode(), weights[0]) for t in texts], rel=1e-6)


def brute_ngrams(text):
    """The buckets of the distinct n-grams of a text's characters."""
    fold = {**{i: " " for i in range(9, 14)}, 0: " "}
    points = [ord(c) for c in odd.lower(text).translate(fold)]
    buckets, mask = set(), (1 << 64) - 1
    for order in toxicity.ORDERS:
        for i in range(len(points) - order + 1):
            h = 0
            for c in points[i : i + order]:
                h = (h * 0x100000001B3 + c) & mask
            h = h * 0x9E3779B97F4A7C15 & mask
            h = (h ^ h >> 29) * 0x9E3779B97F4A7C15 & mask
            buckets.add(max(1, h >> 64 - toxicity.BUCKET_BITS))
    return buckets


CHARACTERS = ["", "ab", "abc", "Abc\tÄÖ\x00", "привет мир, привет", "日本語のテキスト", "😀😀😀 ok", "x" * 30]


def test_ngrams_are_of_characters():
    found = list(toxicity._present([t.encode() for t in CHARACTERS]))
    assert [set(f.tolist()) for f in found] == [brute_ngrams(t) for t in CHARACTERS]
    assert len(brute_ngrams("日本語のテ")) == 3 + 2 + 1


@pytest.mark.parametrize("segment", [4, 16, 100])
def test_pieces_do_not_cut_characters(monkeypatch, segment):
    whole = [f.tolist() for f in toxicity._present([t.encode() for t in CHARACTERS])]
    monkeypatch.setattr(toxicity, "SEGMENT", segment)
    assert [f.tolist() for f in toxicity._present([t.encode() for t in CHARACTERS])] == whole


def brute_train(texts, labels, most, rounds):
    """The same training with dictionaries, text by text."""
    held = [brute_ngrams(t) for t in texts]
    counts = {}
    for buckets, label in zip(held, labels, strict=True):
        for b in buckets:
            counts.setdefault(b, [0, 0])[label] += 1
    size, n = 1 << toxicity.BUCKET_BITS, len(texts)
    share = sum(labels) / n
    chi = {
        b: (c[1] - sum(c) * share) ** 2 / sum(c) for b, c in counts.items() if sum(c) >= toxicity.MIN_TEXTS
    }
    kept = sorted((b for b in chi if chi[b] > 0), key=lambda b: (-chi[b], b))[:most]
    totals = [sum(c[k] for c in counts.values()) + size for k in (0, 1)]
    ratio = {b: np.log((counts[b][1] + 1) / totals[1]) - np.log((counts[b][0] + 1) / totals[0]) for b in kept}
    weights = dict.fromkeys(kept, 0.0)
    raw = [sum(c[k] for c in counts.values()) for k in (0, 1)]
    weights["bias"] = float(np.log(raw[1] / raw[0]))
    first, second = dict.fromkeys(weights, 0.0), dict.fromkeys(weights, 0.0)
    for step in range(1, rounds + 1):
        slope = {b: toxicity.L2 * w for b, w in weights.items()} | {"bias": 0.0}
        for buckets, label in zip(held, labels, strict=True):
            mine = [b for b in kept if b in buckets]
            z = weights["bias"] + sum(weights[b] * ratio[b] for b in mine)
            error = (1 / (1 + np.exp(-z)) - label) / n
            slope["bias"] += error
            for b in mine:
                slope[b] += error * ratio[b]
        for b in weights:
            first[b] += 0.1 * (slope[b] - first[b])
            second[b] += 0.01 * (slope[b] ** 2 - second[b])
            move = first[b] / (1 - 0.9**step) / (np.sqrt(second[b] / (1 - 0.99**step)) + 1e-8)
            weights[b] -= toxicity.RATE * (1 - 0.9 * step / rounds) * move
    return {b: w * ratio.get(b, 1.0) for b, w in weights.items()}


def test_toxicity_training_and_scoring_by_brute_force():
    rng = np.random.default_rng(4)
    words = ["gut", "böse", "мир", "日本語", "calm", "vile"]
    texts = [" ".join(rng.choice(words[: 5 + i % 2], 4)) for i in range(40)]
    labels = [int("vile" in t) for t in texts]
    got = toxicity.train([t.encode() for t in texts], labels, most=12, rounds=20)
    want = brute_train(texts, labels, 12, 20)
    assert {int(b) for b in np.flatnonzero(got)} <= {0, *(b for b in want if b != "bias")}
    for b, weight in want.items():
        assert got[0 if b == "bias" else b] == pytest.approx(weight, rel=1e-3, abs=1e-5)
    scored = toxicity.score_texts([t.encode() for t in [*texts, *CHARACTERS]], got)
    for text, score in zip([*texts, *CHARACTERS], scored.tolist(), strict=True):
        z = got[0] + sum(float(got[b]) for b in brute_ngrams(text))
        assert score == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-6)


def test_a_text_scores_alike_alone_and_among_others(weights):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(b"abcdef ##"), n)) for n in (0, 1, 5, 50, 3000, 2 * SEGMENT, 7)]
    together = toxicity.score_texts(texts, weights[1])
    alone = [toxicity.score_texts([t], weights[1])[0] for t in texts]
    assert together.tolist() == pytest.approx(alone)


def test_ngrams_do_not_cross_texts(weights):
    texts = [b"hor", b"rid aw", b"ful"] * 20
    assert len(set(toxicity.score_texts(texts, weights[1]).tolist())) <= 3
    split = toxicity.score_texts([b"horrid"], weights[1])[0]
    assert split > toxicity.score_texts([b"hor", b"rid"], weights[1]).max()


def test_without_labels(spark):
    docs = odd.documents(spark)
    none = spark.createDataFrame([(1, None, None)], "doc_id bigint, quality int, toxic int")
    assert quality_model.learn_quality(docs, none) is None
    assert toxicity.learn_toxicity(docs, none) is None
    assert {r["score"] for r in quality_model.score_quality(docs, None).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score_toxicity(docs, None).collect()} == {0.5}
    empty = odd.documents(spark, [])
    assert quality_model.score_quality(empty, None).collect() == []
    assert learn_languages(empty) is None
    assert predict_languages(empty, None).collect() == []
    found = predict_languages(docs, None, keep=("doc_id", "lang_pred")).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}


def test_languages_of_odd_documents(spark):
    docs = odd.documents(spark)
    found = predict_languages(docs, learn_languages(docs), keep=("doc_id", "text", "score")).collect()
    assert len(found) == len(odd.texts())
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") is not letters
        assert (r["lang_pred"] in ("de", "en")) is letters
        assert 0 <= r["score"] <= 1


def test_training_takes_nothing_but_usable_rows(spark):
    docs = spark.createDataFrame(
        [(i, "aaaa bbbb " * 9 if i % 2 else "cccc dddd " * 9, "x" if i % 2 else "y") for i in range(80)],
        "doc_id bigint, text string, lang string",
    )
    model = BiGru.from_bytes(learn_languages(docs, usable=F.col("doc_id") % 2 == 1))
    assert model.labels == ["x"]


def test_gradients_by_small_differences():
    """Backpropagation through time against the slope of the loss itself."""
    from stockweek.llm import gru

    rng = np.random.default_rng(2)
    side = gru.Direction(
        rng.normal(0, 0.5, (9, 256)).astype(np.float32), rng.normal(0, 0.5, (9, 3)).astype(np.float32)
    )
    inputs, steps = rng.integers(0, 9, (6, 4)), list(range(6))
    goal = rng.normal(0, 1, (6, 3, 4)).astype(np.float32)

    def loss(direction):
        return float((gru._run(direction, steps, inputs)[0].astype(np.float64) * goal).sum())

    slopes = gru._back(side, steps, inputs, gru._run(side, steps, inputs)[1], goal)
    for which in (0, 1):
        for _ in range(25):
            at = tuple(rng.integers(0, n) for n in (9, 9 if which == 0 else 3))
            up, down = ([w.copy() for w in side] for _ in range(2))
            up[which][at] += 1e-2
            down[which][at] -= 1e-2
            slope = (loss(gru.Direction(*up)) - loss(gru.Direction(*down))) / 2e-2
            assert slopes[which][at] == pytest.approx(slope, abs=2e-2, rel=2e-2)


def test_network_survives_its_bytes_and_pools_whole_texts():
    windows = np.array([[97] * 16, [98] * 16], np.uint8)
    model = BiGru.from_bytes(train(windows, np.array([0, 1]), ["a", "b"], rounds=60).to_bytes())

    class Shared:
        value = model.to_bytes()

    import pyarrow as pa

    work = lang_id._predict_work(Shared)
    long = "a" * (2 * lang_id.WINDOW * lang_id.WINDOWS) + "b" * 900
    texts = pa.array([None, "", "aaaa", "bbbb", long, "b" * 700]).cast(pa.large_binary())
    label, score = (c.to_pylist() for c in work(texts))
    assert label[2:] == ["a", "b", "a", "b"]
    assert 0.5 < score[4] <= 1


def plain_network(model, raw):
    """Label probabilities of a text's bytes, added up: one byte after the other, window by window."""
    units, total = model.forward.again.shape[1], np.zeros(len(model.labels))
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(side, values):
        state, out = np.zeros(units), []
        for b in values:
            x, inner = side.by_byte[:, b].astype(float), side.again.astype(float) @ state
            update = sigmoid(x[:units] + inner[:units])
            reset = sigmoid(x[units : 2 * units] + inner[units : 2 * units])
            new = np.tanh(x[2 * units :] + reset * inner[2 * units :])
            state = update * state + (1 - update) * new
            out.append(state)
        return out

    for at in range(0, len(raw), lang_id.WINDOW):
        piece = raw[at : at + lang_id.WINDOW]
        padded = list(piece.ljust(lang_id.WINDOW, bytes([lang_id.BLANK])))
        ahead = states(model.forward, padded)
        behind = states(model.backward, padded[::-1])[::-1]
        for a, b, _ in zip(ahead, behind, piece, strict=False):
            scores = model.out.astype(float) @ np.concatenate([a, b]) + model.bias[:, 0]
            odds = np.exp(scores - scores.max())
            total += odds / odds.sum()
    return total / max(1, len(raw))


def test_predictions_by_a_plain_network(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = BiGru.from_bytes(learn_languages(docs))
    texts = ["the dog", "die Katze", "x", "der Hund und the cat, " * 30, "日本 é", "1 2 3"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in predict_languages(asked, model.to_bytes()).collect()}
    for i, text in enumerate(texts):
        want = plain_network(model, text.encode())
        if any(c.isalpha() for c in text):
            assert found[i]["lang_pred"] == model.labels[int(want.argmax())]
            assert found[i]["score"] == pytest.approx(want.max(), abs=1e-4)
        else:
            assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)


def test_the_training_task_gets_windows_only(spark, monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"]), pa.array([("a long text " * 5000).encode()], pa.binary())], names=["lang", "text"]
    )
    (made,) = lang_id._windows(iter([batch]))
    assert made.num_rows == lang_id.SAMPLE_WINDOWS and made.nbytes < 1000
    assert list(map(len, made.column(1).to_pylist())) == [lang_id.TRAIN_BYTES] * lang_id.SAMPLE_WINDOWS
    monkeypatch.setattr(lang_id, "MAX_LANGUAGES", 1)
    schema = "doc_id bigint, text string, lang string"
    many = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], schema)
    with pytest.raises(ValueError, match="languages to learn"):
        learn_languages(many)
