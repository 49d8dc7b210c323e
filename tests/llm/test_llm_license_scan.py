import random
import re

import odd
import pytest

from stockweek.llm.license_scan import Shape, scan_licenses
from stockweek.llm.license_texts import LICENSE_TEXTS


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def expected(rows, notices):
    found = {}
    for i, text in rows:
        w = words(text)
        for name, notice in notices:
            n = words(notice)
            size = min(5, len(n))
            want = shingles(n, size)
            for at in range(max(1, len(w) - len(n) + 1)):
                share = len(want & shingles(w[at : at + len(n)], size)) / len(want) if want else 0
                if share >= 0.8:
                    found[i, name] = max(share, found.get((i, name), 0))
    return found


def scan(df, **options):
    found = scan_licenses(df, **options).collect()
    assert len({tuple(r)[:2] for r in found}) == len(found)
    return {(r["doc_id"], r["license_id"]): r["containment"] for r in found}


def test_every_notice_is_found_anywhere(spark):
    rng, rows = random.Random(1), []
    for i, (_, text) in enumerate(LICENSE_TEXTS):
        for before in (0, 1, 3, 8, 17):
            around = [" ".join(rng.choices(odd.WORDS, k=before)), " ".join(rng.choices(odd.WORDS, k=9))]
            rows.append((100 * i + before, f"{around[0]}\n# {text.upper()}\n{around[1]}"))
    assert scan(odd.documents(spark, rows)) == pytest.approx(expected(rows, LICENSE_TEXTS))


def test_edited_notices(spark):
    """Words changed here and there: all that hold enough are found, and no others."""
    rng, rows = random.Random(2), []
    for k in range(120):
        w = rng.choice(LICENSE_TEXTS)[1].split()
        for _ in range(rng.randint(0, 1 + len(w) // 20)):
            w[rng.randrange(len(w))] = "changed"
        rows.append((k, " ".join([*rng.choices(odd.WORDS, k=rng.randint(0, 20)), *w])))
    got, want = scan(odd.documents(spark, rows)), expected(rows, LICENSE_TEXTS)
    assert got.keys() == want.keys()
    assert 20 < len(got) < 140


def test_odd_documents(spark):
    assert scan(odd.documents(spark)) == {}
    rows = odd.texts() + [(20, "All rights reserved."), (20, "all RIGHTS reserved"), (None, "All rights reserved")]
    assert scan(odd.documents(spark, rows)) == {(20, "reserved"): 1.0, (None, "reserved"): 1.0}
    assert scan(odd.documents(spark, [])) == {}


def test_own_notices(spark):
    notices = [("own", "one two three four five six"), ("empty", " ... "), ("word", "Xylophon")]
    docs = odd.documents(spark, [(1, "0 One two, three FOUR five six 7"), (2, "a xylophon b"), (3, "one two")])
    assert scan(docs, notices=notices) == {(1, "own"): 1.0, (2, "word"): 1.0}


def test_bands_leave_little_chance_to_miss():
    from math import ceil, comb

    for n in range(1, 300):
        shape = Shape.of(n)
        shingles_held = ceil(0.8 * (n - shape.shingle + 1))
        held = min(shingles_held, ceil(0.8 * (shape.window - shape.stride + 1)))
        k = shape.bands(n)
        assert comb(shape.window - held, k) / comb(shape.window, k) <= 0.001


def test_no_python_on_the_way(spark):
    plan = scan_licenses(odd.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InArrow|InPandas|Cartesian|NestedLoop", plan)
