"""Fingerprints against a plain model of what they hold, and ids far apart or missing."""

import hashlib
import random

import pytest

from docengine.llm import syncmers

WIDTH = syncmers.DIGITS + 1


def held(fingerprint):
    return [fingerprint[k : k + WIDTH] for k in range(0, len(fingerprint), WIDTH)]


def alike(a, b):
    """The longest common chain, by the quadratic rule, over all different anchors."""
    x, y = (list(dict.fromkeys(m[:-1] for m in held(f))) for f in (a, b))
    if not x and not y:
        return 1.0
    places = [y.index(v) for v in x if v in y]
    best = []
    for k, p in enumerate(places):
        best.append(1 + max((best[j] for j in range(k) if places[j] < p), default=0))
    chain = max(best, default=0)
    return chain / (len(x) + len(y) - chain)


def edited(text, after):
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


def texts():
    seeded = random.Random(3)
    passages = [" ".join(f"p{p}w{k}" for k in range(40)) for p in range(12)]
    out = {}
    for k in range(40):
        own = seeded.sample(passages, seeded.randint(0, 8))
        out[k * k] = " ".join([*own, *(f"own{k}x{j}" for j in range(seeded.randint(0, 12)))])
    out[-(2**62)], out[2**62] = "far below", "far above " * 30
    out[5], out[7] = "", None
    return out


@pytest.mark.parametrize("rows", [2048, 3])
def test_fingerprints_match_a_plain_model(spark, monkeypatch, rows):
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", rows)
    monkeypatch.setattr(syncmers, "CUTS", 1024 if rows > 3 else 4)
    given = texts()
    df = spark.createDataFrame(list(given.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.fingerprints(df).collect()}
    order = sorted(given, reverse=True)
    assert sorted(got) == sorted(given)
    for k, doc in enumerate(order):
        text, after = given[doc] or "", order[(k + 1) % len(order)]
        new = edited(text, given[after] or "")
        r = got[doc]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.near_edited == pytest.approx(alike(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(alike(r.fingerprint, got[after].fingerprint))
        steps = [int(m[-1], 16) for m in held(r.fingerprint)]
        assert len(steps) == 1 or all(1 <= s <= syncmers.K - syncmers.S + 1 for s in steps)
        assert (r.fingerprint == "") == (text.split() == [])


def test_passages_in_another_order_are_less_alike(spark):
    a, b, c = (" ".join(f"{n}{k}" for k in range(60)) for n in "abc")
    rows = [(3, f"{a} {b} {c}"), (2, f"{c} {a} {b}"), (1, f"{c} {a} {b}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.fingerprints(df).collect()}
    assert got[2].fingerprint == got[1].fingerprint and got[2].near_next == 1.0
    assert 0.35 < got[3].near_next < 0.7


def test_rows_without_an_id_have_no_next(spark):
    rows = [(None, "one two three"), (None, "one two three"), (None, ""), (4, "four")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = syncmers.fingerprints(df).collect()
    assert sorted(r.near_next for r in got if r.doc_id is None) == [0.0, 0.0, 1.0]
    assert [r.near_next for r in got if r.doc_id == 4] == [1.0]
