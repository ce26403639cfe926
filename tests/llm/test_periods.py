"""Periodic runs against a plain model that tries every period."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docengine.llm import periods, queries

SF = "/root/testdata/sf0.001"


def all_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at + q < len(words):
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            if at - start >= q and at + q - start >= least:
                found.setdefault((start, at + q), q)
            at += at == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digests(doc_id, text):
    words = planted(doc_id, [w.decode() for w in (text or "").encode().split()])
    found = all_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, *sha)


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_are_those_of_every_period(letters):
    random = np.random.default_rng(letters)
    for size in [*range(0, 60), 90, 150]:
        words = random.integers(0, letters, size)
        if size % 3 == 0 and size:
            words = np.resize(words[: int(random.integers(1, size + 1))], size)
        for least in (2, 12):
            got = [tuple(r) for r in periods.runs(words, least).tolist()]
            assert got == all_runs(words.tolist(), least)


def test_runs_of_fibonacci_words_and_edited_powers():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    random = np.random.default_rng(7)
    for words in (b, *[np.where(random.random(300) < 0.02, 2, np.resize(b[:q], 300)) for q in (7, 16, 33, 64)]):
        words = np.array(words)
        assert [tuple(r) for r in periods.runs(words, 2).tolist()] == all_runs(words.tolist(), 2)


def test_query_equals_the_plain_model_on_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(digests(*r) for r in rows if len((r[1] or "").split()) < 1500)
    small = {r[0] for r in expected}
    got = sorted(tuple(r) for r in queries.op11_periods(spark, SF).collect())
    assert len(got) == len(rows) and any(r[1] for r in expected)
    assert [r for r in got if r[0] in small] == expected


def test_odd_rows(spark, odd):
    """Rows without text have no run; rows that share an id are documents of their own."""
    words = "a b " * 20
    rows = odd.select("doc_id", "text").collect() + [(8, words), (8, words), (9, "x\x0by\x1cz\x85 x")]
    extra = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1))
    got = periods.run_digests(periods.periodic_runs(extra)).collect()
    plain = []
    for doc_id, text in rows:
        found = all_runs([w for w in (text or "").encode().split()])
        plain.append((doc_id, len(found), *(found[0] if found else (None,) * 3)))
    key = lambda r: str(r)
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(plain, key=key)
    assert {tuple(r)[:6] for r in got if r[0] == 8} == {(8, 1, 0, 40, 2, 20000)}
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.collapsed_sha256 for r in got if r.doc_id in (3, 4, 5)} == {empty}
    kept = periods.periodic_runs(extra.where("doc_id = 8")).select("n_words", "collapsed").collect()
    assert [tuple(r) for r in kept] == [(40, "a b")] * 2
    assert periods.periodic_runs(extra.limit(0)).count() == 0


def test_runs_of_one_text_do_not_reach_the_next(spark):
    rows = [(k, "a " * 8) for k in range(20)] + [(50, "b c d " * 400_000)]
    got = periods.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in got.collect()}
    assert found == {**{k: [] for k in range(20)}, 50: [(0, 1_200_000, 3)]}
