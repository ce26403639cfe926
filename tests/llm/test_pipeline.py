"""The pipeline from end to end, and the queries that SQL can express."""

import os
from collections import defaultdict
from itertools import combinations

import duckdb
import pytest

import corpus_pipeline
from docengine.llm import lines, minhash_join, packing, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in sorted(os.listdir(SF)):
        con.execute(f"create view {table.removesuffix('.parquet')} as select * from '{SF}/{table}'")
    df = queries.QUERIES[name](spark, SF)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    expected = con.execute(f"select {columns} from ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in df.collect())


def test_each_stage_does_its_work_on_what_is_left(spark):
    """Every stage's output against what it was given, down to the packed sequences."""
    given = {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        given[name] = docs
        if name != "packing":
            assert docs.columns == columns and docs.count() > 0
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    quality = {r.doc_id: r.text for r in given["quality"].collect()}
    assert quality.items() <= first.items() and len(quality) < len(first)

    # One line of each group of similar lines stays.
    left = {r.doc_id: r.text for r in given["lines"].collect()}
    for doc_id, text in left.items():
        rest = iter((quality[doc_id] or "").split("\n"))
        assert all(line in rest for line in (text or "").split("\n"))
    kept = [lines.comparable(x) for t in left.values() for x in (t or "").split("\n")]
    kept = [x for x in kept if x]
    assert len(kept) == len(set(kept))
    sets, shared = [lines.shingle_set(x) for x in kept], defaultdict(list)
    for at, found in enumerate(sets):
        for s in found:
            shared[s].append(at)
    tried = {pair for ids in shared.values() if len(ids) < 60 for pair in combinations(ids, 2)}
    for a, b in tried:
        assert 100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b]), (kept[a], kept[b])

    # No two of the documents that stay are near copies, and each that went has one.
    near = {r.doc_id: r.text for r in given["near"].collect()}
    assert near.items() <= left.items()
    grams = {i: minhash_join.shingles(t, 5) for i, t in left.items()}

    def alike(a, b):
        return 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b]) > 0

    assert not any(alike(a, b) for a, b in combinations(sorted(near), 2))
    assert all(any(alike(a, b) for b in left if b != a) for a in left.keys() - near.keys())

    # Repetitions of whole documents, and one cut document per source.
    mixed = given["mixing"].collect()
    cut = [r for r in mixed if r.text != near[r.doc_id]]
    assert {r.doc_id for r in mixed} <= near.keys()
    assert len(cut) <= len({r.source for r in mixed})

    pieces = given["packing"].collect()
    encode = packing.encoder(*map(__import__("public_tokenizers").path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")))
    assert sum(r.length for r in pieces) == sum(len(encode(r.text or "")) + 1 for r in mixed)
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    for docs in given.values():
        docs.unpersist()


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [c.split()[0] for c in packing.PIECES.split(", ")] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
