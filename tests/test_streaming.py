"""Resumable conversion of arriving page files."""

import os
from datetime import timedelta

import pytest

from docengine.streaming.incremental import BUCKETS, PAGES, assemble_new_documents, bucket


@pytest.fixture
def arriving(spark, tmp_path):
    pages, docs, state = (str(tmp_path / n) for n in ("pages", "docs", "state"))

    def arrive(*rows):
        spark.createDataFrame(list(rows), PAGES).coalesce(1).write.mode("append").parquet(pages)

    def run(state=state):
        assemble_new_documents(spark, pages, docs, state)
        return sorted(tuple(r) for r in spark.read.parquet(docs).collect())

    return arrive, run, state


def test_each_document_is_converted_once(arriving):
    arrive, run, state = arriving
    arrive((1, 2, "b", "", 2), (1, 1, "a", "", 2), (2, 1, "", "scan", 1))
    first = [(1, False, "ab"), (2, True, "scan")]
    assert run() == first
    assert run() == first
    arrive((3, 1, "new", "", 1), (1, 1, "again", "", 2))
    assert run() == [*first, (3, False, "new")]
    # A lost checkpoint replays all files and still adds nothing.
    assert run(state + "2") == [*first, (3, False, "new")]


def test_pages_come_in_several_deliveries(arriving):
    arrive, run, state = arriving
    arrive((1, 1, "a", "", 3), (2, 1, "x", "", None))
    assert run() == []
    arrive((1, 1, "other", "", 3), (1, 3, "c", "", None))  # a page again, one without a count
    assert run() == []
    arrive((3, 1, "z", "", 1))  # the others wait through a batch without them
    assert run() == [(3, False, "z")]
    arrive((1, 2, "b", "", 3), (2, 2, "y", "", 2))
    done = [(1, False, "abc"), (2, False, "xy"), (3, False, "z")]
    assert run() == done
    assert run(state + "2") == done


def test_a_repeated_batch_loses_and_doubles_nothing(arriving):
    arrive, run, state = arriving
    arrive((1, 1, "a", "", 2))
    run()
    arrive((1, 2, "b", "", 2), (2, 1, "x", "", 2))
    assert run() == [(1, False, "ab")]
    # As after a failure between the batch and its commit.
    for name in ("1", ".1.crc"):
        os.remove(f"{state}/commits/{name}")
    assert run() == [(1, False, "ab")]
    arrive((2, 2, "y", "", 2))
    assert run() == [(1, False, "ab"), (2, False, "xy")]


def state_files(state):
    """Files of waiting pages with their times."""
    found = {}
    for folder, _, names in os.walk(f"{state}/waiting"):
        for name in names:
            if name.startswith("part-"):
                found[os.path.join(folder, name)] = os.stat(os.path.join(folder, name)).st_mtime_ns
    return found


def test_only_touched_buckets_are_written(arriving, spark):
    """Documents that nothing comes for stay where they are; passed versions go."""
    arrive, run, state = arriving
    arrive(*[(d, 1, "a", "", 2) for d in range(200)])
    run()
    before = state_files(state)
    assert len(before) > BUCKETS // 2
    arrive((7, 2, "b", "", 2))
    assert run() == [(7, False, "ab")]
    after = state_files(state)
    # The arrival's bucket and the one that is looked at in turn, old and new.
    assert sum(f not in before for f in after) <= 2 and sum(f in after for f in before) == len(before)
    for number in range(3):
        arrive((7, 2, "b", "", 2))
        run()
    own = spark.range(7, 8).toDF("doc_id").select(bucket()).first()[0]
    versions = [v for v in os.listdir(f"{state}/waiting") if os.path.isdir(f"{state}/waiting/{v}/bucket={own}")]
    assert len(versions) <= 2
    arrive(*[(d, 2, "b", "", 2) for d in range(200)])
    assert run() == [(d, False, "ab") for d in range(200)]


def test_documents_that_wait_too_long_are_given_up(arriving, spark, tmp_path):
    arrive, _, state = arriving
    pages, docs = str(tmp_path / "pages"), str(tmp_path / "docs")

    def run(age):
        assemble_new_documents(spark, pages, docs, state, max_age=age)
        rejected = spark.read.parquet(f"{state}/rejected")
        return sorted((r.doc_id, r.page_no, r.native_text) for r in rejected.collect())

    arrive((1, 1, "a", "", 3), (1, 2, "b", "", 3), (2, 1, "x", "", None))
    assert run(timedelta(days=1)) == []
    arrive((1, 2, "late", "", 3), (2, 1, "x", "", None))
    assert run(timedelta(0)) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "x")]
    # What comes afterwards waits anew.
    arrive((1, 3, "c", "", 3), (2, 1, "x", "", 1))
    run(timedelta(days=1))
    done = {r.doc_id: r.text for r in spark.read.parquet(docs).collect()}
    assert 1 not in done and done[2] == "x"
