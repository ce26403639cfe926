"""Every registered query against its oracle statement, and the plans behind them."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from docengine.plans.oracle import ORACLE
from docengine.plans.queries import QUERIES, stage_tables
from docengine.plans.stages import export_stages

SF = "/root/testdata/sf0.001"
TABLES = [name.removesuffix(".parquet") for name in sorted(os.listdir(SF))]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    yield con
    con.close()


# Those that look for many patterns in one text, or cut texts longer than a chunk.
ARROW = {
    "section_slices", "section_match", "topic_texts", "mention_counts", "best_document", "chunk_greedy",
    "section_requests", "showcase_end_to_end",
}


def comparable(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    """Same columns, types and rows, by a plan without cross join or limit.

    Python workers run only where many patterns are looked for, and by Arrow batches.
    """
    df = QUERIES[name](spark, SF)
    plan = executed(df)
    assert not re.search(r"BatchEvalPython|Pandas|Cartesian|BroadcastNestedLoop|CollectLimit", plan)
    assert name in ARROW or "Python" not in plan
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in columns]).collect()]
    types = {row[0]: row[1] for row in duck.execute("describe " + ORACLE[name]).fetchall()}
    assert sorted(types) == columns
    named = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {c: named[t] for c, t in df.dtypes} == types
    chosen = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"select {chosen} from ({ORACLE[name]})").fetchall()
    assert got and comparable(got) == comparable(expected)


def scanned(plan):
    return [re.findall(r"(\w+)#", c) for c in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]


def test_only_asked_columns_are_read(spark):
    plan = executed(QUERIES["kv_pivot"](spark, SF))
    assert [set(c) for c in scanned(plan)] == [{"event_id", "ts", "user_id", "event_type", "props"}]
    assert "PushedFilters: [In(event_type" in plan
    plan = executed(QUERIES["unprocessed_documents"](spark, SF))
    assert scanned(plan) == [["doc_id", "source"], ["doc_id"]]


def test_top_links_are_limited_before_the_shuffle(spark):
    plan = executed(QUERIES["top3_candidates"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_and_slices_need_no_shuffle_of_their_own(spark):
    """A table is read as it is; the operators add no exchange."""
    for name in ("toc_scan", "section_slices", "context_lines", "chunk_greedy", "html_rows"):
        plan = executed(QUERIES[name](spark, SF))
        assert "Exchange" not in plan


def test_section_texts_take_five_exchanges(spark):
    """Each text is moved once and searched once, for the names that its entities ask."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(QUERIES["topic_texts"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"(?<!Reused)Exchange ", plan)) <= 5
    # Names are looked up among the entries, then marks in the text.
    assert plan.count("ArrowEvalPython") == 2 and plan.count("_body") >= 1


def test_same_rows_when_nothing_is_broadcast(spark, duck):
    """Shuffled joins, as on a cluster, give the same rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("topic_texts", "best_document", "lookup_links", "mention_counts", "route_documents"):
            df = QUERIES[name](spark, SF)
            assert "SortMergeJoin" in executed(df)
            chosen = ", ".join(f'"{c}"' for c in df.columns)
            expected = duck.execute(f"select {chosen} from ({ORACLE[name]})").fetchall()
            assert comparable([tuple(r) for r in df.collect()]) == comparable(expected)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stages_export_as_csv(spark, tmp_path):
    tables = stage_tables(spark, SF, str(tmp_path / "stages"))
    assert sorted(os.listdir(tmp_path / "stages")) == sorted([*tables, "species"])
    export_stages(tables, str(tmp_path / "csv"))
    names = [f"st{n}" for n in range(1, 9)] + ["showcase"]
    assert sorted(os.listdir(tmp_path / "csv")) == sorted(names)
    st4 = spark.read.option("header", True).csv(str(tmp_path / "csv" / "st4"))
    assert len(st4.columns) == 19
    assert st4.filter("strategy_file like '%.pdf; %.pdf'").count() > 0
    # Which stages are written does not change the outcome.
    fewer = QUERIES["showcase_end_to_end"](spark, SF).collect()
    assert comparable(map(tuple, fewer)) == comparable(map(tuple, tables["showcase"].collect()))
    assert {r[0] for r in st4.select("strategy_present").distinct().collect()} == {"True", "False"}
