"""Candidates, best documents and assembled texts."""

from docengine.operators.candidates import (
    backfill_candidates,
    first_candidates,
    pick_best_document,
    search_queries,
)
from docengine.operators.documents import (
    assemble_documents,
    page_flags,
    prefer_scan_text,
    unprocessed,
)


def test_search_queries(spark):
    df = spark.createDataFrame(
        [(1, "kõre", False), (2, "b", True), (3, "c", None)],
        "species_id int, `Estonian Name` string, strategy_present boolean",
    )
    out = {r["species_id"]: r["query"] for r in search_queries(df).collect()}
    assert out == {1: '"kaitse tegevuskava" "kõre" pdf', 3: '"kaitse tegevuskava" "c" pdf'}


def test_first_candidates(spark):
    df = spark.createDataFrame(
        [(1, 5, "u/e.pdf"), (1, 1, "u/a.PDF"), (1, 2, "u/a.PDF"), (1, 3, "u/x.html"),
         (1, 4, "u/d.pdf"), (1, 9, "u/late.pdf"), (2, 1, "u/x.html")],
        "species_id int, rank int, url string",
    )
    out = [tuple(r) for r in first_candidates(df).orderBy("place").collect()]
    assert out == [(1, 1, "u/a.PDF"), (1, 2, "u/d.pdf"), (1, 3, "u/e.pdf")]


def test_backfill(spark):
    entities = spark.createDataFrame(
        [(1, False, None), (2, True, ["own.pdf"]), (3, None, None), (4, False, None)],
        "species_id int, strategy_present boolean, strategy_file array<string>",
    )
    found = spark.createDataFrame(
        [(1, 1, "h/b.pdf"), (1, 0, "h/a.pdf"), (2, 0, "h/no.pdf"), (3, 0, "h/c.pdf"), (4, 0, "h/x.htm")],
        "species_id int, rank int, url string",
    )
    out = {r[0]: (r[1], r[2]) for r in backfill_candidates(entities, found).collect()}
    assert out == {
        1: (True, ["a.pdf", "b.pdf"]),
        2: (True, ["own.pdf"]),
        3: (True, ["c.pdf"]),
        4: (False, None),
    }


def test_best_document(spark):
    entities = spark.createDataFrame(
        [
            (1, "kõre", ["s/z.pdf", "s/x.pdf", "s/y.pdf"]),  # 0, 3, 3: first of equals
            (2, "ilves", ["x.pdf", "y.pdf"]),  # none
            (3, "kõre", ["dir/missing.pdf"]),  # single: unseen, folder away
            (4, "", ["x.pdf", "y.pdf"]),  # no name: untouched
            (5, "kõre", None),
            (6, "kõre", [" ", "w.pdf"]),
            (7, "kõre", ["x.pdf", "w.PDF"]),  # 3, 4
        ],
        "species_id int, `Estonian Name` string, strategy_file array<string>",
    )
    documents = spark.createDataFrame(
        [("x", "Kõre KÕRE kõre"), ("y", "kõre kõre kõre"), ("z", "other"), ("w", "kõre " * 4)],
        "doc_key string, text string",
    )
    out = {r["species_id"]: r["strategy_file"] for r in pick_best_document(entities, documents).collect()}
    assert out == {1: "x.pdf", 2: "Not Present", 3: "missing.pdf", 4: "x.pdf,y.pdf", 5: None,
                   6: "w.pdf", 7: "w.PDF"}


def test_assembled_text(spark):
    pages = spark.createDataFrame(
        [(1, 2, "b", "B"), (1, 1, "a", "A"), (1, 10, "", "C"), (2, 2, "", "y"), (2, 1, None, "x"),
         (3, 1, "done", "")],
        "doc_id int, page_no int, native_text string, ocr_text string",
    )
    done = spark.createDataFrame([(3,)], "doc_id int")
    out = {r["doc_id"]: (r["scanned"], r["text"]) for r in assemble_documents(pages, done).collect()}
    assert out == {1: (False, "ab"), 2: (True, "xy")}
    cleaned = spark.createDataFrame([(2, " clean \n"), (1, "never")], "doc_id int, text string")
    out = {r["doc_id"]: r["text"] for r in assemble_documents(pages, done, cleaned).collect()}
    assert out == {1: "ab", 2: "clean"}


def test_page_flags(spark):
    pages = spark.createDataFrame(
        [(1, 1, "", ""), (1, 2, "x", ""), (2, 1, "", ""), (2, 2, None, "")],
        "doc_id int, page_no int, native_text string, ocr_text string",
    )
    ids = spark.createDataFrame([(1,), (2,), (3,)], "doc_id int")
    assert {tuple(r) for r in page_flags(pages, ids).collect()} == {(1, False), (2, True), (3, True)}


def test_scan_text_replaces_native(spark):
    native = spark.createDataFrame([(1, "n1"), (2, "n2")], "doc_id int, text string")
    scan = spark.createDataFrame([(2, "s2"), (3, "s3")], "doc_id int, text string")
    out = {tuple(r) for r in prefer_scan_text(native, scan).collect()}
    assert out == {(1, "n1"), (2, "s2"), (3, "s3")}


def test_unprocessed(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id int")
    assert [r[0] for r in unprocessed(docs, docs.filter("doc_id = 1")).collect()] == [2]


def test_hot_key_gives_the_same_result(spark):
    """A third of all entities share one document and name."""
    rows = [(i, "kõre" if i % 3 == 0 else f"n{i}", ["hot.pdf", f"d{i % 50}.pdf"]) for i in range(3000)]
    entities = spark.createDataFrame(
        rows, "species_id int, `Estonian Name` string, strategy_file array<string>"
    )
    documents = spark.createDataFrame(
        [("hot", "kõre " * 5)] + [(f"d{i}", f"kõre n{i}") for i in range(50)],
        "doc_key string, text string",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = {r[0]: r[2] for r in pick_best_document(entities, documents).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for i, name, files in rows:
        if i % 3 == 0:
            assert out[i] == "hot.pdf"
        elif f"n{i % 50}".startswith(name):
            assert out[i] == files[1]
        else:
            assert out[i] == "Not Present"
