"""Files in and out."""

import os

import pytest
from pyspark.sql import types as T

from docengine.operators.columns import fill_text, ragged_union
from docengine.sources import tables
from docengine.sources.tables import (
    list_files,
    read_csv,
    read_texts,
    write_csv,
    write_stage,
)
from docengine.sources.workspace import RunFolder, shared_base

SCHEMA = T.StructType().add("name", "string").add("text", "string").add("flag", "boolean").add("n", "integer")


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        'name,text,flag,n\nkõre,"two\nlines, ""quoted""",True,1\nNA,None,False,\n"",nan,,3\n',
        encoding="utf-8",
    )
    rows = [tuple(r) for r in read_csv(spark, str(path), SCHEMA).collect()]
    assert rows == [
        ("kõre", 'two\nlines, "quoted"', True, 1),
        (None, None, False, None),
        (None, None, None, 3),
    ]


def test_csv_round_trip(spark, tmp_path):
    rows = [("a,b", 'q"uote\n\n"x', True, 1), ("ä", "\\back", False, None), (None, "x", None, 2)]
    write_csv(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), SCHEMA).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(map(str, rows))


def test_csv_export_forms(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, ["a", "b"], ["c", "d"], True, None)],
        "id int, files array<string>, parts array<string>, flag boolean, none string",
    ).coalesce(1)
    write_csv(df, str(tmp_path / "out"), {"files": "; "})
    part = next(p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv")
    assert part.read_text() == 'id,files,parts,flag,none\n1,a; b,"c, d",True,\n'


def test_text_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "x_cleaned.txt").write_text("line\n\fpage", encoding="utf-8")
    (tmp_path / "sub" / "y_cleaned.txt").write_text("õ", encoding="utf-8")
    (tmp_path / "z.txt").write_text("no")
    out = {r["doc_key"]: (r["file_name"], r["text"]) for r in read_texts(spark, str(tmp_path)).collect()}
    assert out == {"x": ("x_cleaned.txt", "line\n\fpage"), "y": ("y_cleaned.txt", "õ")}
    names = spark.createDataFrame([("x",), ("missing",)], "doc_key string")
    joined = names.join(read_texts(spark, str(tmp_path)), "doc_key", "left").collect()
    assert {r["doc_key"]: r["text"] for r in joined} == {"x": "line\n\fpage", "missing": None}


def test_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.pdf", "b.PDF", "c.txt", "sub/d.pdf"):
        (tmp_path / name).write_bytes(b"12345")
    deep = {(r["doc_key"], r["length"]) for r in list_files(spark, str(tmp_path)).collect()}
    flat = {r["doc_key"] for r in list_files(spark, str(tmp_path), recursive=False).collect()}
    assert deep == {("a", 5), ("b", 5), ("d", 5)} and flat == {"a", "b"}


def test_stage_is_written_once(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "cast(id as string) as t")
    out = write_stage(df, str(tmp_path), "st1")
    assert out.dtypes == df.dtypes and out.count() == 5
    assert out.inputFiles() and all("/st1/" in f for f in out.inputFiles())
    assert write_stage(df.filter("id < 2"), str(tmp_path), "st1").count() == 2


def test_shared_base_is_the_one_the_session_names():
    class Session:
        def __init__(self, folder):
            self.conf = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "w/"}

    assert shared_base(Session("hdfs://x/y")) == "hdfs://x/y"
    assert shared_base(Session("hdfs://x/y"), "hdfs://z/") == "hdfs://z"
    assert shared_base(Session(None)) == "w"


def test_run_folder_drops_what_is_not_needed(spark, tmp_path):
    run = RunFolder(spark, str(tmp_path))
    assert run.write(spark.range(3).toDF("id"), "a").count() == 3
    run.drop("a")
    assert os.listdir(run.path) == []


def test_csv_columns_go_by_name(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("b,a\n1,2\n")
    schema = T.StructType().add("a", "integer").add("b", "integer")
    assert [tuple(r) for r in read_csv(spark, str(path), schema).collect()] == [(2, 1)]


@pytest.mark.parametrize("rows", ["1,2,3\n", "1\n", '"1,2\n3,4\n'])
def test_csv_that_is_not_well_formed_raises(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text("a,b\n" + rows)
    schema = T.StructType().add("a", "string").add("b", "string")
    with pytest.raises(Exception):
        read_csv(spark, str(path), schema).collect()


def test_keys_are_not_nulled(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,t\nNA,NA\n")
    schema = T.StructType().add("id", "string").add("t", "string")
    assert [tuple(r) for r in read_csv(spark, str(path), schema, keys=("id",)).collect()] == [("NA", None)]


def test_equal_file_names_give_one_row(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x_cleaned.txt").write_text(folder)
    assert [r["text"] for r in read_texts(spark, str(tmp_path)).collect()] == ["a"]


def test_names_are_settled_on_the_listing(spark, tmp_path, monkeypatch):
    """Texts are read where they lie: no exchange carries one, however many names are taken."""
    for folder in ("a", "b", "c"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x_cleaned.txt").write_text(folder)
        (tmp_path / folder / f"õ {folder}_cleaned.txt").write_text(folder * 2)
    expected = [("x", "a"), ("õ a", "aa"), ("õ b", "bb"), ("õ c", "cc")]
    df = read_texts(spark, str(tmp_path))
    assert sorted((r.doc_key, r.text) for r in df.collect()) == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # Too many to be named: the paths are joined.
    monkeypatch.setattr(tables, "NAMED_FILES", 1)
    df = read_texts(spark, str(tmp_path))
    assert sorted((r.doc_key, r.text) for r in df.collect()) == expected


def test_ragged_union_and_fill(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    out = ragged_union(a, b, a).orderBy("id")
    assert [tuple(r) for r in out.collect()] == [(1, "x", None), (1, "x", None), (2, None, "y")]
    assert [tuple(r) for r in fill_text(out).collect()][0] == (1, "x", "")
