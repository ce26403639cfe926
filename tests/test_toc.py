"""Contents lists and sections."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docengine.operators.toc import match_sections, slice_sections, toc_rows, with_toc


def docs(spark, *texts):
    rows = [(f"d{i}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_key string, text string")


def scan(spark, text):
    toc = with_toc(docs(spark, text)).select("toc").collect()[0]["toc"]
    return toc and ([e["title"] for e in toc["entries"]], toc["first"], toc["last"])


STOP = "Sisukord\n1. A ..... 3\n" + "plain\n" * 11 + "9. Z ..... 9"
TEN = "Sisukord\n1. A ..... 3\n" + "plain\n" * 10 + "9. Z ..... 9"


@pytest.mark.parametrize(
    "text, expected",
    [
        (
            "Title\nX\nSisukord\n1. A ......... 3\n\n2. B ........ 5\nbody a\nbody b",
            (["1. A", "2. B"], 3, 6),
        ),
        (STOP, (["1. A"], 1, 2)),
        (TEN, (["1. A", "9. Z"], 1, 13)),
        ("Sisukord\n1. A ..... 3\n\f2. B ...... 4\nz", (["1. A", "2. B"], 1, 4)),
        ("Sisukord\n1. A .... 3\n2. B ..... 4 \n3. C ..... 5", (["3. C"], 1, 4)),
        ("Sisukord\nnothing", None),
        ("1. A ..... 3", None),
        # The marker inside a line: that line is the first one.
        ("x\nsee Sisukord\n1. A ..... 3", (["1. A"], 2, 3)),
        # Blank lines are no misses.
        ("Sisukord\n" + "\n" * 20 + "1. A ..... 3", (["1. A"], 1, 22)),
        # The marker's line is the first miss.
        ("Sisukord\n" + "x\n" * 9 + "1. A ..... 3", (["1. A"], 1, 11)),
        ("Sisukord\n" + "x\n" * 10 + "1. A ..... 3", None),
    ],
)
def test_scan(spark, text, expected):
    assert scan(spark, text) == expected


@pytest.mark.parametrize(
    "text, first, last",
    [
        ("Title\nX\nSisukord\n1. A ......... 3\n\n2. B ........ 5\nbody a\nbody b", 3, 7),
        (STOP, 1, 3),
        (TEN, 1, 14),
        ("Sisukord\n1. A ..... 3\n\f2. B ...... 4\nz", 1, 5),
        ("Sisukord\n1. A .... 3\n2. B ..... 4 \n3. C ..... 5", 1, 5),
        ("x\nsee Sisukord\n1. A ..... 3", 3, 5),
    ],
)
def test_late_count(spark, text, first, last):
    toc = with_toc(docs(spark, text), late_count=True).select("toc").collect()[0]["toc"]
    assert (toc["first"], toc["last"]) == (first, last)


def test_scan_equals_line_by_line_model(spark):
    rnd = random.Random(5)
    kinds = ["T {} ..... {}", "plain {} {}", "", "   ", "x .... {}{}", "T {}......{}"]
    texts = []
    for _ in range(250):
        lines = ["start"] * rnd.randint(0, 2) + ["Sisukord"]
        for n in range(rnd.randint(0, 60)):
            line = rnd.choices(kinds, [3, 6, 1, 1, 1, 1])[0].format(n, n)
            lines.append(rnd.choice(["", "", "", "\f"]) + line)
        texts.append("\n".join(lines))
    got = {
        r["doc_key"]: r["toc"] and [(e["line"], e["raw"]) for e in r["toc"]["entries"]]
        for r in with_toc(docs(spark, *texts)).collect()
    }
    for i, text in enumerate(texts):
        misses, kept, begun = 0, [], False
        for n, line in enumerate(text.splitlines(), 1):
            begun = begun or "Sisukord" in line
            if not begun or not line.strip():
                continue
            if re.search(r"\.{5,}\s*\d+$", line):
                kept.append((n, line))
                misses = 0
            else:
                misses += 1
                if misses > 10:
                    break
        assert got[f"d{i}"] == (kept or None)


REPORT = (
    "Intro\nSisukord\n1. Alpha ..... 1\n2. Beta ..... 2\n3. Gamma ..... 3\n4. Gone ..... 4\n"
    "first body\n1. ALPHA\nalpha text\n2. Beta\nbeta text\n3. Gamma\ngamma text"
)


def test_slices(spark):
    out = slice_sections(with_toc(docs(spark, REPORT))).orderBy("k").collect()
    assert [(r["k"], r["title"], r["section_text"]) for r in out] == [
        (0, "1. Alpha", "1. alpha\nalpha text"),
        (1, "2. Beta", "2. beta\nbeta text"),
        # The title after it does not occur, so it reaches to the end.
        (2, "3. Gamma", "3. gamma\ngamma text"),
    ]


def test_slice_with_repeated_title_is_dropped(spark):
    text = "Sisukord\nA ..... 1\nA b ..... 2\nx\nA b text"
    out = slice_sections(with_toc(docs(spark, text))).collect()
    assert [(r["k"], r["section_text"]) for r in out] == [(1, "a b text")]


def test_lines_after_the_list_are_kept(spark):
    text = "Sisukord\nBody ..... 1\nbody one\nbody two"
    out = slice_sections(with_toc(docs(spark, text))).collect()
    assert [r["section_text"] for r in out] == ["body one\nbody two"]


def test_slices_do_not_overlap(spark):
    titles = [f"{n}. Part {chr(96 + n)}" for n in range(1, 20)]
    body = [line for t in titles for line in (t, f"text of {t.split()[-1]}")]
    text = "\n".join(["Sisukord", *[f"{t} ........ 9" for t in titles], *body])
    out = slice_sections(with_toc(docs(spark, text))).orderBy("k").collect()
    assert "\n".join(r["section_text"] for r in out) == "\n".join(body).lower()


def test_match(spark):
    asked = spark.createDataFrame(
        [("d0", "beta"), ("d0", "beta"), ("d0", "2 Beta..... 7"), ("d0", "a"), ("d0", ""),
         ("d0", "delta"), ("d1", "beta"), ("dx", "beta")],
        "doc_key string, section string",
    )
    out = match_sections(asked, with_toc(docs(spark, REPORT, "no list"))).collect()
    assert {(r["doc_key"], r["section"], r["k"], r["title"]) for r in out} == {
        ("d0", "beta", 1, "2. Beta"),
        ("d0", "2 Beta..... 7", 1, "2. Beta"),
        ("d0", "a", 0, "1. Alpha"),
    }
    assert len(out) == 3


def test_toc_rows(spark):
    out = toc_rows(with_toc(docs(spark, REPORT))).orderBy("k").collect()
    assert [(r["k"], r["line"], r["title"]) for r in out][:2] == [(0, 3, "1. Alpha"), (1, 4, "2. Beta")]


def test_text_is_computed_once_per_row(spark):
    """The scan of a derived text shows up once in the plan, not once per use."""
    base = docs(spark, REPORT).withColumn("text", F.concat("text", F.lit("<mark>")))
    plan = slice_sections(with_toc(base))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("<mark>") == 1
