"""Text functions: literal cases, and random cases against short Python models."""

import random
import time

import pytest
from pyspark.sql import functions as F

from docengine.functions import text as X


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, t string").repartition(4)


def results(df, column="v"):
    return [r[column] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, name",
    [("12)¹ kõre", "kõre"), ("7) x", "x"), ("3¹¹  y ", "y"), ("kõre 2", "kõre 2")],
)
def test_clean_name(value, raw, name):
    assert value(X.clean_name, raw) == name


@pytest.mark.parametrize(
    "raw, latin",
    [
        ("Bufo calamita; [RT 2010];", "Bufo calamita"),
        ("Anas acuta (haudeasurkond)", "Anas acuta (haudeasurkond)"),
        ("A b [x] [y].,;", "A b"),
        ("A [x\ny] b", "A [x\ny] b"),
    ],
)
def test_clean_latin(value, raw, latin):
    assert value(X.clean_latin, raw) == latin
    assert value(X.clean_latin, latin) == latin


@pytest.mark.parametrize(
    "line, expected",
    [
        ("2.1 Elupaiganõudlus ..... 12", "2.1 Elupaiganõudlus"),
        ("2.1 ... 12", "2.1 ... 12"),
        ("\t a  b  7", "a b"),
        ("", ""),
    ],
)
def test_normalize_line(value, line, expected):
    assert value(X.normalize_line, line) == expected


def test_strip_takes_every_unicode_space(value):
    assert value(X.strip, " \t\x1c x  \r\n") == "x"


def test_split_lines_knows_all_breaks(spark):
    raw = "a\r\nb\rc\nd\fe\x0bf\x1cg\x85h i j"
    assert results(texts(spark, [raw]).select("i", X.split_lines(F.col("t")).alias("v"))) == [
        list("abcdefghij")
    ]


def test_lines_and_words_equal_python(spark):
    rnd = random.Random(1)
    alphabet = "ab .\n\r\f\x0b\x1c\x1e\x85  \t　é"
    values = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 40))) for _ in range(400)]
    df = texts(spark, values).select(
        "i", X.split_lines(F.col("t")).alias("l"), X.split_words(F.col("t")).alias("w"),
        X.strip(F.col("t")).alias("s"),
    )
    for row, raw in zip(df.orderBy("i").collect(), values):
        lines = row["l"][:-1] if row["l"][-1] == "" else row["l"]
        assert lines == raw.splitlines()
        assert row["w"] == raw.split()
        assert row["s"] == raw.strip()


@pytest.mark.parametrize(
    "text, name, n",
    [
        ("Kõre KÕRE kõre", "kõre", 3),
        (None, "kõre", 0),
        ("", "kõre", 0),
        ("a.b axb", "a.b", 1),
        ("aaaa", "aa", 2),
        (r"x\Ey \E", r"\E", 2),
    ],
)
def test_count_mentions(value, text, name, n):
    assert value(X.count_mentions, text, name) == n


@pytest.mark.parametrize(
    "text, limit, expected",
    [
        ("aaaaaa b c", 5, ["", "aaaaaa", "b c"]),
        ("a bb ccc", 3, ["a bb", "ccc"]),
        ("", 3, []),
        (" \n ", 3, []),
        ("abc", 128000, ["abc"]),
    ],
)
def test_chunk_words(value, text, limit, expected):
    assert value(lambda c: X.chunk_words(c, limit), text) == expected


def test_chunks_keep_all_words_and_the_limit(spark):
    rnd = random.Random(2)
    values = [
        " ".join("x" * rnd.randint(1, 9) for _ in range(rnd.randint(0, 60))) for _ in range(200)
    ]
    df = texts(spark, values).select("i", X.chunk_words(F.col("t"), 20).alias("v"))
    for chunks, raw in zip(results(df), values):
        assert " ".join(chunks).split() == raw.split()
        assert all(sum(map(len, c.split())) <= 20 for c in chunks)
        # Greedy: no chunk could have taken the next word too.
        for a, b in zip(chunks, chunks[1:]):
            assert sum(map(len, a.split())) + len(b.split()[0]) > 20


def test_context_lines_equal_brute_force(spark):
    rnd = random.Random(3)
    values = [
        "\n".join(rnd.choice(["x", "hit", "a hit", "y", "z", ""]) + str(rnd.randint(0, 9))
                  if rnd.random() < 0.3 else rnd.choice("pqrst") * 2
                  for _ in range(rnd.randint(1, 40)))
        for _ in range(300)
    ]
    for k in (0, 2, 30):
        df = texts(spark, values).select(
            "i", X.context_lines(F.col("t"), F.lit("hit"), k).alias("v")
        )
        for got, raw in zip(results(df), values):
            lines = raw.split("\n")
            hits = [i for i, line in enumerate(lines) if "hit" in line]
            near = [line for i, line in enumerate(lines) if any(abs(i - h) <= k for h in hits)]
            assert got == list(dict.fromkeys(near))


def test_context_is_case_sensitive_and_empty_without_hit(value):
    assert value(lambda t: X.context_lines(t, F.lit("Hit"), 1), "hit\nx") == []


@pytest.mark.parametrize(
    "path, key", [("a/b/X y.PDF", "X y"), ("x.pdf", "x"), ("x_cleaned.txt", "x"), ("x.doc", "x.doc")]
)
def test_document_key(value, path, key):
    assert value(X.document_key, path) == key
    assert value(X.cleaned_name, path) == key + "_cleaned.txt"


def test_name_stem(value):
    assert [value(X.name_stem, s) for s in ("kõre", "ab", "a", "")] == ["kõ", "", "", ""]


def test_render_keeps_braces_of_the_template(value):
    out = value(lambda a, b: X.render('{"{name}": [{toc}]}', name=a, toc=b), "{toc}", "T")
    assert out == '{"{toc}": [T]}'


def test_split_list(value):
    assert value(X.split_list, " a , b,c ,") == ["a", "b", "c", ""]


def test_chunks_of_many_words(spark):
    words = [f"{'w' * (k % 7)}{k}" for k in range(2000)]
    expected, run = [], 0
    for w in words:
        if not expected or run + len(w) > 60:
            expected.append([])
            run = 0
        expected[-1].append(w)
        run += len(w)
    df = texts(spark, [" ".join(words)]).select("i", X.chunk_words(F.col("t"), 60).alias("v"))
    assert results(df) == [[" ".join(c) for c in expected]]


def test_chunking_grows_with_the_text(spark, tmp_path):
    def seconds(words):
        path = str(tmp_path / str(words))
        text = F.repeat(F.lit("word and word "), words // 3)
        spark.range(1).select(text.alias("t")).write.parquet(path)
        df = spark.read.parquet(path).select(X.chunk_words(F.col("t"), 500))

        def once():
            begin = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            return time.perf_counter() - begin

        return min(once() for _ in range(3))

    assert seconds(600_000) < 2.5 * seconds(300_000)
