"""Many patterns in one pass, against one search per pattern."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from docengine.functions import patterns
from docengine.operators.candidates import mention_counts
from docengine.operators.routing import route_documents
from docengine.operators.shares import with_lists
from docengine.operators.toc import slice_sections, with_toc


def searched(text, starts, ends):
    out = []
    for start, end in zip(starts, ends):
        at = text.find(start)
        if at < 0:
            out.append(None)
            continue
        stop = text.find(end, at) if end else -1
        out.append(text[at:stop] if stop >= 0 else text[at:])
    return out


def test_texts_between_marks_are_those_of_a_search():
    draw = random.Random(1)
    for _ in range(2000):
        text = "".join(draw.choice("abA. \n") for _ in range(draw.randint(0, 40)))
        marks = ["".join(draw.choice("abA. ") for _ in range(draw.randint(0, 4))) for _ in range(5)]
        ends = [draw.choice([*marks, None, ""]) for _ in marks]
        assert patterns.between(text, marks, ends) == searched(text, marks, ends)


@pytest.mark.parametrize("alphabet", ["ab ", "aAbB. ", "õÕkKß ", "σςΣ iIİı", "äÄ\U00010400\U00010428x"])
def test_counts_are_those_of_a_search_in_any_case(spark, alphabet):
    draw = random.Random(len(alphabet))
    rows = []
    for i in range(150):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60)))
        names = ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 3))) for _ in range(4)]
        rows.append((i, text, names))
    df = spark.createDataFrame(rows, "i int, t string, names array<string>")
    each = df.select("i", "t", F.explode("names").alias("name"))
    quoted = F.concat(F.lit(r"(?iu)\Q"), "name", F.lit(r"\E"))
    one = each.select("i", "name", F.regexp_count("t", quoted).alias("n")).distinct().collect()
    expected = {(r.i, r.name): r.n for r in one}
    many = df.select("i", "names", patterns.count_each(F.col("t"), F.col("names")).alias("n"))
    for r in many.collect():
        assert dict(zip(r.names, r.n)) == {n: expected[r.i, n] for n in r.names}


def test_nulls_and_empty_lists(spark):
    rows = [(0, None, ["a"]), (1, "a", None), (2, "a", []), (3, "", ["a", "", None]), (4, "aa", ["a", "", None])]
    df = spark.createDataFrame(rows, "i int, t string, names array<string>")
    counted = df.select("i", patterns.count_each(F.col("t"), F.col("names")).alias("n"))
    assert [r.n for r in counted.orderBy("i").collect()] == [[0], None, [], [0, 0, 0], [2, 0, 0]]
    cut = df.select("i", patterns.texts_between(F.col("t"), F.col("names"), F.col("names")).alias("v"))
    assert [r.v for r in cut.orderBy("i").collect()][:3] == [None, None, []]


def test_first_lines_are_those_of_a_search():
    draw = random.Random(3)
    for _ in range(2000):
        lines = ["".join(draw.choice("ab 1") for _ in range(draw.randint(0, 6))) for _ in range(draw.randint(0, 8))]
        parts = ["".join(draw.choice("ab 1") for _ in range(draw.randint(0, 3))) for _ in range(6)]
        expected = [next((i for i, x in enumerate(lines) if p in x), None) for p in parts]
        assert patterns.first_holding(lines, parts) == expected


def test_breaks_are_those_of_a_walk_over_the_words():
    draw = random.Random(4)
    for _ in range(3000):
        words = ["x" * draw.randint(1, 9) for _ in range(draw.randint(0, 30))]
        limit = draw.randint(1, 15)
        expected, chunk, run = [], [], 0
        for w in words:
            if run + len(w) > limit:
                expected.append(" ".join(chunk))
                chunk, run = [], 0
            chunk.append(w)
            run += len(w)
        expected += [" ".join(chunk)] if chunk else []
        assert patterns.chunks(words, limit) == expected


def test_cutting_grows_with_the_titles(spark, tmp_path):
    """Twice the titles and the text take less than 2.5 times as long."""

    def seconds(titles):
        path = str(tmp_path / str(titles))
        names = [f"{n}. Part {n * 7919 % 10007} of the report" for n in range(titles)]
        body = [f"{t}\n" + "plain words of this section and more of them " * 4 for t in names]
        text = "\n".join(["Sisukord", *[f"{t} ..... {n}" for n, t in enumerate(names)], *body])
        docs = spark.createDataFrame([("d", text)], "doc_key string, text string")
        with_toc(docs).write.parquet(path)
        df = slice_sections(spark.read.parquet(path))
        assert df.count() == titles

        def once():
            begin = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            return time.perf_counter() - begin

        return min(once() for _ in range(4))

    took = [seconds(n) for n in (2000, 4000, 8000)]
    assert took[1] < 2.5 * took[0] and took[2] < 2.5 * took[1]


def test_many_names_cost_little_more_than_few(spark, tmp_path):
    draw = random.Random(6)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(5000)]
    text = " ".join(draw.choice(vocabulary) for _ in range(200_000))
    spark.createDataFrame([("d", text)], "doc_key string, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))

    def seconds(names):
        rows = [(i, i, vocabulary[i], "d") for i in range(names)]
        pairs = spark.createDataFrame(rows, "species_id int, pos int, name string, doc_key string")
        path = str(tmp_path / f"p{names}")
        pairs.write.parquet(path)
        df = mention_counts(spark.read.parquet(path), docs)
        got = {r.species_id: r.n for r in df.collect()}
        for i in range(0, names, 97):
            assert got[i] == len(re.findall(vocabulary[i], text))

        def once():
            begin = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            return time.perf_counter() - begin

        return min(once() for _ in range(2))

    assert seconds(1000) < 5 * seconds(10)


def test_lists_follow_the_number_of_values(spark):
    """A key asked often gets several rows, each with a share; every pair is there once."""
    asked = [("hot", f"v{k}") for k in range(950)] + [("cold", "v1"), ("none", "v2"), (None, "v3")]
    asked = spark.createDataFrame(asked, "key string, value string")
    rows = spark.createDataFrame([("hot", 1), ("cold", 2), ("idle", 3)], "key string, n int")
    got = with_lists(asked, rows, "key", "value", size=100).collect()
    assert [r.asked for r in got if r.key == "cold"] == [["v1"]]
    hot = [r.asked for r in got if r.key == "hot"]
    assert len(hot) == 10 and max(map(len, hot)) < 200
    assert sorted(v for part in hot for v in part) == sorted(f"v{k}" for k in range(950))
    assert {r.key for r in got} == {"hot", "cold"} and {r.n for r in got if r.key == "hot"} == {1}
    # Its shares go to different tasks.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shares = with_lists(asked, rows, "key", "value", size=100).where("key = 'hot'")
        assert shares.select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_are_asked_move_once(spark):
    """Texts go through one exchange by themselves, and again only with a further list."""
    asked = [("hot", f"v{k}") for k in range(950)] + [("cold", "v1")]
    asked = spark.createDataFrame(asked, "key string, value string")
    rows = spark.createDataFrame([("hot", "a"), ("cold", "b")], "key string, body string")
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in off}
    for name, value in off.items():
        spark.conf.set(name, value)
    try:
        lists = with_lists(asked, rows, "key", "value", size=100)
        query = lists._jdf.queryExecution()
        plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(query, "formatted")
        assert lists.count() == 11
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    bodies = [columns for columns in moved if "body#" in columns]
    assert len([columns for columns in bodies if "asked#" not in columns]) == 1


def test_one_report_that_very_many_names_ask(spark):
    """Each name is answered once, in shares; all its entities get the answer."""
    lines = [f"line of name{k} here" for k in range(0, 3000, 2)]
    text = "\n".join(line for x in lines for line in (x, *["other"] * 8))
    docs = with_toc(spark.createDataFrame([("r", text)], "doc_key string, text string"))
    rows = [(k, f"name{k % 3000}ab", "r.pdf", False) for k in range(6000)]
    entities = spark.createDataFrame(
        rows, "species_id int, `Estonian Name` string, strategy_file string, strategy_present boolean"
    )
    got = {r.species_id: (r.route, r.reading) for r in route_documents(entities, docs, k=0).collect()}
    assert len(got) == 6000
    for k in (0, 7, 10, 2998, 5998):
        name = f"name{k % 3000}"
        expected = list(dict.fromkeys(x for x in lines if name in x))
        assert got[k] == ("SNIPPETS", "\n".join(expected))
