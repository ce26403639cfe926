"""Rows, values and links out of pages."""

import html as stdlib_html
import html.parser as stdlib_parser
import random
import re

from pyspark.sql import functions as F

from docengine.functions import html
from docengine.operators.registry import (
    enrich_kv,
    lookup_links,
    page_key_values,
    pivot_keys,
    plan_files,
)
from docengine.operators.rows import clean_rows, extract_rows
from docengine.plans.stages import profiles

LAW = """<html><a name="para4"></a><p>x</p>
<TABLE border="1"><tr><th>no</th></tr>
<tr><td>1)</td></tr>
<tr><td class="n">12)&sup1; k&otilde;re </td><td><i>Bufo calamita</i>; [RT 2010];</td><td>more</td></tr>
<tr><td>must-toonekurg</td><td>;Ciconia nigra;</td></tr></TABLE>
<a href="#" class='c' name='lg11'>II</a><table><tr><td>2) kotkas</td><td>Aquila.</td></tr></table>
<a name="lg111"></a><table><tr><td>wrong</td><td>wrong</td></tr></table>"""


def pages(spark, *rows):
    return spark.createDataFrame(
        [(i, url, body) for i, (url, body) in enumerate(rows)],
        "page_id long, url string, html string",
    )


def test_rows_of_sections(spark):
    sections = [("u1", "para4", "I"), ("u1", "lg11", "II"), ("u2", "lg11", "III"), ("u1", "none", "X")]
    out = clean_rows(extract_rows(pages(spark, ("u1", LAW), ("u2", LAW), ("u3", LAW)), sections))
    got = sorted(tuple(r) for r in out.collect())
    assert got == [
        (0, 0, 2, "kõre", "Bufo calamita", "I"),
        (0, 0, 3, "must-toonekurg", "Ciconia nigra", "I"),
        (0, 1, 0, "kotkas", "Aquila", "II"),
        (1, 2, 0, "kotkas", "Aquila", "III"),
    ]


def test_repeated_rows_are_kept(spark):
    page = "<ul><li><a>x</a></li><li><a>x</a></li></ul>"
    out = extract_rows(pages(spark, ("u", page), ("u", page)), [(None, None, "I")], "ul", "li", "a", 1)
    assert [r["cells"] for r in out.collect()] == [["x"]] * 4


def test_unescape_equals_standard_library(spark):
    rnd = random.Random(7)
    parts = ["&amp;", "&lt;", "&otilde;", "&#228;", "&#xE4;", "&#x1F600;", "&", ";", "&bogus;",
             "x", " ", "&#150;", "&#0;", "&#55296;", "&#1114112;", "&#xD800;", "&quot;", "&nbsp;", "&amp;lt;", "&&amp;",
             "&#x00000041;", "&#0000000065;", "&lbrack;", "&amp", "&nbsp", "&notit;", "&notin;", "&#65", "&#x41g",
             "&#99999999999;", "&#11;", "&#xFFFE;", "&#x1FFFF;", "&#129;", "&NotEqualTilde;", "&#x;", "&#;", "&Amp;"]
    values = ["".join(rnd.choices(parts, k=rnd.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    got = [r["v"] for r in df.select("i", html.unescape(F.col("t")).alias("v")).orderBy("i").collect()]
    assert got == [stdlib_html.unescape(v) for v in values]


PAGE = """<div class="Top"><table><tr><td>Rühm</td><td>Top</td></tr></table></div>
<div id="b" class="Body_MiddlePanel"><table>
<tr><td>Rühm</td><td>
 Linnud </td></tr>
<tr><td>only one</td></tr>
<tr><td>Nimi
inglise k</td><td><b>Toad</b> &amp; co</td></tr>
<tbody style="display:none"><tr><td>Rühm</td><td>Hidden</td></tr></tbody>
<tr><td>Liigi tegevuskava</td><td><a href="/getdok/1"> Plan
A </a><a href="/getdok/2"><img></a><a href="/other">no</a></td></tr>
<tr><td>Muu</td><td><a href="/getdok/3">not a plan</a></td></tr>
</table></div>"""


def test_key_values_and_plans(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>")], "species_id long, html string")
    kv = page_key_values(df)
    assert [(r["name"], r["value"]) for r in kv.orderBy("pos").collect()][:2] == [
        ("Rühm", "Linnud"),
        ("Nimi inglise k", "Toad & co"),
    ]
    assert kv.filter("value = 'Hidden' or value = 'Top'").count() == 0
    assert kv.filter("species_id = 2").count() == 0
    files = {r["species_id"]: r["files"] for r in plan_files(df).collect()}
    assert files[1] == ["Plan A.pdf", "strategy_document.pdf"]
    assert not files[2]


def test_key_values_end_with_their_panel(spark):
    def table(name):
        return f"<table><tr><td>{name}</td><td>v</td></tr></table>"

    html_page = (
        table("before") + "<DIV class='Body_MiddlePanel'>" + table("a") + "<div>" + table("b")
        + "</div>" + table("c") + "</DIV >" + table("between")
        + '<!-- <div class="Body_MiddlePanel">' + table("comment") + "</div> -->"
        + '<div id="x" class="Body_MiddlePanel">' + table("d") + "</div>" + table("after")
        + '<div class="Body_MiddlePanel_2">' + table("other") + "</div>"
        + '<div class="Body_MiddlePanel"><div>' + table("open")
    )
    df = spark.createDataFrame([(1, html_page), (2, None)], "species_id long, html string")
    got = page_key_values(df).orderBy("pos").collect()
    assert [r["name"] for r in got] == ["a", "b", "c", "d", "open"]


def test_pivot_takes_the_last_value(spark):
    kv = spark.createDataFrame(
        [(1, 0, "k1", "a"), (1, 1, "k1", "b"), (1, 2, "k3", "c"), (2, 5, "k2", "z"), (3, 1, "k9", "q")],
        "species_id long, pos int, name string, value string",
    )
    out = pivot_keys(kv, ["k1", "k2"]).orderBy("species_id").collect()
    assert [tuple(r) for r in out] == [(1, "b", None), (2, None, "z")]


def test_lookup(spark):
    entities = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "a", "y"), (5, None, "y")],
        "species_id int, `Estonian Name` string, `Latin Name` string",
    )
    index = spark.createDataFrame(
        [("a (x)", 2, "second"), ("a (x)", 1, "first"), ("a", 9, "plain a"), ("b", 1, "plain b"),
         ("z", 1, "z")],
        "name string, pos int, link string",
    )
    out = {r["species_id"]: r["EELIS link"] for r in lookup_links(entities, index).collect()}
    assert out == {1: "first", 2: "plain b", 3: "NotFound", 4: "plain a", 5: "NotFound"}


def test_lookup_splits_a_hot_name(spark):
    """A third of all entities share one name; its rows go to several partitions."""
    entities = spark.range(3000).selectExpr(
        "id as species_id", "if(id % 3 = 0, 'hot', concat('n', id)) as `Estonian Name`", "'x' as `Latin Name`"
    )
    index = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('n', id)) as name", "id as pos", "concat('/', id) as link"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup_links(entities, index)
        rows = out.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hot = [r for r in rows if r["Estonian Name"] == "hot"]
    assert len(rows) == 3000 and {r["EELIS link"] for r in hot} == {"/0"}
    assert len({r["part"] for r in hot}) > 2
    assert all(r["EELIS link"] == f"/{r['species_id']}" for r in rows if r["Estonian Name"] != "hot")


def test_enrichment(spark):
    entities = spark.createDataFrame(
        [(1, "a", "A", "I", "/1", "old"), (2, "b", "B", "I", "NotFound", "old"),
         (3, "c", "C", "I", "/3", "old"), (4, "d", "D", "I", "/4", "old")],
        "species_id int, `Estonian Name` string, `Latin Name` string, Category string,"
        " `EELIS link` string, Kirjeldus string",
    )
    kv = spark.createDataFrame(
        [(1, 0, "Rühm", "Linnud"), (1, 1, "Kirjeldus", "new"), (2, 0, "Rühm", "Linnud"),
         (3, 0, "Rühm", "Kalad"), (4, 0, "Rühm", "Linnud"), (4, 1, "Muu", "x")],
        "species_id int, pos int, name string, value string",
    )
    files = spark.createDataFrame(
        [(1, ["p.pdf"]), (2, ["q.pdf"]), (4, [])], "species_id int, files array<string>"
    )
    out = enrich_kv(entities, kv, files)
    assert out.columns[0] == "species_id" and len(out.columns) == 19
    rows = {r["species_id"]: r for r in out.collect()}
    assert set(rows) == {1, 4}
    assert (rows[1]["Kirjeldus"], rows[1]["strategy_present"], rows[1]["strategy_file"]) == (
        "new", True, ["p.pdf"])
    assert (rows[4]["Kirjeldus"], rows[4]["strategy_present"], rows[4]["strategy_file"]) == (
        "old", False, None)
    # Without the group filter the sentinel row is there, untouched.
    untouched = enrich_kv(entities, kv, files, keep=None).filter("species_id = 2").collect()[0]
    assert (untouched["Rühm"], untouched["strategy_present"]) == (None, False)


def test_pages_keyed_by_link(spark):
    entities = spark.createDataFrame(
        [(1, "a", "A", "I", "/1"), (2, "b", "B", "I", "/1"), (3, "c", "C", "I", "NotFound"),
         (4, "d", "D", "I", "/none")],
        "species_id int, `Estonian Name` string, `Latin Name` string, Category string, `EELIS link` string",
    )
    pages = spark.createDataFrame([("/1", PAGE), ("NotFound", PAGE)], "`EELIS link` string, html string")
    out = profiles(entities, pages)
    assert len(out.columns) == 19
    rows = {r["species_id"]: r for r in out.collect()}
    assert set(rows) == {1, 2}
    assert rows[2]["Nimi inglise k"] == "Toad & co"
    assert rows[2]["strategy_file"] == ["Plan A.pdf", "strategy_document.pdf"]
    by_id = pages.filter("`EELIS link` = '/1'").selectExpr("2 as species_id", "html")
    assert [r["species_id"] for r in profiles(entities, by_id).collect()] == [2]


class Elements(stdlib_parser.HTMLParser):
    """Inner HTML of every element of one tag, in the order of their opening tags."""

    def __init__(self, tag, page):
        super().__init__(convert_charrefs=False)
        self.tag, self.page, self.open, self.found = tag, page, [], []
        self.starts = [0]
        for line in page.split("\n"):
            self.starts.append(self.starts[-1] + len(line) + 1)
        self.feed(page)
        self.close()
        for at in self.open:
            self.found[at][1] = len(page)

    def here(self):
        line, column = self.getpos()
        return self.starts[line - 1] + column

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.open.append(len(self.found))
            self.found.append([self.here() + len(self.get_starttag_text()), None])

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            self.found[self.open.pop()][1] = self.here()

    def blocks(self):
        return [self.page[a:b] for a, b in self.found]


def test_nested_blocks_are_those_of_a_parser(spark):
    draw = random.Random(9)
    bodies = []

    def element(depth):
        if depth > 3 or draw.random() < 0.3:
            return draw.choice(["x", "y z", "<b>w</b>", "\n"])
        tag = draw.choice(["tr", "td", "table", "TR"])
        inner = "".join(element(depth + 1) for _ in range(draw.randint(0, 3)))
        end = "" if draw.random() < 0.1 else f"</{tag}>"
        return f"<{tag}{draw.choice(['', ' class=\"k\"'])}>{inner}{end}"

    for _ in range(300):
        body = "".join(element(0) for _ in range(4))
        # What no element of its kind follows or holds is found by pattern, when it is closed.
        bodies.append(body)
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, html string").select(
        "i", html.nested_blocks(F.col("html"), "tr").alias("v")
    )
    for r in df.collect():
        assert r.v == Elements("tr", bodies[r.i]).blocks(), bodies[r.i]


NESTED = (
    '<a name="n"></a><table><tr><td>a<table><tr><td>b</td><td>d</td></tr></table></td><td>c</td></tr>'
    "<tr><td>e</td><td>f</td></tr></table><table><tr><td>g</td><td>h</td></tr></table>"
)


def test_rows_of_nested_tables(spark):
    """The outer row with the cells inside it, then the inner row, then what follows."""
    df = pages(spark, ("u", NESTED))
    for anchor in ("n", None):
        got = [(r.pos, r.cells) for r in extract_rows(df, [("u", anchor, "I")]).collect()]
        assert sorted(got) == [(0, ["abd", "b", "d", "c"]), (1, ["b", "d"]), (2, ["e", "f"])]


def test_values_and_hidden_bodies_of_nested_tables(spark):
    page = (
        "<div class='Body_MiddlePanel'><table><tr><td>Outer</td><td><table><tr><td>Inner</td>"
        "<td>1</td></tr></table></td></tr>"
        '<tbody style="display:none"><tr><td>H</td><td><table><tbody><tr><td>I</td><td>2</td></tr>'
        "</tbody></table></td></tr><tr><td>J</td><td>3</td></tr></tbody>"
        "<tr><td>Shown</td><td>4</td></tr></table></div>"
    )
    rows = spark.createDataFrame([("s", page)], "species_id string, html string")
    got = sorted((r.pos, r.name, r.value) for r in page_key_values(rows).collect())
    assert [(n, v) for _, n, v in got] == [("Outer", "Inner1"), ("Inner", "1"), ("Shown", "4")]


def test_profiles_take_one_scan_of_the_page_and_one_join(spark):
    """Values and files come from the page's row; nothing is exchanged before the join."""
    page = (
        "<div class='Body_MiddlePanel'><table><tr><td>Rühm</td><td>Linnud</td></tr>"
        "<tr><td>Kirjeldus</td><td>first</td></tr><tr><td>Kirjeldus</td><td>last</td></tr>"
        "<tr><td>Liigi tegevuskava</td><td><a href='/getdok/1'>plan</a></td></tr></table></div>"
    )
    rows = [("s1", page), ("s2", page.replace("Linnud", "Muu")), ("s1", page), ("s3", "")]
    raw = spark.createDataFrame(rows, "species_id string, html string")
    linked = spark.createDataFrame(
        [(s, s, "L", "I", "/x") for s in ("s1", "s2", "s3", "s4")],
        "species_id string, `Estonian Name` string, `Latin Name` string, Category string, `EELIS link` string",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = profiles(linked, raw)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = df.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r.species_id, r.Kirjeldus, r.strategy_file, r.strategy_present) for r in got] == [
        ("s1", "last", ["plan.pdf"], True)
    ]
    assert len(re.findall(r"(?<!Reused)Exchange ", plan)) == 2 and plan.count("Join") == 1
    assert "Generate" not in plan
