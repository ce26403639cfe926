"""Inputs of the jobs, derived from the given tables.

The tables hold plain prose and plain pages.  Here Spark writes reports with contents
lists, law pages, registry pages, candidate links and responses out of them, for all
rows and whole texts, so that each job meets the kind of input it is made for.
"""

import re

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.functions.fixed_values import (
    DESCRIPTION_FIELD,
    THREAT_FIELD,
    TOPICS,
)
from docengine.functions.text import NOT_WS, WS, let, strip
from docengine.operators.rows import clean_rows, extract_rows
from docengine.sources.tables import read_table

# A law page of each language: (url, anchor, category) as `extract_rows` takes it.
LAW_SECTIONS = [(None, "para4", "I"), (None, "lg11", "II"), (None, "lg5", "III")]


def heading(line: Column, i: Column) -> Column:
    """Line number, line and, from three words on, the line's heading."""
    three = rf"^{WS}*+{NOT_WS}++{WS}++{NOT_WS}++{WS}++{NOT_WS}++"
    return let(
        strip(F.regexp_replace(F.regexp_extract(line, three, 0), WS + "+", " ")),
        lambda words: F.struct(
            (i + 1).alias("n"),
            line.alias("line"),
            F.when(
                words != "", F.concat((i + 1).cast("string"), F.lit(". "), words)
            ).alias("title"),
        ),
    )


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """`(doc_id, doc_key, text)`: documents with a contents list in front.

    Every line of three words or more gets a numbered heading.  The list carries page
    breaks and stray lines; in some documents eleven stray lines cut it short.
    """
    docs = read_table(spark, sf, "documents")

    def entry(e, j):
        return F.concat(
            F.when(j % 10 == 9, "\f").otherwise(""),
            e["title"],
            F.lit(" "),
            F.repeat(F.lit("."), 5 + e["n"] % 7),
            F.lit(" "),
            e["n"].cast("string"),
            F.when(j % 4 == 3, "\n\ncontinued").otherwise(""),
            F.when(
                (j == 2) & (F.col("doc_id") % 13 == 5), "\nstray" * 11
            ).otherwise(""),
        )

    def report(items):
        return let(
            F.filter(items, lambda e: e["title"].isNotNull()),
            lambda titled: F.when(
                F.size(titled) > 0,
                F.concat(
                    F.lit("Report "),
                    F.col("doc_id").cast("string"),
                    F.lit("\nSisukord\n"),
                    F.array_join(F.transform(titled, entry), "\n"),
                    F.lit("\n\n"),
                    F.array_join(
                        F.transform(
                            items,
                            lambda e: F.concat(
                                F.coalesce(F.concat(e["title"], F.lit("\n")), F.lit("")),
                                e["line"],
                            ),
                        ),
                        "\n",
                    ),
                ),
            ).otherwise(F.col("text")),
        )

    text = let(F.transform(F.split("text", "\n"), heading), report)
    return docs.select(
        "doc_id",
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("doc_key"),
        text.alias("text"),
    )


def every_nth(items: Column, n: int) -> Column:
    """The share of a list that goes to topic `n`."""
    return F.filter(items, lambda x, i: i % len(TOPICS) == n)


def asked_topics(spark: SparkSession, sf: str) -> DataFrame:
    """An entity per document, asking for the heading of every line, spread over topics."""
    docs = read_table(spark, sf, "documents")
    headings = F.filter(
        F.transform(F.split("text", "\n"), lambda line, i: heading(line, i)["title"]),
        lambda t: t.isNotNull(),
    )
    return docs.select(
        F.col("doc_id").alias("species_id"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias(
            "strategy_file"
        ),
        F.lit(True).alias("Analyze_by_sisukord"),
        headings.alias("headings"),
    ).select(
        "species_id",
        "strategy_file",
        "Analyze_by_sisukord",
        *[every_nth(F.col("headings"), n).alias(t) for n, t in enumerate(TOPICS)],
    )


def mention_entities(spark: SparkSession, sf: str) -> DataFrame:
    """An entity per document, named by its first word, with three candidate files."""
    docs = read_table(spark, sf, "documents")
    ids = [F.col("doc_id") + 1, F.floor(F.col("doc_id") / 2), F.col("doc_id") + 7]
    return docs.select(
        F.col("doc_id").alias("species_id"),
        F.regexp_extract("text", r"\p{L}+", 0).alias("Estonian Name"),
        F.array(
            *[
                F.concat(F.lit("strategy_materials/doc_"), i.cast("string"), F.lit(".pdf"))
                for i in ids
            ]
        ).alias("strategy_file"),
    )


def plain_documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("doc_key"),
        "text",
    )


def turn_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as pages; only assistant turns have native text."""
    turns = read_table(spark, sf, "conversations")
    return turns.select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("page_no"),
        F.when(F.col("role") == "assistant", F.col("text")).otherwise("").alias("native_text"),
        F.col("text").alias("ocr_text"),
    )


def file_folder(spark: SparkSession, sf: str, folder: str, suffix: Column) -> str:
    """A folder with a file per conversation, most of them in sub-folders; its path."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    conversations = read_table(spark, sf, "conversations").groupBy("conv_id")
    files = conversations.agg(F.array_join(turns["text"], "\n").alias("text")).select(
        F.concat(
            F.when(F.col("conv_id") % 3 == 0, "").otherwise(
                F.concat(F.lit("sub/"), (F.col("conv_id") % 3).cast("string"), F.lit("/"))
            ),
            F.lit("conv_"),
            F.col("conv_id").cast("string"),
            suffix,
        ).alias("path"),
        "text",
    )
    base = re.sub("^file:/(?!/)", "file:///", folder)

    def write(rows) -> None:
        store, root = fs.FileSystem.from_uri(base)
        for row in rows:
            path = f"{root}/{row.path}"
            store.create_dir(path.rpartition("/")[0], recursive=True)
            with store.open_output_stream(path) as out:
                out.write(row.text.encode())

    files.foreachPartition(write)
    return folder


def law_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose link list became a table of numbered names under an anchor."""
    pages = read_table(spark, sf, "pages")
    anchor = (
        F.when(F.col("html").contains('<html lang="en">'), "para4")
        .when(F.col("html").contains('<html lang="fr">'), "lg11")
        .otherwise("lg5")
    )
    html = F.replace(
        F.regexp_replace(
            F.col("html"),
            r'<li><a href="/([^"]*)">([^<]*)</a></li>',
            "<tr><td>12)¹ $2</td><td>$1 [note]; [RT 2014];</td></tr>",
        ),
        F.lit("</ul></nav>"),
        F.lit("<tr><td>end</td></tr></table>"),
    )
    html = F.replace(
        html,
        F.lit("<nav><ul>"),
        F.concat(F.lit('<a name="'), anchor, F.lit('"></a><p>List</p><table class="t">')),
    )
    return pages.select("page_id", "url", html.alias("html"))


def page_number():
    """Number in a page's address."""
    return F.regexp_extract("url", r"/\w\w/(\d+)", 1)


def profile_pages(species: DataFrame) -> DataFrame:
    """A registry page per entity: shown rows, hidden rows and links to plans."""
    number = F.col("number")

    def row(key, value):
        return F.concat(F.lit(f"<tr><td>{key}</td><td> "), value, F.lit("\n</td></tr>"))

    plans = F.when(
        F.col("pos") % 3 == 1,
        F.concat(
            F.lit('<a href="/getdok/1"> doc_'),
            number,
            F.lit('\n</a> <a href="/other">no</a><a href="/getdok/2">doc_'),
            F.col("page_id").cast("string"),
            F.lit("</a>"),
        ),
    ).otherwise("-")
    html = F.concat(
        F.lit("<div class='Body_MiddlePanel'><table><tr><th>Andmed</th></tr>"),
        row("Nimi ladina\nk", F.lit("-")),
        row("Nimi inglise k", F.concat(F.lit("<b>"), F.col("Latin Name"), F.lit("</b>"))),
        row("Rühm", F.when(F.col("Category") == "III", "Imetajad").otherwise("Linnud")),
        row("Kaitsekategooria", F.col("Category")),
        row("Kirjeldus", F.when(F.col("pos") % 2 == 0, "").otherwise("on &amp; off")),
        row("Ohutegurite kirjeldus", F.when(F.col("pos") % 5 == 0, "NA").otherwise("low")),
        row("Liigi tegevuskava", plans),
        row("Kirjeldus", F.when(F.col("pos") == 5, "later").otherwise("")),
        F.lit("<tbody style='display:none'>"),
        row("Rühm", F.lit("Hidden")),
        F.lit("</tbody></table></div>"),
    )
    # The rows are far smaller than the pages; dealt by key, they also meet there later.
    return species.repartition("species_id").select("species_id", html.alias("html"))


def species_rows(spark: SparkSession, sf: str) -> DataFrame:
    """List rows of all law pages, with their place of origin and page number."""
    pages = law_pages(spark, sf)
    rows = clean_rows(extract_rows(pages, LAW_SECTIONS))
    numbers = pages.select("page_id", page_number().alias("number"))
    return rows.join(numbers, "page_id").withColumn(
        "species_id", F.concat_ws("-", "page_id", "section", "pos")
    )


def name_index(species: DataFrame) -> DataFrame:
    """A registry index that knows two thirds of the rows, in two key forms."""
    full = F.concat("Estonian Name", F.lit(" ("), "Latin Name", F.lit(")"))
    return species.filter(F.col("pos") % 3 != 2).select(
        F.when(F.col("pos") % 3 == 0, full).otherwise(F.col("Estonian Name")).alias("name"),
        F.col("species_id").alias("pos"),
        F.concat(F.lit("/lnim/"), F.col("species_id")).alias("link"),
    )


def search_results(species: DataFrame) -> DataFrame:
    """Ranked links per entity: with repeats, other file types and upper-case suffixes."""
    number, page = F.col("number"), F.col("page_id").cast("string")
    links = F.array(
        F.concat(F.lit("http://a/b/doc_"), number, F.lit(".html")),
        F.concat(F.lit("http://a/b/doc_"), number, F.lit(".PDF")),
        F.concat(F.lit("http://a/b/doc_"), number, F.lit(".PDF")),
        F.concat(F.lit("http://a/c/doc_"), page, F.lit(".pdf")),
        F.concat(F.lit("http://a/d/doc_"), F.col("pos").cast("string"), F.lit(".pdf")),
        F.concat(F.lit("http://a/e/doc_"), F.col("section").cast("string"), F.lit(".pdf")),
    )
    return species.filter(F.col("pos") != 5).select(
        "species_id", F.posexplode(links).alias("rank", "url")
    )


def answer_sections(requests: DataFrame, routed: DataFrame) -> DataFrame:
    """Responses to topic and passage requests.

    The topic answer spreads the contents lines over the topics, fenced or bare.
    """
    lines = F.split("toc_text", "\n")
    titles = F.transform(
        lines, lambda x: F.regexp_replace(x, r"\.{5,}[^.]*$|[\f\"\\]", "")
    )
    listed = let(
        titles,
        lambda titles: F.array(
            *[F.create_map(F.lit(t), every_nth(titles, n)) for n, t in enumerate(TOPICS)]
        ),
    )
    answer = F.to_json(F.create_map(F.lit("Lind"), listed))
    fenced = F.concat(F.lit("See:\n```json\n"), answer, F.lit("\n```\nDone."))
    topics = routed.filter("Analyze_by_sisukord").select(
        "species_id",
        F.lit("topics").alias("kind"),
        F.lit(0).alias("chunk"),
        F.when(F.rlike("species_id", F.lit("[024]$")), fenced).otherwise(answer).alias("response"),
    )
    passages = requests.filter(F.col("kind") == "passages").select(
        "species_id",
        "kind",
        "chunk",
        F.concat(F.lit(" P "), F.md5("prompt")).alias("response"),
    )
    return topics.unionByName(passages)


def answer_summaries(requests: DataFrame, texts: DataFrame) -> DataFrame:
    """Responses to summary requests: plain text, or JSON with a list in it."""
    digest = F.md5("prompt")
    whole = F.concat(
        F.lit("{" + f'"{DESCRIPTION_FIELD}":"D '),
        digest,
        F.lit(f'","{THREAT_FIELD}":["T","'),
        digest,
        F.lit('"]}'),
    )
    return requests.select(
        "species_id",
        "kind",
        "chunk",
        F.when(F.col("kind") == "summary", whole)
        .otherwise(F.concat(F.lit(" S "), digest, F.lit("\n")))
        .alias("response"),
    )


def shaped_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as responses of nine shapes, readable and not."""
    turns = read_table(spark, sf, "conversations")
    text = F.translate("text", '"\n\\', "   ")
    valid = F.concat(F.lit('{"Desc":"'), text, F.lit('","Threat":["a","'), F.col("role"), F.lit('"]}'))
    fenced = F.concat(F.lit("Here:\n```json\n"), valid, F.lit("\n```\nBye"))
    shape = (F.col("conv_id") + F.col("turn")) % 9
    response = (
        F.when(shape == 0, valid)
        .when(shape == 1, fenced)
        .when(shape == 2, F.col("text"))
        .when(shape == 3, F.concat(F.lit('```json\n{"Desc": '), text, F.lit("}\n```")))
        .when(shape == 4, F.concat(F.lit('{"Desc":'), F.col("turn").cast("string"), F.lit(',"Threat":true}')))
        .when(shape == 5, F.concat(valid, F.lit(" trailing")))
        .when(shape == 6, F.concat(F.lit("One:\n```json\n["), valid, F.lit("]\n```")))
        .when(shape == 7, F.concat(F.lit("```json\n["), valid, F.lit(","), valid, F.lit("]\n```")))
        .otherwise("{}")
    )
    return turns.select("conv_id", "turn", response.alias("response"))


def shaped_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as nested topic answers, bare and fenced."""
    turns = read_table(spark, sf, "conversations")
    text = F.translate("text", '"\n\\', "   ")
    body = F.concat(
        F.lit('{"Lind":[{"Ohud":["old"]},{"Ohud":["'),
        text,
        F.lit('","2 B"]},{"Uuringud":["'),
        F.col("role"),
        F.lit('"]}],"Other":[{"Uuringud":["x"]}]}'),
    )
    return turns.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("species_id"),
        F.when(F.col("turn") % 2 == 0, body)
        .otherwise(F.concat(F.lit("t\n```json\n"), body, F.lit("\n```")))
        .alias("response"),
    )
