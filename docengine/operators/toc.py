"""Contents lists and the sections they name."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.fixed_values import TOC_MARKER, TOC_MAX_MISS
from docengine.functions.patterns import first_lines, texts_between
from docengine.functions.text import (
    dotless,
    let,
    normalize_line,
    strip,
    table_of_contents,
    without_lines,
)
from docengine.operators.columns import unfold
from docengine.operators.shares import with_lists


def with_toc(
    documents: DataFrame,
    marker: str = TOC_MARKER,
    max_miss: int = TOC_MAX_MISS,
    late_count: bool = False,
) -> DataFrame:
    """Add `toc`, a struct of first line, last line and entries, or null.

    The scan runs inside each document's row, so no text is moved between tasks.
    """
    return documents.withColumn(
        "toc", table_of_contents(F.col("text"), marker, max_miss, late_count)
    )


def toc_rows(documents: DataFrame, key: str = "doc_key") -> DataFrame:
    """`(key, k, line, title)` of all entries."""
    entries = F.transform(
        F.col("toc.entries"),
        lambda e, k: F.struct(
            k.alias("k"), e["line"].alias("line"), e["title"].alias("title")
        ),
    )
    return unfold(documents, [key], entries, "k")


def _comparable(name: Column) -> Column:
    """Form in which a requested name is looked for in an entry's dotless title."""
    return dotless(normalize_line(name))


def _body() -> Column:
    """Lower-case text without the contents list; null where there is none."""
    return let(
        F.col("toc"),
        lambda toc: F.lower(without_lines(F.col("text"), toc["first"], toc["last"])),
    )


def slice_sections(documents: DataFrame, key: str = "doc_key") -> DataFrame:
    """`(key, k, title, section_text)`: lower-case text from each title to the next.

    The contents list itself is left out of the text.  A title that is not found, or
    is directly followed by the next one, gives no row.  All titles of a document are found
    in one pass over its text, inside the document's row.
    """
    titles = F.col("toc.entries.title")
    marks = documents.select(
        F.col(f"`{key}`"),
        titles.alias("_titles"),
        _body().alias("_body"),
        F.transform(titles, F.lower).alias("_starts"),
        let(titles, lambda ts: F.transform(ts, lambda t, k: F.lower(F.get(ts, k + 1)))).alias("_ends"),
    )
    pieces = texts_between(F.col("_body"), F.col("_starts"), F.col("_ends"))
    # Bound outside the lambda, where Spark can't run an Arrow function.
    sections = let(
        pieces,
        lambda pieces: F.transform(
            F.col("_titles"),
            lambda title, k: F.struct(
                k.alias("k"),
                title.alias("title"),
                F.nullif(strip(F.get(pieces, k)), F.lit("")).alias("section_text"),
            ),
        ),
    )
    return unfold(marks, [key], sections, "section_text")


def named_sections(
    names: DataFrame, documents: DataFrame, key: str = "doc_key"
) -> DataFrame:
    """`(key, section, section_text)` of `(key, names)`, lists of different names per document.

    A name stands for the first entry that holds it, case and dots apart, as in
    `match_sections`; only the sections of entries that are asked for are cut out.  The
    lists ride in the document's row, which a single pass over its text then answers.
    """
    toc = F.col("toc.entries.title")
    asked = F.filter(F.col("names"), lambda s: strip(s) != "")
    with_names = (
        documents.join(names, key)
        .select(
            F.col(f"`{key}`"),
            asked.alias("_asked"),
            F.transform(asked, _comparable).alias("_compared"),
            toc.alias("_titles"),
            F.transform(toc, dotless).alias("_entries"),
            _body().alias("_body"),
        )
        .withColumn("_at", first_lines(F.col("_entries"), F.col("_compared")))
    )
    # Names of one entry share its section.
    wanted = F.array_distinct(F.filter(F.col("_at"), lambda at: at.isNotNull()))

    def marks(after: int) -> Column:
        return let(
            F.col("_titles"),
            lambda ts: F.transform("_wanted", lambda at: F.lower(F.get(ts, at + after))),
        )

    cut = with_names.withColumn("_wanted", wanted)
    cut = cut.withColumns({"_starts": marks(0), "_ends": marks(1)})
    pieces = texts_between(F.col("_body"), F.col("_starts"), F.col("_ends"))

    def piece(cut: Column, at: Column) -> Column:
        text = F.get(cut["pieces"], F.array_position(cut["wanted"], at).cast("int") - 1)
        return F.nullif(strip(text), F.lit(""))

    sections = let(
        F.struct(pieces.alias("pieces"), F.col("_wanted").alias("wanted")),
        lambda cut: F.zip_with(
            F.col("_asked"),
            F.col("_at"),
            lambda s, at: F.struct(s.alias("section"), piece(cut, at).alias("section_text")),
        ),
    )
    return unfold(cut, [key], sections, "section_text")


def match_sections(
    requested: DataFrame, documents: DataFrame, key: str = "doc_key"
) -> DataFrame:
    """`(key, section, k, title)`: the first entry holding each requested name.

    Case and dots do not count; empty names match nothing.  All different names of a document
    are compared with its entries in one pass, however often they are asked for; those of
    a document with very many are dealt to several tasks.
    """
    wanted = requested.filter(strip(F.col("section")) != "").select(key, "section").distinct()
    titles = F.col("toc.entries.title")
    entries = documents.select(key, titles.alias("_titles"))
    lists = with_lists(wanted, entries, key, "section").select(
        F.col(f"`{key}`"),
        "asked",
        "_titles",
        F.transform("_titles", dotless).alias("_entries"),
        F.transform("asked", _comparable).alias("_compared"),
    )
    at = first_lines(F.col("_entries"), F.col("_compared"))
    found = F.zip_with(
        F.col("asked"),
        at,
        lambda s, k: F.struct(
            s.alias("section"), k.alias("k"), F.get(F.col("_titles"), k).alias("title")
        ),
    )
    return unfold(lists, [key], found, "k")
