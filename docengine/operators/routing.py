"""Which way each entity's document is read."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.fixed_values import (
    CONTEXT_LINES,
    FLAG_COLUMN,
    NOT_PRESENT,
    STEM_CUT,
)
from docengine.functions.text import context_lines, document_key, name_stem, strip
from docengine.operators.columns import true_or_false
from docengine.operators.shares import with_lists

TOC_SINGLE = "TOC_SINGLE"
TOC_MULTI = "TOC_MULTI"
SNIPPETS = "SNIPPETS"
WHOLE_TEXT = "WHOLE_TEXT"


def needs_enrichment(
    entities: DataFrame, columns=("Kirjeldus", "Ohutegurite kirjeldus")
) -> DataFrame:
    """Entities with a null in any of the columns; an absent column is no null."""
    empty = F.lit(False)
    for c in columns:
        if c in entities.columns:
            empty = empty | F.col(f"`{c}`").isNull()
    return entities.filter(empty)


def holds(text: Column, part: Column) -> Column:
    """Containment in any case; false for nulls."""
    return true_or_false(F.contains(F.lower(text), F.lower(part)))


def route(
    read: Column, toc: Column, in_toc: Column, in_file: Column, present: Column
) -> Column:
    """Route of an entity whose document was read and has this contents list."""
    has_toc = toc.isNotNull()
    return (
        F.when(~read, None)
        .when(in_file & has_toc, TOC_SINGLE)
        .when(in_file, WHOLE_TEXT)
        .when(has_toc & in_toc, TOC_MULTI)
        .when(has_toc & true_or_false(present), TOC_SINGLE)
        .otherwise(SNIPPETS)
    )


def route_documents(
    entities: DataFrame,
    documents: DataFrame,
    stem_cut: int = STEM_CUT,
    k: int = CONTEXT_LINES,
    key: str = "species_id",
    sentinel: str = NOT_PRESENT,
) -> DataFrame:
    """Add the route, the flag, the contents list as text and the text to read.

    `documents(doc_key, text, toc)` is unique by key.  The text to read is the whole
    document, or the lines around the name, or null when sections will be cut out.  What a
    document says to a name is found once per different name stem, in the document's row;
    a document that very many names ask is dealt to several tasks by their number.  Entities
    meet the answers by document and stem, so those of one document do not meet in one task,
    and a whole text goes only where it is read.  An entity without a document keeps its
    row, with a null route; one without a file joins by a value of its own that no document
    has, so that such rows do not meet in one task.
    """
    file = F.nullif(F.col("strategy_file"), F.lit(sentinel))
    alone = F.concat(F.lit("\0"), F.xxhash64(key).cast("string"))
    keyed = (
        entities.withColumn("_stem", name_stem(F.col("Estonian Name"), stem_cut))
        .withColumn("_in_file", holds(F.col("strategy_file"), F.col("_stem")))
        .withColumn("_file", document_key(file))
    )
    asked = (
        keyed.filter(F.col("_file").isNotNull())
        .groupBy(F.col("_file").alias("_doc"), F.col("_stem"))
        .agg(F.max("_in_file").alias("whole"))
        .select("_doc", F.struct(F.col("_stem").alias("stem"), "whole").alias("asked"))
    )
    entries = strip(F.array_join(F.col("toc.entries.raw"), "\n"))
    texts = documents.select(
        F.col("doc_key").alias("_doc"), F.col("text").alias("_text"), entries.alias("toc_text")
    )
    toc, text = F.col("toc_text"), F.col("_text")

    def answer(name: Column) -> Column:
        in_toc = holds(toc, name["stem"])
        around = F.array_join(context_lines(text, name["stem"], k), "\n")
        return F.struct(
            name["stem"].alias("_name"),
            text.isNotNull().alias("_read"),
            toc.alias("toc_text"),
            in_toc.alias("_in_toc"),
            F.when(name["whole"] & toc.isNull(), text).alias("_whole"),
            F.when(toc.isNull() | ~in_toc, around).alias("_around"),
        )

    answers = with_lists(asked, texts, "_doc", "asked").select(
        "_doc", F.inline(F.transform("asked", answer))
    )
    added = ("toc_text", "route", FLAG_COLUMN, "reading")
    reading = F.when(F.col("route") == WHOLE_TEXT, F.col("_whole")).when(
        F.col("route") == SNIPPETS, F.col("_around")
    )
    same = (F.coalesce("_file", alone) == F.col("_doc")) & F.col("_stem").eqNullSafe(F.col("_name"))
    return (
        keyed.join(answers, same, "left")
        .withColumn(
            "route",
            route(
                true_or_false(F.col("_read")),
                F.col("toc_text"),
                F.col("_in_toc"),
                F.col("_in_file"),
                F.col("strategy_present"),
            ),
        )
        .withColumn(FLAG_COLUMN, F.col("route").isin(TOC_SINGLE, TOC_MULTI))
        .withColumn("reading", reading)
        .select(
            *[F.col(f"`{c}`") for c in entities.columns if c not in added], *added
        )
    )
