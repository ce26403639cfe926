"""Candidate documents: the first few found, and the best of them."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docengine.functions.fixed_values import NOT_PRESENT, SEARCH_QUERY, TOP_LINKS
from docengine.functions.patterns import count_each
from docengine.functions.text import basename, document_key, render, strip
from docengine.operators.columns import true_or_false, unfold
from docengine.operators.shares import with_lists


def search_queries(entities: DataFrame, key: str = "species_id") -> DataFrame:
    """Search query of every entity that has no document yet."""
    return entities.filter(~true_or_false(F.col("strategy_present"))).select(
        key, render(SEARCH_QUERY, name=F.col("Estonian Name")).alias("query")
    )


def first_candidates(
    candidates: DataFrame,
    suffix: str = ".pdf",
    top: int = TOP_LINKS,
    key: str = "species_id",
) -> DataFrame:
    """`(key, place, url)` of the first `top` distinct links with the suffix.

    The rank limit is applied before and after the shuffle, so a key with very many
    links sends only `top` rows per task.
    """
    distinct = (
        candidates.filter(F.lower("url").endswith(suffix))
        .groupBy(key, "url")
        .agg(F.min("rank").alias("rank"))
    )
    by_rank = Window.partitionBy(key).orderBy("rank", "url")
    return (
        distinct.withColumn("place", F.row_number().over(by_rank))
        .filter(F.col("place") <= top)
        .select(key, "place", "url")
    )


def backfill_candidates(
    entities: DataFrame,
    candidates: DataFrame,
    suffix: str = ".pdf",
    top: int = TOP_LINKS,
    key: str = "species_id",
) -> DataFrame:
    """Give entities without a document the file names of their first candidates."""
    absent = ~true_or_false(F.col("strategy_present"))
    wanted = entities.filter(absent).select(key)
    # At most `top` links per key are collected.
    files = (
        first_candidates(
            candidates.join(wanted, key, "left_semi"), suffix, top, key
        )
        .groupBy(F.col(key).alias("_key"))
        .agg(
            F.array_sort(
                F.collect_list(F.struct("place", basename(F.col("url")).alias("file")))
            )["file"].alias("_files")
        )
    )
    found = F.col("_files").isNotNull()
    return (
        entities.join(files, F.col(key) == F.col("_key"), "left")
        .withColumn(
            "strategy_present", found | true_or_false(F.col("strategy_present"))
        )
        .withColumn("strategy_file", F.coalesce("_files", "strategy_file"))
        .drop("_key", "_files")
    )


def candidate_files(entities: DataFrame, key: str = "species_id") -> DataFrame:
    """`(key, name, pos, doc_key)`: entities with several files, a row per file."""
    return (
        entities.filter(F.size("strategy_file") > 1)
        .filter(F.coalesce("Estonian Name", F.lit("")) != "")
        .select(
            key,
            F.col("Estonian Name").alias("name"),
            F.posexplode("strategy_file").alias("pos", "file"),
        )
        .filter(strip(F.col("file")) != "")
        .withColumn("doc_key", document_key(strip(F.col("file"))))
        .drop("file")
    )


def mention_counts(
    pairs: DataFrame, documents: DataFrame, key: str = "species_id"
) -> DataFrame:
    """`(key, pos, n)`: how often the name occurs in the document.

    A document that is not there gives no row, one without text counts 0.  All different
    names asked of a text are found in one pass over it, however many entities ask; a text
    asked for very many names is searched for shares of them in several tasks.  The counts
    are narrow rows.
    """
    names = pairs.select("doc_key", "name").distinct()
    texts = with_lists(names, documents.select("doc_key", "text"), "doc_key", "name")
    found = F.zip_with(
        F.col("asked"),
        count_each(F.col("text"), F.col("asked")),
        lambda s, n: F.struct(s.alias("name"), n.alias("n")),
    )
    counted = unfold(texts, ["doc_key"], found, "name")
    return pairs.join(counted, ["doc_key", "name"]).select(key, "pos", "n")


def pick_best_document(
    entities: DataFrame,
    documents: DataFrame,
    sentinel: str = NOT_PRESENT,
    key: str = "species_id",
) -> DataFrame:
    """Reduce `strategy_file` to the file that mentions the entity's name most.

    The first of equals wins, no mention at all gives `sentinel`, and a single file is
    kept unseen.  Only positions travel through the aggregation; being a number, the
    best one is found by a hash aggregate with map-side reduction.
    """
    counts = mention_counts(candidate_files(entities, key), documents, key)
    # More mentions first, then the smaller position; above 0 when mentioned at all.
    score = F.col("n").cast("long") * F.lit(1 << 32) - F.col("pos")
    best = (
        counts.groupBy(F.col(key).alias("_key"))
        .agg(F.max(score).alias("_score"))
        .select(
            "_key",
            F.when(F.col("_score") > 0, F.pmod(-F.col("_score"), F.lit(1 << 32)))
            .cast("int")
            .alias("_pos"),
        )
    )
    files = F.col("strategy_file")
    named = F.coalesce(F.col("Estonian Name"), F.lit("")) != ""
    chosen = (
        F.when(F.size(files) == 1, basename(strip(F.get(files, F.lit(0)))))
        .when(
            (F.size(files) > 1) & named,
            F.coalesce(basename(strip(F.get(files, F.col("_pos")))), F.lit(sentinel)),
        )
        .when(F.size(files) > 1, F.array_join(files, ","))
    )
    return (
        entities.join(best, F.col(key) == F.col("_key"), "left")
        .withColumn("strategy_file", chosen)
        .drop("_key", "_pos")
    )
