"""Mixing sources to target weights under a limit on repetitions (SQL only).

Sources share the corpus's words by weight, but none gets more than `epochs` times its own
words: what it can't take is shared again among the others, by weight, until none is above
(water-filling). With all sources in order of limit by weight, the level where the water
stands follows from two running sums, so no loop is needed.

A document is taken whole as often as its source's epochs say; the fraction that is left is
sampled: documents go by a seeded hash until the source's words are used up, the last one
with a part of its words. Words are `[^\\x20\\x09-\\x0D]+`; null text has none.

Defined cases: sources are ordered by code point, null last, and weigh 1, 2, 3, repeating;
a source without words gets nothing; equal rows may differ in what they take; only doc_id,
text and source are read.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docengine.sources.workspace import RunFolder

WORD = r"[^\x20\x09-\x0D]+"
EPOCHS = 3
SLOTS = 4096


def default_weights(sources: DataFrame) -> DataFrame:
    """Weight 1, 2, 3, repeating, by the order of the distinct sources."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)


def targets(sizes: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """sizes (source, words, weight) with each source's `target`: a row per source."""
    limit = (epochs * F.col("words")).cast("decimal(38,0)")
    rising = W.orderBy(
        (F.col("words") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    )
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    everyone = W.partitionBy()
    none = F.lit(0).cast("decimal(38,0)")
    total = F.sum("words").over(everyone)
    # Level if all sources before this one are full and the others share what is left.
    filled = F.coalesce(F.sum(limit).over(before), none)
    weights = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (total - filled).cast("double") / weights
    return (
        sizes.withColumn("own_level", level)
        # Each source that is really full raises the level, each one taken for full lowers it.
        .withColumn("level", F.max("own_level").over(everyone))
        .withColumn(
            "target",
            F.least(
                F.col("level") * F.col("weight"), epochs * F.col("words").cast("double")
            ),
        )
        .select("source", "words", "weight", "target")
    )


def place(documents: DataFrame, epochs: int, seed: int, run: RunFolder) -> DataFrame:
    """keep, source, size, source_size, target, taken: a row per row of `documents`.

    `keep` has the columns of `documents`. The cut inside a source is found without sorting
    it: words are added up by `SLOTS` ranges of the hash, and only documents of the range
    where they run out are moved and ordered. All others meet a row per source, which is
    written, so that Spark knows whether it is small enough to go to them.
    """
    mark = F.xxhash64(F.lit(seed), "doc_id", "source", F.length("text"))
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("keep"),
        F.col("source").cast("string").alias("source"),
        mark.alias("mark"),
        F.pmod(F.shiftrightunsigned(mark, 40), F.lit(SLOTS)).cast("int").alias("slot"),
    )
    size = F.coalesce(F.regexp_count("keep.text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = rows.withColumn("size", size)
    slots = sized.groupBy("source", "slot").agg(F.sum("size").alias("words"))
    cuts = run.write(_cuts(slots, epochs), "cuts")
    same = F.col("source").eqNullSafe(F.col("p_source"))
    at, rest = F.col("cut.slot"), F.col("cut.rest")
    taken = F.col("whole") * F.col("size")
    even = sized.join(cuts, same).where(at.isNull() | (F.col("slot") != at)).withColumn(
        "taken", taken + F.when(at.isNull() | (F.col("slot") < at), F.col("size")).otherwise(0)
    )
    within = (
        W.partitionBy("source")
        .orderBy("mark", "keep.doc_id", "size")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    ahead = F.coalesce(F.sum("size").over(within), F.lit(0))
    # Words are counted after the join, which few rows pass.
    uneven = rows.join(cuts, same & (F.col("slot") == at)).withColumn("size", size).withColumn(
        "taken", taken + F.least("size", F.greatest(F.lit(0), rest - ahead))
    )
    names = ["keep", "source", "size", "source_size", "target"]
    names = [*map(F.col, names), F.col("taken").cast("long").alias("taken")]
    return even.select(names).union(uneven.select(names))


def _cuts(slots: DataFrame, epochs: int) -> DataFrame:
    """p_source, source_size, target, whole, cut: a row per source of `slots`.

    `whole` repetitions of each document are taken, one more below `cut.slot`, and there
    `cut.rest` words more; without a cut all documents are taken once more.
    """
    sources = slots.groupBy("source").agg(F.sum("words").alias("words"))
    # Whole repetitions, and the words that the sampled fraction adds.
    whole = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0)
    plan = (
        targets(default_weights(sources), epochs)
        .select(
            F.col("source").alias("p_source"),
            F.col("words").alias("source_size"),
            "target",
            whole.cast("long").alias("whole"),
        )
        .withColumn(
            "extra", F.round("target").cast("long") - F.col("whole") * F.col("source_size")
        )
    )
    by_slot = W.partitionBy("source").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    full = F.col("ahead") + F.col("words") <= F.col("extra")
    cut = F.struct("slot", (F.col("extra") - F.col("ahead")).alias("rest"))
    return (
        slots.withColumn("ahead", F.coalesce(F.sum("words").over(by_slot), F.lit(0)))
        .join(plan, F.col("source").eqNullSafe(F.col("p_source")))
        .groupBy("p_source", "source_size", "target", "whole")
        .agg(F.min(F.when(~full, cut)).alias("cut"))
    )


def mix(
    documents: DataFrame, epochs: int = EPOCHS, seed: int = 8, folder: str | None = None
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: a row per row of `documents`."""
    run = RunFolder(documents.sparkSession, folder)
    placed = place(documents.select("doc_id", "text", "source"), epochs, seed, run)
    return placed.select("keep.doc_id", "source", "size", "source_size", "target", "taken")


def mixed(
    documents: DataFrame, epochs: int = EPOCHS, seed: int = 8, folder: str | None = None
) -> DataFrame:
    """The mix itself, with the columns of `documents`: a row per repetition.

    The one document per source that is taken in part is cut after its last word taken;
    its words are then parted by single blanks. Documents without words are left out.
    """
    text, size, taken = F.col("keep.text"), F.col("size"), F.col("taken")
    run = RunFolder(documents.sparkSession, folder)
    rows = place(documents, epochs, seed, run).where("taken > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(taken / size).cast("int"))))
    rows = rows.withColumn("part", taken - (F.col("copy") - 1) * size)
    first = F.slice(F.regexp_extract_all(text, F.lit(WORD), 0), F.lit(1), F.col("part").cast("int"))
    cut = F.when(F.col("part") < size, F.array_join(first, " ")).otherwise(text)
    rows = rows.withColumn("cut", cut)
    return rows.select(
        *(
            F.col("cut").alias(c)
            if c == "text"
            else F.length("cut").cast(documents.schema[c].dataType).alias(c)
            if c == "n_chars"
            else F.col("keep")[c].alias(c)
            for c in documents.columns
        )
    )
