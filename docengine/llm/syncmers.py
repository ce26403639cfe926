"""Document fingerprints from closed syncmers (SQL only).

A text is a row of tokens: its words, words of more than `TOKEN` characters cut. With a
lead of empty tokens, every token ends a run of `K` tokens; a run is an anchor if the
smallest of its inner runs of `S` tokens, by hash, lies at one of its two edges. That
depends on the run alone, so equal passages have equal anchors wherever they stand. About
two in K - S + 1 runs are anchors, at least one in K - S runs that follow each other.

The fingerprint has the anchors in the order of the text, each as `DIGITS` hex digits of its
hash and one of its distance in tokens from the anchor before (the first: from the text's
start). Two fingerprints are matched by position: of the anchors that both hold, each at its
first place, the longest chain that stands in the same order in both counts, and likeness is
that chain over all different anchors of the two. The same passages in another order are
less alike than in the same one. Matching uses what the fingerprint holds, nothing else.

Defined cases: null text is empty; an empty text has an empty fingerprint, and two empty
ones are alike; a text none of whose runs is an anchor has its whole as the only one, with
distance 0. The next document is the one with the next smaller doc_id, after the smallest
the largest; rows that share a doc_id follow each other; rows without one have no next, as
if it were empty. Only doc_id and text are read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TOKEN = 8
K = 7
S = 2
DIGITS = 10
BUCKET_ROWS = 2048
CUTS = 1024  # quantiles of the ids
BROADCAST_ROWS = 65536


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the array of marks of the anchors of column `text`, in its order."""
    words = F.regexp_extract_all(F.col(text), F.lit(rf"\S{{1,{TOKEN}}}"), 0)
    lead = F.array_repeat(F.lit(0).cast("long"), K - 1)
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    df = df.withColumn("_h", F.concat(lead, hashed)).withColumn("_n", F.size("_h"))
    inner = F.transform(
        F.sequence(F.lit(0), F.col("_n") - S),
        lambda i: F.xxhash64(*(F.get("_h", i + k) for k in range(S))),
    )
    df = df.withColumn("_s", inner)
    span = K - S
    runs = F.filter(
        F.sequence(F.lit(0), F.col("_n") - K),
        lambda i: F.least(F.get("_s", i), F.get("_s", i + span))
        <= F.least(*(F.get("_s", i + k) for k in range(1, span))),
    )
    df = df.withColumn("_r", runs)
    marks = F.transform(
        F.col("_r"),
        lambda i, at: _mark(
            F.xxhash64(F.slice("_h", i + 1, K)), i - F.coalesce(F.get("_r", at - 1), F.lit(-1))
        ),
    )
    df = df.withColumn(out, F.when(F.col("_n") >= K, marks))
    none = F.array().cast("array<long>")
    alone = F.array(_mark(F.xxhash64("_h"), F.lit(0)))
    whole = F.when(F.col("_n") >= K, alone).otherwise(none)
    found = F.when(F.size(out) > 0, F.col(out)).otherwise(whole)
    return df.withColumn(out, found).drop("_h", "_n", "_s", "_r")


def _mark(anchor: Column, distance: Column) -> Column:
    """The first `DIGITS` hex digits of a hash, then one of the distance."""
    return F.shiftleft(F.shiftrightunsigned(anchor, 64 - 4 * DIGITS), 4) + distance


def fingerprint(marks: Column) -> Column:
    shown = F.transform(marks, lambda x: F.lpad(F.lower(F.hex(x)), DIGITS + 1, "0"))
    return F.array_join(shown, "")


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds the likeness of two columns of marks: the longest common chain over all anchors.

    Common anchors fall into segments that stand together in both texts. A chain has a
    segment as a whole or not at all, so the heaviest chain of segments is the longest one.
    """
    for side, name in ((a, "_x"), (b, "_y")):
        own = F.transform(side, lambda x: F.shiftrightunsigned(x, 4))
        df = df.withColumn(name, F.array_distinct(own))
    df = df.withColumn("_p", F.array_intersect("_x", "_y"))
    df = df.withColumn("_q", F.array_intersect("_y", "_x"))

    def numbered(c: str) -> Column:
        return F.sort_array(F.transform(c, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))

    # Places in b of the common anchors, in a's order; none where the order is the same.
    places = F.sort_array(
        F.zip_with(
            numbered("_p"), numbered("_q"), lambda s, t: F.struct(s["i"].alias("s"), t["i"].alias("t"))
        )
    )
    moved = F.col("_p") != F.col("_q")
    df = df.withColumn("_t", F.when(moved, F.transform(places, lambda s: s["t"])))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_t") - 1),
        lambda i: (i == 0) | (F.get("_t", i) != F.get("_t", i - 1) + 1),
    )
    df = df.withColumn("_s", F.when(moved, starts))
    segments = F.transform(
        F.col("_s"),
        lambda i, k: F.struct(
            F.get("_t", i).alias("low"),
            (F.coalesce(F.get("_s", k + 1), F.size("_t")) - i).alias("n"),
        ),
    )

    def longer(chains: Column, segment: Column) -> Column:
        """Chains by their end, without those that another beats in end and length."""
        before = F.filter(chains, lambda c: c["end"] < segment["low"])
        length = F.coalesce(F.array_max(F.transform(before, lambda c: c["n"])), F.lit(0))
        new = F.struct(
            (segment["low"] + segment["n"] - 1).alias("end"), (length + segment["n"]).alias("n")
        )
        return F.transform(
            F.array(new),
            lambda w: F.when(
                F.exists(chains, lambda c: (c["end"] <= w["end"]) & (c["n"] >= w["n"])), chains
            ).otherwise(
                F.concat(
                    F.filter(chains, lambda c: (c["end"] < w["end"]) | (c["n"] > w["n"])), F.array(w)
                )
            ),
        )[0]

    none = F.array().cast("array<struct<end:int,n:int>>")
    chain = F.aggregate(
        segments, none, longer, lambda chains: F.array_max(F.transform(chains, lambda c: c["n"]))
    )
    df = df.withColumn("_c", F.when(moved, chain).otherwise(F.size("_p")))
    every = F.size("_x") + F.size("_y") - F.col("_c")
    alike = F.when(every == 0, F.lit(1.0)).otherwise(F.col("_c") / every)
    return df.withColumn(out, alike).drop("_x", "_y", "_p", "_q", "_t", "_s", "_c")


def id_range(cuts: list[int], high: int, parts: int) -> Column:
    """The number of the range that doc_id lies in: a span between cuts, or a part of it."""
    step = 32
    rows = [cuts[k : k + step] for k in range(0, len(cuts), step)]

    def known(values: list[int]) -> str:
        return f"array({', '.join(f'bigint({v})' for v in values)})"

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= F.col("doc_id")))

    row = passed(F.expr(known([r[0] for r in rows]))) - 1
    at = row * step + passed(F.get(F.expr(f"array({', '.join(map(known, rows))})"), row)) - 1
    if parts == 1:
        return at.cast("long")
    low = F.get(F.expr(known(cuts)), at).cast("double")
    end = F.get(F.expr(known([*cuts[1:], high])), at).cast("double")
    part = F.floor((F.col("doc_id").cast("double") - low) / (end - low + 1) * parts)
    return (at * parts + F.least(part, F.lit(parts - 1))).cast("long")


def with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds next_<column> of the next smaller doc_id; after the smallest comes the largest.

    Ids are cut into ranges by their quantiles, so that far ids do not widen them, each
    ordered by itself; the largest document of a range is also handed to the next range
    above, as its end. The list of largest ids is sent to every executor while it has
    `BROADCAST_ROWS` at most, else it is merged. Rows without an id are dealt by their text.
    """
    rows = df.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    spans = min(buckets, CUTS)
    shares = [k / spans for k in range(spans)]
    low, high, cuts = df.agg(
        F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", shares, 10 * CUTS)
    ).first()
    cuts = sorted({low, *cuts}) if cuts else [0]
    df = df.withColumn("_b", id_range(cuts, high or 0, -(-buckets // spans)))
    df = df.withColumn("_b", F.when(F.col("doc_id").isNotNull(), F.col("_b")))
    dealt = F.pmod(F.xxhash64(columns[0]), F.lit(buckets))
    df = df.withColumn("_k", F.when(F.col("doc_id").isNull(), dealt))
    tops = df.where("doc_id is not null").groupBy("_b").agg(F.max("doc_id").alias("top"))
    above = F.lead("_b").over(W.orderBy("_b"))
    lowest = F.min("_b").over(W.partitionBy())
    ends = tops.select(F.col("top").alias("_top"), F.coalesce(above, lowest).alias("_to"))
    homes = F.array(F.struct(F.col("_b").alias("b"), F.lit(False).alias("end")))
    end = F.array(F.struct(F.col("_to").alias("b"), F.lit(True).alias("end")))
    homes = F.when(F.col("_to").isNull(), homes).otherwise(F.concat(homes, end))
    ends = F.broadcast(ends) if buckets <= BROADCAST_ROWS else ends.hint("merge")
    placed = (
        df.join(ends, F.col("doc_id") == F.col("_top"), "left")
        .withColumn("_at", F.explode(homes))
        .withColumn("_b", F.col("_at.b"))
        .withColumn("_end", F.col("_at.end"))
    )
    order = W.partitionBy("_b", "_k").orderBy("_end", F.col("doc_id").desc(), columns[0])
    for c in columns:
        placed = placed.withColumn(f"next_{c}", F.lead(c).over(order))
        placed = placed.withColumn(f"next_{c}", F.when(F.col("doc_id").isNotNull(), F.col(f"next_{c}")))
    return placed.where("not _end").drop("_b", "_k", "_to", "_top", "_at", "_end")


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next per row.

    The edited text has its last third (of code points) replaced by the first as many of
    the next document, or all of them.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = with_next(with_anchors(rows, "text", "anchors"), ["text", "anchors"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn(
        "edited",
        F.concat(
            F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third),
            F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third),
        ),
    ).drop("text", "next_text")
    rows = with_anchors(rows, "edited", "edited_anchors")
    empty = F.array().cast("array<long>")
    rows = rows.withColumn("next_anchors", F.coalesce("next_anchors", empty))
    rows = with_likeness(rows, "anchors", "edited_anchors", "near_edited")
    rows = with_likeness(rows, "anchors", "next_anchors", "near_next")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
