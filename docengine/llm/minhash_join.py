"""Near copies of documents by an inverted join over MinHash signature coordinates.

A signature has `COORDINATES` minima over a document's distinct word shingles. A document
is posted under its coordinate-value pairs; two documents that agree on at least `MATCHES`
coordinates are compared on their full shingle sets.

* Prefix: with pairs ordered rarest first, two signatures that agree on `MATCHES`
  coordinates share one of their first `COORDINATES - MATCHES + 1` pairs, so only these
  are posted. The long lists of very frequent pairs come last and are mostly not posted.
* Count: collisions of a list's documents with its first one are counted on their whole
  signatures, and pairs at or above the threshold are compared exactly.
* Skip: lists of one document are dropped before any document is moved, lists that lie in
  one component are not merged again; what is left is compared in blocks (`blocks`) by the
  same posted lists, so that no row stands for a pair of a large group. There the lower bits
  of the signatures are compared first, and sets go only where two agree at `LEAST` places;
  at similarity 0.8 a pair agrees at fewer with a chance below 1e-11.

At similarity 0.8 a pair agrees on fewer than 36 of 64 coordinates with a chance below
5e-6. Documents with equal shingle sets are one node throughout.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. Fewer words than a shingle has form
one shingle; no words or null text: empty set, linked with nothing; so is a row without
`doc_id`. Every row is judged by its own text: repeated rows get equal results. Other columns
are not read.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.batches import pieces
from docengine.llm.blocks import links_between
from docengine.llm.components import bucket_components
from docengine.sources.workspace import RunFolder

COORDINATES = 64
MATCHES = 36
LEAST = 24


def shingles(text: str | None, words: int) -> set[bytes]:
    """Distinct runs of `words` words; bytes.split() parts at exactly the six blanks."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return set()
    if len(found) < words:
        return {b" ".join(found)}
    return set(map(b" ".join, zip(*(found[i:] for i in range(words)))))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    return np.unique(
        np.fromiter(map(xxhash.xxh64_intdigest, shingles(text, words)), np.uint64)
    )


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of `COORDINATES` minima per set; the sets are not empty."""
    odd = np.random.default_rng(4).integers(0, 2**63, COORDINATES, np.uint64) * 2 + 1
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDINATES), np.uint64)
    for i, factor in enumerate(odd):
        mixed = values * factor
        mixed ^= mixed >> np.uint64(31)
        mixed *= factor
        out[:, i] = np.minimum.reduceat(mixed, starts)
    return out.view(np.int32)[:, 1::2]  # upper halves


SIGNED = "doc_id long, n_shingles long, digest binary, signature array<int>"


def _sign(words: int):
    def run(batches):
        for ids, texts in pieces(batches):
            sets = [shingle_hashes(t, words) for t in texts]
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full).tolist() if full else ())
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                    pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int32())),
                ],
                ["doc_id", "n_shingles", "digest", "signature"],
            )

    return run


def _sets(words: int):
    def run(batches):
        for ids, texts in pieces(batches):
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(
                        [shingle_hashes(t, words).view(np.int64) for t in texts],
                        pa.list_(pa.int64()),
                    ),
                ],
                ["id", "hashes"],
            )

    return run


def postings(classes: DataFrame) -> DataFrame:
    """(key, id): each document under the rarest pairs of its signature (its prefix)."""
    pairs = classes.select("id", F.posexplode("signature").alias("at", "v")).select(
        "id", F.xxhash64("at", "v").alias("key")
    )
    lists = pairs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    own = (
        pairs.join(lists, "key")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("own"))
    )
    # Pairs that no other document has come first in the order and need no list.
    alone = COORDINATES - F.size("own")
    posted = F.greatest(F.lit(0), COORDINATES - MATCHES + 1 - alone)
    return own.select("id", F.explode(F.slice("own", F.lit(1), posted)).alias("p")).select(
        F.col("p.key").alias("key"), "id"
    )


def near_copies(
    documents: DataFrame, words: int = 5, percent: int = 80, folder: str | None = None
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per row of `documents`.

    Links documents whose shingle sets A and B have 100 * |A and B| >= percent * |A or B|;
    component_id is the smallest doc_id reachable, kept tells the document that stays.
    `MATCHES` is set for 80 percent and more; lower values would lose pairs.
    """
    if percent < 80:
        raise ValueError("the signature settings hold for 80 percent and more")
    run = RunFolder(documents.sparkSession, folder)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = run.write(texts.mapInArrow(_sign(words), SIGNED), "signed")
    classes = run.write(
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature")),
        "classes",
    )

    posted = run.write(postings(classes), "posted")

    # Sides whose size follows the corpus are merged, never broadcast, at any size.
    def sets_of(ids: DataFrame, name: str) -> DataFrame:
        wanted = ids.toDF("doc_id").distinct().hint("merge")
        sets = texts.join(wanted, "doc_id", "left_semi").mapInArrow(
            _sets(words), "id long, hashes array<long>"
        )
        return run.write(sets, f"{name}-sets")

    def both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        x, y = (table.select(F.col("id").alias(e), F.col(column).alias(n)) for e, n in ("ax", "by"))
        return pairs.hint("merge").join(x, "a").hint("merge").join(y, "b")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        agree = F.size(F.filter(F.arrays_zip("x", "y"), lambda p: p["x"] == p["y"]))
        counted = run.write(
            both(pairs, classes, "signature").where(agree >= MATCHES).select("a", "b").distinct(),
            f"{name}-counted",
        )
        sets = sets_of(counted.select("a").union(counted.select("b")), name)
        common = F.col("common")
        linked = (
            both(counted, sets, "hashes")
            .withColumn("common", F.size(F.array_intersect("x", "y")))
            .where(100 * common >= percent * (F.size("x") + F.size("y") - common))
            .select("a", "b")
            .distinct()
        )
        edges = run.write(linked, f"{name}-edges")
        run.drop(f"{name}-counted", f"{name}-sets")
        return edges

    def finish(ids: DataFrame, name: str) -> DataFrame:
        # All lists of the prefix, at most COORDINATES - MATCHES + 1 per document.
        prefix = (
            posted.join(ids.select("id").hint("merge"), "id", "left_semi")
            .groupBy("id")
            .agg(F.collect_set("key").alias("coords"))
        )
        low = F.transform("signature", lambda x: x.bitwiseAND(127).cast("byte"))
        items = (
            ids.join(sets_of(ids.select("id"), name).hint("merge"), "id")
            .join(prefix.hint("merge"), "id")
            .join(classes.select("id", low.alias("brief")).hint("merge"), "id")
            .select("id", "part", "coords", "brief", F.col("hashes").alias("payload"))
        )
        items = run.write(items, f"{name}-items")
        edges = links_between(items, percent, run, f"{name}-edges", least=LEAST)
        run.drop(f"{name}-sets", f"{name}-items")
        return edges

    parts = bucket_components(posted, confirm, finish, run, "near")
    run.drop("posted")
    reps = classes.join(parts, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component")
    )
    component = F.coalesce("component", "doc_id")
    return (
        signed.join(reps, "digest", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
