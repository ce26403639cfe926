"""Near copies of vectors: signs against random hyperplanes, exact cosine, components.

A table's key is the signs of a vector's products with `k` random hyperplanes; vectors of
one label and length that share a key in any of `L` tables are compared by their cosine in
double precision. `k` grows with the logarithm of the number of vectors, which keeps the
keys' groups small, and `L` with it, so that a pair at the threshold shares no key with a
chance of at most `MISS`. Equal vectors are one node; groups are compared in blocks by
matrix products, a pair in its first common table only, and hand on a count per vector and
a spanning star, never a row per pair.

Defined cases: a vector without label, with null or non-finite components, empty, zero or
null links with nothing; so does a row without id. Vectors of different lengths have no
cosine. Equal rows are one vector; different vectors under one id are linked each on its own.
Only the id, vector and label columns are read.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.blocks import groups, plain, spread, tasks
from docengine.llm.components import components
from docengine.sources.workspace import RunFolder

MISS = 1e-8
LEAST_BITS = 14


def settings(vectors: int, cosine: float) -> tuple[int, int]:
    """Bits per key and number of tables."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(vectors, 2))) - 4)
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-same))


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision with length one; safe for huge values."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _keys(bits: int, tables: int, seed: int):
    weights = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        planes = {}
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("vector"))
            for size in pa.compute.unique(sizes).to_pylist():
                part = batch.filter(pa.compute.equal(sizes, size))
                if size not in planes:
                    random = np.random.default_rng([seed, size])
                    planes[size] = random.standard_normal((size, bits * tables))
                signs = (_unit(np.array(plain(part.column("vector")))) @ planes[size]) >= 0
                codes = signs.reshape(part.num_rows, tables, bits) @ weights
                ends = pa.array(np.arange(part.num_rows + 1) * tables, pa.int32())
                keys = pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))
                yield pa.record_batch([*part.columns, keys], [*part.schema.names, "keys"])

    return run


def _compare(cosine: float):
    def run(batches):
        for group in groups(batches, 6):
            at, i, j = (int(group[c][0]) for c in ("at", "i", "j"))
            ids, copies, blk = (group[c] for c in ("id", "copies", "blk"))
            unit = _unit(np.array(group["vector"]))
            hit = np.triu(unit @ unit.T >= cosine, 1)
            if i != j:
                hit &= blk[:, None] != blk[None]
            a, b = np.nonzero(hit)
            if not len(a):
                continue
            keys = np.array(group["keys"])
            for before in range(at):  # compared there
                fresh = keys[a, before] != keys[b, before]
                a, b = a[fresh], b[fresh]
            links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
            root = np.arange(len(ids))
            while True:  # every vector takes the smallest root among its links
                low = root.copy()
                np.minimum.at(low, a, root[b])
                np.minimum.at(low, b, root[a])
                low = low[low]
                if (low == root).all():
                    break
                root = low
            some = np.flatnonzero(links)
            yield pa.record_batch(
                [
                    pa.array(ids[some]),
                    pa.array(links[some].astype(np.int64)),
                    pa.array(ids[root[some]]),
                ],
                ["id", "links", "root"],
            )

    return run


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    seed: int = 1,
    folder: str | None = None,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per distinct row of `vectors`.

    `vectors` has vec_id, embedding and label. Links join vectors of one label with a
    cosine of at least `cosine`; n_links counts the others linked directly, component_id is
    the smallest vec_id reachable, kept tells the vector that stays.
    """
    run = RunFolder(vectors.sparkSession, folder)
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    usable = F.coalesce(
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & finite
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(
        "vec_id",
        F.when(usable, F.xxhash64(F.lit(1), "label", "embedding")).alias("h1"),
        F.when(usable, F.xxhash64(F.lit(2), "embedding", "label")).alias("h2"),
        "label",
        "embedding",
    )
    classes = run.write(
        rows.where("h1 is not null")
        .groupBy("h1", "h2")
        .agg(
            F.min("vec_id").alias("vec"),
            F.countDistinct("vec_id").alias("copies"),
            F.first("label").alias("label"),
            F.first("embedding").alias("vector"),
        )
        # A node's number is its own, as different vectors may share a vec_id.
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    bits, tables = settings(classes.count(), cosine)
    nodes = classes.select("id", "copies", "label", F.size("vector").alias("dim"), "vector")
    keyed = run.write(
        nodes.mapInArrow(_keys(bits, tables, seed), f"{_ddl(nodes)}, keys array<long>"), "keyed"
    )
    narrow = keyed.select("id", "label", "dim", F.posexplode("keys").alias("at", "v"))
    bucket = ["label", "dim", "at", "v"]
    sizes = narrow.groupBy(bucket).agg(F.count("*").alias("n")).where("n > 1")
    keys = [*bucket, "i", "j"]
    work = tasks(narrow, sizes, bucket, F.col("id")).select(*keys, "blk", "id")
    work = work.join(keyed.select("id", "copies", "vector", "keys").hint("merge"), "id")
    work = spread(work.select(*keys, "blk", "id", "copies", "vector", "keys"), keys)
    linked = run.write(
        work.mapInArrow(_compare(cosine), "id long, links long, root long"), "linked"
    )
    run.drop("keyed")
    degree = linked.groupBy("id").agg(F.sum("links").alias("links"))
    edges = linked.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    parts = run.write(components(edges, run, "cc"), "parts")
    placed = (
        classes.select("h1", "h2", "id", "vec", "copies")
        .join(parts, "id", "left")
        .withColumn("root", F.coalesce("component", "id"))
    )
    least = placed.groupBy("root").agg(F.min("vec").alias("component_id"))
    known = (
        placed.join(degree, "id", "left")
        .join(least, "root")
        .select(
            "h1",
            "h2",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "component_id",
        )
    )
    return (
        rows.select("vec_id", "h1", "h2")
        .distinct()
        .join(known, ["h1", "h2"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
