"""Distributed connected components, and links inside buckets without all their pairs."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.sources.workspace import RunFolder


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(
        edges.agg(
            F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u))")
        ).first()
    )


def components(edges: DataFrame, run: RunFolder, name: str) -> DataFrame:
    """(id, component): smallest id reachable over `edges` (a, b), for ids that have one.

    Alternates large and small stars: every node hands its larger, then its smaller
    neighbours the smallest neighbour, until each node points at its component's minimum.
    A round is a minimum per node (reduced before the shuffle) and a join whose one side
    has one row per node, so a node with many edges can be split. Rounds grow with the
    logarithm of the nodes; each is written, and the one before it dropped.
    """
    now = run.write(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        f"{name}-0",
    )
    mark, step = _mark(now), 0
    while True:
        low = (
            now.select(F.col("u").alias("n"), F.col("v").alias("m"))
            .union(now.select(F.col("v").alias("n"), F.col("v").alias("m")))
            .groupBy("n")
            .agg(F.min("m").alias("m"))
        )
        large = (
            now.join(low, now.v == low.n).select("u", F.col("m").alias("v")).distinct()
        )
        least = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = (
            large.join(least, large.u == least.n)
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select(F.col("n").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        step += 1
        now = run.write(small, f"{name}-{step}")
        run.drop(f"{name}-{step - 1}")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    # A minimum has no edge of its own: it is the component of those that point at it.
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )


def bucket_components(
    members: DataFrame,
    confirm: Callable[[DataFrame, str], DataFrame],
    finish: Callable[[DataFrame, str], DataFrame],
    run: RunFolder,
    name: str,
) -> DataFrame:
    """(id, component) of ids that share a bucket and are linked.

    `members` (key, id) is a written table without repeated rows; it may have the `head` of
    each key, one of its ids, and its `size`, 3 or more if it has more than two, and rows may
    come again then. First every id is tried with its bucket's head, a row per member: `confirm(pairs, name)` turns distinct
    pairs (a, b) into written links, which joins a group of copies without its pairs. What
    can still be linked are ids of one bucket in different components: `finish(ids, name)`
    gets these ids with their component so far (id, part) and writes the links that join
    different parts.
    """
    shared = members
    if "head" not in members.columns:
        heads = run.write(
            members.groupBy("key")
            .agg(F.min("id").alias("head"), F.count("*").alias("size"))
            .where("size > 1"),
            f"{name}-heads",
        )
        shared = members.join(heads, "key")
    first = run.write(
        shared.where("id <> head")
        .select(F.col("head").alias("a"), F.col("id").alias("b"))
        .distinct(),
        f"{name}-first",
    )
    edges = confirm(first, f"{name}-c1")
    joined = run.write(components(edges, run, f"{name}-cc1"), f"{name}-joined")
    placed = (
        shared.where("size > 2")
        .join(joined, "id", "left")
        .select("key", "id", F.coalesce("component", "id").alias("part"))
    )
    mixed = (
        placed.groupBy("key")
        .agg(F.min("part").alias("low"), F.max("part").alias("high"))
        .where("low <> high")
        .select("key")
    )
    left = run.write(
        placed.join(mixed, "key", "left_semi").select("id", "part").distinct(), f"{name}-left"
    )
    run.drop(f"{name}-heads", f"{name}-first")
    if not left.take(1):
        return joined
    more = finish(left, f"{name}-c2")
    if not more.take(1):
        return joined
    done = components(edges.union(more), run, f"{name}-cc2")
    return run.write(done, f"{name}-done")
