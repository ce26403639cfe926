"""Comparing the members of buckets in blocks, without a row for every pair."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.sources.workspace import RunFolder

BLOCK = 512


def tasks(members: DataFrame, sizes: DataFrame, keys: list[str], id: Column) -> DataFrame:
    """A row of `members` for every pair of blocks of its bucket that it takes part in.

    `sizes` has the number `n` of members by `keys`. A bucket of n members is cut into
    n / BLOCK blocks, and blocks i <= j meet in task (i, j): no task holds more than two
    blocks, however large a bucket is. Adds i, j and blk, the member's own block.
    """
    count = F.ceil(F.col("n") / BLOCK)
    return (
        members.join(sizes, keys)
        .withColumn("blk", F.pmod(F.xxhash64(id), count).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
        .withColumn("i", F.least("blk", "other"))
        .withColumn("j", F.greatest("blk", "other"))
        .drop("n", "other")
    )


def groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[dict]:
    """Columns of each run of rows with equal first `keys` columns; rows come sorted."""
    held: dict[str, list] = {}
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        # Texts and lists stay in Arrow until their group is complete.
        columns = [
            plain(c) if pa.types.is_primitive(c.type) else c for c in batch.columns
        ]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns[:keys]:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(c[start] for c in columns[:keys])
            if held and key != last:
                yield {n: joined(parts) for n, parts in held.items()}
                held = {}
            for n, c in zip(names, columns):
                held.setdefault(n, []).append(c[start:end])
            last = key
    if held:
        yield {n: joined(parts) for n, parts in held.items()}


def plain(column: pa.Array) -> np.ndarray | list:
    """Numbers as an array, texts as a list, lists as a list of arrays."""
    if pa.types.is_list(column.type):
        values, starts = flat(column)
        ends = starts.tolist()
        return [values[a:b] for a, b in zip(ends, ends[1:])]
    if pa.types.is_string(column.type):
        return column.to_pylist()
    return column.to_numpy(zero_copy_only=False)


def joined(parts: list) -> np.ndarray | list:
    if isinstance(parts[0], pa.Array):
        return [x for part in parts for x in plain(part)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def spread(items: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of one task together, tasks one after the other."""
    return items.repartition(*keys).sortWithinPartitions(*keys)


def flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and start offsets (one more than rows) of a list column."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return lists.flatten().to_numpy(zero_copy_only=False), starts


def overlaps(values: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Common elements of each set in `rows` with each set: a product of 0/1 matrices."""
    n = len(starts) - 1
    _, column, seen = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), np.diff(starts))
    shared = seen[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    out = np.zeros((len(rows), n), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 4096
    last = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, last, width):
        a, b = np.searchsorted(column, [low, low + width])
        matrix = np.zeros((n, width), np.float32)
        matrix[owner[a:b], column[a:b] - low] = 1
        out += matrix[rows] @ matrix.T
    return out


SMALL = 24
# Elements of sets, or characters, that are held as matrices at once.
HELD = 1_000_000


def _parts(sizes: list[int]) -> np.ndarray:
    """The number of each item's part; a part's sizes add up to about half of `HELD`."""
    return (np.cumsum(sizes) - sizes) // (HELD // 2)


def _compare(percent: int, to_set: Callable | None, to_hashes: Callable | None):
    def few(part, blk, payload, apart):
        """Pairs of a small group, one by one."""
        sets: dict[int, set] = {}
        done = set()
        for x in range(len(part)):
            for y in range(x):
                if part[x] == part[y] or (apart and blk[x] == blk[y]):
                    continue
                ends = (min(part[x], part[y]), max(part[x], part[y]))
                if ends in done:
                    continue
                for k in (x, y):
                    if k not in sets:
                        sets[k] = to_set(payload[k]) if to_set else set(payload[k].tolist())
                sizes = len(sets[x]), len(sets[y])
                if 100 * min(sizes) < percent * max(sizes):
                    continue
                common = len(sets[x] & sets[y])
                if 100 * common >= percent * (sum(sizes) - common):
                    done.add(ends)
                    yield x, y

    def many(part, blk, payload, apart):
        """Pairs of a large group by products of matrices, a bounded part of it at a time."""
        own = _parts([len(x) for x in payload])
        for low in range(own[-1] + 1):
            for high in range(low, own[-1] + 1):
                at = np.flatnonzero((own == low) | (own == high))
                sides = [own[at]] if high > low else []
                sides += [blk[at]] if apart else []
                found = block(part[at], [payload[k] for k in at], sides)
                yield from ((int(at[x]), int(at[y])) for x, y in found)

    def block(part, payload, sides):
        """Links between different parts, and between different values of all `sides`."""
        names, own, counts = np.unique(part, return_inverse=True, return_counts=True)
        if len(names) == 1:
            return
        # The most frequent component needs no comparing with itself.
        rows = np.flatnonzero(own != counts.argmax())
        if to_hashes:
            values, starts = to_hashes(payload)
        else:
            values = np.concatenate(payload)
            starts = np.concatenate([[0], np.cumsum([len(x) for x in payload])])
        sizes = np.diff(starts)
        common = overlaps(values, starts, rows)
        hit = 100 * common >= percent * (sizes[rows][:, None] + sizes[None] - common)
        hit &= part[rows][:, None] != part[None]
        for side in sides:
            hit &= side[rows][:, None] != side[None]
        a, b = np.nonzero(hit)
        a = rows[a]
        # One link for two components.
        ends = np.minimum(own[a], own[b]) * len(names) + np.maximum(own[a], own[b])
        _, first = np.unique(ends, return_index=True)
        yield from zip(a[first].tolist(), b[first].tolist())

    def run(batches):
        a, b = [], []
        for group in groups(batches, 3):
            part = group["part"]
            if (part == part[0]).all():
                continue
            i, j = (int(group[c][0]) for c in ("i", "j"))
            ids, blk, payload = group["id"], group["blk"], group["payload"]
            pairs = few if len(part) <= SMALL else many
            for x, y in pairs(part, blk, payload, i != j):
                a.append(int(ids[x])), b.append(int(ids[y]))
            if len(a) > 10_000:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _promising(least: int):
    """Rows whose `brief` agrees with that of another part at `least` places or more.

    What is left of a task is named by its members, so that equal tasks become equal rows.
    """
    names = ["v", "i", "j", "blk", "id"]

    def run(batches):
        kept, held = [], 0
        for group in groups(batches, 3):
            part, blk, ids = group["part"], group["blk"], group["id"]
            if (part == part[0]).all():
                continue
            agree = np.zeros((len(part), len(part)), np.uint8)
            for place in np.stack(group["brief"]).T:
                agree += place[:, None] == place
            hit = (agree >= least) & (part[:, None] != part)
            if apart := group["i"][0] != group["j"][0]:
                hit &= blk[:, None] != blk
            at = np.flatnonzero(hit.any(axis=1))
            if not len(at):
                continue
            at = at[np.argsort(ids[at])]
            name = xxhash.xxh64_intdigest(ids[at].tobytes() + blk[at].tobytes()) - 2**63
            shape = np.ones(len(at), np.int32)
            kept.append([shape.astype(np.int64) * name, 0 * shape, apart * shape, blk[at], ids[at]])
            held += len(at)
            if held > 10_000:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*kept)], names)
                kept, held = [], 0
        if kept:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*kept)], names)

    return run


def lists_of(narrow: DataFrame) -> DataFrame:
    """(v, n, main) of the lists `v` of `narrow` (id, part, v) that hold several parts.

    Of lists of the same members, one is given. `main` is the most frequent part with its number.
    """
    return (
        narrow.groupBy("v", "part")
        .agg(
            F.count("*").alias("own"),
            F.expr("bit_xor(xxhash64(id))").alias("x"),
            F.expr("bit_xor(xxhash64(id, 1))").alias("y"),
        )
        .groupBy("v")
        .agg(
            F.sum("own").alias("n"),
            F.count("*").alias("parts"),
            F.max(F.struct("own", "part")).alias("main"),
            F.expr("bit_xor(x)").alias("x"),
            F.expr("bit_xor(y)").alias("y"),
        )
        .where("parts > 1")
        .groupBy("n", "x", "y")
        .agg(F.min(F.struct("v", "main")).alias("one"))
        .select("one.v", "n", "one.main")
    )


def links_between(
    items: DataFrame,
    percent: int,
    run: RunFolder,
    name: str,
    to_set: Callable | None = None,
    to_hashes: Callable | None = None,
    least: int | None = None,
) -> DataFrame:
    """Links (a, b) that join different parts, found by exact comparison in blocks.

    `items` (id, part, coords, payload): `coords` are an item's different keys, `payload` the
    set's hashes, or something that `to_set` turns into a set, and `to_hashes`, for a list of
    them, into all hashes and the sets' start offsets. Items that share a key are compared,
    no pair of them is left out. Of keys that the same items share, as those of a group of
    near copies mostly are, one is worked on.

    With `least`, items also have a `brief` of up to 255 small numbers, and pairs whose briefs
    agree at fewer places are left out. They are looked at first, so that the payloads, which
    may be far larger, go only where there is something to compare.
    """
    narrow = items.select("id", "part", F.explode("coords").alias("v"))
    lists = lists_of(narrow)
    keys = ["v", "i", "j"]
    work = halves(narrow, lists)
    if least is not None:
        brief = items.select("id", "part", "brief").hint("merge")
        work = work.join(brief, "id").select(*keys, "blk", "id", "part", "brief")
        schema = "v long, i int, j int, blk int, id long"
        work = spread(work, keys).mapInArrow(_promising(least), schema).distinct()
    work = work.join(items.hint("merge"), "id").select(*keys, "blk", "id", "part", "payload")
    found = spread(work, keys).mapInArrow(_compare(percent, to_set, to_hashes), "a long, b long")
    return run.write(found, name)


def halves(narrow: DataFrame, lists: DataFrame) -> DataFrame:
    """A row of `narrow` (id, part, v) for every pair of blocks in which it is compared.

    `lists` has the number `n` of members by `v` and `main`, their most frequent part with
    its number. Members of one part need no comparing, so in a list of more than `BLOCK` the
    main part's members lie in blocks that meet those of the others only: a large group that
    hangs together but for a few adds rows by these few, not by its size in blocks.
    """
    cut = F.col("n") > BLOCK
    other = F.col("part") != F.col("main.part")
    few = F.when(cut, F.ceil((F.col("n") - F.col("main.own")) / BLOCK)).otherwise(1).cast("int")
    rest = F.when(cut, F.ceil(F.col("main.own") / BLOCK)).otherwise(0).cast("int")
    at = F.xxhash64("id")
    placed = narrow.join(lists, "v").select(
        "v",
        "id",
        F.when(other | ~cut, F.pmod(at, few)).otherwise(few + F.pmod(at, rest)).cast("int").alias("blk"),
        # The blocks that this one meets: all of them, or those of the smaller parts.
        F.when(other & cut, few + rest).otherwise(few).alias("meets"),
    )
    placed = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("meets") - 1)))
    ends = F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j")
    return placed.select("v", *ends, "blk", "id")
