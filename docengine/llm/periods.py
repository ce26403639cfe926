"""Periodic runs of words, found with a dictionary of basic factors.

Every stretch of 2^k words has a name; equal stretches of one document have equal names, and
the names of one length follow from pairs of names of half that length. A run with smallest
period q repeats each of its stretches of length L = 2^k, L <= q < 2L, q words further on. So
each occurrence looks at the next ones less than 2L away. Those at most L/2 apart form an
arithmetic progression, whose difference is a period of the stretch itself: of a progression
after (or before) its own an occurrence takes the first member only, which is enough for
every run to be proposed (a run starts inside, before or at the first word of the
progressions that it joins). Proposals are extended to both sides by names, from long ones to
short, and those of one start and end are one run, with the least period.

Documents are worked on in pieces of bounded size, all documents of a piece at once; a longer
text is a piece of its own, its names taking 4 bytes per word and length that repeats.

Defined cases: null, empty and blank texts have no words and no run, their collapsed text is
empty; rows that share a doc_id, or have none, are documents of their own, a row each; ties
between runs are kept, runs may overlap; only doc_id and text are read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.text import let
from docengine.llm.batches import pieces

CHARACTERS = 1_000_000
LEAST = 12
SPACE = r"[\x20\x09-\x0D]+"


def _named(keys: np.ndarray, at: np.ndarray, size: int):
    """Names by position, and the positions of repeated names, by name, then position.

    A stretch that occurs once has a name of its own below zero.
    """
    names = -1 - np.arange(size, dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    name = np.cumsum(np.append(0, keys[1:] != keys[:-1])) if len(keys) else keys
    again = np.bincount(name)[name] > 1 if len(keys) else np.zeros(0, bool)
    at, name = at[again], name[again]
    names[at] = name
    return names, at, name


def _proposed(at: np.ndarray, name: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods, at least `length` and below twice that, that repeats propose."""
    fresh = np.append(True, (name[1:] != name[:-1]) | (2 * (at[1:] - at[:-1]) > length))
    part = np.cumsum(fresh) - 1
    first, kind = at[fresh], name[fresh]
    starts, periods = [], []
    # Progressions begin more than half a length apart, so the third is the last in reach.
    for step in (-3, -2, -1, 1, 2, 3):
        other = part + step
        inside = (other >= 0) & (other < len(first))
        here, other = at[inside], other[inside]
        near = kind[other] == name[inside]
        here, other = here[near], first[other[near]]
        period = np.abs(other - here)
        near = (period >= length) & (period < 2 * length)
        starts.append(np.minimum(here, other)[near])
        periods.append(period[near])
    start, period = np.concatenate(starts), np.concatenate(periods)
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    # Neighbouring starts of one period extend to the same run.
    fresh = np.append(True, (period[1:] != period[:-1]) | (start[1:] - start[:-1] > 1))
    return start[fresh[: len(start)]], period[fresh[: len(start)]]


def runs(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all runs in a sequence of numbers, by start, then period.

    A run is a stretch with smallest period q, at least `least` and 2 * q long, which no
    neighbour extends with that period.
    """
    size = len(words)
    levels, proposals = [], []
    keys, at, length = words, np.arange(size), 1
    while True:
        names, repeated, name = _named(keys, at, size)
        if not len(repeated):
            break
        levels.append(names.astype(np.int32))
        proposals.append(_proposed(repeated, name, length))
        # A longer stretch can only repeat where both of its halves do.
        at = repeated[repeated + length < size]
        at = np.sort(at[names[np.minimum(at + length, size - 1)] >= 0])
        keys = names[at] * size + names[at + length]
        length *= 2
    if not levels:
        return np.zeros((0, 3), np.int64)
    start = np.concatenate([p[0] for p in proposals])
    period = np.concatenate([p[1] for p in proposals])
    low, high = start.copy(), start.copy()
    for level in range(len(levels) - 1, -1, -1):
        names, length = levels[level], 1 << level
        fits = high + period < size
        fits[fits] = names[high[fits]] == names[(high + period)[fits]]
        high[fits] += length
        fits = low >= length
        fits[fits] = names[low[fits] - length] == names[(low + period)[fits] - length]
        low[fits] -= length
    high += period
    whole = high - low >= np.maximum(least, 2 * period)
    low, high, period = low[whole], high[whole], period[whole]
    order = np.lexsort((period, high, low))
    low, high, period = low[order], high[order], period[order]
    fresh = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))[: len(low)]
    low, high, period = low[fresh], high[fresh], period[fresh]
    order = np.lexsort((period, low))
    return np.stack([low, high - low, period], 1)[order]


def _documents(texts: list, least: int) -> tuple[list[int], np.ndarray, list[bytes], np.ndarray]:
    """Words, runs, collapsed text and number of runs of each text."""
    split = [(t or "").encode().split() for t in texts]
    counts = [len(w) for w in split]
    numbers: dict[bytes, int] = {}
    # A mark of its own between two texts; words of different texts have different numbers.
    ends = np.cumsum([c + 1 for c in counts])
    text_of = np.repeat(np.arange(len(split)), [c + 1 for c in counts])
    flat = np.fromiter(
        (n for words in split for n in (*[numbers.setdefault(w, len(numbers)) for w in words], -1)),
        np.int64,
        int(ends[-1]) if len(ends) else 0,
    )
    flat = np.where(flat < 0, len(numbers), flat) + text_of * (len(numbers) + 1)
    found = runs(flat, least)
    owner = text_of[found[:, 0]]
    drop = np.zeros(len(flat) + 1, np.int64)
    np.add.at(drop, found[:, 0] + found[:, 2], 1)
    np.add.at(drop, found[:, 0] + found[:, 1], -1)
    keep = np.cumsum(drop) == 0
    begin = ends - [c + 1 for c in counts]
    found[:, 0] -= begin[owner]
    per_text = np.bincount(owner, minlength=len(split))
    collapsed = [
        b" ".join([words[k] for k in np.flatnonzero(keep[b : b + len(words)])] if some else words)
        for words, b, some in zip(split, begin.tolist(), per_text.tolist())
    ]
    return counts, found, collapsed, per_text


def _scan(least: int):
    def run(batches):
        for ids, texts in pieces(batches, CHARACTERS):
            counts, found, collapsed, per_text = _documents(texts, least)
            columns = [pa.array(found[:, k], pa.int64()) for k in range(3)]
            ends = pa.array(np.append(0, np.cumsum(per_text)), pa.int32())
            listed = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(ends, listed),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


RUNS = (
    "doc_id long, n_words long, "
    "runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


def periodic_runs(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """`RUNS` of each row: all runs by start, then period, and the text without repeats.

    `collapsed` is the words that lie in no run after that run's first period, joined by one
    space. Runs are at least `least` words long and have at least two periods.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scan(least), RUNS)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """Doc_id and text, where every tenth text, by the checksum of its id, ends in a run.

    With h = crc32(decimal doc_id) and g = floor(h / 10), a text with h % 10 = 0 and n > 0 words
    has original word a + (i - a) % p at each place i >= a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def ending(words: Column, a: Column, p: Column) -> Column:
        placed = F.transform(
            words, lambda w, i: F.when(i >= a, F.get(words, (a + (i - a) % p).cast("int"))).otherwise(w)
        )
        return F.array_join(placed, " ")

    def planted(words: Column) -> Column:
        n = F.size(words)
        return let(
            g % F.greatest(n, F.lit(1)),
            lambda a: let(1 + F.floor((n - a) / (3 + g % 8)), lambda p: ending(words, a, p)),
        )

    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    text = F.when(h % 10 == 0, let(words, planted)).otherwise(F.col("text"))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """A row per document: its longest run (ties: smallest start, then period) and digests."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ranked = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"]))
    )
    return (
        found.withColumn("_longest", ranked)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            F.col("_longest.start").alias("start"),
            (-F.col("_longest.l")).alias("length"),
            F.col("_longest.period").alias("period"),
            F.floor(-1000 * F.col("_longest.l") / F.col("_longest.period")).alias("exponent_milli"),
            F.sha2(
                F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256
            ).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
