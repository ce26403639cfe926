"""Repeated passages by a sparse suffix array over words.

Suffixes are kept at minimiser positions only: where the hash of a run of `GRAM` words is
the smallest among `WINDOW` neighbouring runs. A run of GRAM + WINDOW - 1 = `LEAST` words keeps
the same position wherever it stands, so all its places meet at equal first GRAM words.
Suffixes that also agree in the `SIDE` words before and after are one from there on. Where
such neighbourhoods differ, the order of what follows alone can part two suffixes that share a
run, as can the order of what precedes. So the suffixes are ordered at each of the SIDE + 1
places where a run of LEAST words that keeps this position can start, by the digest of the run,
and equal neighbours match. The first and the last such place extend the match to the left and
right; matches of neighbouring positions overlap, so their union has the whole passage, however
long it is. Words are compared by two 64-bit digests each time.

Defined cases: words are parted by blanks, in any number; null or short texts have no
passage; repeats inside one document count; rows without doc_id are left out; rows that
share a doc_id and text repeat each other. Only doc_id and text are read.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docengine.llm.batches import pieces
from docengine.sources.workspace import RunFolder

GRAM = 20
WINDOW = 31
LEAST = 50
SIDE = LEAST - GRAM
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
KEPT = "doc_id long, pos int, first long, side long, l byte, r byte"
RUNS = "first long, side long, l int, run long"


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(FACTORS[1])
    return x ^ (x >> np.uint64(29))


class Codes(dict):
    """Hash of each word, taken once; one for each piece of a batch."""

    def __missing__(self, word: str) -> int:
        code = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return self.setdefault(word, code)


class Runs:
    """Hashes of runs of words, each from two sums over the words before."""

    def __init__(self, codes: np.ndarray, factor: int):
        codes = (codes ^ (codes >> np.uint64(29))) * np.uint64(factor)
        powers = np.full(len(codes) + 1, factor, np.uint64)
        self.back = np.full(len(codes) + 1, pow(factor, -1, 1 << 64), np.uint64)
        powers[0] = self.back[0] = 1
        self.back = np.cumprod(self.back)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * np.cumprod(powers)[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _stir((self.sums[end] - self.sums[start]) * self.back[start])


class Suffixes:
    """The kept suffixes of a text of `LEAST` words or more."""

    def __init__(self, words: list[str], codes: Codes):
        hashed = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        self.n = len(words)
        self.runs, self.sides = (Runs(hashed, f) for f in FACTORS)
        starts = np.arange(self.n - GRAM + 1)
        marks = self.runs.of(starts, starts + GRAM)
        windows = np.lib.stride_tricks.sliding_window_view(marks, WINDOW)
        # The position that each run of LEAST words keeps, which never falls.
        self.keeper = windows.argmin(axis=1) + starts[: len(windows)]
        self.marks = marks.view(np.int64)

    def kept(self) -> np.ndarray:
        return self.keeper[np.diff(self.keeper, prepend=-1) > 0]

    def around(self, at: np.ndarray) -> list[np.ndarray]:
        """first, side, l, r: the words from positions, around them, before and after."""
        start, end = np.maximum(at - SIDE, 0), np.minimum(at + LEAST, self.n)
        place = ((at - start) * LEAST + end - at).astype(np.uint64)
        side = _stir(self.sides.of(start, end) + place * np.uint64(FACTORS[0]))
        l, r = (at - start).astype(np.int8), (end - at - GRAM).astype(np.int8)
        return [self.marks[at], side.view(np.int64), l, r]

    def through(self, at: np.ndarray) -> list[np.ndarray]:
        """which, l, run: the runs of LEAST words that keep positions, l words before each."""
        low = np.searchsorted(self.keeper, at, "left")
        count = np.searchsorted(self.keeper, at, "right") - low
        which = np.repeat(np.arange(len(at)), count)
        start = np.arange(len(which)) - np.repeat(np.cumsum(count) - count - low, count)
        run = self.sides.of(start, start + LEAST).view(np.int64)
        return [which, (at[which] - start).astype(np.int32), run]


def _table(found: list[list[np.ndarray]], schema: str):
    if found:
        names = [c.split()[0] for c in schema.split(", ")]
        yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found)], names)


def _keep(batches):
    for ids, texts in pieces(batches):
        found, codes = [], Codes()
        for doc, text in zip(ids, texts):
            words = (text or "").split()
            if len(words) >= LEAST:
                own = Suffixes(words, codes)
                at = own.kept()
                found.append([np.full(len(at), doc), at.astype(np.int32), *own.around(at)])
        yield from _table(found, KEPT)


def _through(batches):
    for wanted, texts in pieces(batches):
        found, codes = [], Codes()
        for marks, text in zip(wanted, texts):
            words = (text or "").split()
            if len(words) < LEAST:
                continue
            own = Suffixes(words, codes)
            asked = np.array([(m["pos"], m["first"], m["side"]) for m in marks], np.int64)
            asked = asked[asked[:, 0] + GRAM <= len(words)]
            first, side, *_ = own.around(asked[:, 0])
            # Rows may share a doc_id: only positions that are this text's own.
            asked = asked[(first == asked[:, 1]) & (side == asked[:, 2])]
            which, l, run = own.through(asked[:, 0])
            found.append([asked[which, 1], asked[which, 2], l, run])
        yield from _table(found, RUNS)


def passages(documents: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, start, n_words: maximal runs of words that repeat, a row each."""
    run = RunFolder(documents.sparkSession, folder)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        "doc_id is not null"
    )
    kept = run.write(texts.mapInArrow(_keep, KEPT), "kept")
    same = run.write(
        kept.groupBy("first", "side").agg(
            F.count("*").alias("n"),
            F.min(F.struct("doc_id", "pos")).alias("one"),
            F.min("l").cast("int").alias("l"),
            F.min("r").cast("int").alias("r"),
        ),
        "same",
    )
    # Equal neighbourhoods: the common run is all of it, and one of them stands for all.
    whole = same.where("n > 1").select("first", "side", "l", "r")
    several = same.groupBy("first").agg(F.count("*").alias("sides")).where("sides > 1")
    differ = same.select("first", "side", "one").join(several.hint("merge"), "first")
    wanted = differ.groupBy(F.col("one.doc_id").alias("doc_id")).agg(
        F.collect_set(F.struct("one.pos", "first", "side")).alias("wanted")
    )
    # Texts are read again only where neighbourhoods of one run of words differ.
    through = texts.join(wanted.hint("merge"), "doc_id").select("wanted", "text")
    runs = run.write(through.mapInArrow(_through, RUNS), "runs")
    shared = runs.groupBy("first", "run").agg(F.min("side").alias("a"), F.max("side").alias("b"))
    shared = shared.where("a <> b").drop("a", "b")
    part = (
        runs.join(shared.hint("merge"), ["first", "run"])
        .groupBy("first", "side")
        .agg(F.max("l").alias("l"), (SIDE - F.min("l")).alias("r"))
    )
    found = run.write(whole.union(part), "found")
    run.drop("same", "runs")
    spans = (
        kept.select("doc_id", "pos", "first", "side")
        .join(found, ["first", "side"])
        .select(
            "doc_id",
            (F.col("pos") - F.col("l")).alias("start"),
            (F.col("pos") + GRAM + F.col("r")).alias("end"),
        )
        .distinct()
    )
    ahead = W.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(ahead.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    return (
        spans.withColumn("opens", opens)
        .withColumn("no", F.sum("opens").over(ahead))
        .groupBy("doc_id", "no")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select("doc_id", "start", (F.col("end") - F.col("start")).alias("n_words"))
    )
