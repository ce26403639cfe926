"""Many literal patterns in one text, found in a single pass over it.

Spark's functions search a text for one pattern at a time, from its start.  Where the patterns
of a text grow with it (the titles of a contents list, the names of many entities), that takes
their number times its length.  The functions here hand Arrow batches of texts, each with its
own patterns, to an automaton that finds all of them at once; a row never leaves its task.
"""

import sys
from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# These functions travel with the job, wherever the driver was started.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def places(text: str, patterns) -> dict[str, list[int]]:
    """Starts of every pattern that is not empty, rising, overlaps included."""
    import ahocorasick

    found: dict[str, list[int]] = {}
    machine = ahocorasick.Automaton()
    for pattern in patterns:
        if pattern and pattern not in found:
            found[pattern] = []
            machine.add_word(pattern, (len(pattern) - 1, found[pattern]))
    if found:
        machine.make_automaton()
        for end, (before, starts) in machine.iter(text):
            starts.append(end - before)
    return found


def between(text: str, starts: list[str], ends: list[str | None]) -> list[str | None]:
    """For each start mark the text from its first place to the next place of its end mark.

    Null without the mark; the rest of the text without an end mark or a place for it.  An
    empty start mark stands at the text's start.
    """
    found = places(text, [*starts, *ends])
    out: list[str | None] = []
    for start, end in zip(starts, ends):
        first = found.get(start, [0] if start == "" else [])
        if not first:
            out.append(None)
            continue
        stops = found.get(end, []) if end else []
        at = bisect_left(stops, first[0])
        out.append(text[first[0] : stops[at] if at < len(stops) else len(text)])
    return out


def first_holding(lines: list[str], parts: list[str]) -> list[int | None]:
    """Number of the first line that holds each part; the parts hold no line break."""
    found = places("\n".join(lines), parts)
    starts = list(accumulate((len(line) + 1 for line in lines), initial=0))
    out: list[int | None] = []
    for part in parts:
        at = found.get(part, [0] if lines and part == "" else [])
        out.append(bisect_right(starts, at[0]) - 1 if at else None)
    return out


def _folded_character(c: str) -> str:
    upper = c.upper()
    upper = upper if len(upper) == 1 else c
    return upper.lower()[0]


def folded(text: str) -> str:
    """Characters in the form in which their cases are equal, as many as before."""
    upper = text.upper()
    if len(upper) == len(text):
        lower = upper.lower()
        if len(lower) == len(text):
            return lower.replace("ς", "σ")
    return "".join(map(_folded_character, text))


def counts(text: str | None, names: list[str | None]) -> list[int]:
    """How often each name occurs without overlap, in any case; empty names never do."""
    wanted = [folded(n) if n else "" for n in names]
    found = places(folded(text), wanted) if text else {}
    number = {}
    for name, starts in found.items():
        free, number[name] = 0, 0
        for start in starts:
            if start >= free:
                number[name] += 1
                free = start + len(name)
    return [number.get(n, 0) for n in wanted]


def breaks(lengths: np.ndarray, limit: int) -> list[int]:
    """Numbers of the words that begin a new chunk of at most `limit` characters.

    The end of each chunk is looked up in the running sums.  A longer word is a chunk by
    itself; as the first one it follows an empty chunk.
    """
    upto = np.cumsum(lengths)
    out = [0] if len(lengths) and lengths[0] > limit else []
    at = 0
    while True:
        before = upto[at - 1] if at else 0
        at = max(int(np.searchsorted(upto, before + limit, side="right")), at + 1)
        if at >= len(lengths):
            return out
        out.append(at)


def chunks(words: list[str], limit: int) -> list[str]:
    """Words joined by spaces, cut before the word that would exceed the limit."""
    if not words:
        return []
    cuts = breaks(np.fromiter(map(len, words), np.int64, len(words)), limit)
    return [" ".join(words[lo:hi]) for lo, hi in zip([0, *cuts], [*cuts, len(words)])]


@F.arrow_udf(T.ArrayType(T.StringType()))
def _between(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    rows = zip(texts, starts, ends)
    return pa.array(
        (
            between(t.as_py(), s.as_py(), e.as_py()) if t.is_valid and s.is_valid else None
            for t, s, e in rows
        ),
        pa.list_(pa.string()),
    )


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _first_holding(lines: pa.Array, parts: pa.Array) -> pa.Array:
    rows = zip(lines, parts)
    return pa.array(
        (
            first_holding(t.as_py(), p.as_py()) if t.is_valid and p.is_valid else None
            for t, p in rows
        ),
        pa.list_(pa.int32()),
    )


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _counts(texts: pa.Array, names: pa.Array) -> pa.Array:
    rows = zip(texts, names)
    return pa.array(
        (counts(t.as_py(), n.as_py()) if n.is_valid else None for t, n in rows),
        pa.list_(pa.int32()),
    )


@F.arrow_udf(T.ArrayType(T.StringType()))
def _chunks(texts: pa.Array, limits: pa.Array) -> pa.Array:
    rows = zip(texts, limits)
    return pa.array(
        (chunks(t.as_py().split(), n.as_py()) if t.is_valid else None for t, n in rows),
        pa.list_(pa.string()),
    )


def texts_between(text: Column, starts: Column, ends: Column) -> Column:
    """`between` of a text and two lists of marks of one length."""
    return _between(text, starts, ends)


def first_lines(lines: Column, parts: Column) -> Column:
    """`first_holding` of a list of lines and a list of parts."""
    return _first_holding(lines, parts)


def count_each(text: Column, names: Column) -> Column:
    """`counts` of a list of names in a text."""
    return _counts(text, names)


def chunk_each(text: Column, limit: int) -> Column:
    """`chunks` of a text's words; null for null."""
    return _chunks(text, F.lit(limit))
