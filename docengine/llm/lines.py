"""Near copies of lines: MinHash over character shingles, banded, checked, united.

Lines are compared without outer blanks and in lower case. A line is the set of its runs
of `SHINGLE` characters (a shorter line is one shingle). One hash per shingle fills `BANDS` x
`ROWS` bins with their minima, an empty bin takes the next filled one's. Hashes are
binned `PASSES` times, each time by another order. Lines that agree on one band are tried: at
similarity 0.8 a pair of long lines misses all bands with a chance of 6 in 10 million. Lines of
at most `SHORT` different shingles, where borrowed bins repeat, meet by their least hashes
instead, so many of them that no similar pair is missed; lines that can be similar to both
kinds have both. All tried pairs are compared on their whole shingle sets, links are united, and a component keeps its first line by (doc_id, line number).

Defined cases: blank lines are no lines and always stay; a row without doc_id or text has
no lines; rows that share doc_id and line number share the verdict. Only doc_id and text
are read.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.batches import pieces
from docengine.llm.blocks import links_between, lists_of, plain, spread
from docengine.llm.components import bucket_components
from docengine.sources.workspace import RunFolder

SHINGLE = 8
BANDS = 10
ROWS = 3
BINS = BANDS * ROWS
PASSES = 2
SHORT = BINS - 1
MIX = np.uint64(0x9E3779B97F4A7C15)
# Where each pass finds its order in a hash, whose halves are independent.
ORDERS = [np.uint64(0), np.uint64(32)]
# Odd factors of the rows of a band.
ROW_FACTORS = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
CACHED = 100_000
MARK = 512
WORDS = MARK // 64
MARKS = [f"s{k}" for k in range(WORDS)]


def comparable(line: str) -> str:
    return line.strip().lower()


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of each value (odd products are one-to-one)."""
    values = values ^ (values >> np.uint64(33))
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _distinct(values: np.ndarray) -> np.ndarray:
    """Different values in order; for numbers in any order a sort takes less than `np.unique`."""
    values = np.sort(values)
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh]


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, with repeats, and the lines' start offsets."""
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    text = "".join(padded)
    try:
        raw, above = np.frombuffer(text.encode("latin-1"), np.uint8), None
    except UnicodeEncodeError:
        above = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        raw = above.astype(np.uint8)
    # Below U+0100 a shingle is its eight bytes; what characters have above is added.
    codes = np.ndarray(len(raw) - SHINGLE + 1, "<u8", raw, strides=(1,)).astype(np.uint64)
    if above is not None:
        at = np.flatnonzero(above > 0xFF)
        above = (above[at] >> np.uint32(8)).astype(np.uint64)
        for back in range(SHINGLE):
            first, last = np.searchsorted(at, [back, back + len(codes)])
            codes[at[first:last] - back] += above[first:last] * np.uint64(pow(int(MIX), back + 1, 2**64))
    ends = np.cumsum(sizes)
    inside = np.ones(len(codes), bool)
    for back in range(1, SHINGLE):  # runs that reach into the next line
        at = ends[:-1] - back
        inside[at] = False
    return _mixed(codes[inside]), np.concatenate([[0], np.cumsum(sizes - SHINGLE + 1)])


def line_sets(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each line and their start offsets."""
    values, starts = shingle_hashes(lines)
    sets = [_distinct(values[a:b]) for a, b in zip(starts, starts[1:])]
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def line_marks(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of different shingles of each line, and its mark of `MARK` bits as `WORDS` numbers.

    A bit tells whether the number of hashes that fall on it is odd. Two marks differ in no more
    bits than the two lines have shingles that the other one lacks. Hashes are shortened by the
    bits that tell the lines of a part from each other.
    """
    upto = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    cuts = np.flatnonzero(np.diff(upto // CACHED)) + 1
    parts = [_part_marks(lines[a:b]) for a, b in zip([0, *cuts], [*cuts, len(lines)])]
    return tuple(np.concatenate(side) for side in zip(*parts))


def _part_marks(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    values, starts = shingle_hashes(lines)
    bits = max(1, (len(lines) - 1).bit_length())
    owner = np.repeat(np.arange(len(lines), dtype=np.uint64), np.diff(starts))
    held = _distinct((owner << np.uint64(64 - bits)) | (values >> np.uint64(bits)))
    sizes = np.bincount((held >> np.uint64(64 - bits)).astype(np.int64), minlength=len(lines))
    place = held >> np.uint64(64 - bits - MARK.bit_length() + 1)
    begins = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    place = place[begins[np.diff(np.append(begins, len(place))) % 2 == 1]]
    marks = np.zeros(len(lines) * WORDS, np.uint64)
    if len(place):
        word = (place >> np.uint64(6)).astype(np.int64)
        begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        marks[word[begins]] = np.add.reduceat(np.uint64(1) << (place & np.uint64(63)), begins)
    return sizes, marks.view(np.int64).reshape(-1, WORDS)


def shingle_set(line: str) -> set[str]:
    return {line[k : k + SHINGLE] for k in range(max(1, len(line) - SHINGLE + 1))}


def _minima(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`BINS` minima per pass and line, and whether the first pass fills all the line's bins."""
    empty, lines = np.uint32(0xFFFFFFFF), len(starts) - 1
    first = np.repeat(np.arange(lines) * BINS, np.diff(starts))
    found = np.full((PASSES, lines * BINS), empty)
    for out, shift in zip(found, ORDERS):
        order = (values >> shift).astype(np.uint32)
        at = ((order >> np.uint32(16)) * np.uint32(BINS)) >> np.uint32(16)
        np.minimum.at(out, first + at, order)
    found = found.reshape(-1, BINS)
    gaps = found == empty
    full = ~gaps.any(axis=1)
    some = np.flatnonzero(~full)
    # Of two rounds of a line's bins, the place of the next filled one.
    places = np.where(np.tile(gaps[some], 2), 2 * BINS - 1, np.arange(2 * BINS))
    places = np.minimum.accumulate(places[:, ::-1], axis=1)[:, ::-1][:, :BINS] % BINS
    found[some] = np.take_along_axis(found[some], places, axis=1)
    return found.reshape(PASSES, lines, BINS), full[:lines]


def bin_minima(lines: list[str]) -> np.ndarray:
    return _minima(*shingle_hashes(lines))[0][0]


def band_keys(minima: np.ndarray, salt: int = 0) -> np.ndarray:
    keys = np.arange(salt * BANDS + 1, (salt + 1) * BANDS + 1, dtype=np.uint64) * MIX
    bands = minima.reshape(-1, BANDS, ROWS)
    for row, factor in enumerate(ROW_FACTORS):
        keys = keys + bands[:, :, row] * factor
    return _mixed(keys).view(np.int64)


def line_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All lines' keys, one line after the other, and their start offsets.

    Taken in parts of about `CACHED` characters, whose arrays stay near the processor.
    """
    upto = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    cuts = np.flatnonzero(np.diff(upto // CACHED)) + 1
    parts = [_part_keys(lines[a:b]) for a, b in zip([0, *cuts], [*cuts, len(lines)])]
    sizes = np.concatenate([np.diff(starts) for _, starts in parts])
    return np.concatenate([keys for keys, _ in parts]), np.concatenate([[0], np.cumsum(sizes)])


def _part_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    values, starts = shingle_hashes(lines)
    minima, full = _minima(values, starts)
    bands = [band_keys(own, salt) for salt, own in enumerate(minima)]
    # A line of fewer than BINS different shingles leaves a bin empty.
    few = np.flatnonzero(~full)
    chosen = np.repeat(~full, np.diff(starts))
    sizes = np.diff(starts)[few]
    owner = np.repeat(np.arange(len(few), dtype=np.uint64), sizes)
    held = _distinct((owner << np.uint64(40)) | (values[chosen] >> np.uint64(24)))
    owner = (held >> np.uint64(40)).astype(np.int64)
    counts = np.bincount(owner, minlength=len(few))
    rank = np.arange(len(held)) - (np.cumsum(counts) - counts)[owner]
    small = counts <= SHORT
    # Similar sets share one of so many least hashes of either.
    least = np.where(small, counts - (counts * 80 + 99) // 100 + 1, 0)
    taken = rank < least[owner]
    prefix = _mixed(held[taken] & np.uint64(2**40 - 1)).view(np.int64)
    banded = np.ones(len(lines), bool)
    banded[few[100 * counts < 80 * (SHORT + 1)]] = False
    keys = np.concatenate([prefix, np.concatenate(bands, axis=1)[banded].ravel()])
    of = np.concatenate([few[owner[taken]], np.repeat(np.flatnonzero(banded), BANDS * PASSES)])
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=len(lines)))
    return keys[order], np.concatenate([[0], ends])


LINES = "doc_id long, line_no int, h1 long, h2 long"
POSTED_ROWS = "key long, id long, head long, size long"
CHARACTERS = 1_000_000
POSTED = 1_000_000  # rows of keys that are held at once
PACKED = 256  # keys that go in one row at most
BUCKET = 250_000  # different keys of a bucket, about
PAIRED = 128  # members of a list whose pairs are told apart by marks at once
COMPARED = 200_000  # characters whose shingles are held as texts


def _digests(lines) -> np.ndarray:
    raw = b"".join(xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines)
    return np.frombuffer(raw, np.int64).reshape(-1, 2)


def _read_lines(batches):
    for ids, texts in pieces(batches, CHARACTERS):
        docs, numbers, lines = [], [], []
        for doc, text in zip(ids, texts):
            if doc is not None and text is not None:
                for number, line in enumerate(text.split("\n")):
                    if line := comparable(line):
                        docs.append(doc), numbers.append(number), lines.append(line)
        if not lines:
            continue
        known = {line: at for at, line in enumerate(dict.fromkeys(lines))}
        own = np.fromiter((known[x] for x in lines), np.int64, len(lines))
        digests = _digests(known)[own]
        yield pa.record_batch(
            [
                pa.array(docs, pa.int64()),
                pa.array(numbers, pa.int32()),
                pa.array(digests[:, 0]),
                pa.array(digests[:, 1]),
            ],
            ["doc_id", "line_no", "h1", "h2"],
        )


def _dealt(keys: np.ndarray, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows (bucket, keys, ids): a bucket's keys, without what the bucket says, and their ids."""
    keys = keys.view(np.uint64)
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    if buckets <= 2**16:  # sorted by digits then
        bucket = bucket.astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.arange(len(keys)) % PACKED == 0
    cut[1:] |= bucket[1:] != bucket[:-1]
    starts = np.append(np.flatnonzero(cut), len(keys))
    columns = [pa.array(bucket[starts[:-1]].astype(np.int32))]
    for values in (keys.astype(np.uint32)[order], ids[order]):
        ends = pa.py_buffer((starts * values.itemsize).astype(np.int32))
        parts = [None, ends, pa.py_buffer(values)]
        columns.append(pa.Array.from_buffers(pa.binary(), len(starts) - 1, parts))
    return pa.record_batch(columns, ["bucket", "keys", "ids"])


def _post_lines(buckets: int):
    """The keys of a piece's different lines with the lines' ids, dealt to buckets."""

    def run(batches):
        keys, ids, held = [], [], 0
        for numbers, texts in pieces(batches, CHARACTERS):
            lines = {
                line: None
                for doc, text in zip(numbers, texts)
                if doc is not None and text is not None
                for raw in text.split("\n")
                if (line := comparable(raw))
            }
            if not lines:
                continue
            own, starts = line_keys(list(lines))
            keys.append(own)
            ids.append(np.repeat(_digests(lines)[:, 0], np.diff(starts)))
            held += len(own)
            if held >= POSTED:
                yield _dealt(np.concatenate(keys), np.concatenate(ids), buckets)
                keys, ids, held = [], [], 0
        if held:
            yield _dealt(np.concatenate(keys), np.concatenate(ids), buckets)

    return run


def _of_buckets(batches):
    """(bucket, keys, ids) of each stretch of rows (bucket, keys, ids) of one bucket."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, packed, owners = batch.columns
        ends = np.cumsum(pa.compute.binary_length(owners).to_numpy() // 8)
        keys = np.frombuffer(b"".join(packed.to_pylist()), np.uint32)
        ids = np.frombuffer(b"".join(owners.to_pylist()), np.int64)
        bucket, start = plain(bucket), 0
        for last in [*np.flatnonzero(bucket[1:] != bucket[:-1]).tolist(), len(bucket) - 1]:
            yield int(bucket[last]), keys[start : ends[last]], ids[start : ends[last]]
            start = ends[last]


def _meeting(batches):
    """`POSTED_ROWS` of keys with more than one id, of rows (bucket, keys, ids) that come by bucket.

    Of a large bucket, a part is looked at at a time. One row of each key goes on to the
    next part, so that what is held follows the bucket's different keys, however many ids
    one of them has; that row may come again then, and sizes are those of parts, but more than
    `PAIRED` at least, as the whole list is not known.
    """
    now, keys, ids, held, whole = None, [], [], 0, True

    def settle():
        low, own = np.concatenate(keys), np.concatenate(ids)
        number = np.arange(len(low), dtype=np.uint64)
        packed = np.sort((low.astype(np.uint64) << np.uint64(32)) | number)
        low, own = packed >> np.uint64(32), own[(packed & np.uint64(2**32 - 1)).astype(np.int64)]
        fresh = np.ones(len(low), bool)
        fresh[1:] = low[1:] != low[:-1]
        at = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        key = ((np.uint64(now) << np.uint64(32)) | low[at]).view(np.int64)
        by = np.lexsort((own[at], key))
        rows = pa.record_batch([pa.array(key[by]), pa.array(own[at][by])], ["key", "id"])
        return _headed(_shared([rows]), whole), ([low[fresh].astype(np.uint32)], [own[fresh]])

    for bucket, more, owners in _of_buckets(batches):
        if held and (bucket != now or held >= POSTED):
            whole = whole and bucket != now
            found, rest = settle()
            yield from found
            keys, ids = rest if bucket == now else ([], [])
            held, whole = 0, bucket != now
        now = bucket
        keys.append(more)
        ids.append(owners)
        held += len(more)
    if held:
        yield from settle()[0]


def _headed(batches, whole: bool):
    """Rows (key, id), which come sorted, with their key's smallest id and number of rows."""
    for batch in batches:
        key, id = plain(batch.column(0)), plain(batch.column(1))
        begins = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        sizes = np.diff(np.append(begins, len(key)))
        size = np.repeat(sizes if whole else np.maximum(sizes, PAIRED + 1), sizes)
        head = np.repeat(id[begins], sizes)
        yield pa.record_batch([pa.array(c) for c in (key, id, head, size)], ["key", "id", "head", "size"])


def _shared(batches):
    """Different rows (key, id) of keys with more than one id; rows come sorted.

    Only the last row of a batch is held back, until it is known whether it is alone.
    """
    held = np.zeros((2, 0), np.int64)  # the last row, if it may be the only one of its key
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([plain(batch.column(0)), plain(batch.column(1))])
        fresh = np.ones(rows.shape[1], bool)
        fresh[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
        if last is not None:
            fresh[0] = (rows[:, 0] != last).any()
        rows = rows[:, fresh]
        if not rows.shape[1]:
            continue
        # The first row of a key goes with the second one.
        begins = np.ones(rows.shape[1], bool)
        begins[1:] = rows[0, 1:] != rows[0, :-1]
        begins[0] = last is None or rows[0, 0] != last[0]
        if begins[0]:
            held = held[:, :0]
        out = ~begins
        out[:-1] |= ~begins[1:]
        parts = [held, rows[:, out]]
        last = rows[:, -1]
        held = rows[:, -1:] if begins[-1] else held[:, :0]
        rows = np.concatenate(parts, axis=1)
        yield pa.record_batch([pa.array(rows[0]), pa.array(rows[1])], ["key", "id"])


def _take_lines(batches):
    """(id, size, marks, line) of the lines asked for; the size counts different shingles."""
    for wanted, texts in pieces(batches, CHARACTERS):
        rows = [
            (id, comparable(lines[number]))
            for marks, text in zip(wanted, texts)
            for lines in [text.split("\n")]
            for id, number in ((m["id"], m["line_no"]) for m in marks)
            if number < len(lines)  # rows may share a doc_id
        ]
        if not rows:
            continue
        sizes, marks = line_marks([line for _, line in rows])
        out = {
            "id": pa.array([id for id, _ in rows], pa.int64()),
            "size": pa.array(sizes, pa.int64()),
            **{name: pa.array(own) for name, own in zip(MARKS, marks.T)},
            "line": pa.array([line for _, line in rows], pa.string()),
        }
        yield pa.record_batch(list(out.values()), list(out))


OWN_ROWS = f"id long, size long, {', '.join(f'{name} long' for name in MARKS)}, line string"
SHORTENED = np.uint64(40)  # bits that are left of a hash beside the number of its line
SLACK = 2
CLASSES = 128  # a power of 2


def _by_hashes(xs: list[str], ys: list[str], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each pair can be similar, and whether it must be, by shortened hashes of its shingles.

    Different shingles of a pair of 1000 fall together in one of a million pairs, which changes
    a size or what the pair has in common by one; it is judged only if `SLACK` of them
    change nothing. Most pairs that can't be similar are told by the numbers of their hashes in
    each of `CLASSES` classes: two lines share no more than the smaller number.
    """
    known = {x: at for at, x in enumerate(dict.fromkeys([*xs, *ys]))}
    values, starts = shingle_hashes(list(known))
    owner = np.repeat(np.arange(len(known), dtype=np.uint64), np.diff(starts))
    held = _distinct((owner << SHORTENED) | (values >> (np.uint64(64) - SHORTENED)))
    sizes = np.bincount((held >> SHORTENED).astype(np.int64), minlength=len(known))
    begins = np.cumsum(sizes) - sizes
    x = np.fromiter((known[k] for k in xs), np.int64, len(xs))
    y = np.fromiter((known[k] for k in ys), np.int64, len(ys))
    may = np.ones(len(xs), bool)
    place = (held >> SHORTENED) * np.uint64(CLASSES) + (held & np.uint64(CLASSES - 1))
    counts = np.bincount(place.astype(np.int64), minlength=len(known) * CLASSES)
    counts = np.minimum(counts, 2**32 - 1).astype(np.uint32).reshape(-1, CLASSES)
    for low in range(0, len(xs), 512):
        part = slice(low, low + 512)
        most = np.minimum(counts[x[part]], counts[y[part]]).sum(axis=1, dtype=np.int64)
        either = sizes[x[part]] + sizes[y[part]] - most
        may[part] = 100 * (most + SLACK) >= percent * either
    # What is left has sides of like sizes, so that a long line is not held for each short one.
    at = np.flatnonzero(may)
    sides = []
    for side in (x[at], y[at]):
        own = sizes[side]
        place = np.arange(own.sum()) + np.repeat(begins[side] - (np.cumsum(own) - own), own)
        pair = np.repeat(np.arange(len(at), dtype=np.uint64), own)
        sides.append((pair << SHORTENED) | (held[place] & np.uint64(2**40 - 1)))
    both = np.sort(np.concatenate(sides))
    twice = both[1:][both[1:] == both[:-1]] >> SHORTENED
    common = np.bincount(twice.astype(np.int64), minlength=len(at))
    either = sizes[x[at]] + sizes[y[at]] - common
    must = np.zeros(len(xs), bool)
    may[at] = 100 * (common + SLACK) >= percent * either
    must[at] = 100 * (common - SLACK) >= percent * (either + 3 * SLACK)
    return may, must


def like_sizes(percent: int) -> str:
    """Whether sets of sizes m and n can be similar; hashes may fall together."""
    return f"100 * (least(m, n) + {SLACK}) >= {percent} * greatest(m, n)"


def like_marks(percent: int) -> str:
    """Whether sets of sizes m and n with marks x and y can be similar.

    They have to differ in no more than (100 - percent) / (100 + percent) of m + n shingles.
    """
    apart = " + ".join(f"bit_count(x{k} ^ y{k})" for k in range(WORDS))
    return f"{100 + percent} * ({apart}) <= {100 - percent} * (m + n + {SLACK})"


def _meant(percent: int):
    """Pairs (a, b) of rows (key, id, part, size, marks) of one key, which come sorted, that can be similar.

    What `like_sizes` and `like_marks` say, for pairs of different parts. Rows of a key are held together.
    """

    def pairs(rows):
        key, id, part, size, *marks = rows
        marks = np.stack(marks, axis=1).view(np.uint64)
        at, step, found = np.arange(len(key)), 0, []
        while len(at):
            step += 1
            at = at[: np.searchsorted(at, len(key) - step)]
            at = at[key[at] == key[at + step]]
            m, n = size[at], size[at + step]
            may = part[at] != part[at + step]
            may &= 100 * (np.minimum(m, n) + SLACK) >= percent * np.maximum(m, n)
            x, most = at[may], (100 - percent) * (m + n + SLACK)[may]
            apart = np.bitwise_count(marks[x] ^ marks[x + step]).sum(axis=1, dtype=np.int64)
            x = x[(100 + percent) * apart <= most]
            found.append((id[x], id[x + step]))
        a, b = (np.concatenate(side) for side in zip(*found))
        return pa.record_batch([np.minimum(a, b), np.maximum(a, b)], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [plain(c) for c in batch.columns]
            if held:
                rows = [np.concatenate(both) for both in zip(held, rows)]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if cut:
                yield pairs([c[:cut] for c in rows])
            held = [c[cut:] for c in rows]
        if held:
            yield pairs(held)

    return run


def _similar(percent: int):
    def run(batches):
        for a, b, xs, ys in pieces(batches, COMPARED):
            may, must = _by_hashes(xs, ys, percent)
            kept = np.flatnonzero(must).tolist()
            close = np.flatnonzero(may & ~must).tolist()
            sets = {x: shingle_set(x) for x in {side[k] for side in (xs, ys) for k in close}}
            for at in close:
                x, y = sets[xs[at]], sets[ys[at]]
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    kept.append(at)
            kept.sort()
            yield pa.record_batch(
                [pa.array([a[k] for k in kept], pa.int64()), pa.array([b[k] for k in kept], pa.int64())],
                ["a", "b"],
            )

    return run


def line_verdicts(
    documents: DataFrame, percent: int = 80, folder: str | None = None
) -> DataFrame:
    """doc_id, line_no, group_doc_id, group_line_no, kept: a row per line that isn't blank.

    The group is named by the line that stays. `BANDS` and `ROWS` are set for 80 percent
    and more.
    """
    if percent < 80:
        raise ValueError("the bands are set for 80 percent and more")
    run = RunFolder(documents.sparkSession, folder)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lines = run.write(texts.mapInArrow(_read_lines, LINES), "lines")
    classes = run.write(
        lines.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("lines"))
        .select("h1", "h2", "first.doc_id", "first.line_no", "lines"),
        "classes",
    )
    # Keys go straight into the one exchange that brings equal ones together.
    buckets = 1 + classes.count() * BANDS * PASSES // BUCKET
    posted = texts.mapInArrow(_post_lines(buckets), "bucket int, keys binary, ids binary")
    posted = posted.repartition("bucket").sortWithinPartitions("bucket")
    posted = run.write(posted.mapInArrow(_meeting, POSTED_ROWS), "posted")
    asked = posted.select(F.col("id").alias("h1")).distinct().hint("merge")
    asked = run.write(classes.join(asked, "h1", "left_semi"), "asked")
    wanted = asked.groupBy("doc_id").agg(
        F.collect_list(F.struct(F.col("h1").alias("id"), "line_no")).alias("wanted")
    )
    found = texts.where("text is not null").join(wanted.hint("merge"), "doc_id")
    found = found.select("wanted", "text").mapInArrow(_take_lines, OWN_ROWS)
    own = run.write(found, "own")

    def side(id: str, size: str, mark: str) -> DataFrame:
        marks = [F.col(c).alias(f"{mark}{k}") for k, c in enumerate(MARKS)]
        return own.select(F.col("id").alias(id), F.col("size").alias(size), *marks)

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.hint("merge").join(side("a", "m", "x"), "a").hint("merge")
        both = both.join(side("b", "n", "y"), "b").where(like_sizes(percent)).where(like_marks(percent))
        return compared(both.select("a", "b"), name)

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        """Texts go only to pairs that can be similar."""
        x = own.select(F.col("id").alias("a"), F.col("line").alias("x"))
        y = own.select(F.col("id").alias("b"), F.col("line").alias("y"))
        both = pairs.hint("merge").join(y, "b").hint("merge").join(x, "a")
        linked = both.select("a", "b", "x", "y").mapInArrow(_similar(percent), "a long, b long")
        return run.write(linked.distinct(), f"{name}-edges")

    def finish(ids: DataFrame, name: str) -> DataFrame:
        listed = posted.select(F.col("key").alias("v"), "id", F.col("size").alias("n"))
        narrow = listed.where(F.col("n") > PAIRED).join(ids.hint("merge"), "id")
        narrow = run.write(narrow.select("id", "part", "v").distinct(), f"{name}-narrow")
        lists = run.write(lists_of(narrow), f"{name}-lists")
        few = narrow.join(lists.where(F.col("n") <= PAIRED).select("v"), "v").select("v", "id")
        few = listed.where(F.col("n") <= PAIRED).select("v", "id").union(few)
        marked = ids.join(own.select("id", "size", *MARKS).hint("merge"), "id")
        few = few.join(marked.hint("merge"), "id").select("v", "id", "part", "size", *MARKS)
        pairs = spread(few, ["v"]).mapInArrow(_meant(percent), "a long, b long")
        edges = compared(pairs.distinct(), name)
        large = lists.where(F.col("n") > PAIRED)
        if large.take(1):
            items = narrow.join(large.select("v"), "v").groupBy("id", "part")
            items = items.agg(F.collect_set("v").alias("coords")).join(
                own.select("id", F.col("line").alias("payload")).hint("merge"), "id"
            )
            items = run.write(items, f"{name}-items")
            more = links_between(items, percent, run, f"{name}-large", shingle_set, line_sets)
            edges = edges.union(more).distinct()
        return edges

    parts = bucket_components(posted, confirm, finish, run, "like")
    run.drop("posted", "own")
    # A line that comes once and was not asked for stands alone.
    several = classes.where("lines > 1").union(asked.where("lines = 1"))
    grouped = several.join(parts, several["h1"] == parts["id"], "left").select(
        "h1",
        "h2",
        F.struct("doc_id", "line_no").alias("first"),
        F.coalesce("component", "h1").alias("component"),
    )
    heads = grouped.groupBy("component").agg(F.min("first").alias("head"))
    stays = grouped.join(heads, "component").select("h1", "h2", "head")
    head = F.coalesce("head", F.struct("doc_id", "line_no"))
    return lines.join(stays, ["h1", "h2"], "left").select(
        "doc_id",
        "line_no",
        head["doc_id"].alias("group_doc_id"),
        head["line_no"].alias("group_line_no"),
        F.struct("doc_id", "line_no").eqNullSafe(head).alias("kept"),
    )


def _drop_lines(columns: list[str]):
    def run(batches):
        for batch in batches:
            texts, chars = [], []
            gone = batch.column(batch.num_columns - 1).to_pylist()
            for text, numbers in zip(batch.column(columns.index("text")).to_pylist(), gone):
                if numbers and text is not None:
                    drop = set(numbers)
                    text = "\n".join(
                        x for at, x in enumerate(text.split("\n")) if at not in drop
                    )
                texts.append(text)
                chars.append(None if text is None else len(text))
            out = {c: batch.column(at) for at, c in enumerate(columns)}
            out["text"] = pa.array(texts, pa.string())
            if "n_chars" in out:
                given = out["n_chars"]
                changed = pa.array([bool(g) for g in gone])
                out["n_chars"] = pa.compute.if_else(
                    changed, pa.array(chars).cast(given.type), given
                )
            yield pa.record_batch(list(out.values()), columns)

    return run


def without_repeats(
    documents: DataFrame, percent: int = 80, folder: str | None = None
) -> DataFrame:
    """`documents` without the lines that do not stay; the columns stay as they are.

    A document that had lines and has none left goes: all of it stays elsewhere. Documents
    without lines pass. `n_chars`, where there is one, follows the text.
    """
    verdicts = line_verdicts(documents, percent, folder)
    drops = verdicts.groupBy("doc_id").agg(
        F.collect_list(F.when(~F.col("kept"), F.col("line_no"))).alias("drop"),
        F.max("kept").alias("some"),
    )
    columns = documents.columns
    # The documents' columns travel in one, so that no name of theirs can clash.
    whole = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
    )
    rows = whole.join(drops.hint("merge"), "doc_id", "left").where("coalesce(some, true)")
    rows = rows.select("row", "drop").select(
        *[F.col(f"row.`{c}`").alias(f"c{at}") for at, c in enumerate(columns)], "drop"
    )
    return rows.mapInArrow(_drop_lines(columns), documents.schema)
