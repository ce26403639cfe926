"""Packing documents into sequences: first-fit decreasing over a tournament tree.

A document's ids are its text's by a byte-level vocabulary (no special tokens added), then
id 0. Whole runs of `LENGTH` ids are sequences of their own; what is left of a document,
less than `LENGTH`, goes to a random group of documents by a seeded hash of its id and text, and each group is
packed by itself: pieces from the longest down, each into the first bin with room, which a
tournament tree over the bins' room finds in logarithmic time. Then the emptiest bins are
cut up to fill the others' gaps, and the last one is cut into lengths that are powers of
two, so nothing is padded.

Groups hold about `GROUP` documents, rows without an id or that share one included; a row takes less than 2 * `LENGTH` bytes plus 8 per whole
run, so a group has a bound, and their number follows the number of documents.

Ids are those of the vocabulary file for the `tokenizers` library; texts whose characters
all lie below U+0250 are encoded by `tiktoken` from the same vocabulary, four times as
fast, with the same ids. Defined cases: null text is empty (its ids are id 0); rows that share a
doc_id are packed each on its own; rows equal in both share a group; an id beyond 16 bits is
an error; only doc_id and text are read.
"""

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.batches import pieces

LENGTH = 1024
GROUP = 2048
END = 0


class RoomTree:
    """Tournament tree over bins in order; each node has the most room below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [room] * (2 * self.leaves)

    def first(self, size: int) -> int:
        """The first bin with room for `size`; its room is taken."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < size:
                node += 1
        at = node - self.leaves
        most[node] -= size
        while node := node // 2:
            most[node] = max(most[2 * node], most[2 * node + 1])
        return at


def first_fit_decreasing(sizes: list[int], room: int = LENGTH) -> list[list[int]]:
    """Bins of indexes into `sizes`, none larger than `room`."""
    tree = RoomTree(len(sizes), room)
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = tree.first(sizes[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def pack(sizes: list[int], room: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length); each is full or as long as a power of two."""
    full = [[(k, 0, sizes[k]) for k in b] for b in first_fit_decreasing(sizes, room)]
    fill = [sum(p[2] for p in b) for b in full]
    order = sorted(range(len(full)), key=lambda b: (-fill[b], b))
    full, fill = [full[b] for b in order], [fill[b] for b in order]
    gap, at = 0, 0
    loose: list[tuple[int, int, int]] = []
    while gap < len(full):
        need = room - fill[gap]
        while need and (loose or gap + 1 < len(full)):
            if not loose:
                loose = full.pop()
                fill.pop()
            item, start, size = loose.pop()
            part = min(need, size)
            full[gap].append((item, start, part))
            fill[gap] += part
            need -= part
            if part < size:
                loose.append((item, start + part, size - part))
        gap += 1
    rest = loose
    if full and fill[-1] < room:  # at most one: all loose pieces were used on it
        rest = full.pop() + rest
    left = sum(p[2] for p in rest)
    rest.reverse()
    while left:
        space = 1 << (left.bit_length() - 1)
        left -= space
        sequence = []
        while space:
            item, start, size = rest.pop()
            part = min(space, size)
            sequence.append((item, start, part))
            space -= part
            if part < size:
                rest.append((item, start + part, size - part))
        full.append(sequence)
    return full


def encoder(vocabulary: str, ranks: str):
    """Text to ids, by the vocabulary file for `tokenizers`."""
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    plain = re.compile("[\0-ɏ]*")

    def encode(text: str) -> list[int]:
        if plain.fullmatch(text) and "<|" not in text:
            return fast.encode_ordinary(text)
        return exact.encode(text, add_special_tokens=False).ids

    return encode


def _cut(vocabulary: str, ranks: str):
    def run(batches):
        encode = encoder(vocabulary, ranks)
        for ids, group, texts in pieces(batches):
            counts, crcs, rests = [], [], []
            for text in texts:
                tokens = np.array([*encode(text or ""), END], "<u4")
                if tokens.max() > 0xFFFF:
                    raise ValueError("ids of the vocabulary do not fit into 16 bits")
                whole = len(tokens) // LENGTH
                counts.append(len(tokens))
                crcs.append(
                    [zlib.crc32(tokens[k * LENGTH : (k + 1) * LENGTH]) for k in range(whole)]
                )
                rests.append(tokens[whole * LENGTH :].astype("<u2").tobytes())
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(group, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())),
                    pa.array(rests, pa.binary()),
                ],
                ["doc_id", "pack", "doc_tokens", "crcs", "rest"],
            )

    return run


CUT = "doc_id long, pack long, doc_tokens long, crcs array<long>, rest binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _pack_group(table: pa.Table) -> pa.Table:
    table = table.sort_by([("doc_id", "ascending"), ("doc_tokens", "ascending"), ("rest", "ascending")])
    docs = table.to_pylist()
    base = docs[0]["pack"] << 32
    out, sequence = [], 0
    for doc in docs:
        for at, crc in enumerate(doc["crcs"]):
            out.append(
                (doc["doc_id"], at * LENGTH, LENGTH, crc, doc["doc_tokens"], base + sequence, 0)
            )
            sequence += 1
    rests = [d for d in docs if d["rest"]]
    for bin in pack([len(d["rest"]) // 2 for d in rests]):
        offset = 0
        for item, start, length in bin:
            doc = rests[item]
            ids = np.frombuffer(doc["rest"], "<u2")
            begin = doc["doc_tokens"] - len(ids) + start
            crc = zlib.crc32(ids[start : start + length].astype("<u4"))
            out.append(
                (doc["doc_id"], begin, length, crc, doc["doc_tokens"], base + sequence, offset)
            )
            offset += length
        sequence += 1
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names)


def packed(
    documents: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    seed: int = 3,
) -> DataFrame:
    """A row per piece: `PIECES`. Sequences are numbered, pieces in one without gaps."""
    from public_tokenizers import path

    vocabulary = vocabulary or path("byte_bpe_50k.json")
    ranks = ranks or path("byte_bpe_50k.tiktoken")
    number = max(1, -(-documents.count() // GROUP))
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(number)).alias("pack")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), group, "text")
    cut = rows.mapInArrow(_cut(vocabulary, ranks), CUT)
    return cut.groupBy("pack").applyInArrow(_pack_group, PIECES)
