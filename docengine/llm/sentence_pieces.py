"""Ids of a merge-type (BPE) SentencePiece vocabulary, by backtracking, and texts of ids.

An automaton over all pieces gives the longest piece at each place. Walking from the left, a
piece is taken if it is compatible with the one before: merging the two pieces' characters
again, best score first, gives exactly these two. Otherwise the next shorter piece that
begins it is tried; when none is left, the place is marked as failed in a bitfield and the
piece before is replaced. A place fails once, so the walk takes time in proportion to the
text. Characters without a piece are ids of bytes.

No piece has a blank mark after another character (checked when the vocabulary is read), so
nothing merges across the start of a run of blanks, nor next to a character that no longer
piece holds: the text is cut there, and the ids of a cut are kept for the next time, in a
table that is emptied when it is full. The vocabulary is
read once, on the driver, and goes to the tasks with the job; its size is that of the file.

Defined cases: null text is empty and has no ids; rows that share a doc_id, or have none, are
documents of their own; only doc_id and text are read. Vocabularies that normalise more than
blanks, or have pieces defined by the user, are refused.
"""

import hashlib
import re
from array import array
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.batches import pieces

CHARACTERS = 1_000_000
KEPT = 500_000  # cuts whose ids are kept, and pairs of pieces; more of either empty the table
KEPT_LENGTH = 64
BLANK = "▁"
UNKNOWN = " ⁇ "
#: Texts whose ids and normal forms tell what the vocabulary does besides merging.
PROBES = ("", " ", "a", " a  b ", "\t\n\r a　b ", "ﬁ①Ａé­​")


@dataclass
class Vocabulary:
    """Pieces by id, with scores; bytes and controls apart."""

    pieces: list[str]
    scores: list[float]
    merged: list[int]
    byte_ids: list[int]
    controls: set[int]
    unknown: int
    prefix: bool
    unreachable: set[int] = field(default_factory=set)

    @classmethod
    def read(cls, path: str) -> "Vocabulary":
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        found = cls(
            [model.id_to_piece(i) for i in ids],
            [model.get_score(i) for i in ids],
            [i for i in ids if i not in special and not model.is_unused(i)],
            [i for i in ids if model.is_byte(i)],
            {i for i in ids if model.is_control(i)},
            model.unk_id(),
            model.normalize("a") != "a",
        )
        texts = [found.pieces[i] for i in found.merged]
        single = {t for t in texts if len(t) == 1}
        if any(BLANK in t.lstrip(BLANK) for t in texts) or not single.issuperset(BLANK.join(texts)):
            raise ValueError("pieces with inner blanks, or characters that are no piece")
        if len(found.byte_ids) != 256 or any(model.is_unused(i) for i in ids):
            raise ValueError("a vocabulary without bytes, or with unused pieces")
        if any(model.normalize(t) != found.normal(t) for t in PROBES):
            raise ValueError("a vocabulary that normalises more than blanks")
        merge = Merger(found)
        found.unreachable = {i for i in found.merged if merge(found.pieces[i]) != [found.pieces[i]]}
        return found

    def normal(self, text: str) -> str:
        marked = text.replace(" ", BLANK)
        return BLANK + marked if self.prefix and text else marked


class Merger:
    """The pieces of a short text by merging neighbours, best score first, then leftmost."""

    def __init__(self, vocabulary: Vocabulary):
        self.rank = {vocabulary.pieces[i]: -vocabulary.scores[i] for i in vocabulary.merged}

    def __call__(self, text: str) -> list[str]:
        parts, rank = list(text), self.rank
        ranks = [rank.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank.get(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = rank.get(parts[at] + parts[at + 1])


class Encoder:
    """Texts to ids by one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = vocabulary
        self.merge = Merger(vocabulary)
        self.ids = {
            vocabulary.pieces[i]: i for i in vocabulary.merged if i not in vocabulary.unreachable
        }
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, (len(piece) - 1, piece))
        self.automaton.make_automaton()
        self.shorter: dict[str, str | None] = {}
        for piece in self.ids:
            ends = (piece[:k] for k in range(len(piece) - 1, 0, -1))
            self.shorter[piece] = next((p for p in ends if p in self.ids), None)
        joining = {c for piece in self.ids if len(piece) > 1 for c in piece} - {BLANK}
        some = f"[{re.escape(''.join(sorted(joining)))}]"
        # Blanks with what can join them, characters that can join, or a character alone.
        self.cuts = re.compile(f"(?s){BLANK}+{some}*|{some}+|.")
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def compatible(self, left: str, right: str) -> bool:
        if len(self.fits) >= KEPT:
            self.fits.clear()
        found = self.fits[left, right] = self.merge(left + right) == [left, right]
        return found

    def _walk(self, text: str, longest: list[str | None]) -> list[str]:
        """Pieces of a text all of whose characters are pieces."""
        fits, shorter, size = self.fits, self.shorter, len(text)
        failed = bytearray()  # a bit per place, from the first failure on
        taken: list[str] = []
        at, piece = 0, longest[0]
        while at < size:
            left = taken[-1] if taken else None
            while piece is not None:
                end = at + len(piece)
                if not (failed and failed[end >> 3] >> (end & 7) & 1):
                    if left is None:
                        break
                    fit = fits.get((left, piece))
                    if self.compatible(left, piece) if fit is None else fit:
                        break
                piece = shorter[piece]
            if piece is not None:
                taken.append(piece)
                at = end
                if at < size:
                    piece = longest[at]
            elif left is not None:
                failed = failed or bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= len(piece)
                piece = shorter[piece]
            else:
                raise ValueError("no sequence of pieces is stable under merging")
        return taken

    def _cut(self, text: str) -> tuple[int, ...]:
        """Ids of a part of a text that nothing merges into or out of."""
        ids = self.ids
        longest: list[str | None] = [None] * len(text)
        for end, (before, piece) in self.automaton.iter(text):
            longest[end - before] = piece  # later ends are longer
        if longest[0] is None:  # a character alone, as those of longer pieces all are pieces
            return tuple([self.vocabulary.byte_ids[b] for b in text.encode()])
        return tuple([ids[p] for p in self._walk(text, longest)])

    def encode(self, text: str) -> array:
        """Ids of a text, four bytes each."""
        out, known = array("I"), self.known
        for cut in self.cuts.findall(self.vocabulary.normal(text)):
            found = known.get(cut)
            if found is None:
                found = self._cut(cut)
                if len(cut) <= KEPT_LENGTH:
                    if len(known) >= KEPT:
                        known.clear()
                    known[cut] = found
            out.extend(found)
        return out


class Decoder:
    """Ids to text: pieces joined, bytes read as UTF-8, each that is none as U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        shown = [p.replace(BLANK, " ") for p in vocabulary.pieces]
        for control in vocabulary.controls:
            shown[control] = ""
        shown[vocabulary.unknown] = UNKNOWN
        self.shown, self.vocabulary = shown, vocabulary
        self.bytes = {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}

    def decode(self, ids) -> str:
        shown, single, out = self.shown, self.bytes, []
        waiting: list[bytes] = []
        first = True  # until a piece shows text, the blank before it is the one put there
        for i in ids:
            if i in single:
                waiting.append(single[i])
                first = False
                continue
            if waiting:
                out.append(_utf8(b"".join(waiting)))
                waiting.clear()
            piece = shown[i]
            if first and piece:
                first = False
                if self.vocabulary.prefix and i != self.vocabulary.unknown:
                    piece = piece.removeprefix(" ")
            out.append(piece)
        if waiting:
            out.append(_utf8(b"".join(waiting)))
        return "".join(out)


def _utf8(raw: bytes) -> str:
    """Characters of UTF-8, each byte that begins none as U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError as fault:
        at = fault.start
        return raw[:at].decode() + "�" + _utf8(raw[at + 1 :])


def _scan(vocabulary: Vocabulary, make):
    def run(batches):
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for ids, texts in pieces(batches, CHARACTERS):
            tokens = [encoder.encode(t or "") for t in texts]
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), *make(tokens, decoder)], list(make.names)
            )

    return run


def _lists(tokens, decoder):
    return [
        pa.array([t.tolist() for t in tokens], pa.list_(pa.int32())),
        pa.array([decoder.decode(t) for t in tokens], pa.string()),
    ]


def _digests(tokens, decoder):
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    return [
        pa.array([len(t) for t in tokens], pa.int64()),
        pa.array([sha(",".join(map(str, t))) for t in tokens]),
        pa.array([sha(decoder.decode(t)) for t in tokens]),
    ]


_lists.names = ("doc_id", "ids", "decoded")
_digests.names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def _apply(documents: DataFrame, model: str, make, schema: str) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scan(Vocabulary.read(model), make), schema)


def encoded(documents: DataFrame, model: str) -> DataFrame:
    """`(doc_id, ids, decoded)`: each text's ids, and the text that they give back."""
    return _apply(documents, model, _lists, "doc_id long, ids array<int>, decoded string")


def encoded_digests(documents: DataFrame, model: str) -> DataFrame:
    """`(doc_id, n_tokens, ids_sha256, decoded_sha256)` of the same, without moving ids."""
    return _apply(
        documents,
        model,
        _digests,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
