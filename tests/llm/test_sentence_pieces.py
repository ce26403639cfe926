"""Ids and texts against the sentencepiece library."""

import hashlib
import random

import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F

from docengine.llm import queries, sentence_pieces

MODEL = path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return sentence_pieces.Vocabulary.read(MODEL)


ODD = [
    "", " ", "  ", "\n", " " * 1001 + "abc", " " * 17, "a" * 5000, "▁▁▁x ▁", "<s> </s> <unk> <0x0A>",
    "漢字" * 300, "\x00a�", "abc　ﬁ", "🙂👍🏽 x", "\U0010ffff", "a\r\nb", "é", "x" * 100_000,
]


def test_every_text_has_the_ids_of_the_library(library, vocabulary):
    draw = random.Random(1)
    pieces = vocabulary.pieces[259:]
    texts = list(ODD)
    for _ in range(3000):
        some = [draw.choice(pieces) for _ in range(draw.randint(1, 12))]
        texts.append("".join(some).replace("▁", " "))
        texts.append("".join(draw.choice("aeiotnshr  ab") for _ in range(draw.randint(1, 60))))
        low = draw.choice([1, 0x80, 0x3000, 0x10000])
        texts.append("".join(chr(draw.randint(low, low + 0x2000)) for _ in range(20)))
    encoder, decoder = sentence_pieces.Encoder(vocabulary), sentence_pieces.Decoder(vocabulary)
    for text in texts:
        ids = library.encode(text)
        assert encoder.encode(text).tolist() == ids, text[:80]
        assert decoder.decode(ids) == library.decode(ids), text[:80]


def test_any_ids_decode_as_in_the_library(library, vocabulary):
    draw = random.Random(2)
    decoder = sentence_pieces.Decoder(vocabulary)
    for _ in range(5000):
        ids = [
            draw.choice([draw.randint(0, 2), draw.randint(100, 258), draw.randint(259, 31999), 28705])
            for _ in range(draw.randint(0, 8))
        ]
        assert decoder.decode(ids) == library.decode(ids), ids


def test_a_full_table_is_emptied(library, vocabulary, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "KEPT", 3)
    encoder = sentence_pieces.Encoder(vocabulary)
    text = "the quick brown fox jumps over the lazy dog " * 3
    assert encoder.encode(text).tolist() == library.encode(text)
    assert len(encoder.known) <= 3 and len(encoder.fits) <= 3


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, rows):
    found = []
    for doc_id, text in rows:
        ids = library.encode(text or "")
        found.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    return sorted(found, key=str)


def test_query_equals_the_library_on_the_given_table(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.op13_sentence_pieces(spark, SF).collect()]
    assert sorted(got, key=str) == expected(library, rows)


def test_odd_rows(odd, library):
    """Null text is empty; repeated and missing ids are rows of their own."""
    table = odd.withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    got = [tuple(r) for r in sentence_pieces.encoded_digests(table, MODEL).collect()]
    assert sorted(got, key=str) == expected(library, rows)
    lists = sentence_pieces.encoded(table, MODEL).where("doc_id = 7").collect()[0]
    assert lists.ids == library.encode("ÄÖ 漢字\nline\nline\n")
    assert lists.decoded == "ÄÖ 漢字\nline\nline\n"
    assert sentence_pieces.encoded(table.limit(0), MODEL).count() == 0
