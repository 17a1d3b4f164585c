"""Piece encoding against the library."""

import hashlib
import random

import pytest
import sentencepiece

from sheafline.llm import pieces
from sheafline.llm.queries import op12_sentencepiece


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_query_matches_the_library(spark, sf, library):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in rows:
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = [tuple(r) for r in op12_sentencepiece(spark, sf).collect()]
    assert len(got) == len(rows) and set(got) == want


def test_odd_texts_and_pieces(library):
    rng, tables = random.Random(1), pieces.Pieces(pieces.MODEL)
    known = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    odd = list(" ▁\n\t\r\x00\x1faébﬁ日本語😀́ \x85﻿\xa0x<>0A{}();")
    for _ in range(4000):
        text = "".join(rng.choice(odd) if rng.random() < 0.5 else rng.choice(known) for _ in range(rng.randint(0, 12)))
        if rng.random() < 0.3:
            text = text.replace("▁", " " * rng.randint(1, 40))
        ids = library.encode(text)
        assert list(tables.encode(text)) == ids, text
        assert tables.decode(ids) == library.decode(ids), text
    for _ in range(1000):  # ids that no text has
        ids = [rng.randrange(400) if rng.random() < 0.7 else rng.randrange(library.vocab_size()) for _ in range(rng.randint(0, 12))]
        assert tables.decode(ids) == library.decode(ids), ids


def test_long_texts_and_small_memory(library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 50)
    tables = pieces.Pieces(pieces.MODEL)
    for text in ("ab" * 100_000, " " * 50_000, "x 丁\n" * 20_000, "the quick brown fox " * 5000, "<s></s><0x41>" * 5000):
        assert list(tables.encode(text)) == library.encode(text)


def test_compatible_pairs_are_those_of_merging():
    tables = pieces.Pieces(pieces.MODEL)
    for text in ("▁the", "▁▁▁▁▁word", "aaaaaaaaaaaaaaaa", "ization", "▁" * 40, "=====" * 9):
        assert tables.split(text) == tables.merge(text)


def test_corner_cases(spark, monkeypatch):
    monkeypatch.setattr(pieces, "BATCH", 3)
    rows = [(1, None, "x"), (2, "", "y"), (None, "a b", None), (2, "a b", "z"), (3, "a b", "z"), (3, "a b", "z")]
    table = spark.createDataFrame(rows, "doc_id LONG, text STRING, ids STRING")
    coded = pieces.encode(table, keep=("doc_id", "ids"), ids="__ids")
    back = pieces.decode(coded, keep=("doc_id", "ids", "__ids"), ids="__ids").collect()
    assert sorted(((r[0], r[1], len(r[2]), r[3]) for r in back), key=repr) == sorted(
        [(1, "x", 0, ""), (2, "y", 0, ""), (None, None, 2, "a b"), (2, "z", 2, "a b"), (3, "z", 2, "a b"), (3, "z", 2, "a b")], key=repr)
    assert pieces.encode(table.limit(0)).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id LONG, ids ARRAY<INT>")
    assert sorted(map(tuple, pieces.decode(nulls).collect())) == [(1, None), (2, "")]
