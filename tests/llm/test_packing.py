"""Pieces, checksums and sequences against the tokenizers library, and the packing itself against a plain search."""

import functools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxsift.llm import packing
from voxsift.llm.queries import tokenizer_file
from voxsift.llm.token_ids import TextIds

FILE = tokenizer_file("byte_bpe_50k.json")
TEXTS = [
    "", " ", "\n", "a", "It's   we'll\t\n\n x", "don’t été  　 İK", "123 45² ١٢ _-_ !!",
    "<|endoftext|> in <|endoftext|>text", "\U0001f600 ‍\U0001f469 á \x1c\x1f\x85 ﻿", "tail \n", "\r\n a\r b",
    "word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def test_ids_are_the_librarys(library):
    ids_of = TextIds(FILE)
    for text in TEXTS:
        assert ids_of.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


@functools.cache
def both():
    from tokenizers import Tokenizer

    return TextIds(FILE), Tokenizer.from_file(FILE)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    ids_of, library = both()
    assert ids_of.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_decreasing(lengths):
    lengths = np.array(lengths, np.int64)
    bins, offsets = packing.first_fit_decreasing(lengths, 64)
    rooms, want = [], {}
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((k for k, room in enumerate(rooms) if room >= lengths[item]), len(rooms))
        rooms += [64] * (at == len(rooms))
        want[item] = (at, 64 - rooms[at])
        rooms[at] -= int(lengths[item])
    assert {i: (int(bins[i]), int(offsets[i])) for i in range(len(lengths))} == want


def test_every_id_lies_in_one_piece(spark, library):
    rows = [(i, text) for i, text in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "no id"), (90, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS start", "'x' AS part", "2 AS checks")  # names the operator uses itself
    got = packing.pack_documents(docs, FILE, group_docs=4).collect()
    want = []
    for number, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 1024):
            piece = np.array(ids[start:start + 1024], "<u4")
            want.append((number, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    key = str
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got), key=key) == sorted(want, key=key)
    for number in {r.sequence_id for r in got}:
        inside = sorted((r.offset, r.length, r.padding) for r in got if r.sequence_id == number)
        ends = np.cumsum([length for _, length, _ in inside])
        assert [offset for offset, _, _ in inside] == [0, *ends[:-1]] and ends[-1] <= 1024
        assert sum(padding for *_, padding in inside) == 1024 - ends[-1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, FILE).collect() == []


def test_reruns_agree_and_pack_tightly(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('one two ', cast(1 + id * 7919 % 200 AS int)) AS text")
    once = packing.pack_documents(docs.repartition(5), FILE).collect()
    again = packing.pack_documents(docs.repartition(3), FILE).collect()
    assert sorted(once) == sorted(again)
    sequences = len({r.sequence_id for r in once})
    assert sum(r.length for r in once) / (1024 * sequences) > 0.99
