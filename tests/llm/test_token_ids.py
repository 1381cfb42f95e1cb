"""Texts that are too much for the faster encoder."""

import zlib

import numpy as np
import pytest

from voxsift.llm import packing
from voxsift.llm.queries import tokenizer_file
from voxsift.llm.token_ids import TextIds

FILE = tokenizer_file("byte_bpe_50k.json")
LONG = ["a" + " " * 1_000_000 + "word", "a" + "\n" * 1_000_000 + "word", "\t" * 1_200_000 + " end, don't", "x" + " \n" * 600_000 + "y"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def test_a_million_blanks_or_line_ends(library):
    ids_of = TextIds(FILE)
    for text in LONG:
        assert np.array_equal(ids_of.encode(text), library.encode(text, add_special_tokens=False).ids)


def test_padded_texts_are_packed(spark, library):
    got = packing.pack_documents(spark.createDataFrame([(0, LONG[0]), (1, LONG[1]), (2, "short")], "doc_id long, text string"), FILE).collect()
    for number, text in enumerate([LONG[0], LONG[1], "short"]):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want = [(at, zlib.crc32(ids[at:at + 1024].tobytes())) for at in range(0, len(ids), 1024)]
        assert sorted((r.start, r.ids_crc32) for r in got if r.doc_id == number) == want
