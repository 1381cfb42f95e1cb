"""Counts of whole texts and of every prefix against the tokenizers library."""

import functools

from hypothesis import given, settings
from hypothesis import strategies as st

from tokenizers import Tokenizer

from voxsift.llm.queries import tokenizer_file
from voxsift.llm.token_prefix import _LONGEST_KEPT, PrefixCounts, prefix_table, token_counts

FILE = tokenizer_file("word_bpe_49k.json")
TEXTS = [
    "", "  ", "A", "It's   WE'LL\t\n\n x", "don’t ÉTÉ é  İK ΣΑΣ", "12345² ١٢ _-_ !!?",
    "<|endoftext|>in<|startoftext|> <|ENDOFTEXT|>", "\U0001f600‍\U0001f469 \x1c!\x1c\x1f\x85a b ﻿",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa banana cococococo", "Thheouble heenwh ononenen threha ciónosgata verschlüßelung",
    "x" * 5000, "word! " * 2000,
]


@functools.cache
def both():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(FILE)
    return PrefixCounts(FILE), lambda text: len(library.encode(text, add_special_tokens=False).ids)


def test_whole_texts():
    counts, library = both()
    for text in TEXTS:
        assert counts.count(text) == library(text), text[:60]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text("abcdeghinorst <|>'", max_size=60))
def test_any_text(text):
    counts, library = both()
    assert counts.count(text) == library(text)


@settings(max_examples=200, deadline=None)
@given(st.text("abcdeghiklmnorstu", min_size=1, max_size=30))
def test_every_prefix_of_a_word(word):
    counts, library = both()
    assert counts.word(word) == [library(word[:n]) for n in range(1, len(word) + 1)]


@settings(max_examples=100, deadline=None)
@given(st.text("abénorst. '1É", max_size=80), st.integers(0, 12))
def test_cut_is_the_longest_prefix(text, budget):
    counts, library = both()
    assert counts.count(text[:counts.cut(text, budget)]) <= budget
    assert counts.cut(text, budget) >= max(n for n in range(len(text.rstrip()) + 1) if library(text[:n]) <= budget and (n == 0 or not text[n - 1].isspace() or n == len(text)))


def test_queries_of_a_table(spark):
    _, library = both()
    rows = [*enumerate(TEXTS), (2, "A"), (50, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_tokens", "2 AS ends")
    got = token_counts(docs, FILE, budget=40).collect()
    want = [(i, len((t or "").encode()), library(t or ""), library(t or "") > 40) for i, t in rows]
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(want, key=str)
    assert all(r.prefix_chars == len(dict(rows)[r.doc_id] or "") for r in got if not r.over_limit)
    for row in prefix_table(docs, FILE).collect():
        text = dict(rows)[row.doc_id] or ""
        if len(text) < 100:
            assert row.tokens == [library(text[:end]) for end in row.ends]
    assert token_counts(docs.limit(0), FILE).collect() == []


def test_long_words_are_not_kept():
    counts = PrefixCounts(FILE)
    long = "abcdefghij" * 5_000
    library = Tokenizer.from_file(FILE)
    for text in (long, f"short {long} short", "é" * 300 + " x"):
        assert counts.count(text) == counts.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    kept = _LONGEST_KEPT
    assert max(map(len, counts._words)) <= kept and max(map(len, counts._chunks)) <= kept and "short" in counts._words
