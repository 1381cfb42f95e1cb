"""Removed bytes against a set of all strings of 200 bytes."""

import hashlib
import random
from collections import Counter

import pytest

from voxsift.llm import suffix_dedup
from voxsift.llm.suffix_dedup import LENGTH, cut_repeats, digest


def plain(rows, keep_first=False):
    """[(id, bytes, removed, runs, sha256 of the rest)] by looking up every string."""
    data = [(i, (t or "").encode()) for i, t in rows]
    if keep_first:
        order = sorted(range(len(data)), key=lambda k: (data[k][0], k))
    else:
        order = range(len(data))
        count = Counter(d[p:p + LENGTH] for _, d in data for p in range(len(d) - LENGTH + 1))
    seen, told = set(), {}
    for k in order:
        i, d = data[k]
        gone = bytearray(len(d))
        for p in range(len(d) - LENGTH + 1):
            s = d[p:p + LENGTH]
            if s in seen if keep_first else count[s] > 1:
                gone[p:p + LENGTH] = b"\1" * LENGTH
            seen.add(s)
        runs = sum(1 for p in range(len(d)) if gone[p] and (p == 0 or not gone[p - 1]))
        told[k] = (i, len(d), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest())
    return [told[k] for k in range(len(data))]


def corpus(seed):
    draw = random.Random(seed)
    prose = lambda n: "".join(draw.choice("abcdeé \n") for _ in range(n))
    passages = [prose(n) for n in (199, 200, 201, 260, 350, 900)]
    texts = ["", None, "short", "x" * 1000, "ab" * 400, "x" * 199, "x" * 200, "\0" * 250, "a" + "\0" * 230]
    for _ in range(30):
        texts.append(prose(draw.randint(0, 300)) + draw.choice(passages) + prose(draw.randint(0, 40)) + draw.choice(passages) + prose(draw.randint(0, 99)))
    base = prose(1500)
    for _ in range(15):  # near copies
        at = draw.randrange(1500)
        texts.append(base[:at] + prose(draw.randint(0, 3)) + base[at + draw.randint(0, 3):])
    texts += [base, base, prose(200) * 3, passages[5][:210], passages[5][100:]]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,keep_first", [(1, False), (2, False), (3, True)])
def test_digest(spark, seed, keep_first):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 AS uid", "2 AS start", "3 AS s_found")
    got = sorted(tuple(r) for r in digest(docs, keep_first).collect())
    want = sorted(plain(rows, keep_first))
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, wrong[:3]


def test_repeated_and_missing_ids(spark):
    text = "".join(random.Random(9).choice("abcdefgh ") for _ in range(500))
    rows = [(4, text), (4, text), (None, text), (7, "alone " * 3), (-1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in digest(docs).collect()), key=str) == sorted(plain(rows), key=str)


def test_rows_of_the_cut_table(spark):
    rows = [(i, t, "s", len(t or "")) for i, t in corpus(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    cut = cut_repeats(docs)
    assert cut.schema == docs.schema or cut.columns == docs.columns
    told = {i: (removed, sha) for i, _, removed, _, sha in plain([(i, t) for i, t, *_ in rows], keep_first=True)}
    got = {r.doc_id: r for r in cut.collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        assert got[i].n_chars == len(got[i].text or "")
        if told[i][0] == 0:
            assert got[i].text == text
        elif (text or "").isascii():
            assert hashlib.sha256(got[i].text.encode()).hexdigest() == told[i][1]
    assert cut_repeats(docs.limit(0)).collect() == [] and digest(docs.limit(0)).collect() == []


def plain_longest(keys, letters, where, keep_first):
    out = []
    for i in range(len(keys)):
        best = -1
        for j in range(len(keys)):
            if j != i and keys[i] == keys[j] and (not keep_first or where[j] < where[i]):
                same = letters[i] == letters[j]
                best = max(best, len(same) if same.all() else int(same.argmin()))
        out.append(best)
    return out


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_longest_factors_from_smaller_positions_in_suffix_order(seed, keep_first):
    import numpy as np

    draw = np.random.default_rng(seed)
    keys = draw.integers(0, 4, 120).astype(np.uint64)
    letters = draw.integers(97, 99, (120, 9)).astype(np.uint8)
    where = draw.permutation(120)
    order, common = suffix_dedup._classes(keys, letters)
    lengths, sources = suffix_dedup.longest_matches(order, common, where, keep_first)
    want = plain_longest(keys, letters, where, keep_first)
    assert lengths.tolist() == want
    for i, length in enumerate(want):
        if length >= 0:
            j = sources[i]
            assert j != i and keys[i] == keys[j] and (letters[i][:length] == letters[j][:length]).all()
            assert not keep_first or where[j] < where[i]


def test_long_runs_take_seconds(spark):
    import time

    start = time.process_time()
    for text in (b"a" * 1_000_000, b"ab" * 300_000, b"abcdefg" * 100_000):
        p, *_ = suffix_dedup.chosen_grams(text)
        assert len(p)
    assert time.process_time() - start < 20


@pytest.mark.parametrize("keep_first", [False, True])
def test_long_texts(spark, keep_first):
    draw = random.Random(5)
    long = "".join(draw.choice("abcdefgh \n") for _ in range(60_000))
    edited = long[:20_000] + "X" + long[20_001:40_000] + long[40_050:]
    rows = [(1, long + "z" * 3_000 + long[1_000:2_000]), (2, edited), (3, "xy" * 2_000 + long[30_000:30_400]), (4, long[:199]), (5, edited[100:9_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, digest(docs, keep_first).collect())) == sorted(plain(rows, keep_first))


def test_parts_by_bytes_do_not_change_the_result(spark, monkeypatch):
    rows = corpus(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 1000)
    assert sorted(map(tuple, digest(docs).collect())) == sorted(plain(rows))
