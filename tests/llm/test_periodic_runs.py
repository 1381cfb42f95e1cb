import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from voxsift.llm import periodic_runs as pr
from voxsift.llm.queries import QUERIES


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_runs(words):
    """Every maximal stretch per period, by comparing all words that are q apart."""
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q):
                found.setdefault((i, length), q)  # the smallest period comes first
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_row(doc_id, words):
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def texts():
    draw = random.Random(7)
    made = []
    for k in range(60):
        words = []
        for _ in range(draw.randint(1, 6)):
            period = [draw.choice("abcd") if draw.random() < 0.5 else str(draw.random()) for _ in range(draw.choice([1, 2, 3, 7, 8, 9, 16, 17, 33, 40]))]
            times = draw.choice([1, 2, 2.9, 3, 3.2, 5, 12])
            n = int(len(period) * times)
            words += [period[i % len(period)] for i in range(n)]
            words += [draw.choice("ab") for _ in range(draw.randint(0, 5))]
        made.append(words)
    made.append(["a"] * 700)
    made.append(["a"] * 23)
    made.append(["a"] * 24)
    made.append((["a"] * 40 + ["b"]) * 9)
    made.append([draw.choice("ab") for _ in range(900)])
    fib = ["a", "ab"]
    while len(fib[-1]) < 800:
        fib.append(fib[-1] + fib[-2])
    made.append(list(fib[-1]))
    period = [str(i) for i in range(1500)]
    made.append(["x"] + period * 3 + ["y"] + period[:100])
    return made


def test_runs_equal_those_of_comparing_all_words(spark):
    rows = [(i, " ".join(words)) for i, words in enumerate(texts())]
    found = {}
    for row in pr.with_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect():
        found[row.doc_id] = sorted((r["start"], r["length"], r["period"]) for r in row.runs or [])
    for i, text in rows:
        assert found[i] == plain_runs(text.split()), i


def test_tiles_of_a_long_text_are_solved_apart(spark):
    draw = random.Random(1)
    words = [str(draw.random()) for _ in range(9000)]
    period = [str(draw.random()) for _ in range(2500)]
    words[500:500] = period * 3 + period[:1200]
    n_tiles = len(list(pr.tiles([w.encode() for w in words])))
    assert n_tiles > 2
    row = pr.with_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [(r["start"], r["length"], r["period"]) for r in row.runs] == [(500, 8700, 2500)]


def test_query_equals_the_plain_version(spark):
    sf_small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(plain_row(d, planted(d, (t or "").encode().split() and [w.decode() for w in t.encode().split()])) for d, t in docs)
    assert sorted(map(tuple, QUERIES["op13_periodic_runs"](spark, sf_small).collect())) == want


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "x"), (None, "a " * 30, "x"), (2, "a b " * 30, None), (2, "a b " * 30, None), (3, " \t\n\x1c ", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, number string")
    got = sorted(map(tuple, pr.summary(docs).collect()), key=str)
    want = sorted((plain_row(d, [w.decode() for w in (t or "").encode().split()]) for d, t, _ in rows), key=str)
    assert got == want
    kept = pr.collapse(docs).collect()
    assert sorted((str(r.doc_id), str(r.text), str(r.number)) for r in kept) == sorted(
        (str(d), "a" if d is None else "a b" if t and "a" in t else str(t), str(n)) for d, t, n in rows
    )
    assert pr.summary(docs.limit(0)).count() == 0


def test_words_planted_as_stated(spark):
    rows = [(i, " ".join(str(k) for k in range(i % 90))) for i in range(400)] + [(None, "a b")]
    got = {r.doc_id: r.text for r in pr.with_planted_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.pop(None) == "a b"
    for i, text in rows[:-1]:
        assert got[i].split() == planted(i, text.split()), i


@pytest.mark.parametrize("n", [0, 1, 23, 24, 27, 100, 5000])
def test_octaves_cover_each_period_once(n):
    covered = [q for octave in pr.octaves(n) for q in range(pr.periods(octave)[0], pr.periods(octave)[1] + 1)]
    assert covered == list(range(1, len(covered) + 1))
    assert len(covered) >= n // 3 if n >= 24 else not covered


def test_z_values():
    draw = np.random.default_rng(0)
    for _ in range(50):
        s = draw.integers(0, 2, 30).tolist()
        for i, z in enumerate(pr.z_values(s)):
            assert s[:z] == s[i:i + z] and (i + z == 30 or s[z] != s[i + z] or z == 30)
