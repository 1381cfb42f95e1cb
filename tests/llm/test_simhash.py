"""Fingerprints by definition, and components against all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from voxsift.llm import simhash
from voxsift.llm.components import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """{doc: smallest doc reachable} over (doc, fp), by comparing all pairs."""
    low = {d: d for d, _ in fps}
    changed = True
    while changed:
        changed = False
        for a, x in fps:
            for b, y in fps:
                if low[a] < low[b] and (x ^ y).bit_count() <= 4:
                    low[b] = low[a]
                    changed = True
    return low


TEXTS = ["", None, " \n\t", "One", "one", "a b c", "A\x1cB é\xa0x y z w", "x y z w v " * 50, "ÄÖ Straße a b c d e", "long " * 20000]


def test_fingerprints():
    for text in TEXTS:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text), text


def _clusters(seed, groups, size):
    draw, fps = random.Random(seed), []
    for _ in range(groups):
        centre = draw.getrandbits(64)
        for _ in range(size):
            fps.append(centre ^ sum(1 << k for k in draw.sample(range(64), draw.randint(0, 5))))
    return list(dict.fromkeys(fps))


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("groups,size", [(60, 6), (2, 150), (300, 1)])
def test_links_join_what_all_pairs_join(spark, groups, size):
    fps = _clusters(groups, groups, size)
    nodes = spark.createDataFrame([(_signed(x),) for x in fps], "fp long").repartition(3)
    got = {r.node: r.root for r in components(simhash.near_links(nodes)).collect()}
    want = plain_components([(_signed(x), x) for x in fps])
    assert {_signed(x): got.get(_signed(x), _signed(x)) for x in fps} == want


@pytest.mark.parametrize("groups,size", [(60, 6), (2, 150), (300, 1)])
def test_large_buckets_are_dealt_out_again(spark, monkeypatch, groups, size):
    """Rows of one bucket come in many batches, as those of a bucket larger than a batch do."""
    monkeypatch.setattr(simhash, "SPLIT", 3)
    fps = _clusters(groups + 1, groups, size) + [1 << k for k in range(40)] + [0]
    fps = list(dict.fromkeys(fps))
    nodes = spark.createDataFrame([(_signed(x),) for x in fps], "fp long").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = {r.node: r.root for r in components(simhash.near_links(nodes)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = plain_components([(_signed(x), x) for x in fps])
    assert {_signed(x): got.get(_signed(x), _signed(x)) for x in fps} == want


def test_large_buckets_are_divided(monkeypatch, spark):
    monkeypatch.setattr(simhash, "DENSE", 8)
    import numpy as np

    fps = _clusters(5, 3, 60)
    for segment, bit, _ in simhash._variants()[::7]:
        nodes = np.array(fps, np.uint64)
        links = simhash._joined(nodes, segment, bit)
        part = {i: i for i in range(len(fps))}
        for x, y in links:
            old, new = part[x], part[y]
            part = {k: new if v == old else v for k, v in part.items()}
        for i in range(len(fps)):
            for j in range(i):
                if simhash._near(nodes[i:i + 1], nodes[j:j + 1], segment, bit)[0]:
                    assert part[i] == part[j]


def test_near_duplicates_of_a_table(spark):
    base = " ".join(f"w{i * 7919 % 1000}" for i in range(400))
    rows = [(10 + i, t) for i, t in enumerate(TEXTS)] + [(100, base), (90, base + " end"), (95, base), (95, base), (None, base), (3, "One")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS component", "3 AS salt")
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    want = plain_components([(i, x) for i, x in fps if i is not None])
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.fp % (1 << 64), r.component_id) == (dict(fps)[r.doc_id], want[r.doc_id])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({low for low in want.values()})
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100), (None, 3)], "a long, b long")
    assert {(r.node, r.root) for r in components(links).collect()} == {(i, 0) for i in range(41)}


def test_rows_with_one_id_are_told_apart(spark):
    texts = {name: " ".join(f"{name}{i * 31 % 97}" for i in range(200)) for name in "ABCDE"}
    rows = [(1, "A"), (5, "A"), (5, "B"), (7, "C"), (7, "D"), (7, "D"), (None, "E"), (None, "E"), (None, "A")]
    docs = spark.createDataFrame([(i, texts[t], t, {"k": [1]}) for i, t in rows], "doc_id long, text string, name string, s_id map<string,array<int>>")
    result = simhash.keep_one(docs.repartition(3))
    assert result.schema == docs.schema
    kept = sorted(((r.doc_id, r.name) for r in result.collect()), key=str)
    assert kept == sorted([(1, "A"), (5, "B"), (7, "C"), (7, "D"), (None, "E")], key=str)
    # rows with one id and text that differ elsewhere are near copies as well
    marked = docs.withColumn("name", F.concat("name", F.col("doc_id").cast("string"))).unionByName(docs.limit(1))
    assert simhash.keep_one(marked).count() == 5
