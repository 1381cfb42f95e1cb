"""Neighbours against brute force, and the order of visited cells against a full sort."""

import numpy as np
import pytest

from voxsift.llm import multi_index
from voxsift.llm.queries import QUERIES


def brute(rows, queries, k=5):
    """{query: [(id, cosine)]} over all usable rows; ids are distinct."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    told = {}
    for q, v in good:
        if q in queries:
            scored = [(multi_index.cosine(v, w), i) for i, w in good if i != q]
            told[q] = sorted(scored, key=lambda x: (-x[0], x[1]))[:k]
    return told


def test_cells_come_in_order_of_summed_distance():
    draw = np.random.default_rng(1)
    first, second, sizes = draw.random(9), draw.random(9), draw.integers(0, 3, 81)
    cells = multi_index.visited(first, second, sizes, 10**9)
    sums = (first[:, None] + second[None, :]).ravel()
    assert cells == [c for c in np.argsort(sums, kind="stable").tolist() if sizes[c]]
    some = multi_index.visited(first, second, sizes, 20)
    assert some == cells[:len(some)] and sizes[some].sum() >= 20 > sizes[some[:-1]].sum()


def test_small_tables_are_searched_whole(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=7).tolist()) for i in range(60)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(30)]  # copies
    rows += [(200, None), (201, [0.0] * 7), (202, [float("nan")] + [1.0] * 6), (203, [None] + [1.0] * 6), (204, [float("inf")] * 7), (None, [1.0] * 7), (250, [1e-200] * 7), (300, [1e200] * 7)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS vec", "3 AS cell").repartition(4)
    good = multi_index.usable(frame)
    got = multi_index.nearest(good, good.where("id % 50 = 0")).collect()
    want = brute([r for r in rows if r[0] not in (250, 300)], {0, 50, 100})
    for q in (0, 50, 100):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5]
        for r, (score, i) in zip(mine, want[q]):
            if r.vec_id not in (250, 300) and i not in (250, 300):
                assert r.score == pytest.approx(score, abs=1e-12)
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 100), key=lambda r: r.rank)][:3] == [0, 103, 106]


def test_few_vectors_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    good = multi_index.usable(frame)
    assert [tuple(r) for r in multi_index.nearest(good, good.where("id = 0")).collect()] == [(0, 1, 1, 0.0)]
    assert multi_index.nearest(good.limit(0), good.limit(0)).collect() == []
    assert multi_index.nearest(good.where("id = 0"), good.where("id = 0")).collect() == []


def test_recall_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, {i for i, _ in rows if i % 50 == 0})
    got = QUERIES["op10_multi_index"](spark, sf_dir).collect()
    found = sum(r.vec_id in {i for _, i in want[r.query_id]} for r in got)
    assert found / sum(map(len, want.values())) >= 0.9
    exact = {(q, i): score for q, near in want.items() for score, i in near}
    assert all(exact.get((r.query_id, r.vec_id), r.score) == r.score for r in got)


def test_recall_of_the_approximate_path(spark):
    """20,000 and more vectors, of which a query sees little more than half; the exact search is in blocks here."""
    draw = np.random.default_rng(11)
    spread = draw.normal(size=(21_000, 64)) * np.linspace(1.6, 0.4, 64) + draw.normal(size=(30, 64))[draw.integers(0, 30, 21_000)] * 0.5
    units = spread / np.sqrt((spread**2).sum(axis=1, keepdims=True))
    asked = np.arange(0, 21_000, 150)
    close = units[asked] @ units.T
    close[np.arange(len(asked)), asked] = -9
    want = {int(q): set(np.argsort(-line, kind="stable")[:5].tolist()) for q, line in zip(asked, close)}
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(spread.tolist())], "id long, vec array<double>").repartition(6)
    got = multi_index.nearest(frame, frame.where("id % 150 = 0"), least_probed=1).collect()
    found = sum(r.vec_id in want[r.query_id] for r in got)
    assert len(got) == 5 * len(asked)
    assert found / len(got) >= 0.9
    fewer = multi_index.nearest(frame, frame.where("id % 1500 = 0"), probed_share=0.02, least_probed=1).collect()
    part = sum(r.vec_id in want[r.query_id] for r in fewer) / len(fewer)
    assert part < 0.9  # the share decides: nothing falls back to a whole search


def test_centroids_grow_with_the_table():
    assert [multi_index.centroids_for(n) for n in (1, 2_000, 50_000, 10**8, 10**12)] == [4, 13, 30, 200, 256]


def test_lengths_do_not_mix_and_large_numbers_have_a_cosine(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0, 0.0, 0.0]), (2, [0.0, 1.0]), (3, [0.6, 0.8]), (50, [0.0, 0.0, 0.0, 1.0]), (100, [3.0]),
            (150, [1e200, 1e200]), (151, [1e-200, 1e-200]), (152, [1e308, 1e308])]
    frame = spark.createDataFrame(rows, "id long, vec array<double>")
    got = {}
    for r in multi_index.nearest(frame, frame.where("id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert sorted(got[50]) == [(1, 1, 0.0)] and 100 not in got
    assert [(i, s) for _, i, s in sorted(got[150])] == [(151, 1.0), (152, 1.0), (3, round(1.4 / 2**0.5, 9)), (0, round(0.5**0.5, 9)), (2, round(0.5**0.5, 9))]
    assert {i for _, i, _ in got[0]} == {2, 3, 150, 151, 152}
    with pytest.raises(ValueError, match="lengths"):
        many = spark.createDataFrame([(i, [1.0] * (i + 1)) for i in range(70)], "id long, vec array<double>")
        multi_index.nearest(many, many)
