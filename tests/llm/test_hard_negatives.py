import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxsift.llm import hard_negatives as hn
from voxsift.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, anchor=lambda i: i % 50 == 0, positives=5, negatives=3):
    """rows: (id, vector, label), all of which take part."""
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    out = []
    for at, (i, v, label) in enumerate(whole):
        if not anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for k, (j, w, other) in enumerate(whole) if k != at and len(w) == len(v)]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for ps, pid, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and 50 * ps <= 100 * x[0] <= 95 * ps][:negatives]
            out += [(i, pid, rank, x[1], ps, x[0]) for rank, x in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, schema=SCHEMA, **options):
    return sorted(map(tuple, hn.hard_negatives(hn.usable(spark.createDataFrame(rows, schema)), **options).collect()))


def clustered(n, width=12, seed=2):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, width))
    rows = centres[draw.integers(0, 9, n)] + 0.25 * draw.normal(size=(n, width))
    return [(int(i), [float(x) for x in row], int(draw.integers(0, 4))) for i, row in enumerate(rows)]


def test_equal_to_scoring_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(hn, "SHARD_ROWS", 100)
    monkeypatch.setattr(hn, "CHUNK", 16)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 5)
    rows = clustered(900)
    rows += [(1000 + i, rows[3][1], 1) for i in range(300)]  # a third are copies
    rows += [(5000 + i, [0.0] * 12, i % 2) for i in range(4)]
    assert found(spark, rows) == plain(rows)


def test_shards_without_rows_and_results_given_out_early(spark, monkeypatch):
    monkeypatch.setattr(hn, "SHARD_ROWS", 1)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 2)
    monkeypatch.setattr(hn, "HELD_BLOCKS", 1)
    rows = clustered(160)
    assert found(spark, rows, anchors="id % 20 = 0") == plain(rows, anchor=lambda i: i % 20 == 0)


def test_bounds_hold_and_leave_pairs_out():
    rows = np.array([r[1] for r in clustered(3000)])
    whole = np.floor(256 * rows)
    units, norms = hn.units_and_norms(whole)
    book = hn.directions(units)
    near = hn.angles(units, book)
    exact = whole[:40] @ whole.T
    lower, upper = hn.score_bounds(near[:40].astype(float), norms[:40], near.astype(float), near.astype(float), norms, norms)
    assert (lower <= exact).all() and (exact <= upper).all()
    own = near.argmin(axis=1)
    members = np.flatnonzero(own == own[0])
    shard = hn.Shard(
        int(own[0]), members.tolist(), members.tolist(), [0] * len(members), [hn.packed(whole[i]) for i in members],
        [near[i].tobytes() for i in members], norms[members].tolist(),
    )
    others = np.flatnonzero(own != own[0])[:60]
    low = np.quantile(whole[others] @ whole.T, 0.98, axis=1).astype(np.int64)
    block = hn.Block({
        "uids": others.astype(np.int64).tobytes(), "labels": np.zeros(60, np.int64).tobytes(), "norms": norms[others].tobytes(),
        "angles": near[others].tobytes(), "rows": hn._joined([hn.packed(whole[i]) for i in others]), "low": low.tobytes(),
        "high": np.full(60, hn._HIGHEST).tobytes(),
    }, 5, True)
    scored = block.meet(shard)
    assert scored < 0.5 * 60 * len(members)
    for k, i in enumerate(others):
        values = whole[i] @ whole[members].T
        want = sorted(zip(-values, members))[:5]
        got = [(-s, j) for slot, s, j in zip(block.slot, block.score, block.id) if slot == k]
        assert got == [(int(s), int(j)) for s, j in want if -s >= low[k]]


def test_odd_rows(spark):
    draw = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in draw.normal(size=3)], int(i % 3)) for i in range(101)]
    rows += [rows[50], rows[50], rows[7]]  # repeated rows, anchors among them
    rows += [(100, [0.5, 0.25], 1), (203, [0.5, 0.3], 1), (204, [0.25, 0.2], 2)]  # another length
    rows += [(150, [], 1), (151, [], 1), (152, [], 2)]
    skipped = [
        (None, [1.0, 1.0, 1.0], 1), (250, None, 1), (300, [1.0, None, 0.0], 1), (350, [1.0, float("nan"), 0.0], 1),
        (400, [float("inf"), 0.0, 0.0], 1), (450, [1.0, 0.5, 0.0], None), (500, [1.7e308, 0.0, 0.0], 0),
    ]
    extra = [(*row, "x", 1) for row in rows + skipped]
    schema = SCHEMA + ", id string, score int"
    assert found(spark, extra, schema) == plain(rows)
    assert found(spark, [], SCHEMA) == []
    assert found(spark, [r for r in rows if r[2] == 1]) == []
    assert found(spark, skipped) == []


def test_large_numbers_are_exact(spark):
    rows = [(i, [2.0**19 * (1 + i / 40) + 3 * i, 2.0**10 * i, 1.0], i % 2) for i in range(120)]
    want = plain(rows)
    assert want and min(x[4] for x in want) > 2**53
    assert found(spark, rows) == want
    beyond = [(i, [2.0**60 * (1 + i), 1.0], i % 2) for i in range(60)]  # scores beyond a long are the nearest long
    for line in (hn.scores(np.array([[2.0**60, 1.0]]), np.array([[2.0**60, 1.0], [-(2.0**60), 1.0]])).tolist()):
        assert line == [hn._HIGHEST, hn._LOWEST]
    assert found(spark, beyond) == []  # no window lies below the highest score but holds it


@pytest.mark.parametrize("value", [0.0, 3.0, -3.0, 40_000.0, -(2.0**31), 2.0**60])
def test_packed_rows_come_back(value):
    row = np.array([value, 1.0, -2.0])
    assert (hn.unpacked([hn.packed(row)])[0] == row).all()


def test_query_equals_scoring_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, sf).collect()))
    table = spark.read.parquet(f"{sf}/embeddings.parquet").withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in table.collect()]
    assert got == plain(rows)
