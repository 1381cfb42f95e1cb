"""The mix against a plain sort per source, and its promises on odd input."""

import hashlib
import re
from collections import defaultdict

import pytest

from voxsift.llm.mixing import mix, mixed_rows


def plain_targets(sizes, weights=(1.0, 2.0, 3.0), most=3.0):
    """Cut off and share out again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else share[s] for s in names}
        full |= over


ROWS = (
    [(i, "w " * (1 + i * 31 % 97), ["a", "b", "c", "d", "é", None][i % 6]) for i in range(300)]
    + [(1000 + i, "x y", "tiny") for i in range(4)]
    + [(2000, None, "a"), (2001, "", "b"), (2002, " \n", "empty"), (5, "w " * 59, "é"), (2003, "long " * 20000, "a"), (None, "no id", "a")]
)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS m_u", "'x' AS target")


def test_targets_and_copies(docs):
    got = mix(docs).collect()
    sizes = defaultdict(int)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for _, text, source in ROWS:
        sizes[source] += size(text)
    goal = plain_targets(sizes)
    taken = defaultdict(int)
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in got) == sorted((str(i), str(s), size(t)) for i, t, s in ROWS)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert 0 <= r.copies <= 3
        if r.size:
            assert int(r.target / r.source_size + 1e-9) <= r.copies <= r.target / r.source_size + 1
        taken[r.source] += r.copies * r.size
    for source, words in taken.items():
        largest = max(size(t) for _, t, s in ROWS if s == source)
        assert abs(words - goal[source]) <= largest / 2 + 1


def test_order_is_that_of_the_draws(docs):
    rows = [r for r in mix(docs).collect() if r.source == "b" and r.size]
    draw = lambda i: int(hashlib.md5(f"{i}:11".encode()).hexdigest()[:13], 16)
    copies = [r.copies for r in sorted(rows, key=lambda r: draw(r.doc_id))]
    assert copies == sorted(copies, reverse=True)


def test_reruns_agree(docs):
    assert sorted(mix(docs.repartition(7)).collect(), key=str) == sorted(mix(docs.repartition(2)).collect(), key=str)


def test_rows_of_the_mix(docs):
    want = sum(r.copies for r in mix(docs).collect())
    got = mixed_rows(docs)
    assert got.columns == docs.columns and got.count() == want


def test_weighted_documents_keep_near_the_target(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 9 AS int)) AS text", "if(id % 10 < 9, 'a', 'b') AS source", "double(1 + id % 2) AS w")
    rows = mix(docs, weight_col="w").collect()
    for source in "ab":
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) < 30 or mine[0].target == pytest.approx(3 * mine[0].source_size)


def test_empty_table(docs):
    assert mix(docs.limit(0)).collect() == []


def plain_due(sizes, weights, target, most=3.0):
    """Copies due: level * weight, at most the limit, so that all together fill the target."""
    low, high = 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        if sum(n * min(most, mid * w) for n, w in zip(sizes, weights)) < target:
            low = mid
        else:
            high = mid
    return [min(most, high * w) for w in weights]


@pytest.mark.parametrize("heavy", [1e6, 40.0, 1.0])
def test_what_the_limit_cuts_off_is_shared_out(spark, heavy):
    """A few documents hold nearly all of the weight, and can be taken three times only."""
    rows = [(i, "w " * (1 + i % 7), "a" if i % 5 else "b", heavy ** (i % 4) if i % 50 < 3 else 1.0 + i % 3) for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    got = {r.doc_id: r for r in mix(docs, weight_col="w").collect()}
    for source in "ab":
        mine = [(i, len(t.split()), w) for i, t, s, w in rows if s == source]
        target = got[mine[0][0]].target
        due = plain_due([n for _, n, _ in mine], [w for *_, w in mine], target)
        assert abs(sum(got[i].copies * n for i, n, _ in mine) - target) <= 8
        for (i, _, _), expected in zip(mine, due):
            assert int(expected + 1e-6) <= got[i].copies <= expected + 1 + 1e-6


def test_weights_that_are_no_weights(spark):
    odd = [None, float("nan"), float("inf"), -1.0, 0.0]
    rows = [(i, "a b c", "s", 1.0 if i >= 50 else odd[i % 5]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    got = mix(docs, weight_col="w").collect()
    assert len(got) == 200 and all(r.copies == 0 for r in got if r.doc_id < 50)
    assert abs(sum(r.copies * r.size for r in got) - 600) <= 2
    none = mix(docs.where("doc_id < 50"), weight_col="w").collect()
    assert len(none) == 50 and all(r.copies == 0 for r in none)


def test_buckets_of_weighted_sources_are_even(spark, monkeypatch):
    from voxsift.llm import mixing

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    draw = spark.range(6000).selectExpr("id AS doc_id", "'s' AS source", "cast(1 + id % 5 AS long) AS size", "pow(10D, id % 6) AS m_weight")
    placed = mixing._ranked(draw, (1.0,), 3, 11, weighted=True)
    counts = [r["count"] for r in placed.where("m_bucket >= 0").groupBy("source", "m_bucket").count().collect()]
    assert max(counts) <= 120 and len(counts) > 100
