import random

import pytest

from voxsift.functions import selection


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(selection, "TAKEN", 3)
    monkeypatch.setattr(selection, "DRAWN", 40)


def table(spark, n=700):
    draw = random.Random(3)
    values = [("a", "hot")] * (n // 3) + [(None, None)] * 5 + [("b", None), (None, "x")]
    values += [(draw.choice("abc"), f"{draw.randrange(10**6)}") for _ in range(n - len(values))]
    draw.shuffle(values)
    rows = spark.createDataFrame(values, "x string, y string").repartition(5)
    order = sorted(values, key=lambda v: tuple((p is not None, p or "") for p in v))
    return rows, order


@pytest.mark.parametrize("n", [1, 2, 8, 9, 200, 233, 234, 240, 300, 500, 699, 700])
def test_the_key_at_a_place_is_that_of_the_sorted_table(spark, small, n):
    rows, order = table(spark)
    assert tuple(selection.nth_key(rows, ["x", "y"], n)) == order[n - 1]


def test_beyond_the_end_there_is_none(spark, small):
    rows, _ = table(spark)
    assert selection.nth_key(rows, ["x", "y"], 701) is None
    assert selection.nth_key(rows.limit(0), ["x", "y"], 1) is None
    assert selection.first_rows(rows, ["x", "y"], 10_000) == (None, None, 0)
    with pytest.raises(ValueError):
        selection.nth_key(rows, ["x", "y"], 0)


def test_nothing_is_sorted_or_moved_but_counts_and_samples(spark, monkeypatch):
    rows = spark.range(0, 200_000, 1, 8).selectExpr("cast(id * 7919 % 200003 AS STRING) AS x")
    want = sorted(str(i * 7919 % 200003) for i in range(200_000))
    monkeypatch.setattr(selection, "TAKEN", 100)
    for n in (50, 150_000):
        assert selection.nth_key(rows, ["x"], n)["x"] == want[n - 1]
