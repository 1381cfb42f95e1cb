import pytest

from voxsift.functions.text import clamp, strip
from voxsift import fixed_values as fv
from voxsift.operators import intake
from pyspark.sql import functions as F


def test_strip_removes_every_kind_of_whitespace(spark):
    padded = [(c + "a" + c + "b" + c, "a" + c + "b") for c in fv.WHITESPACE] + [(None, ""), ("\n\t ", "")]
    rows = spark.createDataFrame(padded, "t string, want string").select(strip(F.col("t")).alias("s"), "want")
    assert all(r.s == r.want for r in rows.collect())


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.4,), (7.0,)], "x double")
    assert [r[0] for r in df.select(clamp(F.col("x"), 0.0, 1.0)).collect()] == [None, 0.0, 0.4, 1.0]


@pytest.fixture
def items(spark):
    rows = [(f"R{i:03d}", "review", f"text {i}") for i in range(40)] + [
        (f"E{i:03d}", "email", f"mail {i}") for i in range(30)
    ]
    return spark.createDataFrame(rows, "source_id string, source_type string, text string").repartition(5)


@pytest.mark.parametrize("limit", [1, 7, 35, 500])
def test_limit_takes_emails_first(items, limit):
    got = sorted(r.source_id for r in intake.first_items(items, limit).collect())
    everything = sorted(r.source_id for r in items.collect())  # E.. before R..
    assert got == everything[:limit]


def test_a_limit_is_a_prefix_of_the_next(spark):
    rows = [("same", "review", f"text {i % 4}") for i in range(12)] + [(None, "review", "x"), ("z", None, None)]
    items = spark.createDataFrame(rows, "source_id string, source_type string, text string").repartition(4)
    before = []
    for limit in range(1, 16):
        now = sorted(map(str, intake.first_items(items, limit).collect()))
        assert len(now) == min(limit, 14)
        rest = list(now)
        for row in before:
            rest.remove(row)
        before = now


def test_limit_of_nothing_keeps_all_and_negative_fails(items):
    assert intake.first_items(items, 0).count() == 70
    assert intake.first_items(items, None).count() == 70
    with pytest.raises(ValueError):
        intake.first_items(items, -1)
