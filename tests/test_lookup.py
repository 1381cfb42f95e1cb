import pytest
from pyspark.sql import functions as F

from voxsift.functions.lookup import HOT_KEYS, hot_keys, lookup
from voxsift.functions.positions import with_positions


@pytest.fixture
def skewed(spark):
    """A third of the rows share a key, many have none, the rest is spread thin."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), n % 5000))
    return spark.range(0, 30000, 1, 40).select("id", key.alias("key"))


@pytest.fixture
def entries(spark):
    names = spark.range(0, 4000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") * 2).alias("v"))
    return names.unionByName(spark.createDataFrame([("hot", -1)], "key string, v bigint"))


@pytest.fixture
def large_table_rules(spark):
    """Joins as with a large table: nothing is broadcast or merged for being small."""
    rules = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in rules.items():
        spark.conf.set(name, value)
    yield
    for name in rules:
        spark.conf.unset(name)


def test_lookup_equals_a_plain_join_and_spreads_the_load(large_table_rules, skewed, entries):
    got = lookup(skewed, entries, "key")
    assert got.columns == ["id", "key", "v"]
    want = skewed.join(entries, "key", "left").select("id", "key", "v")
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)

    def largest_task(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    assert largest_task(want) > 30000 / 3 > largest_task(got)


def test_only_frequent_keys_are_hot_and_never_more_than_the_bound(spark, skewed):
    counts = skewed.groupBy("key").count()
    assert set(hot_keys(counts, "key", "count")) == {"hot", None}
    even = spark.range(100000).groupBy((F.col("id") % (HOT_KEYS + 200)).alias("key")).count()
    assert len(hot_keys(even, "key", "count")) <= HOT_KEYS
    assert hot_keys(counts.limit(0), "key", "count") == []


def test_lookup_without_hot_keys(spark, entries):
    left = spark.range(5000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    rows = {r.id: r.v for r in lookup(left, entries, "key").collect()}
    assert len(rows) == 5000 and rows[10] == 20 and rows[4500] is None


def test_positions_are_dense_and_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("x"), F.lit("same").alias("y"))
    rows = with_positions(df, ["x"], "n").collect()
    assert all(r.n == r.x + 1 for r in rows) and len(rows) == 5000
    copies = sorted(r.n for r in with_positions(df.select("y"), ["y"], "n").collect())
    assert copies == list(range(1, 5001))
