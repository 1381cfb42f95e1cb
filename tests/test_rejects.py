import contextlib
import io
import re

from checks import spine
from voxsift.operators import responses as rs


def _orders(spark):
    return spark.range(40).selectExpr("id AS o_orderkey", "date_add(DATE '2024-01-01', cast(id AS INT)) AS o_orderdate")


def _longest_method(df) -> int:
    """Bytes of the longest generated method; the JVM compiles none over 8,000."""
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        df.explain("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", told.getvalue())))


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_recorded_responses_are_compiled(spark, tmp_path):
    _orders(spark).write.parquet(f"{tmp_path}/orders.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _longest_method(spine.responses(spark, str(tmp_path))) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rejects_parse_a_response_once(spark):
    recorded = spark.range(3).selectExpr("cast(id AS STRING) AS source_id", "'bug' AS stage", "1 AS attempt", "repeat('x', id) AS raw")
    parsed, rejected = (_plan(df).count("from_json(StructField(category") for df in (rs.parse(recorded), rs.rejects(recorded)))
    assert (parsed, rejected) == (1, 1)
