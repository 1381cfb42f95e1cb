import contextlib
import io
import re

from checks import spine
from voxsift.functions.picks import fill


def _orders(spark):
    return spark.range(40).selectExpr("id AS o_orderkey", "date_add(DATE '2024-01-01', cast(id AS INT)) AS o_orderdate")


def _longest_method(df) -> int:
    """Bytes of the longest generated method; the JVM compiles none over 8,000."""
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        df.explain("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", told.getvalue())))


def test_texts_of_items_are_compiled(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _longest_method(spine.items_of(_orders(spark))) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_fill_keeps_slots_without_a_value_and_null_templates(spark):
    filled = fill("template", {"a": "a", "b": "b"})
    rows = spark.createDataFrame(
        [("{a}-{b}-{a}-{c}", "1", None), (None, "1", "2"), ("", "1", "2")], "template string, a string, b string"
    ).selectExpr(f"{filled} AS text").collect()
    assert [r.text for r in rows] == ["1-{b}-1-{c}", None, ""]
    assert fill("template", {}) == "template"
