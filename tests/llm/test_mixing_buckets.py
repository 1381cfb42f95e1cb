"""Buckets of equal-weight sources are even, whatever part of a copy the documents are due."""

import pytest

from voxsift.llm import mixing


@pytest.mark.parametrize("source", ["'only'", "if(id % 50 = 0, 'a', 'b')"])
def test_no_bucket_holds_most_of_a_source(spark, monkeypatch, source):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 100)
    narrow = spark.range(4000).selectExpr("id AS doc_id", f"{source} AS source", "1 + id % 9 AS size", "1.0D AS m_weight")
    rows = mixing._ranked(narrow, (1.0, 2.0, 3.0), 3, 11, weighted=False)
    assert rows.groupBy("source", "m_bucket").count().agg({"count": "max"}).first()[0] < 200
