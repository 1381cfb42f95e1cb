from checks import store


def _orders(spark):
    return spark.range(40).selectExpr("id AS o_orderkey", "date_add(DATE '2024-01-01', cast(id AS INT)) AS o_orderdate")


def test_a_stored_run_writes_only_what_is_asked_for(spark, tmp_path):
    _orders(spark).write.parquet(f"{tmp_path}/orders.parquet")
    run = store.stored_run(spark, str(tmp_path))
    assert run.outcome.count() == 40 and not run._stored
    assert run.metrics.selectExpr("sum(total_processed) AS n").first().n == 40
    assert list(run._stored) == ["metrics"] and store.stored_run(spark, str(tmp_path)) is run
    assert run.tickets.count() == run.outcome.filter("disposition = 'created'").count()
