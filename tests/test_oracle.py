import pytest

from checks.compare import difference, oracle
from checks.oracle import all_statements
from checks.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_every_statement_has_its_query():
    assert set(all_statements()) == set(all_queries()) - {"classify_ml"}


@pytest.mark.parametrize("name", sorted(all_statements()))
def test_query_equals_statement(spark, con, name):
    assert difference(all_queries()[name](spark, SF_DIR), con, all_statements()[name]) == ""


def test_trained_model_scores_every_item(spark):
    df = all_queries()["classify_ml"](spark, SF_DIR)
    rows = df.collect()
    assert len(rows) == 1500 and sum(r.category == r.label for r in rows) > 1300
