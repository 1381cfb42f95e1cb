from collections import Counter

import pytest
from pyspark.sql import functions as F

from voxsift import fixed_values as fv, schemas
from voxsift.operators import evaluation
from voxsift.operators.scoring import cross_scored, rule_scorer
from voxsift.plans import generate as gen


@pytest.fixture(scope="module")
def data(spark):
    return [df.cache() for df in gen.generate(spark, seed=5)]


def test_default_size_quota_and_ids(data):
    reviews, emails, labels = data
    assert reviews.columns == gen.REVIEW_COLUMNS and emails.columns == gen.EMAIL_COLUMNS
    assert labels.columns == schemas.LABELS.names
    assert sorted(r.review_id for r in reviews.collect()) == [f"REV{i:05d}" for i in range(1, 121)]
    counts = Counter((r.source_type, r.category) for r in labels.collect())
    assert counts == {("review", "Bug"): 36, ("review", "Feature Request"): 30, ("review", "Praise"): 24,
                      ("review", "Complaint"): 18, ("review", "Spam"): 12,
                      ("email", "Bug"): 36, ("email", "Feature Request"): 24}


def test_rows_fit_their_label(data):
    reviews, emails, labels = data
    label = {r.source_id: r for r in labels.collect()}
    for r in reviews.collect():
        assert r.rating in fv.RATINGS[label[r.review_id].category]
        assert "{" not in r.review_text
    for r in emails.collect():
        assert r.priority in fv.EMAIL_PRIORITIES[label[r.email_id].category]
        assert "{" not in r.body and r.sender_email.count("@") == 1
    for r in label.values():
        percents = dict(zip(fv.PRIORITIES, fv.LABEL_PRIORITY_PERCENT[r.category]))
        assert percents[r.priority] > 0
        assert bool(r.technical_details) == (r.category == "Bug")
        if r.category == "Bug":
            assert ("App version" in r.technical_details) == (r.source_type == "email")


def test_seed_repeats_and_changes(spark, data):
    again = gen.generate(spark, seed=5)[0]
    other = gen.generate(spark, seed=6)[0]
    assert sorted(again.collect()) == sorted(data[0].collect()) != sorted(other.collect())


@pytest.mark.parametrize("n", [0, 1, 7, 13])
def test_any_size(spark, n):
    reviews, emails, labels = gen.generate(spark, n, n)
    assert (reviews.count(), emails.count(), labels.filter(F.col("category").isNotNull()).count()) == (n, n, 2 * n)


def test_distribution(data):
    rows = {(r.kind, r.value): r["items"] for r in gen.distribution(data[2]).collect()}
    assert rows[("review category", "Bug")] == 36
    assert sum(n for (kind, _), n in rows.items() if kind == "priority") == 180


def test_scorers_on_labelled_items(spark):
    from voxsift.operators.intake import unify

    reviews, emails, labels = gen.generate(spark, 400, 200, seed=1)
    items = unify(reviews, emails)
    pairs = evaluation.confusion(rule_scorer(items), labels)
    row = evaluation.accuracy(pairs).first()
    assert row["items"] == 600 and row.accuracy > 0.8
    labelled = items.join(labels.selectExpr("source_id", "category AS label"), "source_id")
    scored = cross_scored(labelled.select("source_id", "source_type", "text", "label"))
    rows = scored.collect()
    assert len(rows) == 600 and all(r.category in fv.CATEGORIES and 0 <= r.confidence <= 1 for r in rows)
    assert sum(r.category == r.label for r in rows) > 500


def test_evaluation(spark):
    def frame(rows, names):
        return spark.createDataFrame(rows, names)

    labels = frame([("r", "1", "Bug"), ("r", "2", "Bug"), ("r", "3", "Spam"), ("e", "1", "Spam")],
                   "source_type string, source_id string, category string")
    predicted = frame([("r", "1", "Bug", False), ("r", "2", "Spam", False), ("r", "3", "Spam", False),
                       ("e", "1", None, True), ("e", "9", "Bug", False)],
                      "source_type string, source_id string, category string, failed_response boolean")
    pairs = evaluation.confusion(predicted, labels)
    assert {(r.actual, r.predicted): r["items"] for r in pairs.collect()} == {
        ("Bug", "Bug"): 1, ("Bug", "Spam"): 1, ("Spam", "Spam"): 1, ("Spam", "none"): 1}
    per = {r.category: r for r in evaluation.per_class(pairs).collect()}
    assert (per["Bug"].precision, per["Bug"].recall, per["Bug"].f1) == (1.0, 0.5, round(2 / 3, 6))
    assert (per["Spam"].support, per["Spam"].predicted, per["Spam"].hits) == (2, 2, 1)
    matrix = {r.actual: r for r in evaluation.confusion_matrix(pairs).collect()}
    assert matrix["Spam"].predicted_none == 1 and matrix["Bug"].predicted_praise == 0
