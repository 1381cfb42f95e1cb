import random

import pytest
from pyspark.sql import functions as F

from voxsift.operators import evaluation, scoring
from voxsift.plans import generate as gen


def monotone_least_squares(hits, rows):
    """The rising fit by its definition: the largest over starts of the smallest over ends of the mean."""
    n = len(rows)

    def mean(a, b):
        total = sum(rows[a:b + 1])
        return sum(hits[a:b + 1]) / total if total else None

    out = []
    for i in range(n):
        best = None
        for a in range(i + 1):
            means = [m for b in range(i, n) if (m := mean(a, b)) is not None]
            if means and (best is None or min(means) > best):
                best = min(means)
        out.append(best)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_pooled_bins_are_the_best_rising_fit(seed):
    draw = random.Random(seed)
    rows = [draw.randrange(1, 9) for _ in range(12)]
    hits = [draw.randrange(r + 1) for r in rows]
    got = scoring.pool_adjacent_violators(hits, rows)
    assert got == pytest.approx(monotone_least_squares(hits, rows)) and got == sorted(got)


def test_empty_bins():
    assert scoring.pool_adjacent_violators([0, 0, 0], [0, 0, 0]) == [0.0] * 3
    shares = scoring.pool_adjacent_violators([0, 1, 0, 4], [0, 2, 0, 4])
    assert shares == sorted(shares) and shares[1] == 0.5 and shares[3] == 1.0


def test_confidence_is_the_share_of_right_answers(spark):
    # a scorer that is overconfident: says 0.9 and is right in 6 of 10, says 0.5 and is right in 3 of 10
    rows = [("Bug" if i % 10 < (6 if high else 3) else "Spam", "Bug", 0.9 if high else 0.5) for high in (0, 1) for i in range(500)]
    scored = spark.createDataFrame(rows, "label string, category string, confidence double")
    fitted = scoring.fit_calibration(scored)
    again = scored.withColumn("confidence", fitted.confidence(F.col("confidence")))
    assert {round(r.confidence, 6) for r in again.select("confidence").distinct().collect()} == {0.3, 0.6}
    error = evaluation.calibration_error(evaluation.calibration_table(again)).first()
    assert error["items"] == 1000 and error["error"] == pytest.approx(0, abs=1e-9)
    before = evaluation.calibration_error(evaluation.calibration_table(scored)).first()
    assert before["error"] > 0.2
    edges = spark.createDataFrame([(0.0,), (1.0,), (0.999,)], "s double").select(fitted.confidence(F.col("s")).alias("c"))
    assert all(0 <= r.c <= 1 for r in edges.collect())


def test_held_out_items_are_scored_once_and_calibrated(spark):
    reviews, emails, labels = gen.generate(spark, 900, 400, seed=3)
    from voxsift.operators.intake import unify

    labelled = unify(reviews, emails).join(labels.select("source_id", "source_type", F.col("category").alias("label")), ["source_id", "source_type"])
    scored = scoring.cross_calibrated(labelled).cache()
    assert scored.count() == 1300 and scored.filter("confidence < 0 OR confidence > 1 OR category IS NULL").count() == 0
    right = scored.filter("label = category").count() / 1300
    error = evaluation.calibration_error(evaluation.calibration_table(scored)).first()["error"]
    assert right > 0.9 and error < 0.06
