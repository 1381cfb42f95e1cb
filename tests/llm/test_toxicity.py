import zlib

import numpy as np
import pytest

from voxsift.llm import toxicity as tx
from voxsift.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def random_vectors(n, n_terms, seed=0):
    draw = np.random.default_rng(seed)
    made = []
    for _ in range(n):
        terms = np.sort(draw.choice(n_terms, min(n_terms, draw.integers(0, 12)), replace=False)).astype(np.int64)
        weights = draw.choice([0.5, 1.0, 2.0], len(terms))
        made.append((terms, weights / np.sqrt((weights**2).sum()) if len(terms) else weights))
    return made


@pytest.mark.parametrize("n, n_terms", [(0, 5), (3, 5), (700, 40), (700, 400)])
def test_neighbours_equal_those_of_all_cosines(n, n_terms):
    vectors = random_vectors(n, n_terms)
    ids, labels = [(7 * i) % 1009 for i in range(n)], [i % 3 == 0 for i in range(n)]
    index = tx.Index.build(ids, [int(y) for y in labels], vectors, n_terms)
    dense = np.zeros((n, n_terms))
    for i, (terms, weights) in enumerate(vectors):
        dense[i, terms] = weights
    for terms, weights in random_vectors(60, n_terms, seed=1):
        query = np.zeros(n_terms)
        query[terms] = weights
        cosines = np.round(dense @ query, 12)
        want = sorted(((c, i, int(y)) for c, i, y in zip(cosines.tolist(), ids, labels) if c > 0), key=lambda x: (-x[0], x[1]))
        got = index.nearest(terms, weights, k=9)
        assert [x[1:] for x in got] == [x[1:] for x in want[:9]]
        assert np.allclose([x[0] for x in got], [x[0] for x in want[:9]])
        assert [x[1] for x in index.nearest(terms, weights, k=9, without=14)] == [x[1] for x in want if x[1] != 14][:9]


def test_bounds_leave_blocks_unvisited(monkeypatch):
    vectors = random_vectors(4000, 300)
    index = tx.Index.build(list(range(4000)), [0] * 4000, vectors, 300)
    looked = []
    unique = np.unique
    monkeypatch.setattr(tx.np, "unique", lambda a, **k: (looked.append(len(a)), unique(a, **k))[1])
    total = 0
    for terms, weights in vectors[:50]:
        index.nearest(terms, weights, k=3)
        total += int(np.isin(index.term, terms).sum())
    assert sum(looked) < 0.5 * total


def test_curve_rises_and_keeps_the_mean():
    draw = np.random.default_rng(3)
    votes = np.round(draw.random(500), 2)
    labels = (draw.random(500) < votes**2).astype(int)
    x, y = tx.monotone_curve(votes, labels)
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()
    by_hand = np.interp(votes, x, y)
    assert abs(by_hand.mean() - labels.mean()) < 0.02
    assert tx.monotone_curve(np.zeros(0), np.zeros(0))[0].size == 0


def test_held_out_documents_are_told_apart(spark):
    rows = QUERIES["op12_toxicity"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]).all()
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()
    judged = rows[rows.held_out].merge(labels, on="doc_id")
    hit = (judged.predicted == 1) & (judged.toxic == 1)
    # one toxic label in twenty is on a text without any toxic word
    assert hit.sum() >= 0.92 * (judged.toxic == 1).sum()
    assert hit.sum() >= 0.95 * (judged.predicted == 1).sum()
    assert len(judged) > 500
    # calibration: where many rows have a like score, their share of toxic ones is like it
    for low, high in ((0, 0.1), (0.9, 1.01)):
        part = judged[judged.score.between(low, high, inclusive="left")]
        assert abs(part.score.mean() - part.toxic.mean()) < 0.05


def test_vectors_count_as_the_terms_are_defined():
    text = "Achtung achtsam ACHT achtzig x " + "word " * 4
    counts = tx.term_counts(text)
    assert counts["acht"] == 4 and counts["acht*2"] == counts["acht*3"] == counts["word$*3"] == 1 and "achtun*2" not in counts
    names = sorted(["acht", "acht*3", "achtung$", "word$*2", "none*2"])
    vectors = tx.Vectors({t: i for i, t in enumerate(names)}, np.array([1.0, 2.0, 3.0, 4.0, 5.0]))
    terms, weights = vectors.of(text)
    want = {t: (1 + np.log(counts[t])) * (i + 1) for i, t in enumerate(names) if counts[t]}
    assert [names[t] for t in terms] == list(want)
    assert np.allclose(weights, np.array(list(want.values())) / np.sqrt(sum(v * v for v in want.values())))


def toy(spark):
    bad, good = "you nasty wretch begone", "a calm day by the quiet sea"
    docs = [(i, f"{bad if i % 3 == 0 else good} word{i % 5}") for i in range(120)]
    labels = [(i, int(i % 3 == 0)) for i in range(120)]
    return docs, labels


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs, labels = toy(spark)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    first, second = (
        {r.doc_id: (r.score, r.evidence) for r in tx.toxicity(frame, spark.createDataFrame(ls, "doc_id long, toxic int")).collect()} for ls in (labels, turned)
    )
    assert first == second
    assert all((score >= 0.3) == (i % 3 == 0) for i, (score, _) in first.items())
    assert all(zlib.crc32(str(e["example"]).encode()) % 4 != 2 for _, near in first.values() for e in near)


def test_odd_rows(spark):
    docs, labels = toy(spark)
    docs = [(*d, "x") for d in docs + [(None, None), (None, "nasty wretch"), (500, ""), (500, ""), (3, "you nasty wretch begone"), (501, "nasty " * 300_000)]]
    labels = [(*x, "y") for x in labels + [(None, 1), (7, None), (8, 5), (3, 0), (900, 1)]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = tx.toxicity(frame, marks).collect()
    assert len(got) == len(docs)
    empty = [r for r in got if r.doc_id == 500]
    assert len(empty) == 2 and all(r.evidence == [] and 0 < r.score < 1 for r in empty)
    assert len({r.score for r in got if not r.evidence}) == 1
    assert [r.predicted for r in got if r.doc_id == 501] == [1]
    assert all(not r.held_out for r in got if r.doc_id is None)
    none = tx.toxicity(frame, marks.where("toxic > 9")).collect()
    assert len(none) == len(docs) and {r.score for r in none} == {0.0}
    assert tx.toxicity(frame.limit(0), marks).count() == 0


def test_sample_and_index_keep_their_bounds(spark):
    docs, labels = toy(spark)
    frame = spark.createDataFrame(docs + [(1, f"another {k}") for k in range(50)], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert tx.sample(frame, marks, 20).count() <= 20
    model = tx.fit(frame, marks, postings=40)
    assert len(model.index.term) <= 40
