"""Counts and verdicts against a plain version, with quantiles taken from sorted lists."""

import math
import re
from collections import Counter, defaultdict

import pytest

from voxsift.llm import quality_rules as q


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
    failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
    capitals = sum(c.isupper() and c.lower() != c for c in text)
    share = lambda a, b: a / b if b else 0.0
    shares = (share(counts[2], counts[0]), share(counts[3], len(lines)), share(counts[4], counts[0]), share(capitals, counts[1]))
    return counts, failed, shares


def plain(rows):
    told = [(i, lang, source, *plain_counts(text)) for i, text, lang, source in rows]
    groups = defaultdict(list)
    for _, lang, source, _, failed, shares in told:
        if not failed:
            for key in ((lang, source), (lang,), ()):
                groups[key].append(shares)

    def fence(lang, source):
        key = next((k for k in ((lang, source), (lang,)) if len(groups[k]) >= q.LEAST_ROWS), ())
        found = []
        for m, margin in enumerate(q.MARGINS.values()):
            values = sorted(s[m] for s in groups[key])
            if not values:
                return [math.inf] * 4
            at = lambda p: values[max(0, math.ceil(p * len(values)) - 1)]
            found.append(at(0.75) + max(margin, q.SPREAD * (at(0.75) - at(0.25))))
        return found

    return [(i, *counts, failed, not failed and all(s <= f for s, f in zip(shares, fence(lang, source)))) for i, lang, source, counts, failed, shares in told]


PROSE = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [
    None, "", " \n\t\n", "few words", PROSE, PROSE.upper(), PROSE + "\n" + PROSE, "a b c d e " * 3, "# $ % & | < > * " + PROSE,
    "x " * 3 + PROSE + " a b c d e f a b c d e g", "a\nb\na\n \nb\nc " + PROSE, "é ü ñ ß Ä Ö " + PROSE, "a b c d e f g h i j\x0bk\x0cl\rm\x1cn", "long word " * 9000,
    "\n".join([PROSE] * 2 + ["z"]), "a b c d e x a b c d e", "q w e r t y u i o p q w e r t",
]


@pytest.fixture(scope="module")
def rows():
    plenty = [(100 + i, f"{PROSE} {i} {i * 7} {'#' * (i % 9 == 0)}\nmore {i}", "en", "s1" if i % 3 else None) for i in range(120)]
    return [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 2]) for i, t in enumerate(TEXTS)] + plenty + [(4, PROSE, "en", "s1")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.selectExpr("*", "1 AS q", "2 AS q_words", "3 AS q_lang", "'x' AS kept").repartition(3)


def test_quality(docs, rows):
    assert sorted(tuple(r) for r in q.quality(docs).collect()) == sorted(plain(rows))


def test_kept_rows(docs, rows):
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, *_, good in plain(rows) if good)


def test_empty_table(docs):
    assert q.quality(docs.limit(0)).collect() == [] and q.keep_good(docs.limit(0)).collect() == []


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    told = q.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    judged = [r for r in told if not r.base_failed]
    assert sum(r.kept for r in judged if r.quality) > 0.97 * sum(1 for r in judged if r.quality)
    assert sum(not r.kept for r in told if not r.quality) > 0.95 * sum(1 for r in told if not r.quality)


@pytest.mark.parametrize("texts", [["short"], [None], ["a b c d e " * 400], ["short", None, "a b c d e " * 400, "", "x"]])
def test_no_document_passes_the_base_rules(spark, texts):
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None, "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = q.quality(docs).collect()
    assert len(got) == len(texts) and all(r.base_failed and not r.kept for r in got)
    assert q.keep_good(docs).count() == 0
    with_one = docs.unionByName(spark.createDataFrame([(99, " ".join(f"w{i}" for i in range(60)), None, None)], docs.schema))
    assert [r.doc_id for r in q.quality(with_one).collect() if r.kept] == [99]


def test_fences_of_a_large_group_keep_to_the_error_of_the_sketch(spark):
    """More values than a sketch holds: quartiles may be off by RANK_ERROR of the ranks, whatever is drawn."""
    value = "((id * 7919) % 60013) / 60013D"
    shares = ", ".join(f"'{name}', {value}" for name in q.MARGINS)
    rows = spark.range(0, 60_013, 1, 7).selectExpr("'en' AS q_lang", "'s' AS q_source", f"named_struct('base_failed', false, 'shares', named_struct({shares})) AS q")
    assert 60_013 > 10 * q.SKETCH_K
    fence = q.fences(rows).first()["q_fence"]
    for name, margin in q.MARGINS.items():
        want = 0.75 + max(margin, q.SPREAD * 0.5)
        assert abs(fence[name] - want) <= q.RANK_ERROR * (1 + 2 * q.SPREAD)
