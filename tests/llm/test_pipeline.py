"""The whole chain against plain versions of its stages, on a small table."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from voxsift.llm.mixing import mix
from voxsift.llm.queries import tokenizer_file

from .test_quality_rules import plain as plain_quality
from .test_simhash import plain_components, plain_fingerprint


def cut_plain(rows):
    """Texts without 200-byte strings that start earlier; ASCII only."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        gone = [False] * len(text)
        for p in range(len(text) - 199):
            s = text[p:p + 200]
            if s in seen:
                gone[p:p + 200] = [True] * 200
            seen.add(s)
        out[i] = "".join(c for c, g in zip(text, gone) if not g)
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    shared, base = prose(70), prose(300)
    rows = [(i, prose(draw.randint(20, 200)) + (" " + shared + " " + prose(20) if i % 7 == 0 else "")) for i in range(60)]
    rows += [(100, base), (101, base), (102, base + " end"), (103, "too short"), (104, None), (105, ("# % & " * 5 + prose(20)) * 1)]
    table = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path), table


def test_run(spark, folder):
    path, table = folder
    good = {i for i, *_, kept in plain_quality([(i, t, lang, s) for i, t, lang, s, _ in table]) if kept}
    left = [(i, t) for i, t, *_ in table if i in good]
    low = plain_components([(i, plain_fingerprint(t)) for i, t in left])
    left = [(i, t) for i, t in left if low[i] == i]
    cut = cut_plain(left)
    source = {i: s for i, _, _, s, _ in table}
    docs = spark.createDataFrame([(i, t, source[i]) for i, t in cut.items()], "doc_id long, text string, source string")
    copies = {r.doc_id: r.copies for r in mix(docs).collect()}  # held against a plain version in test_mixing
    library, want = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json")), []
    for i, n in copies.items():
        ids = library.encode(cut[i], add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 1024):
            piece = np.array(ids[start:start + 1024], "<u4")
            want += [(i, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))] * n
    got = corpus_pipeline.run(spark, path).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(want)
    assert len(good) < len(table) and len(left) < len(good) and any(cut[i] != t for i, t in left)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").selectExpr("*", "doc_id AS uid", "text AS q_row", "1 AS size", "2 AS copies")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder[0])
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "uid", "q_row", "size", "copies"]
    assert docs.count() > 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
