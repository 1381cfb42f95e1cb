"""Exact round trips, and archives that are broken on purpose."""

import pytest

from voxsift.llm import warc

ROWS = [
    (1, "http://a", "<p>same</p>"), (2, "http://b\r\nX: y", "<p>same</p>"), (9, None, "<p>same</p>"), (3, "u", None), (4, "u", ""),
    (5, "u", "x\r\n\r\ny WARC/1.1\r\n"), (6, "é", "äöü€\U0001f600" * 9000), (7, "u", "y" * 400_000), (8, "u", "y" * 400_000),
    (12, "u", "z" * (warc.SEGMENT_BYTES - 200)), (-3, "u", "negative"), (20, "u", "short"), (20, "u", "longer one"), (None, "u", "no id"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3).selectExpr("*", "1 AS payload", "2 AS digest", "'x' AS kind")


def plain(rows):
    """A record per row: of equal payloads one of those with the largest page_id is the response."""
    out, answered = [], set()
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0))):
        payload = (html or "").encode()
        top = next((r[0] for r in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0))) if (r[2] or "").encode() == payload))
        kind = "revisit" if payload in answered else "response"
        answered.add(payload)
        out.append((page_id, len(payload), warc.base32_sha1(payload), kind, top if kind == "revisit" else None))
    return sorted(out, key=str)


def test_round_trip(pages):
    assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str) == plain(ROWS)


@pytest.mark.parametrize("rows", [
    [(1, "u", "a"), (1, "v", "a"), (1, "w", "b")],
    [(None, "u", "a"), (None, "u", "a"), (3, "u", "b"), (None, None, None), (None, None, None)],
    [(5, "u", "y" * 200_000)] * 3 + [(4, "u", "y" * 200_000), (5, "u", "z" * 200_000), (None, "u", "z" * 200_000)],
])
def test_a_record_for_each_row(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    assert sorted((tuple(r) for r in warc.round_trip(table).collect()), key=str) == plain(rows)


def test_short_payloads_are_all_responses(spark, tmp_path):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (2, "u", "a" * 300_000), (2, "u", "a" * 300_000)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "short"), least_bytes=2)
    records = warc.read_records(spark, str(tmp_path / "short"))
    got = warc.reassemble(records).collect()
    assert sorted(r.kind for r in got) == ["response"] * 4 + ["revisit"]
    own = [r["page_id"] for r in got]
    assert sorted(own, key=str) == [1, 1, 2, 2, None]


def test_the_statement_knows_repeated_ids(spark, tmp_path):
    import duckdb

    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, "u", "b"), (2, "u", "b"), (2, "u", "c"), (None, "u", None), (None, "u", None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    table.write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    assert sorted(con.execute(warc.STATEMENT).fetchall(), key=str) == sorted((tuple(r) for r in warc.round_trip(table).collect()), key=str)


def test_payloads_come_back(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path / "archive"))
    records = warc.read_records(spark, str(tmp_path / "archive"))
    assert records.where("kind = 'continuation'").count() > 5
    got = {r.page_id: r for r in warc.reassemble(records).collect()}
    assert bytes(got[6].payload) == ("äöü€\U0001f600" * 9000).encode() and got[6].url == "é"
    assert got[7].payload is None and got[7].refers_to == 8 and got[2].url == "http://b X: y"
    for broken in (records.where("NOT (page_id = 6 AND number = 2)"), records.where("NOT (page_id = 6 AND total IS NOT NULL)"), records.unionByName(records.where("number = 2"))):
        with pytest.raises(Exception, match="segments of page"):
            warc.reassemble(broken).collect()


def test_segments_are_standard_records():
    made = warc.segments(warc.record_id(1, "x"), "u", b"p" * 200_000, size=50_000)
    fields = [f for f, _ in warc.parse(iter([b"\r\n\r\n".join([*made, b""])]))]
    assert [f["WARC-Type"] for f in fields] == ["response"] + ["continuation"] * (len(made) - 1)
    assert [f["WARC-Segment-Number"] for f in fields] == [str(k + 1) for k in range(len(made))]
    assert [("WARC-Segment-Total-Length" in f) for f in fields] == [False] * (len(made) - 1) + [True]


def test_chunks():
    for payload in (b"", b"a", b"ab\r\n0\r\n\r\n", bytes(range(256)) * 300):
        assert warc.unchunked(warc.chunked(payload, 100)) == payload
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_empty_table(pages):
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_archives_have_bounded_bytes(spark, tmp_path, monkeypatch):
    import gzip

    monkeypatch.setattr(warc, "GROUP_BYTES", 10_000)
    monkeypatch.setattr(warc, "FILE_GROUPS", 3)
    rows = [(i, "u", f"{i} " * (20 if i % 9 else 30_000)) for i in range(400)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), str(tmp_path / "a"))
    sizes = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "a").glob("part-*")]
    assert max(sizes) <= 3 * (10_000 + warc.SEGMENT_BYTES + 600) and sorted(sizes)[len(sizes) // 2] > 10_000
    assert warc.reassemble(warc.read_records(spark, str(tmp_path / "a"))).count() == 400
