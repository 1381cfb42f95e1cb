"""WARC archives: writing with segments and revisits, reading with reassembly.

Writing: each page becomes one logical record. Of pages with equal payloads the
one with the largest page_id is a response; the others are revisit records that
refer to it. A response is an HTTP message in chunked transfer coding, cut into
segments of bounded size: the first one is the response record itself, the
others are continuation records that name its id, their number and, in the
last, the total length. So no record, no archive file and no task holds more
than its bound, however long a page is.

The archives are plain WARC/1.1 text files in the shared folder, gzipped as a
whole. Spark's text writer puts the two line ends that close a record between
records, which is what its line separator is set to.

Reading: archive files are parsed into records. Records of one segment are
decoded where they are; continuation records are grouped by the id of their
origin, put in the order of their numbers, and joined if numbers are without
gaps and the total length is the announced one. Then the chunked framing is
taken off. Revisits take the length of their payload from the response they
refer to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import new_folder, stage

SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 16 * 1024
GROUP_BYTES = 1 << 20  # records are handed to the writer in groups of so many bytes, and at most one record more
FILE_GROUPS = 16  # groups to a file, so archives have bounded bytes, however long or short their records are
SALTS = 16
_DATE = "2025-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_BETWEEN = b"\r\n\r\n"  # ends each record
_RECORD = "kind string, page_id long, url string, origin string, number int, total long, digest string, refers_to long, body binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, distinct: str) -> str:
    """Rows may share a page_id or have none, so an id has a second part that tells them apart."""
    return f"urn:warc-record:page-{'none' if page_id is None else page_id}:{distinct}"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer coding."""
    parts = [payload[at:at + size] for at in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(part), part) for part in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """What a chunked body holds; a ValueError if its framing is broken."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size, at = int(body[at:end].split(b";")[0], 16), end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        parts.append(body[at:at + size])
        at += size + 2


def _record(kind: str, block: bytes, fields: list[tuple[str, object]]) -> bytes:
    """Header and block, without the two line ends that follow."""
    named = [("WARC-Type", kind), *fields, ("WARC-Date", _DATE), ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in named).encode() + b"\r\n" + block


def segments(own: str, url: str, payload: bytes, size: int = SEGMENT_BYTES) -> list[bytes]:
    """The response record with the id ``own`` and its continuation records."""
    block = _HTTP + chunked(payload)
    parts = [block[at:at + size] for at in range(0, len(block), size)]
    digest = base32_sha1(payload)
    fields = [("WARC-Record-ID", f"<{own}>"), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if len(parts) == 1:
        return [_record("response", block, fields)]
    told = [_record("response", parts[0], [*fields, ("WARC-Segment-Number", 1)])]
    for number, part in enumerate(parts[1:], 2):
        more = [("WARC-Record-ID", f"<{own}-{number}>"), ("WARC-Segment-Origin-ID", f"<{own}>"), ("WARC-Segment-Number", number)]
        if number == len(parts):
            more.append(("WARC-Segment-Total-Length", len(block)))
        told.append(_record("continuation", part, more))
    return told


def revisit(own: str, url: str, digest: str, refers_to: str) -> bytes:
    return _record("revisit", b"", [
        ("WARC-Record-ID", f"<{own}>"), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", f"<{refers_to}>"),
    ])


def parse(data: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive that arrives in pieces."""
    held, ended = b"", False

    def fill(n: int) -> bool:
        nonlocal held, ended
        parts, have = [held], len(held)
        while have < n and not ended:
            piece = next(data, None)
            if piece is None:
                ended = True
            else:
                parts.append(piece)
                have += len(piece)
        held = b"".join(parts)
        return have >= n

    while fill(1):
        while b"\r\n\r\n" not in held:
            if not fill(len(held) + 1):
                raise ValueError("an archive ends within a header")
        head, _, _ = held.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("no WARC record where one is due")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start, size = len(head) + 4, int(fields["Content-Length"])
        if not fill(start + size + 4) or held[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        block, held = held[start:start + size], held[start + size + 4:]
        yield fields, block


def _row_key() -> Column:
    """A row among all: its page_id, payload, and number where these two repeat."""
    return F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("none")), "sha", F.col("row").cast("string"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Write a record for each page (page_id, url, html) below the folder.

    A null html is an empty payload, a null url an empty one. Line ends in an
    url would break a header and become blanks. Payloads of fewer than
    ``least_bytes`` bytes are never revisits. Every row gets a record of its own,
    also rows with a null page_id (which counts as the smallest) or with one that
    others have as well; of equal payloads with the same page_id one is the response.
    """
    pages = pages.select(
        F.col("page_id").cast("long"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"), F.lit(0).cast("long").alias("row"),
    )
    sha = F.sha1(F.col("html").cast("binary"))

    def digests(rows: DataFrame) -> DataFrame:
        return stage(rows.select("page_id", "row", sha.alias("sha"), F.octet_length("html").alias("n")), "digests")

    narrow = digests(pages)
    if narrow.groupBy("page_id", "sha").count().where("count > 1").limit(1).count():
        # rows that nothing tells apart are numbered, once and for all
        pages = stage(pages.withColumn("row", F.monotonically_increasing_id()), "numbered")
        narrow = digests(pages)
    place = F.struct(F.coalesce(F.col("page_id"), F.lit(-(1 << 63))).alias("order"), "page_id", "row")
    groups = narrow.where(F.col("n") >= least_bytes).groupBy("sha").agg(F.max(place).alias("head"), F.count("*").alias("copies"))
    # one entry per payload that occurs again, once for each salt
    entries = groups.where("copies > 1").select(
        F.col("sha").alias("e_sha"), "head", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("e_salt")
    )
    salt = F.pmod(F.xxhash64("page_id", "row"), F.lit(SALTS))
    again = narrow.where(F.col("n") >= least_bytes).join(entries, (F.col("sha") == F.col("e_sha")) & (salt == F.col("e_salt")))
    again = again.where(~(F.col("page_id").eqNullSafe(F.col("head.page_id")) & (F.col("row") == F.col("head.row"))))
    again = again.select(_row_key().alias("a_key"), F.col("head.page_id").alias("refers_to"), F.lit(True).alias("again"))
    keyed = pages.withColumn("sha", sha)
    planned = keyed.join(again, _row_key() == F.col("a_key"), "left").select(
        "page_id", "url", "html", "refers_to", F.coalesce("again", F.lit(False)).alias("again"), F.monotonically_increasing_id().alias("place"),
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of records, with the line ends between them that the writer puts between groups."""
        out: list[bytes] = []
        held = 0

        def group() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([_BETWEEN.join(out)], pa.binary())], names=["record"])

        for batch in batches:
            for page_id, url, html, refers_to, again, place in zip(*batch.columns):
                payload = html.as_py().encode("utf-8", "surrogatepass")
                page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                digest = base32_sha1(payload)
                if again.as_py():
                    made = [revisit(record_id(page_id, f"row-{place.as_py()}"), url, digest, record_id(refers_to, f"sha1-{digest}"))]
                elif len(payload) < least_bytes:
                    made = segments(record_id(page_id, f"row-{place.as_py()}"), url, payload)
                else:
                    made = segments(record_id(page_id, f"sha1-{digest}"), url, payload)
                for record in made:
                    out.append(record)
                    held += len(record)
                    if held >= GROUP_BYTES:
                        yield group()
                        out, held = [], 0
        if out:
            yield group()

    lines = planned.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", _BETWEEN.decode()).option("compression", "gzip").option("maxRecordsPerFile", FILE_GROUPS).text(folder)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives below a folder, as the fields that reassembly needs."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = re.compile(r"page-(?:none|(-?\d+)):")

        def page(own: str | None) -> int | None:
            found = named.search(own)[1] if own else None
            return int(found) if found else None

        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse(_unzipped(content.as_py())):
                    own, refers = fields["WARC-Record-ID"], fields.get("WARC-Refers-To")
                    rows.append((
                        fields["WARC-Type"], page(own), fields.get("WARC-Target-URI"),
                        fields.get("WARC-Segment-Origin-ID", own), int(fields["WARC-Segment-Number"]) if "WARC-Segment-Number" in fields else None,
                        int(fields["WARC-Segment-Total-Length"]) if "WARC-Segment-Total-Length" in fields else None,
                        fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None,
                        page(refers), block,
                    ))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                columns = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=["kind", "page_id", "url", "origin", "number", "total", "digest", "refers_to", "body"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(opened, _RECORD)


def _unzipped(data: bytes) -> Iterator[bytes]:
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    unzip = zlib.decompressobj(31)
    for at in range(0, len(data), 1 << 18):
        yield unzip.decompress(data[at:at + (1 << 18)])
    yield unzip.flush()


def reassemble(records: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, kind): the logical records; revisits have a null payload.

    An error if segments are missing or repeated, or if their length is not
    the announced one, or if the digest does not fit.
    """
    one, several = records.where("number IS NULL"), records.where("number IS NOT NULL")
    parts = several.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("number", "body"))).alias("parts"), F.max("total").alias("total"),
        F.max(F.when(F.col("number") == 1, F.struct("page_id", "url", "digest", "kind"))).alias("head"),
    )
    whole = one.select(
        "page_id", "url", "digest", "refers_to", F.array(F.struct(F.lit(1).alias("number"), "body")).alias("parts"), F.lit(None).cast("long").alias("total"),
        F.lit(False).alias("cut"), "kind",
    ).unionByName(parts.select("head.*", F.lit(None).cast("long").alias("refers_to"), "parts", "total", F.lit(True).alias("cut")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for page_id, digest, parts, total, cut, kind in zip(*(batch.column(k).to_pylist() for k in (0, 2, 4, 5, 6, 7))):
                if kind == "revisit":
                    payloads.append(None)
                    continue
                block = b"".join(part["body"] for part in parts)
                if [part["number"] for part in parts] != list(range(1, len(parts) + 1)) or cut != (total is not None):
                    raise ValueError(f"segments of page {page_id} are missing or repeated")
                if total is not None and len(block) != total:
                    raise ValueError(f"segments of page {page_id} do not have the announced length")
                payload = unchunked(block[block.index(b"\r\n\r\n") + 4:])
                if base32_sha1(payload) != digest:
                    raise ValueError(f"the payload of page {page_id} does not have its digest")
                payloads.append(payload)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(payloads, pa.binary()), *batch.columns[2:4], batch.column(7)],
                names=["page_id", "url", "payload", "digest", "refers_to", "kind"],
            )

    return whole.mapInArrow(decode, "page_id long, url string, payload binary, digest string, refers_to long, kind string")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages, read them back, and tell per page what the archive says.

    page_id, payload_bytes, payload_digest, record_type and refers_to; a row for each row, whatever its page_id;
    an empty table gives an empty one.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    write(pages, folder)
    found = reassemble(read_records(spark, folder)).select(
        "page_id", F.octet_length("payload").cast("long").alias("n"), "digest", "refers_to", "kind"
    )
    found = stage(found, "records")
    responses = found.where("kind = 'response'")
    # the response that many revisits refer to is met by each of its salts; it has their payload's digest
    wanted = found.where("kind = 'revisit'").withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    referred = wanted.select(F.col("digest").alias("r_digest")).distinct()
    sizes = responses.join(referred, F.col("digest") == F.col("r_digest")).groupBy("r_digest").agg(F.max("n").alias("r_n"))
    entries = sizes.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    told = wanted.join(entries, (F.col("digest") == F.col("r_digest")) & (F.col("salt") == F.col("r_salt")), "left")
    columns = lambda n: ("page_id", n.alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
    return responses.select(*columns(F.col("n"))).unionByName(told.select(*columns(F.col("r_n"))))


STATEMENT = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n,
    sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, list_reduce(list_prepend('', list_transform(range(20), lambda i:
    lpad(bin(('0x' || substr(hex, 2 * i + 1, 2))::INTEGER), 8, '0'))), lambda a, x: a || x) AS bits,
    max(page_id) OVER (PARTITION BY html) AS low,
    row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place FROM p)
SELECT page_id, n AS payload_bytes,
  list_reduce(list_prepend('', list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + list_sum(list_transform(range(5), lambda k: substr(bits, 5 * i + k + 1, 1)::INTEGER * (16 >> k)))::INTEGER, 1))), lambda a, x: a || x)
    AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN low END AS refers_to
FROM b
"""
