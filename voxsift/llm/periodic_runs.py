"""Runs of words that repeat with a period, found in tiles of every scale.

A run is a stretch of consecutive words with smallest period q, of at least
max(LEAST_WORDS, 3 q) words, that cannot be extended on either side. In terms of
matches (words q apart are identical) it is a maximal stretch of at least 2 q of
them.

Periods are divided into octaves: up to BASE, then reach < q <= 2 reach for reach
= BASE, 2 BASE, .. Each octave has a boundary every ``reach`` words, and
documents are cut into overlapping tiles around the boundaries. A stretch of 2 q
matches touches a boundary from which it goes on for ``reach`` words to one side
at least, so a tile needs no more than 3 reach words after a boundary and reach
before it. Tiles are rows of their own and are dealt out over all tasks, so one
long document is no long task. In a tile, Z-functions forwards and backwards from
a boundary give, for all periods of the octave at once, how far the matches go;
what reaches the tile's edge on one side becomes a fragment. Fragments of one
document and period are shuffled together and stitched where they touch. Of equal
stretches only the smallest period is kept.

Before tiles are written, hashes of ``reach`` words tell which boundaries can have
such a match at all: a necessary condition, so nothing is missed, and ordinary
text leaves almost no tiles.

Defined results: a null or empty text has no words and no runs; a null doc_id is
like any other; repeated rows stay and are told apart by a number of their own;
ties for the greatest exponent go to the smallest start, then period; an empty
table gives an empty one; other columns are ignored, except by ``collapse``,
which keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage

BASE = 8  # periods up to BASE form the first octave
LEAST_WORDS = 24  # at least 3 * BASE, so that a stretch of the first octave is long enough too
TILE_WORDS = 1024  # boundaries of a tile lie within so many words, unless one octave needs more
TASK_WORDS = 4_000_000  # that boundaries look at, dealt to one task
_ROW_BITS = 33


def octaves(n: int) -> list[int]:
    """The reach of each octave that a text of n words can have runs in."""
    found, reach = [BASE] if n >= LEAST_WORDS else [], BASE
    while 3 * (reach + 1) <= n:
        found.append(-reach)  # negative: periods above the reach
        reach *= 2
    return found


def periods(octave: int) -> tuple[int, int]:
    """The first and last period of an octave."""
    return (1, octave) if octave > 0 else (1 - octave, -2 * octave)


def boundaries(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, boundaries) that can have ``reach`` matches to one side, from the hashes of the words."""
    n, width, windows = len(hashes), 1, hashes.astype(np.uint64)
    for octave in octaves(n):
        reach = abs(octave)
        while width < reach:  # hashes of all windows of twice as many words
            a, b = windows[:-width], windows[width:]
            windows = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
            width *= 2
        low, high = periods(octave)
        count = -(-len(windows) // reach)
        padded = np.concatenate((windows, np.zeros(count * reach + high + 1 - len(windows), np.uint64)))
        own = padded[:count * reach:reach]
        if octave > 0:
            ahead = np.zeros(count, bool)
            for q in range(low, high + 1):
                ahead |= padded[q:q + count * reach:reach] == own
        else:
            ahead = (padded[low:low + count * reach].reshape(count, reach) == own[:, None]).any(axis=1)
        # what matches ahead of one boundary matches behind the next one
        either = np.concatenate((ahead, [False])) | np.concatenate(([False], ahead))
        found = np.flatnonzero(either) * reach
        found = found[found < n]
        if len(found):
            yield octave, found


def tiles(words: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(octave, first word, word numbers, boundaries) of each tile that can hold a fragment."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    numbers = None
    for octave, found in boundaries(hashes):
        reach = abs(octave)
        if numbers is None:
            known: dict[bytes, int] = {}
            numbers = np.fromiter((known.setdefault(word, len(known)) for word in words), np.int32, len(words))
        part = found // max(reach, TILE_WORDS)
        for members in np.split(found, np.flatnonzero(np.diff(part)) + 1):
            first = max(0, int(members[0]) - reach)
            yield octave, first, numbers[first:int(members[-1]) + 3 * reach], members


def z_values(s: list[int]) -> list[int]:
    """For each place the number of items from there on that equal the items from the start on."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def fragments(octave: int, first: int, numbers: np.ndarray, found: np.ndarray) -> list[tuple[int, int, int]]:
    """(period, start, end) of stretches of matches in a tile; those that touch are joined."""
    reach, (low, high) = abs(octave), periods(octave)
    held: dict[int, list[list[int]]] = {}
    for boundary in found.tolist():
        at = boundary - first
        ahead = numbers[at:at + 3 * reach].tolist()
        before = numbers[max(0, at - reach):at][::-1].tolist()
        after = numbers[at:at + 2 * reach][::-1].tolist()
        forwards = z_values(ahead)
        backwards = z_values([*before, -1, *after, *before])
        last = min(high, len(after))
        if last < low:
            continue
        q = np.arange(low, last + 1)
        right = np.minimum(np.array([*forwards, 0])[q], reach)
        left = np.array(backwards)[len(before) + 1 + len(after) - q]
        for k in np.flatnonzero((right >= reach) | (left >= reach)).tolist():
            start, end = boundary - int(left[k]), boundary + int(right[k])
            parts = held.setdefault(low + k, [])
            if parts and start <= parts[-1][1]:
                parts[-1][1] = max(parts[-1][1], end)
            else:
                parts.append([start, end])
    return [(period, start, end) for period, parts in held.items() for start, end in parts]


def exploded(docs: DataFrame) -> DataFrame:
    """Documents and their tiles as one stored table, divided by ``kind``.

    A doc row has its number, doc_id, n_words, the digest of its words, and the words themselves if it has tiles. In a tile
    row n_words is how many words its boundaries look at.
    """

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()
                joined, any_tile = b" ".join(words), False
                for octave, first, ids, found in tiles(words):
                    any_tile = True
                    rows.append(("tile", number, None, 4 * abs(octave) * len(found), None, None, octave, first, ids.tobytes(), found.astype(np.int64).tobytes()))
                    held += 4 * len(ids) + 8 * len(found)
                rows.append(("doc", number, doc_id, len(words), hashlib.sha256(joined).hexdigest(), joined if any_tile else None, None, None, None, None))
                held += len(joined) if any_tile else 100
                number += 1
                if held > 8 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)

    return stage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(take, _EXPLODED), "tiles", ["kind"])


_EXPLODED = (
    "kind string, number long, doc_id long, n_words long, sha string, words binary, octave int, first long, ids binary, found binary"
)
_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_KINDS)
    names = [field.split(" ")[0] for field in _EXPLODED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], names=names)


def runs_of(table: DataFrame) -> DataFrame:
    """(number, start, length, period): all runs of the documents of an ``exploded`` table."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for number, octave, first, ids, found in zip(*(column.to_pylist() for column in batch.columns)):
                parts = fragments(octave, first, np.frombuffer(ids, np.int32), np.frombuffer(found, np.int64))
                rows += [(number, *part) for part in parts]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["number", "period", "low", "high"])

    of_tiles = table.where("kind = 'tile'")
    words = of_tiles.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first()["n"]
    dealt = of_tiles.select("number", "octave", "first", "ids", "found").repartition(1 + words // TASK_WORDS, "number", "octave", "first")
    parts = dealt.mapInArrow(solve, "number long, period long, low long, high long")
    # stitch what touches: a fragment begins a stretch if all before it end before it starts
    along = Window.partitionBy("number", "period").orderBy("low", "high")
    reached = F.max("high").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begun = parts.withColumn("begins", F.coalesce((F.col("low") > reached).cast("int"), F.lit(1)))
    named = begun.withColumn("stretch", F.sum("begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = named.groupBy("number", "period", "stretch").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    length = F.col("high") - F.col("low") + F.col("period")
    runs = whole.select("number", F.col("low").alias("start"), length.alias("length"), "period")
    runs = runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), 3 * F.col("period")))
    # a stretch that has a smaller period has the same ends with that period
    return runs.groupBy("number", "start", "length").agg(F.min("period").alias("period"))


def with_runs(docs: DataFrame) -> DataFrame:
    """(number, doc_id, n_words, sha, words, runs): per row its runs by start, then period; null without any.

    ``words`` (joined by one blank) is there for every row that has runs; ``sha`` is the digest of all words.
    """
    table = exploded(docs)
    listed = runs_of(table).groupBy("number").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    of_docs = table.where("kind = 'doc'").select("number", "doc_id", "n_words", "sha", "words")
    return of_docs.join(listed.withColumnRenamed("number", "r_number"), F.col("number") == F.col("r_number"), "left").drop("r_number")


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those after the first period of a run (start, length, period)."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def summary(docs: DataFrame) -> DataFrame:
    """Per row: n_runs, the run with the greatest length / period, and digests of all runs and of the kept words."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, sha, words, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                if not listed:
                    out.append((doc_id, 0, None, None, None, None, nothing, sha))
                    continue
                runs = [(run["start"], run["length"], run["period"]) for run in listed]
                start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
                all_runs = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
                kept = b" ".join(kept_words(words.as_py().split(b" "), runs))
                out.append((
                    doc_id, len(runs), start, length, period, 1000 * length // period,
                    hashlib.sha256(all_runs).hexdigest(), hashlib.sha256(kept).hexdigest(),
                ))
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 6 + [pa.string()] * 2)],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            )

    found = with_runs(docs).select("doc_id", "sha", F.when(F.col("runs").isNotNull(), F.col("words")).alias("words"), "runs")
    return found.mapInArrow(
        tell,
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string",
    )


def collapse(docs: DataFrame) -> DataFrame:
    """All rows and columns; texts with runs keep the first period of each run, their words joined by one blank."""
    names = docs.columns
    held = stage(docs.select(F.struct(*names).alias("p_row"), F.monotonically_increasing_id().alias("p_id")), "rows")
    found = with_runs(held.select(F.col("p_id").alias("doc_id"), F.col("p_row.text").alias("text"))).where("runs IS NOT NULL")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for words, listed in zip(batch.column(1), batch.column(2).to_pylist()):
                runs = [(run["start"], run["length"], run["period"]) for run in listed]
                texts.append(b" ".join(kept_words(words.as_py().split(b" "), runs)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["c_id", "c_text"])

    texts = found.select("doc_id", "words", "runs").mapInArrow(cut, "c_id long, c_text binary")
    joined = held.join(texts, F.col("p_id") == F.col("c_id"), "left")
    fields = [F.coalesce(F.col("c_text").cast("string"), F.col("p_row.text")).alias(n) if n == "text" else F.col(f"p_row.`{n}`").alias(n) for n in names]
    return joined.select(*fields)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts, drawn by the checksum of the doc_id, end in a periodic stretch.

    With h = crc32(doc_id) and g = h // 10: where h % 10 = 0, word i from a = g % n on becomes word
    a + (i - a) % p, with p = 1 + (n - a) // (3 + g % 8). All other texts stay as they are.
    """
    space = " \t\n\x0b\f\r"
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    trimmed = F.btrim(F.col("text"), F.lit(space))
    drawn = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.floor(h / 10).alias("g"),
        F.when((h % 10 == 0) & (trimmed != ""), F.split(trimmed, f"[{space}]+")).alias("w"),
    )
    placed = drawn.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")
    repeated = F.transform("w", lambda x, i: F.when(i < a, x).otherwise(F.get(F.col("w"), (a + F.pmod(i - a, p)).cast("int"))))
    return placed.select("doc_id", F.when(a.isNotNull(), F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text"))
