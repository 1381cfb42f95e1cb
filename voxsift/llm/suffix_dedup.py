"""Removal of repeated byte strings by suffix order, earlier matches and longest previous factors.

Sorting every suffix of a corpus would shuffle hundreds of times its size. A
repeated string of ``length`` bytes is found from far fewer suffixes: of its
100-byte grams, take the one with the smallest hash. Equal strings choose equal
grams at equal offsets, so it is enough to sort the suffixes that start at
chosen grams, about one in fifty.

1. Chosen grams are shuffled by their hash, with a hash of the bytes around
   them. Grams that occur once are dropped; where all occurrences have the same
   surroundings, by hash, all strings that chose the gram repeat.
2. Only for the others the surroundings themselves are fetched from the texts.
3. Per gram they are put in suffix order to the right and, reversed, to the
   left. The longest previous factor of each side is found from the previous and
   the next smaller position in suffix order. Both bound the strings that repeat,
   and where one earlier occurrence shares all of it, byte for byte, that is the
   answer. What no single occurrence settles is decided offset by offset, by
   classes of equal strings. All strings found hold the gram, so what lies between
   the first and the last of them repeats as well.
4. The spans are joined to the texts.

Copies within a batch are settled there: a frequent passage sends one row per
batch, not per occurrence. Positions are bytes of UTF-8; matches never cross
texts and whole texts are used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage

LENGTH = 200
GRAM = 100
REACH = LENGTH - GRAM  # a string may start so many bytes before its gram
PART_BYTES = 4 << 20  # of text to a part: its grams and surroundings are settled in one task
_FULL, _MIXED = 1, 2

_BASES = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_U = np.uint64


def _prefix_sums(data: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Sums of bytes times powers of the base, and inverse powers: hash of [a, b) = (sums[b] - sums[a]) * inverse[a]."""
    inverse = _U(pow(int(base), -1, 1 << 64))
    powers = np.cumprod(np.concatenate(([_U(1)], np.full(len(data) - 1, base))))
    sums = np.concatenate(([_U(0)], np.cumsum((data.astype(_U) + _U(1)) * powers)))
    return sums, np.cumprod(np.concatenate(([_U(1)], np.full(len(data), inverse))))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def chosen_grams(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions, hashes, hashes of the surroundings, and the range [low, high] of offsets.

    A string of LENGTH bytes that chose the gram at p starts at p - REACH + s
    with low <= s <= high.
    """
    if len(text) < LENGTH:
        return (np.empty(0, np.int64), np.empty(0, _U), np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64))
    data = np.frombuffer(text, np.uint8)
    sums, inverse = _prefix_sums(data, _BASES[0])
    n = len(data) - GRAM + 1
    grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[:n])
    low, width = grams, 1
    while 2 * width <= REACH + 1:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    windows = len(data) - LENGTH + 1
    low = np.minimum(low[:windows], low[REACH + 1 - width:][:windows])

    start = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    end = np.concatenate((start[1:], [windows])) - 1
    place = start + REACH  # a new minimum comes in from the right
    risen = np.flatnonzero(np.concatenate(([True], low[start[1:]] > low[start[1:] - 1])))
    for at in range(0, len(risen), 4096):
        some = risen[at:at + 4096]
        place[some] = start[some] + grams[start[some][:, None] + np.arange(REACH + 1)].argmin(axis=1)
    p, a, b = place, start, np.minimum(end, place)
    left = np.flatnonzero(end > place)  # the gram leaves, an equal one remains
    if len(left):
        # each window that is left chooses the first of the equal grams in it: all of them at once, however long a run is
        sizes = end[left] - place[left]
        window = np.repeat(place[left] + 1 - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        values, which = np.unique(low[window], return_inverse=True)
        spots = np.searchsorted(values, grams).clip(max=len(values) - 1)
        equal = np.flatnonzero(values[spots] == grams)
        keys = spots[equal] * np.int64(n) + equal
        order = np.argsort(keys, kind="stable")
        chosen = equal[order][np.searchsorted(keys[order], which * np.int64(n) + window)]
        p, a, b = np.concatenate((p, chosen)), np.concatenate((a, window)), np.concatenate((b, window))
    order = np.lexsort((a, p))
    p, a, b = p[order], a[order], b[order]
    first = np.concatenate(([True], p[1:] != p[:-1]))
    heads = np.flatnonzero(first)
    p, a, b = p[heads], np.minimum.reduceat(a, heads), np.maximum.reduceat(b, heads)
    sums, inverse = _prefix_sums(data, _BASES[1])
    around = (sums[b + LENGTH] - sums[a]) * inverse[a]
    s_low, s_high = a - p + REACH, b - p + REACH
    around = _mixed(around + (s_low * 256 + s_high).astype(_U) * _U(0x9FB21C651E98DF25))
    return p, grams[p], around, s_low, s_high


def _pack(position: np.ndarray, low: np.ndarray, high: np.ndarray, flag) -> np.ndarray:
    return (position << 24) | (low << 16) | (high << 8) | flag


def _by_part(parts: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per part, with the bytes of each column."""
    order = np.argsort(parts, kind="stable")
    parts = parts[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]))
    arrays = [pa.array(parts[cuts[:-1]].astype(np.int32))]
    for values in columns.values():
        values = values[order]
        arrays.append(pa.array([values[i:j].tobytes() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["part", *columns])


def _joined(table: pa.Table, kinds: dict[str, type]) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(table.column(name).to_pylist()), kind) for name, kind in kinds.items()]


def _earlier_in_run(key: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of sorted runs of equal keys: size of its run, and whether a smaller ``where`` is in it."""
    heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.concatenate((heads, [len(key)])))
    return np.repeat(sizes, sizes), where > np.repeat(np.minimum.reduceat(where, heads), sizes)


def _grams_table(texts: DataFrame, parts: int, keep_first: bool) -> DataFrame:
    """(uid, packed): chosen grams that repeat.

    _FULL marks what certainly repeats as far as the gram is chosen, _MIXED one
    occurrence of each surrounding of a gram that has several.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [chosen_grams((text.as_py() or "").encode("utf-8", "surrogatepass")) for text in batch.column(1)]
            if not rows:
                continue
            uid = np.repeat(batch.column(0).to_numpy(), [len(r[0]) for r in rows])
            p, h, around, low, high = (np.concatenate(x) for x in zip(*rows))
            if not len(p):
                continue
            packed = _pack(p, low, high, _FULL)
            order = np.lexsort((packed, uid, around, h))
            uid, h, around, packed = uid[order], h[order], around[order], packed[order]
            same = np.concatenate(([False], (h[1:] == h[:-1]) & (around[1:] == around[:-1])))
            more = np.concatenate((same[1:], [False])) & ~same  # stands for others of the batch
            part = (h % _U(parts)).astype(np.int64)
            part[same] = parts + uid[same] % parts  # known to repeat: passes through
            yield _by_part(part, {
                "h": np.where(same, _U(0), h), "around": np.where(same, _U(0), around), "uid": uid,
                "packed": packed, "more": more.astype(np.uint8),
            })

    def settle(table: pa.Table) -> pa.Table:
        h, around, uid, packed, more = _joined(table, {"h": _U, "around": _U, "uid": np.int64, "packed": np.int64, "more": np.uint8})
        if table.column("part")[0].as_py() < parts:
            order = np.lexsort((packed, uid, around, h))
            h, around, uid, packed, more = h[order], around[order], uid[order], packed[order], more[order]
            heads = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            sizes = np.diff(np.concatenate((heads, [len(h)])))
            mixed = np.repeat(np.maximum.reduceat(around, heads) != np.minimum.reduceat(around, heads), sizes)
            again = np.concatenate(([False], (h[1:] == h[:-1]) & (around[1:] == around[:-1])))
            first = ~again & (np.concatenate((again[1:], [False])) | more.astype(bool))  # of several with one surrounding
            repeats = again if keep_first else again | first
            flag = np.where(repeats, _FULL, 0) | np.where(mixed & ~again, _MIXED, 0)
            uid, packed = uid[flag > 0], ((packed & ~np.int64(255)) | flag)[flag > 0]
        return pa.table({"uid": pa.array(uid), "packed": pa.array(packed)})

    rows = texts.mapInArrow(collect, "part int, h binary, around binary, uid binary, packed binary, more binary")
    return rows.groupBy("part").applyInArrow(settle, "uid long, packed long")


def _classes(keys: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the rows (key, letters) and the common prefix of each with the one before; -1 for another key."""
    width = letters.shape[1]
    whole = np.empty((len(keys), 8 + width), np.uint8)
    whole[:, :8] = keys.astype(">u8").view(np.uint8).reshape(-1, 8)
    whole[:, 8:] = letters
    order = np.argsort(whole.view(f"S{8 + width}").ravel(), kind="stable")
    common = np.full(len(keys), -1, np.int64)
    for at in range(1, len(keys), 8192):
        a, b = whole[order[at - 1:at + 8191]], whole[order[at:at + 8192]]
        differ = a[:len(b)] != b
        common[at:at + 8192] = np.where(differ.any(axis=1), differ.argmax(axis=1), 8 + width) - 8
    common[common < 0] = -1
    return order, common


def longest_matches(order: np.ndarray, common: np.ndarray, where: np.ndarray, keep_first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per row the longest prefix it shares with another row of its key, and one such row (-1 and 0 if there is none).

    With ``keep_first`` only rows at earlier positions count: the longest previous
    factor. In suffix order it is shared with the previous or the next row that has
    a smaller position; a stack of rows with rising positions finds both in one pass.
    """
    n = len(order)
    if not keep_first:
        after = np.concatenate((common[1:], [-1]))
        from_above = common >= after
        at = np.arange(n)
        best, source = np.where(from_above, common, after), np.where(from_above, np.maximum(at - 1, 0), np.minimum(at + 1, n - 1))
    else:
        position, shared = where[order].tolist(), common.tolist()
        longest, found = [-1] * n, [0] * n
        stack: list[tuple[int, int]] = []  # row, prefix shared with the row below it in the stack
        for row in range(n):
            prefix = shared[row]
            while stack and position[stack[-1][0]] > position[row]:
                top, below = stack.pop()
                if prefix > longest[top]:  # the next smaller one; the previous smaller was noted when it came
                    longest[top], found[top] = prefix, row
                prefix = min(prefix, below)
            if stack:
                longest[row], found[row] = prefix, stack[-1][0]
            stack.append((row, prefix))
        best, source = np.array(longest), np.array(found)
    lengths, sources = np.empty(n, np.int64), np.empty(n, np.int64)
    lengths[order], sources[order] = best, np.where(best >= 0, order[source], 0)
    return lengths, sources


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of a and b, byte by byte."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def repeated_offsets(
    keys: np.ndarray, where: np.ndarray, low: np.ndarray, high: np.ndarray,
    left: np.ndarray, right: np.ndarray, keep_first: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset s whose string repeats (with keep_first: repeats an earlier one); (1, 0) if none.

    ``left`` holds the REACH bytes before the gram, nearest first, ``right`` the
    LENGTH bytes from its start, both padded; ``where`` ranks the positions.

    The string with offset s has REACH - s bytes to the left and GRAM + s to the
    right, so the longest (previous) factors of both sides bound the offsets. If
    one row shares all that both sides allow, the bounds are the answer. Only keys
    with a row that no single other one settles are looked at offset by offset.
    """
    ranks = [_classes(keys, letters) for letters in (left, right)]
    (left_length, left_source), (right_length, right_source) = (longest_matches(*rank, where, keep_first) for rank in ranks)
    first, last = np.maximum(low, REACH - left_length), np.minimum(high, right_length - GRAM)
    none = (left_length < 0) | (right_length < 0) | (first > last)
    lowest, highest = np.where(none, 1, first), np.where(none, 0, last)
    open_rows = np.flatnonzero(~none)
    for source in (left_source, right_source):
        for at in range(0, len(open_rows), 8192):
            row = open_rows[at:at + 8192]
            other = source[row]
            covers = (np.maximum(low[other], REACH - _shared(left[row], left[other])) <= first[row]) & (
                np.minimum(high[other], _shared(right[row], right[other]) - GRAM) >= last[row]
            )
            open_rows[at:at + 8192] = np.where(covers, -1, row)
        open_rows = open_rows[open_rows >= 0]
    if len(open_rows):
        lowest[open_rows], highest[open_rows] = 1 << 30, -1
        some = np.flatnonzero(np.isin(keys, keys[open_rows]))
        is_open = np.zeros(len(keys), bool)
        is_open[open_rows] = True
        _by_offset(some, is_open, keys, where, low, high, first, last, left, right, keep_first, lowest, highest)
        none = highest < 0
        lowest, highest = np.where(none, 1, lowest), np.where(none, 0, highest)
    return np.where(lowest > highest, 1, lowest), np.where(lowest > highest, 0, highest)


def _by_offset(some, is_open, keys, where, low, high, first, last, left, right, keep_first, lowest, highest) -> None:
    """Offsets of the open rows among ``some`` (whole keys): classes of equal strings, offset by offset."""
    ranks = [_classes(keys[some], letters[some]) for letters in (left, right)]
    opened = some[is_open[some]]
    for s in range(int(first[opened].min()), int(last[opened].max()) + 1):
        valid = np.flatnonzero((low[some] <= s) & (s <= high[some]))
        if not (is_open[some[valid]] & (first[some[valid]] <= s) & (s <= last[some[valid]])).any():
            continue
        number = []
        for (order, common), depth in zip(ranks, (REACH - s, GRAM + s)):
            classes = np.empty(len(some), np.int64)
            classes[order] = np.cumsum(common < depth)
            number.append(classes[valid])
        key = number[0] * (len(some) + 1) + number[1]
        order = np.argsort(key, kind="stable")
        members = some[valid[order]]
        sizes, later = _earlier_in_run(key[order], where[members])
        hit = members[(later if keep_first else sizes > 1) & is_open[members]]
        lowest[hit] = np.minimum(lowest[hit], s)
        highest[hit] = s


def _mixed_spans(texts: DataFrame, mixed: DataFrame, parts: int, keep_first: bool) -> DataFrame:
    """(uid, start, stop): what repeats around grams with different surroundings."""
    kind = {"h": _U, "uid": np.int64, "packed": np.int64}

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            rows, bodies = [], []
            for uid, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for packed in found:
                    p, low, high = packed >> 24, packed >> 16 & 255, packed >> 8 & 255
                    rows.append((xxhash.xxh64_intdigest(data[p:p + GRAM]), uid, packed))
                    bodies.append(bytes(low) + data[p - REACH + low:p + GRAM + high] + bytes(REACH - high))
            if rows:
                h, uid, packed = zip(*rows)
                h = np.array(h, _U)
                yield _by_part((h % _U(parts)).astype(np.int64), {
                    "h": h, "uid": np.array(uid, np.int64), "packed": np.array(packed, np.int64),
                    "bodies": np.frombuffer(b"".join(bodies), np.uint8).reshape(-1, REACH + LENGTH),
                })

    def settle(table: pa.Table) -> pa.Table:
        h, uid, packed = _joined(table, kind)
        bodies = np.frombuffer(b"".join(table.column("bodies").to_pylist()), np.uint8).reshape(-1, REACH + LENGTH)
        p, low, high = packed >> 24, packed >> 16 & 255, packed >> 8 & 255
        where = np.empty(len(p), np.int64)
        where[np.lexsort((p, uid))] = np.arange(len(p))
        # to the left, the byte next to the gram comes first
        low, high = repeated_offsets(h, where, low, high, bodies[:, REACH - 1::-1], bodies[:, REACH:], keep_first)
        hit = low <= high
        return pa.table({
            "uid": pa.array(uid[hit]), "start": pa.array((p - REACH + low)[hit]), "stop": pa.array((p + GRAM + high)[hit])
        })

    grouped = mixed.groupBy("uid").agg(F.collect_list("packed").alias("found")).withColumnRenamed("uid", "f_uid")
    rows = texts.join(grouped, F.col("uid") == F.col("f_uid")).select("uid", "text", "found").mapInArrow(
        surroundings, "part int, h binary, uid binary, packed binary, bodies binary"
    )
    return rows.groupBy("part").applyInArrow(settle, "uid long, start long, stop long")


def repeated_spans(texts: DataFrame, keep_first: bool) -> DataFrame:
    """(uid, start, stop) over texts (uid, text): spans that repeat; they may overlap and come in any order."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-size // PART_BYTES))
    grams = stage(_grams_table(texts, parts, keep_first), "grams")
    flag = F.col("packed").bitwiseAND(255)
    p = F.shiftright("packed", 24)
    full = grams.where(flag.bitwiseAND(_FULL) > 0).select(
        "uid", (p - REACH + F.shiftright("packed", 16).bitwiseAND(255)).alias("start"),
        (p + GRAM + F.shiftright("packed", 8).bitwiseAND(255)).alias("stop"),
    )
    return full.unionByName(stage(_mixed_spans(texts, grams.where(flag.bitwiseAND(_MIXED) > 0), parts, keep_first), "spans"))


def _numbered(docs: DataFrame) -> DataFrame:
    """Add ``uid``, a number per row: doc_id where that is one, else a number given while the rows are stored."""
    repeated = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL OR doc_id < 0").limit(1).count()
    if not repeated:
        return docs.withColumn("uid", F.col("doc_id").cast("long"))
    return stage(docs.sort("doc_id").withColumn("uid", F.monotonically_increasing_id()), "numbered")


def _cut(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """The spans as sorted maximal runs."""
    runs: list[list[int]] = []
    for start, stop in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    return [(start, min(stop, size)) for start, stop in runs]


def _with_runs(docs: DataFrame, text: str, keep_first: bool) -> DataFrame:
    """Rows with ``uid`` and the column ``text``, and ``s_found``, the spans of each."""
    spans = repeated_spans(docs.select("uid", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")), keep_first)
    grouped = spans.groupBy("uid").agg(F.collect_list(F.struct("start", "stop")).alias("s_found"))
    return docs.join(grouped.withColumnRenamed("uid", "s_uid"), F.col("uid") == F.col("s_uid"), "left").drop("s_uid")


def digest(docs: DataFrame, keep_first: bool = False) -> DataFrame:
    """Per document what removing its repeated strings leaves: bytes, removed bytes, removed runs, SHA-256 of the rest.

    Null texts count as empty. Repeated rows are texts of their own: each repeats
    the other. An empty table gives an empty one.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(*(column.to_pylist() for column in batch.columns)):
                data = (text or "").encode("utf-8", "surrogatepass")
                runs, at, rest = _cut([(x["start"], x["stop"]) for x in found or ()], len(data)), 0, hashlib.sha256()
                for start, stop in runs:
                    rest.update(data[at:start])
                    at = stop
                rest.update(data[at:])
                rows.append((doc_id, len(data), sum(b - a for a, b in runs), len(runs), rest.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(),) * 4 + (pa.string(),))] if rows else
                [pa.array([], k) for k in (pa.int64(),) * 4 + (pa.string(),)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    rows = _with_runs(_numbered(docs.select(F.col("doc_id").cast("long"), "text")), "text", keep_first)
    return rows.select("doc_id", "text", "s_found").mapInArrow(
        told, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The documents without later copies of strings; first copies stay. All columns stay, n_chars follows the text.

    A cut never splits a character: what a run shares of one stays. Documents
    that nothing is left of stay, with an empty text.
    """
    names = docs.columns

    @F.pandas_udf("string")
    def rest(text, found):
        import pandas as pd

        kept = []
        for value, spans in zip(text, found):
            if value is None or spans is None:  # also called for rows whose result is not used
                kept.append(value)
                continue
            data = value.encode("utf-8", "surrogatepass")
            pieces, at = [], 0
            for start, stop in _cut([(x["start"], x["stop"]) for x in spans], len(data)):
                while start < stop and data[start] & 0xC0 == 0x80:
                    start += 1
                while stop > start and stop < len(data) and data[stop] & 0xC0 == 0x80:
                    stop -= 1
                pieces.append(data[at:start])
                at = stop
            kept.append(b"".join([*pieces, data[at:]]).decode("utf-8", "surrogatepass"))
        return pd.Series(kept)

    held = _numbered(docs.select("doc_id", F.struct(*names).alias("s_row")))
    rows = _with_runs(held, "s_row.text", keep_first=True)
    was = F.col("s_row.text")
    rows = rows.withColumn("s_text", F.when(F.col("s_found").isNotNull() & was.isNotNull(), rest(was, "s_found")).otherwise(was))
    changed = {name: F.col(f"s_row.{name}").alias(name) for name in names} | {"text": F.col("s_text").alias("text")}
    if "n_chars" in names:
        count = F.coalesce(F.length("s_text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("s_found").isNull(), F.col("s_row.n_chars")).otherwise(count).alias("n_chars")
    return rows.select(*changed.values())
