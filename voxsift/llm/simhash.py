"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments. If two fingerprints differ
in at most four bits, one segment differs in at most one. So each segment is
indexed once for each of its bits, with that bit wiped out: segments that differ
in one bit, or in none, have such a variant in common. Equal variants are
brought together by a shuffle, and the full fingerprints are compared. A bucket of more
than SPLIT fingerprints is dealt out once more, by blocks of the bits outside its
segment, of which one is equal in near fingerprints.

Equal fingerprints are one node, so copies are never paired. Within a bucket a
large set of fingerprints is divided again by the variants of the other two
segments, compared in blocks, and only as many links are given out as join what
belongs together: links grow with the fingerprints, not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StructField, StructType

from ..functions.staging import stage
from .components import components

SHINGLE = 4
MOST_BITS = 4
SEED = 42
SALTS = 16
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits; one more than MOST_BITS // 2
DENSE = 512  # fingerprints that are compared with each other at once
SPLIT = 4_096  # fingerprints of one bucket that are compared in one task; a larger one is dealt out again

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str, words_in_shingle: int = SHINGLE) -> int:
    """The fingerprint of a text; 0 without words.

    A-Z are lower-cased; words are what ASCII white space divides. A bit is 1 if
    it is set in over half of the hashes of all shingles, repeats included.
    """
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    width = min(words_in_shingle, len(words))
    starts, stops = first[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)])), "<u8"
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprints(rows: DataFrame, words_in_shingle: int = SHINGLE) -> DataFrame:
    """The column ``text`` gives way to ``fp``: its 64 bits as a signed long. Null and empty texts have 0."""
    kept = [field for field in rows.schema if field.name != "text"]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or "", words_in_shingle) for t in batch.column(len(kept))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(found.view(np.int64))], names=[*batch.schema.names[:len(kept)], "fp"]
            )

    return rows.select(*(f.name for f in kept), "text").mapInArrow(take, StructType([*kept, StructField("fp", LongType())]))


def fingerprints(docs: DataFrame, words_in_shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row."""
    return with_fingerprints(docs.select(F.col("doc_id").cast("long"), "text"), words_in_shingle)


def _variants() -> list[tuple[int, int, int]]:
    """(segment, bit within it, number of the variant)."""
    listed = [(s, bit) for s, (_, bits) in enumerate(SEGMENTS) for bit in range(bits)]
    return [(s, bit, number) for number, (s, bit) in enumerate(listed)]


def _near(left: np.ndarray, right: np.ndarray, segment: int, bit: int) -> np.ndarray:
    """Which pairs are near and belong to this variant: each near pair belongs to exactly one."""
    differ = left ^ right
    near = np.bitwise_count(differ) <= MOST_BITS
    for s, (first, bits) in enumerate(SEGMENTS[:segment + 1]):
        part = (differ >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        if s < segment:
            near &= np.bitwise_count(part) > 1
        else:
            near &= (part == np.uint64(1 << bit)) | ((part == 0) & (bit == 0))
    return near


def _joined(nodes: np.ndarray, segment: int, bit: int) -> list[tuple[int, int]]:
    """Links that join what is near among the distinct fingerprints of one bucket: at most one per fingerprint and set."""
    links: list[tuple[int, int]] = []
    root = np.arange(len(nodes))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def compare(members: np.ndarray) -> None:
        for at in range(0, len(members), DENSE):
            block = members[at:at + DENSE]
            for other in range(at, len(members), DENSE):
                against = members[other:other + DENSE]
                i, j = np.nonzero(_near(nodes[block][:, None], nodes[against][None, :], segment, bit))
                a, b = block[i], against[j]
                apart = root[a] != root[b]
                for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                    x_top, y_top = top(x), top(y)
                    if x_top != y_top:
                        root[max(x_top, y_top)] = min(x_top, y_top)
                        links.append((x, y))
                for k in {*a.tolist(), *b.tolist()}:
                    root[k] = top(k)

    if len(nodes) <= DENSE:
        compare(np.arange(len(nodes)))
        return links
    for mask in _other_blocks(segment):
        keys = nodes & mask
        order = np.argsort(keys, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
            if len(members) > 1:
                compare(members)
    return links


def _other_blocks(segment: int) -> list[np.uint64]:
    """Masks of five blocks of the bits outside a segment: at most four of these bits differ, so one block is equal."""
    first, bits = SEGMENTS[segment]
    others = [k for k in range(64) if not first <= k < first + bits]
    return [np.uint64(sum(1 << int(k) for k in block)) for block in np.array_split(others, MOST_BITS + 1)]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def near_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join all that differ in at most four bits in turn."""
    variants = _variants()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                some, keys = fps[at:at + 4096], []
                for s, bit, number in variants:
                    first, bits = SEGMENTS[s]
                    rest = (some >> np.uint64(first)) & np.uint64(((1 << bits) - 1) & ~(1 << bit))
                    keys.append((rest | np.uint64(number << 22)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.tile(some, len(variants)).view(np.int64))], names=["key", "fp"]
                )

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sorted rows, never cut within a key, unless it has more than SPLIT of them."""
        rest: tuple[list, list] = [], []
        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            if last or (rest[0] and (rest[0][-1][-1] != keys[-1] or sum(map(len, rest[0])) > SPLIT)):
                yield np.concatenate([*rest[0], keys[:last]]), np.concatenate([*rest[1], fps[:last]])
                rest = [], []
            rest[0].append(keys[last:])
            rest[1].append(fps[last:])
        if rest[0]:
            yield np.concatenate(rest[0]), np.concatenate(rest[1])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the buckets, and the rows of large buckets under the keys of their other blocks."""
        large = None
        for keys, fps in buckets(batches):
            found, again = [], []
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
            several = np.flatnonzero((ends - starts > 1) | (keys[starts] == (-1 if large is None else large)))
            for start, end in zip(starts[several].tolist(), ends[several].tolist()):
                key = int(keys[start])
                segment, bit, _ = variants[key >> 22]
                nodes = fps[start:end].view(np.uint64)
                if end - start > SPLIT or key == large:
                    large = key
                    again += [
                        (_mixed((nodes & mask) + _mixed(np.full(len(nodes), 8 * key + i, np.uint64))), np.full(len(nodes), key), nodes)
                        for i, mask in enumerate(_other_blocks(segment))
                    ]
                elif end - start == 2:
                    found += [(start, start + 1)] if _near(nodes[:1], nodes[1:], segment, bit)[0] else []
                else:
                    found += [(start + x, start + y) for x, y in _joined(nodes, segment, bit)]
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield told(np.zeros(len(pairs), np.int64), np.full(len(pairs), -1), fps[pairs[:, 0]], fps[pairs[:, 1]])
            for block, key, nodes in again:
                yield told(block.view(np.int64), key, nodes.view(np.int64), nodes.view(np.int64))

    def told(block: np.ndarray, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(block), pa.array(key.astype(np.int32)), pa.array(a), pa.array(b)], names=["block", "key", "a", "b"])

    def compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block and key; what has one key in common is compared with each other."""
        key, nodes = None, []

        def links() -> pa.RecordBatch:
            segment, bit, _ = variants[key[1] >> 22]
            fps = np.unique(np.array(nodes, np.int64).view(np.uint64))
            pairs = np.array(_joined(fps, segment, bit), np.int64).reshape(-1, 2)
            ends = fps.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[pairs[:, 0]]), pa.array(ends[pairs[:, 1]])], names=["a", "b"])

        for batch in batches:
            for block, number, fp in zip(*(column.to_pylist() for column in batch.columns)):
                if (block, number) != key:
                    if len(nodes) > 1:
                        yield links()
                    key, nodes = (block, number), []
                nodes.append(fp)
        if len(nodes) > 1:
            yield links()

    indexed = nodes.select("fp").mapInArrow(index, "key int, fp long")
    sorted_rows = indexed.repartition("key").sortWithinPartitions("key")
    compared = stage(sorted_rows.mapInArrow(compare, "block long, key int, a long, b long"), "links")
    again = compared.where("key >= 0").select("block", "key", "a").repartition("block", "key").sortWithinPartitions("block", "key")
    return compared.where("key < 0").select("a", "b").unionByName(again.mapInArrow(compare_blocks, "a long, b long"))


def near_duplicates(docs: DataFrame, words_in_shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id that links of at most four differing bits lead to.

    Texts without words have fingerprint 0 and are linked like any others.
    Repeated rows stay. A null doc_id is no candidate for the smallest, unless
    there is no other. An empty table gives an empty one.
    """
    taken = stage(fingerprints(docs, words_in_shingle), "fingerprints")
    entries = _classes(taken, "doc_id", "component")
    joined = _with_class(taken, entries, F.xxhash64("doc_id"))
    return joined.select("doc_id", "fp", F.coalesce("component", "doc_id").alias("component_id"))


def _classes(taken: DataFrame, smallest: Column | str, name: str) -> DataFrame:
    """(e_fp, ``name``): for each fingerprint that is shared or linked, the smallest value in its class."""
    nodes = stage(taken.groupBy("fp").agg(F.min(smallest).alias("low"), F.count("*").alias("n")), "nodes")
    roots = components(near_links(nodes)).select(F.col("node").alias("x"), "root")
    # only what shares its fingerprint or has links needs an entry
    classes = nodes.join(roots, F.col("fp") == F.col("x"), "left").where("n > 1 OR root IS NOT NULL").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lows = classes.groupBy("root").agg(F.min("low").alias(name))
    return classes.join(lows, "root").select(F.col("fp").alias("e_fp"), name)


def _with_class(taken: DataFrame, entries: DataFrame, spread: Column) -> DataFrame:
    """Rows with the entry of their fingerprint, if it has one; a fingerprint that many rows share is met by each of its salts."""
    entries = entries.withColumn("e_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = taken.withColumn("salt", F.pmod(spread, F.lit(SALTS)).cast("int"))
    return salted.join(entries, (F.col("fp") == F.col("e_fp")) & (F.col("salt") == F.col("e_salt")), "left").drop("salt", "e_salt", "e_fp")


def keep_one(docs: DataFrame, words_in_shingle: int = SHINGLE) -> DataFrame:
    """Of each group of near copies one row, with all its columns.

    It is the one with the smallest doc_id, null last. Rows are told apart by
    doc_id and a hash of all their columns, so different texts with one id both
    stay. Rows that agree in all of that are copies of each other; one of them stays.
    """
    names = [f"`{name}`" for name in docs.columns]
    keyed = docs.select(F.struct(*names).alias("s_doc"), F.col("doc_id").cast("long").alias("s_id"), _row_hash(docs).alias("s_hash"))
    taken = stage(with_fingerprints(keyed.select("s_id", "s_hash", "s_doc.text"), words_in_shingle), "fingerprints")
    place = F.struct(F.col("s_id").isNull().alias("without"), "s_id", "s_hash")
    judged = _with_class(taken, _classes(taken, place, "first_place"), F.xxhash64("s_id", "s_hash"))
    later = ~(F.col("first_place.s_id").eqNullSafe(F.col("s_id")) & (F.col("first_place.s_hash") == F.col("s_hash")))
    lost = judged.where("first_place IS NOT NULL").where(later).select(F.col("s_id").alias("l_id"), F.col("s_hash").alias("l_hash")).distinct()
    kept = keyed.join(lost, F.col("s_id").eqNullSafe(F.col("l_id")) & (F.col("s_hash") == F.col("l_hash")), "left_anti")
    if taken.groupBy("s_id", "s_hash").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["s_id", "s_hash"])
    return kept.select("s_doc.*")


def _row_hash(rows: DataFrame) -> Column:
    """A hash of all columns; nested ones, which may hold maps, by their JSON."""
    atomic = lambda field: not isinstance(field.dataType, (ArrayType, MapType, StructType))
    return F.xxhash64(*(F.col(f"`{f.name}`") if atomic(f) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in rows.schema))
