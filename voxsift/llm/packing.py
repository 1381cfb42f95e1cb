"""Packing token sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are cut into pieces of at most one sequence; only the last piece of a
document is shorter. Documents are dealt to groups by a hash of their row, and
each group packs its pieces on its own, so the groups are the unit of work: no
task sees more than one group of about ``group_docs`` documents, whatever the
size of the input, and a hash deals hot sources and copies over all groups.

Ids never leave the task that makes them: what is shuffled is one row a
document, with the checksum of each of its pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_DOCS = 4096
SEPARATOR = 0

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "padding long"
)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, none of them over the capacity.

    Longest first (ties: in the given order), each into the first bin with
    room. Inner nodes of the tree hold the most room below them, so the first
    bin is found from the root in log2(bins) steps.
    """
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = [0] * n, [0] * n
    for item in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[item]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 1024) -> DataFrame:
    """Per document: its number of ids, separator included, and the CRC-32 of each piece of ``max_tokens`` ids.

    A null text counts as empty and yields the separator alone. Other columns
    than ``doc_id`` and ``text`` are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .token_ids import TextIds

        ids_of, size = TextIds(tokenizer_path), 4 * max_tokens
        for batch in batches:
            tokens, checks = [], []
            for text in batch.column(1):
                data = ids_of.encode(text.as_py() or "").tobytes() + SEPARATOR.to_bytes(4, "little")
                tokens.append(len(data) // 4)
                checks.append([zlib.crc32(data[at:at + size]) for at in range(0, len(data), size)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tokens, pa.int64()), pa.array(checks, pa.list_(pa.int64()))],
                names=["doc_id", "doc_tokens", "checks"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, doc_tokens long, checks array<long>"
    )


def pack(pieces: DataFrame, groups: int, max_tokens: int = 1024, seed: int = 7) -> DataFrame:
    """Place the pieces of ``token_pieces`` in sequences of ``max_tokens``, padded to that length.

    One row a piece: which ids of its document it holds (``start``,
    ``length``), its sequence and its place there, and the ``padding`` behind
    the last piece of the sequence (0 for the others). Offsets are gapless from 0. Sequence numbers are unique,
    not consecutive: the group in the upper half, the bin in the lower one.
    Repeated rows are packed as often as they occur; an empty table gives none.
    """

    def fill(table: pa.Table) -> pa.Table:
        group = table.column("part")[0].as_py()
        # one order whatever order the rows arrive in
        table = table.sort_by([("doc_id", "ascending"), ("doc_tokens", "ascending")])
        doc_tokens = table.column("doc_tokens").to_numpy()
        counts = (doc_tokens + max_tokens - 1) // max_tokens
        row = np.repeat(np.arange(len(counts)), counts)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * max_tokens
        length = np.minimum(max_tokens, doc_tokens[row] - start)
        bins, offset = first_fit_decreasing(length, max_tokens)
        used = np.bincount(bins, weights=length).astype(np.int64)
        last = offset + length == used[bins]
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(row)),
            "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
            "ids_crc32": table.column("checks").combine_chunks().flatten(),
            "doc_tokens": pa.array(doc_tokens[row], pa.int64()),
            "sequence_id": pa.array((np.int64(group) << 32) + bins, pa.int64()),
            "offset": pa.array(offset, pa.int64()),
            "padding": pa.array(np.where(last, max_tokens - used[bins], 0), pa.int64()),
        })

    drawn = F.xxhash64("doc_id", "doc_tokens", "checks", F.lit(seed))
    return (
        pieces.withColumn("part", F.pmod(drawn, F.lit(max(1, groups))))
        .groupBy("part").applyInArrow(fill, _PIECES)
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, max_tokens: int = 1024, group_docs: int = GROUP_DOCS, seed: int = 7
) -> DataFrame:
    """Tokenize and pack all documents, in groups of about ``group_docs``."""
    groups = -(-docs.select("doc_id").count() // group_docs)
    return pack(token_pieces(docs, tokenizer_path, max_tokens), groups, max_tokens, seed)
