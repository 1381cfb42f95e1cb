"""Approximate nearest neighbours with an inverted multi-index.

Vectors are scaled to length one and cut into two halves. Each half is
quantised with its own small set of centroids, so K centroids a half make K * K
cells. A query visits the pairs of centroids in order of their summed distance,
taken from a heap, until the cells visited hold enough vectors; these are ranked
by their exact cosine.

Centroids are fitted to a sample of bounded size; every vector is indexed. The
index is a table of blocks: the vectors of one cell, at most BLOCK of them in a
row. Queries are grouped by the cells they visit as well, so a block and a group
of queries meet in one matrix product. Equal vectors are one entry with the few
smallest ids that a query can need, so a vector that a third of all rows share
costs one product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage

MOST_CENTROIDS = 256  # per half
SAMPLE_ROWS = 20_000  # vectors that the centroids are fitted to, at most
ROUNDS = 12
PROBED_SHARE = 0.55  # of the indexed vectors that a query's cells must hold
LEAST_PROBED = 64
MOST_LENGTHS = 64  # different lengths of vector in one table
BLOCK = 1024
SHARD_ROWS = 16_384
QUERY_BLOCK = 256


def centroids_for(total: int) -> int:
    """Centroids per half: cells grow with the square root of the table, so both cells and the vectors in one do."""
    return min(MOST_CENTROIDS, max(4, round(2 * total**0.25)))


_SAFE = (1e-280, 1e300)  # squared lengths between which no sum of squares or product overflows or loses digits


def fit(sample: np.ndarray, centroids: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Centroids of both halves, (2, k, half), by Lloyd's rounds from rows drawn at random."""
    draw = np.random.default_rng(seed)
    half = sample.shape[1] // 2
    books = []
    for points in (sample[:, :half], sample[:, half:]):
        width = sample.shape[1] - half
        points = np.pad(points, ((0, 0), (0, width - points.shape[1])))
        book = points[draw.choice(len(points), min(centroids, len(points)), replace=False)]
        for _ in range(rounds):
            near = _distances(points, book).argmin(axis=1)
            counts = np.bincount(near, minlength=len(book))
            sums = np.zeros_like(book)
            np.add.at(sums, near, points)
            book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
        books.append(book)
    return np.stack(books)


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ book.T + (book**2).sum(axis=1)[None, :]


def _half_distances(units: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half, width = units.shape[1] // 2, books.shape[2]
    first = np.pad(units[:, :half], ((0, 0), (0, width - half)))
    return _distances(first, books[0]), _distances(units[:, half:], books[1])


def visited(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells in order of summed distance, until they hold ``enough`` vectors.

    ``first`` and ``second`` are a query's distances to the centroids of each
    half. The heap holds the frontier of the grid of both sorted lists.
    """
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, cells, held = [(float(first[by_first[0]] + second[by_second[0]]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(by_first[i]) * len(second) + int(by_second[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(first) and y < len(second) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (float(first[by_first[x]] + second[by_second[y]]), x, y))
    return cells


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec) of the vectors that take part: not null, not zero, all components finite numbers."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(F.col("vec").isNotNull())
    rows = rows.where(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    return rows.where("id IS NOT NULL")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), -1)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def cosine(query: np.ndarray, vector: np.ndarray) -> float:
    """The cosine of two vectors in double precision; scaled first only where squares leave the range of doubles."""
    with np.errstate(over="ignore", under="ignore"):
        sizes = np.dot(query, query), np.dot(vector, vector)
    if not all(_SAFE[0] < size < _SAFE[1] for size in sizes):
        query, vector = query / np.abs(query).max(), vector / np.abs(vector).max()
        sizes = np.dot(query, query), np.dot(vector, vector)
    return float(np.dot(query, vector) / (np.sqrt(sizes[0]) * np.sqrt(sizes[1])))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, centroids: int | None = None,
    probed_share: float = PROBED_SHARE, least_probed: int = LEAST_PROBED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of ``vectors`` found for each row of ``queries``, itself left out.

    Both have columns (id, vec) as ``usable`` gives them; the ids of queries are
    ids of vectors. Nearest is largest cosine, ties go to the smaller id. Fewer
    vectors than asked for: all of them. Rows with the same id and vector count
    once. Vectors of different lengths have no cosine: each length is a table of
    its own (at most MOST_LENGTHS, else an error). ``centroids`` per half: by
    default they grow with the table. A query's cells hold ``probed_share`` of the
    vectors, at every size of table, and ``least_probed`` at least.
    """
    spark = vectors.sparkSession
    length = F.size("vec")
    counted = vectors.groupBy(length.alias("n")).count().limit(MOST_LENGTHS + 1).collect()
    if len(counted) > MOST_LENGTHS:
        raise ValueError(f"vectors have more than {MOST_LENGTHS} different lengths")
    parts = []
    for n, total in sorted((row["n"], row["count"]) for row in counted):
        own = (vectors, queries) if len(counted) == 1 else (vectors.where(length == n), queries.where(length == n))
        parts.append(_of_one_length(*own, total, k, centroids or centroids_for(total), probed_share, least_probed))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, parts)


def _of_one_length(
    vectors: DataFrame, queries: DataFrame, total: int, k: int, centroids: int, probed_share: float, least_probed: int
) -> DataFrame:
    """``nearest`` among vectors of the same length, of which there is at least one."""
    keep = k + 1
    drawn = vectors.select("vec", F.xxhash64("id", "vec").alias("h")).orderBy("h").limit(SAMPLE_ROWS) if total > SAMPLE_ROWS else vectors
    points = _matrix(drawn.select("vec").toArrow().column("vec").combine_chunks())
    books = fit(_scaled(points), centroids)
    k2 = books.shape[1]  # centroids of each half

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = _matrix(batch.column(1))
            first, second = _half_distances(_scaled(rows), books)
            cell = first.argmin(axis=1) * k2 + second.argmin(axis=1)
            data = np.ascontiguousarray(rows)
            _, inverse = np.unique(data.view(f"V{8 * data.shape[1]}").ravel(), return_inverse=True)
            ids, merged = batch.column(0).to_numpy(), {}
            for at in np.argsort(ids, kind="stable").tolist():
                held = merged.setdefault(int(inverse[at]), (at, []))[1]
                if len(held) < keep and (not held or held[-1] != ids[at]):
                    held.append(int(ids[at]))
            rows_at = [at for at, _ in merged.values()]
            yield pa.RecordBatch.from_arrays([
                pa.array(cell[rows_at].astype(np.int32)), pa.array([data[at].tobytes() for at in rows_at], pa.binary()),
                pa.array([held for _, held in merged.values()], pa.list_(pa.int64())),
            ], names=["cell", "vec", "ids"])

    entries = vectors.select("id", "vec").mapInArrow(assign, "cell int, vec binary, ids array<long>")
    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    merged = entries.groupBy("vec").agg(F.first("cell").alias("cell"), smallest.alias("ids"))
    merged = stage(merged, "entries")
    counted = merged.groupBy("cell").count().collect()  # at most one row for each of the k2 * k2 cells
    sizes = np.zeros(k2 * k2, np.int64)
    for row in counted:
        sizes[row["cell"]] = row["count"]
    enough = max(least_probed, int(probed_share * sizes.sum()))
    shards = np.maximum(1, -(-sizes.reshape(k2, k2).sum(axis=1) // SHARD_ROWS)).tolist()

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard."""
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            cells, vecs, ids = [x[2] % k2 for x in held], [x[3] for x in held], [x[4] for x in held]
            return pa.RecordBatch.from_arrays([
                pa.array([held[0][0]], pa.int32()), pa.array([held[0][1]], pa.int32()),
                pa.array([bytes(cells)]), pa.array([b"".join(vecs)], pa.binary()),
                pa.array([np.array([i for x in ids for i in x], np.int64).tobytes()], pa.binary()),
                pa.array([np.cumsum([0, *map(len, ids)]).astype(np.int64).tobytes()], pa.binary()),
            ], names=["first", "shard", "seconds", "vecs", "ids", "starts"])

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and (row[:2] != held[0][:2] or len(held) >= BLOCK):
                    yield out()
                    held.clear()
                held.append(row)
        if held:
            yield out()

    listed = F.array(*(F.lit(n) for n in shards))
    first = F.floor(F.col("cell") / k2).cast("int")
    placed = merged.select(
        first.alias("first"), F.pmod(F.xxhash64("vec"), F.get(listed, first)).cast("int").alias("shard"), "cell", "vec", "ids"
    )
    blocks = placed.repartition("first", "shard").sortWithinPartitions("first", "shard", "cell").mapInArrow(
        block, "first int, shard int, seconds binary, vecs binary, ids binary, starts binary"
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), QUERY_BLOCK):
                some = batch.slice(at, QUERY_BLOCK)
                rows, ids = _matrix(some.column(1)), some.column(0).to_numpy()
                near_first, near_second = _half_distances(_scaled(rows), books)
                sets = np.zeros((k2, len(rows), k2), bool)
                for q in range(len(rows)):
                    cells = np.array(visited(near_first[q], near_second[q], sizes, enough), np.int64)
                    sets[cells // k2, q, cells % k2] = True
                any_of = sets.any(axis=2)
                for one in np.flatnonzero(any_of.any(axis=1)).tolist():
                    members = np.flatnonzero(any_of[one])
                    values = (ids[members], np.packbits(sets[one, members], axis=1), np.ascontiguousarray(rows[members]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([one], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in values)],
                        names=["q_first", "q_ids", "q_sets", "q_vecs"],
                    )

    probes = queries.select("id", "vec").mapInArrow(probe, "q_first int, q_ids binary, q_sets binary, q_vecs binary")
    probes = probes.withColumn("q_shard", F.explode(F.sequence(F.lit(0), F.get(listed, F.col("q_first")) - 1)))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {}

        def out() -> pa.RecordBatch:
            rows = [(q, i, score) for q, found in best.items() for score, i in found]
            names, kinds = ("query_id", "vec_id", "score"), (pa.int64(), pa.int64(), pa.float64())
            columns = list(zip(*rows)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for batch in batches:
            for seconds, vecs, ids, starts, q_ids, q_sets, q_vecs in zip(*(column.to_pylist() for column in batch.columns)):
                starts, q_ids = np.frombuffer(starts, np.int64), np.frombuffer(q_ids, np.int64)
                ids, n = np.frombuffer(ids, np.int64), len(starts) - 1
                rows = np.frombuffer(vecs).reshape(n, -1)
                asked = np.frombuffer(q_vecs).reshape(len(q_ids), -1)
                seen = np.unpackbits(np.frombuffer(q_sets, np.uint8).reshape(len(q_ids), -1), axis=1)[:, np.frombuffer(seconds, np.uint8)]
                close = np.where(seen == 1, _scaled(asked) @ _scaled(rows).T, -9.0)
                for q, line, vector in zip(q_ids.tolist(), close, asked):
                    # near enough to be among the first even if the product is off in its last bits
                    bound = np.partition(line, n - keep)[n - keep] - 1e-9 if n > keep else -2.0
                    bound = max(bound, -2.0)  # what the query does not visit takes no part
                    found = best.get(q, [])
                    if len(found) == keep:
                        bound = max(bound, found[-1][0] - 1e-9)
                    new = []
                    for at in np.flatnonzero(line >= bound).tolist():
                        score = cosine(vector, rows[at])
                        new += [(score, int(i)) for i in ids[starts[at]:starts[at + 1]] if i != q]
                    if new:
                        best[q] = sorted({*found, *new}, key=lambda x: (-x[0], x[1]))[:keep]
            if len(best) > 20_000:
                yield out()
                best.clear()
        yield out()

    pairs = blocks.join(probes, (F.col("first") == F.col("q_first")) & (F.col("shard") == F.col("q_shard"))).select(
        "seconds", "vecs", "ids", "starts", "q_ids", "q_sets", "q_vecs"
    )
    found = pairs.mapInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
