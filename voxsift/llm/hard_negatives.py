"""Hard negatives by inner product, with score bounds from stored angles.

Vectors become whole numbers, floor(256 x), and a row's score is its exact inner
product with an anchor. An anchor's positives are its nearest rows of the same
label; for each positive, the hard negatives are the best rows of another label
whose score lies in a window below the positive's.

Filter: the angles of every vector to a few reference directions are stored. By
the triangle inequality, angles s and t of two vectors to one direction leave
their own angle between |s - t| and min(s + t, 2 pi - s - t). The cosines of that
interval times both norms, widened by more than all rounding, bound the score.
Rows of one reference are kept in order of their angle to it, in chunks whose
extreme angles and norms are known. A chunk whose bounds do not overlap what an
anchor still looks for is left out, and of the others only the window of angles
that can matter gets integer scoring.

Distribution: rows are dealt out by their nearest reference, in shards of at most
some SHARD_ROWS rows, so a reference that most rows share is many shards. Anchors
are packed into blocks, and each block goes to all shards of its length of vector:
a task holds one shard and lets the blocks pass. It keeps only the few best rows
per anchor and window; these are ranked after a shuffle.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component (also if 256 times it is not finite), take no part; a row is
never its own positive, but a repeated row is another row; vectors of different
lengths have no score; ties go to the smaller id; scores beyond a long are the
nearest long. An empty table, or a single label, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage

REFERENCES = 16
SAMPLE_ROWS = 8_192  # rows that the reference directions are fitted to, at most
ROUNDS = 8
FITTED_LENGTHS = 8  # lengths of vector that get directions of their own; others have one direction
SHARD_ROWS = 16_384
CHUNK = 256
ANCHOR_BLOCK = 128
HELD_BLOCKS = 1_000  # blocks of anchors whose best rows a task holds before it gives them out
POSITIVES = 5
NEGATIVES = 3
SCALE = 256
#: Of the product of both norms: far above the rounding of angles (4e-8 near 0 and pi, stored as 32 bits) and cosines.
SLACK = 4e-6

_LOWEST, _HIGHEST = -(1 << 63) + 1, (1 << 63) - 1
_TYPES = (np.dtype("<i2"), np.dtype("<i4"), np.dtype("<f8"))


def packed(row: np.ndarray) -> bytes:
    """Whole numbers (held as doubles) in the smallest type that holds them, after a byte that names it."""
    most = np.abs(row).max(initial=0)
    kind = 0 if most < 1 << 15 else 1 if most < 1 << 31 else 2
    return bytes([kind]) + row.astype(_TYPES[kind]).tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    """Rows of one length as doubles."""
    return np.array([np.frombuffer(row, _TYPES[row[0]], offset=1) for row in rows], np.float64)


def directions(units: np.ndarray, count: int = REFERENCES, seed: int = 5) -> np.ndarray:
    """Reference directions by spherical k-means on unit vectors."""
    draw = np.random.default_rng(seed)
    book = units[draw.choice(len(units), min(count, len(units)), replace=False)]
    for _ in range(ROUNDS):
        near = (units @ book.T).argmax(axis=1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, units)
        sizes = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        book = np.where(sizes > 1e-12, sums / np.maximum(sizes, 1e-12), book)
    return book


def units_and_norms(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zero rows stay) and their norms, scaled first so that no square overflows."""
    if not rows.shape[1]:
        return rows, np.zeros(len(rows))
    most = np.abs(rows).max(axis=1, keepdims=True)
    scaled = rows / np.where(most > 0, most, 1)
    sizes = np.sqrt((scaled**2).sum(axis=1, keepdims=True))
    return scaled / np.where(sizes > 0, sizes, 1), (sizes * most)[:, 0]


def angles(units: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ book.T, -1, 1)).astype(np.float32)


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows, (left, right); beyond a long the nearest long."""
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    if largest < 1 << 53:
        return (left @ right.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(left) @ whole(right).T if left.size and right.size else np.zeros((len(left), len(right)), object)
    return np.clip(exact, _LOWEST, _HIGHEST).astype(np.int64)


def score_bounds(
    own: np.ndarray, own_norm: np.ndarray, least: np.ndarray, most: np.ndarray, least_norm: np.ndarray, most_norm: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds, (anchor, chunk), of the scores of rows whose angles and norms lie within the given extremes."""
    s, low, high = own[:, None, :], least[None, :, :], most[None, :, :]
    closest = np.maximum(np.maximum(s - high, low - s), 0).max(axis=2)
    farthest = np.minimum(s + high, 2 * np.pi - s - low).min(axis=2)
    best, worst = np.cos(np.minimum(closest, np.pi)), np.cos(np.clip(farthest, 0, np.pi))
    with np.errstate(over="ignore", invalid="ignore"):
        slack = SLACK * own_norm[:, None] * most_norm[None, :] + 1
        upper = own_norm[:, None] * np.where(best >= 0, most_norm, least_norm) * best + slack
        lower = own_norm[:, None] * np.where(worst >= 0, least_norm, most_norm) * worst - slack
    return np.where(np.isfinite(lower), lower, -np.inf), np.where(np.isfinite(upper), upper, np.inf)


class Shard:
    """Rows of one reference in order of their angle to it, in chunks."""

    def __init__(self, own_reference: int, ids: list[int], uids: list[int], labels: list[int], rows: list[bytes], angle_rows: list[bytes], norms: list[float]):
        by = np.array([np.frombuffer(a, np.float32) for a in angle_rows], np.float64)
        order = np.argsort(by[:, own_reference], kind="stable")
        self.reference = own_reference
        self.ids, self.uids, self.labels = np.array(ids, np.int64)[order], np.array(uids, np.int64)[order], np.array(labels, np.int64)[order]
        self.rows, self.angles, self.norms = unpacked(rows)[order], by[order], np.array(norms)[order]
        self.starts = np.arange(0, len(ids), CHUNK)
        self.least, self.most = np.minimum.reduceat(self.angles, self.starts), np.maximum.reduceat(self.angles, self.starts)
        self.least_norm, self.most_norm = np.minimum.reduceat(self.norms, self.starts), np.maximum.reduceat(self.norms, self.starts)

    def window(self, chunk: int, block: Block, members: np.ndarray, low: np.ndarray) -> slice:
        """The rows of a chunk whose angle is near enough to that of any of the anchors."""
        start, end = int(self.starts[chunk]), min(int(self.starts[chunk]) + CHUNK, len(self.ids))
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            needed = (low[members] - 1) / (block.norms[members] * self.most_norm[chunk]) - SLACK
        # a cosine of at least ``needed`` > 0 leaves no wider gap than its angle; below that any gap will do
        gap = np.where(np.isfinite(needed) & (needed > 0), np.arccos(np.clip(needed, 0, 1)), np.pi)
        own, along = block.angles[members, self.reference], self.angles[start:end, self.reference]
        return slice(start + int(np.searchsorted(along, (own - gap).min(), "left")), start + int(np.searchsorted(along, (own + gap).max(), "right")))


class Block:
    """Anchors with the windows of scores they look for, and the best rows found so far in each."""

    def __init__(self, held: dict[str, bytes], best: int, same_label: bool):
        self.uids, self.labels = np.frombuffer(held["uids"], np.int64), np.frombuffer(held["labels"], np.int64)
        m = len(self.uids)
        self.rows = unpacked(_listed(held["rows"], m))
        self.angles, self.norms = np.frombuffer(held["angles"], np.float32).reshape(m, -1).astype(np.float64), np.frombuffer(held["norms"])
        self.low, self.high = np.frombuffer(held["low"], np.int64).reshape(m, -1), np.frombuffer(held["high"], np.int64).reshape(m, -1)
        self.best, self.same_label = best, same_label
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))  # slot: anchor * windows + window

    def wanted(self) -> np.ndarray:
        """The lowest score that can still be among the best, per anchor and window."""
        windows = self.low.shape[1]
        low, counts = self.low.copy().ravel(), np.bincount(self.slot, minlength=self.low.size)
        full = counts == self.best
        ends = np.cumsum(counts) - 1  # rows are in order of slot, best first
        low[full] = np.maximum(low[full], self.score[ends[full]])
        return low.reshape(-1, windows)

    def meet(self, shard: Shard) -> int:
        """Look through a shard; returns how many pairs were scored."""
        done = 0
        least, most = self.outer(self.wanted())
        lower, upper = score_bounds(self.angles, self.norms, shard.least, shard.most, shard.least_norm, shard.most_norm)
        # chunks that promise most come first, so that later ones can be left out
        for chunk in np.argsort(-upper.max(axis=0), kind="stable").tolist():
            members = np.flatnonzero((upper[:, chunk] >= least) & (lower[:, chunk] <= most))
            if not len(members):
                continue
            part = shard.window(chunk, self, members, least)
            if part.start >= part.stop:
                continue
            found = scores(self.rows[members], shard.rows[part])
            done += found.size
            same = self.labels[members][:, None] == shard.labels[part][None, :]
            allowed = same & (self.uids[members][:, None] != shard.uids[part][None, :]) if self.same_label else ~same
            self.take(members, found, allowed, shard.ids[part])
            least, most = self.outer(self.wanted())
        return done

    def outer(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The span of all windows of an anchor that are still open."""
        is_open = low <= self.high
        return np.where(is_open, low, _HIGHEST).min(axis=1).astype(float), np.where(is_open, self.high, _LOWEST).max(axis=1).astype(float)

    def take(self, members: np.ndarray, found: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        windows, low = self.low.shape[1], self.wanted()
        slots, values, names = [self.slot], [self.score], [self.id]
        for w in range(windows):
            fits = allowed & (found >= low[members, w][:, None]) & (found <= self.high[members, w][:, None])
            if not fits.any():
                continue
            if found.shape[1] > self.best:  # no more than the best of a chunk, and what ties with them
                masked = np.where(fits, found, _LOWEST - 1)
                edge = np.partition(masked, found.shape[1] - self.best, axis=1)[:, found.shape[1] - self.best]
                fits &= found >= edge[:, None]
            i, j = np.nonzero(fits)
            slots.append(members[i] * windows + w)
            values.append(found[i, j])
            names.append(ids[j])
        if len(slots) == 1:
            return
        slot, score, name = np.concatenate(slots), np.concatenate(values), np.concatenate(names)
        order = np.lexsort((name, -score, slot))
        slot, score, name = slot[order], score[order], name[order]
        first = np.searchsorted(slot, slot)
        keep = np.arange(len(slot)) - first < self.best
        self.slot, self.score, self.id = slot[keep], score[keep], name[keep]

    def out(self) -> pa.RecordBatch:
        windows = self.low.shape[1]
        columns = [self.uids[self.slot // windows], self.slot % windows, self.id, self.score]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["uid", "part", "found_id", "score"])


def _joined(rows: list[bytes]) -> bytes:
    sizes = np.array([len(row) for row in rows], np.int64)
    return sizes.tobytes() + b"".join(rows)


def _listed(joined: bytes, count: int) -> list[bytes]:
    ends = 8 * count + np.cumsum(np.frombuffer(joined, np.int64, count))
    starts = [8 * count, *ends[:-1].tolist()]
    return [joined[a:b] for a, b in zip(starts, ends.tolist())]


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, vec) of the rows that take part."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec")
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(finite)


def _whole(column: pa.Array) -> list[np.ndarray]:
    """floor(256 x) of each vector, as doubles."""
    values, offsets = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False)), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    return [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def references(rows: DataFrame) -> dict[int, np.ndarray]:
    """Reference directions per length of vector, fitted to at most SAMPLE_ROWS rows drawn by hash."""
    drawn = rows.select("vec", F.xxhash64("id", "vec").alias("drawn")).orderBy("drawn").limit(SAMPLE_ROWS).select("vec").toArrow()
    of_length: dict[int, list[np.ndarray]] = {}
    if drawn.num_rows:
        for row in _whole(drawn.column("vec").combine_chunks()):
            if row.any():
                of_length.setdefault(len(row), []).append(row)
    frequent = sorted(of_length, key=lambda n: (-len(of_length[n]), n))[:FITTED_LENGTHS]
    return {n: directions(units_and_norms(np.array(of_length[n]))[0]) for n in frequent}


_ANGLED = "id long, label long, length int, reference int, norm double, angles binary, vec binary"


def with_angles(rows: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """The rows as whole numbers, with norm, angles to all reference directions, and the nearest of them; a stored table with a ``uid``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_length: dict[int, list[int]] = {}
            whole = _whole(batch.column(2))
            for at, row in enumerate(whole):
                of_length.setdefault(len(row), []).append(at)
            for length, members in of_length.items():
                units, norms = units_and_norms(np.array([whole[at] for at in members]).reshape(len(members), length))
                book = books.get(length)
                book = np.full((1, length), 1 / np.sqrt(max(length, 1))) if book is None else book
                near = angles(units, book)
                taken = pa.array(members)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(taken), batch.column(1).take(taken), pa.array([length] * len(members), pa.int32()),
                    pa.array(near.argmin(axis=1).astype(np.int32)), pa.array(norms, pa.float64()),
                    pa.array([a.tobytes() for a in near], pa.binary()), pa.array([packed(whole[at]) for at in members], pa.binary()),
                ], names=[field.split(" ")[0] for field in _ANGLED.split(", ")])

    return stage(rows.select("id", "label", "vec").mapInArrow(measure, _ANGLED).withColumn("uid", F.monotonically_increasing_id()), "angled")


_BLOCK_FIELDS = ("uids", "labels", "norms", "angles", "rows", "low", "high")


def anchor_blocks(anchors: DataFrame) -> DataFrame:
    """Anchors (uid, label, length, reference, norm, angles, vec, low, high) packed into rows of at most ANCHOR_BLOCK of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            length, uids, labels, norms, near, rows, low, high = zip(*held)
            flat = [
                np.array(uids, np.int64).tobytes(), np.array(labels, np.int64).tobytes(), np.array(norms).tobytes(), b"".join(near),
                _joined(list(rows)), np.array(low, np.int64).tobytes(), np.array(high, np.int64).tobytes(),
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([length[0]], pa.int32()), *(pa.array([x], pa.binary()) for x in flat)], names=["length", *_BLOCK_FIELDS]
            )

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and (row[0] != held[0][0] or len(held) >= ANCHOR_BLOCK):
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    columns = anchors.select("length", "uid", "label", "norm", "angles", "vec", "low", "high", "reference")
    dealt = columns.repartition("length", "reference").sortWithinPartitions("length", "reference", "uid").drop("reference")
    return dealt.mapInArrow(pack, "length int, " + ", ".join(f"{name} binary" for name in _BLOCK_FIELDS))


def best_rows(rows: DataFrame, anchors: DataFrame, best: int, same_label: bool) -> DataFrame:
    """(uid, part, found_id, score, rank): per anchor and window the ``best`` rows of the same, or of another, label.

    ``rows`` as ``with_angles`` gives them; ``anchors`` are such rows with arrays ``low`` and ``high``, one
    window of scores per entry and as many entries in each anchor.
    """
    counts = rows.groupBy("length", "reference").agg(F.count("*").alias("n"))
    counts = stage(counts.withColumn("shards", F.ceil(F.col("n") / SHARD_ROWS).cast("int")), "shards")
    shards = counts.select("length", "reference", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    empty = lambda *names: [F.lit(None).cast("binary").alias(n) for n in names]
    in_shards = rows.join(counts.select("length", "reference", "shards"), ["length", "reference"]).select(
        "length", "reference", F.pmod(F.xxhash64("uid"), F.col("shards")).cast("int").alias("shard"), F.lit(0).alias("kind"),
        "id", "uid", "label", "norm", F.col("angles").alias("row_angles"), "vec", *empty(*_BLOCK_FIELDS),
    )
    passing = anchor_blocks(anchors).join(shards, "length").select(
        "length", "reference", "shard", F.lit(1).alias("kind"), *(F.lit(None).cast("long").alias(n) for n in ("id", "uid", "label")),
        F.lit(None).cast("double").alias("norm"), *empty("row_angles", "vec"), *_BLOCK_FIELDS,
    )
    both = in_shards.unionByName(passing).repartition("length", "reference", "shard").sortWithinPartitions("length", "reference", "shard", "kind")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, shard = None, [], None
        blocks: dict[bytes, Block] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if (row["length"], row["reference"], row["shard"]) != key:
                    key, waiting, shard = (row["length"], row["reference"], row["shard"]), [], None
                if row["kind"] == 0:
                    waiting.append(row)
                    continue
                if shard is None:
                    if not waiting:  # a shard that no row fell into
                        continue
                    columns = [[r[n] for r in waiting] for n in ("id", "uid", "label", "vec", "row_angles", "norm")]
                    shard, waiting = Shard(key[1], *columns), []
                block = blocks.get(row["uids"])
                if block is None:
                    block = blocks[row["uids"]] = Block({n: row[n] for n in _BLOCK_FIELDS}, best, same_label)
                block.meet(shard)
                if len(blocks) > HELD_BLOCKS:
                    yield from (b.out() for b in blocks.values())
                    blocks = {}
        yield from (b.out() for b in blocks.values())

    found = both.mapInArrow(look, "uid long, part long, found_id long, score long")
    order = Window.partitionBy("uid", "part").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def hard_negatives(
    rows: DataFrame, anchors: str = "id % 50 = 0", positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = 50, most: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` as ``usable`` gives them; ``anchors`` is a condition on their columns. A negative fits a positive if its
    score lies between ``least`` and ``most`` hundredths of the positive's, ends included.
    """
    table = with_angles(rows, references(rows))
    asked = table.where(anchors)
    everything = asked.withColumns({"low": F.array(F.lit(_LOWEST)), "high": F.array(F.lit(_HIGHEST))})
    near = stage(best_rows(table, everything, positives, True), "positives")
    # 100 * score >= least * positive and 100 * score <= most * positive, in whole numbers that a long may not hold
    of_positive = F.col("score").cast("decimal(20,0)")
    windows = near.withColumn("low", F.ceil(of_positive * least / 100).cast("decimal(22,0)")).withColumn("high", F.floor(of_positive * most / 100).cast("decimal(22,0)"))
    by_rank = lambda name, empty: F.transform(
        F.sequence(F.lit(1), F.lit(positives)), lambda i: F.coalesce(F.get(F.filter("p", lambda x: x["rank"] == i), F.lit(0))[name], F.lit(empty))
    )
    limited = windows.withColumns({name: F.least(F.greatest(F.col(name), F.lit(_LOWEST)), F.lit(_HIGHEST)).cast("long") for name in ("low", "high")})
    grouped = limited.groupBy(F.col("uid").alias("p_uid")).agg(F.collect_list(F.struct("rank", "low", "high")).alias("p"))  # at most ``positives``
    wanted = asked.join(grouped, F.col("uid") == F.col("p_uid")).withColumns({"low": by_rank("low", 1), "high": by_rank("high", 0)})
    found = best_rows(table, wanted.drop("p", "p_uid"), negatives, False)
    left = near.select("uid", (F.col("rank") - 1).cast("long").alias("part"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = found.select("uid", "part", "rank", F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = asked.select("uid", F.col("id").alias("anchor_id"))
    return named.join(left, ["uid", "part"]).join(ids, "uid").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
