"""Toxicity of documents from their nearest labelled examples.

Documents and examples are TF-IDF vectors over a vocabulary of words and word
beginnings, and of those that a text repeats. A document's nearest examples by exact cosine are found with an
inverted index whose postings are divided into blocks of examples. Per term and
block the largest weight is known, so the sum over a document's terms bounds
every cosine in a block; blocks are visited by falling bound until the bound falls
below the K-th cosine found. The votes of the neighbours are weighted by
similarity, and a monotone curve, fitted to the votes that each example gets from
all others, turns a vote into a probability. The neighbours are the evidence.

What is fitted is bounded: at most EXAMPLES labelled documents, drawn by hash of
their ids, at most VOCABULARY terms, and only so many of the examples that their
vectors hold at most POSTINGS entries. The index is therefore small enough to be
sent to every task. Whole texts are read, and all documents are scored, row by
row, without a shuffle of any text.

Defined results: a null or empty text has no terms, no neighbours and the score
of all texts without neighbours; of equal cosines the example with the smaller id
comes first; a doc_id with several labels counts by the largest; labels other
than 0 and 1 are ignored; without any usable label all scores are 0; repeated rows
stay, and count once as examples; a null doc_id is not held out and has no label;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import stage

EXAMPLES = 10_000
VOCABULARY = 2_048
POSTINGS = 2_000_000
LEAST_DOCS = 5  # examples that a term of the vocabulary is in, at least
LEAST_CHI2 = 10.83  # association with the label by chance: one in a thousand
BEGINNINGS = (4, 5, 6)  # letters of a word that make a term of their own
LONGEST_TERM = 32
AGAIN = (2, 3)  # a term found so often in a text is joined by a further term that says so
NEIGHBOURS = 15
PRIOR_WEIGHT = 0.2  # of the share of toxic examples, against the squared cosines of the neighbours
BLOCK = 32  # examples in a block
VISITED = 8  # blocks that are looked into at once
_DIGITS = 12  # of a cosine, so that sums in another order tie as well

_WORD = re.compile(r"\w+")


def terms_of_word(word: str) -> list[str]:
    """The word, marked as whole, and its beginnings."""
    found = [f"{word}$"] if len(word) < LONGEST_TERM else []
    return found + [word[:n] for n in BEGINNINGS if len(word) >= n]


def words_of(text: str | None) -> Counter[str]:
    return Counter(_WORD.findall((text or "").lower()))


def term_counts(text: str | None) -> Counter[str]:
    """How often each term occurs in a whole text; terms of repetition count once."""
    found: Counter[str] = Counter()
    for word, times in words_of(text).items():
        for term in terms_of_word(word):
            found[term] += times
    for term, times in list(found.items()):
        for least in AGAIN:
            if times >= least:
                found[f"{term}*{least}"] = 1
    return found


@dataclass
class Vectors:
    """TF-IDF vectors of length one over the vocabulary."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    _words: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"vocabulary": self.vocabulary, "idf": self.idf, "_words": {}}

    @cached_property
    def counted(self) -> dict[str, int]:
        """Number of each plain term that has to be counted."""
        return {term: i for i, term in enumerate(sorted({term.partition("*")[0] for term in self.vocabulary}))}

    @cached_property
    def places(self) -> list[list[tuple[int, int]]]:
        """Per plain term: (least count, place in the vocabulary) of the terms it gives; 0 for the plain term itself."""
        return [
            [(least, self.vocabulary[name]) for least in (0, *AGAIN) if (name := f"{term}*{least}" if least else term) in self.vocabulary]
            for term in self.counted
        ]

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights), terms ascending; both empty if the text has none of the vocabulary."""
        if len(self._words) > 200_000:
            self._words.clear()
        counted, places, counts = self.counted, self.places, {}
        for word, times in words_of(text).items():
            known = self._words.get(word)
            if known is None:
                known = tuple(counted[t] for t in terms_of_word(word) if t in counted)
                if len(word) <= 2 * LONGEST_TERM:
                    self._words[word] = known
            for term in known:
                counts[term] = counts.get(term, 0) + times
        found = sorted((place, times if not least else 1) for term, times in counts.items() for least, place in places[term] if times >= least)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        terms, times = (np.array(x) for x in zip(*found))
        weights = (1 + np.log(times)) * self.idf[terms]
        return terms, weights / np.sqrt((weights**2).sum())


@dataclass
class Index:
    """Postings of the examples, by term and example, with the largest weight per term and block."""

    ids: np.ndarray  # of the examples, in the order of the index
    labels: np.ndarray
    term: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    n_terms: int

    @classmethod
    def build(cls, ids: list[int], labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> Index:
        """Examples with the same weightiest term are put next to each other, so that blocks have low bounds for other terms."""
        heads = [int(terms[weights.argmax()]) if len(terms) else n_terms for terms, weights in vectors]
        order = sorted(range(len(ids)), key=lambda i: (heads[i], ids[i]))
        sizes = [len(vectors[i][0]) for i in order]
        term = np.concatenate([np.zeros(0, np.int64), *(vectors[i][0] for i in order)])
        weight = np.concatenate([np.zeros(0), *(vectors[i][1] for i in order)])
        example = np.repeat(np.arange(len(order)), sizes)
        by_term = np.argsort(term, kind="stable")
        return cls(
            np.array([ids[i] for i in order], np.int64), np.array([labels[i] for i in order], np.int64),
            term[by_term], example[by_term], weight[by_term], n_terms,
        )

    def __getstate__(self) -> dict:
        return {name: getattr(self, name) for name in self.__dataclass_fields__}

    @property
    def n_blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)

    @cached_property
    def cuts(self) -> np.ndarray:
        """Where the postings of each term begin in each block; one column more for their end."""
        key = self.term * (self.n_blocks + 1) + self.example // BLOCK
        wanted = np.arange(self.n_terms)[:, None] * (self.n_blocks + 1) + np.arange(self.n_blocks + 1)
        return np.searchsorted(key, wanted.ravel()).reshape(wanted.shape)

    @cached_property
    def block_max(self) -> np.ndarray:
        most = np.zeros((self.n_terms, self.n_blocks))
        np.maximum.at(most, (self.term, self.example // BLOCK), self.weight)
        return most

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, without: int | None = None) -> list[tuple[float, int, int]]:
        """(cosine, example id, label) of the k nearest examples with a cosine above 0, nearest first.

        ``without`` leaves out examples with that id.
        """
        if not len(terms) or not len(self.ids):
            return []
        bounds = weights @ self.block_max[terms]
        order = np.argsort(-bounds, kind="stable")
        best: list[tuple[float, int, int]] = []
        for at in range(0, len(order), VISITED):
            blocks = order[at:at + VISITED]
            blocks = blocks[bounds[blocks] > 0]
            if len(best) == k:
                blocks = blocks[bounds[blocks] > best[-1][0] - 1e-9]
            if not len(blocks):
                break
            low, high = self.cuts[terms[:, None], blocks], self.cuts[terms[:, None], blocks + 1]
            sizes = (high - low).ravel()
            ends = np.cumsum(sizes)
            at_posting = np.arange(ends[-1]) + np.repeat(low.ravel() - (ends - sizes), sizes)
            share = self.weight[at_posting] * np.repeat(np.repeat(weights, len(blocks)), sizes)
            examples, slot = np.unique(self.example[at_posting], return_inverse=True)
            cosines = np.round(np.bincount(slot, share, len(examples)), _DIGITS)
            if len(best) == k:
                near = cosines >= best[-1][0]
                examples, cosines = examples[near], cosines[near]
            found = zip(cosines.tolist(), self.ids[examples].tolist(), self.labels[examples].tolist())
            best = sorted([*best, *(x for x in found if x[0] > 0 and x[1] != without)], key=lambda x: (-x[0], x[1]))[:k]
        return best


def vote(neighbours: list[tuple[float, int, int]], prior: float) -> float:
    """The share of toxic neighbours, each weighted by its squared cosine, drawn towards the prior where they are far."""
    total = sum(cosine**2 for cosine, _, _ in neighbours)
    toxic = sum(cosine**2 * label for cosine, _, label in neighbours)
    return (toxic + PRIOR_WEIGHT * prior) / (total + PRIOR_WEIGHT)


def monotone_curve(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes and probabilities between which a vote is interpolated: pooled adjacent violators."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # rows, sum of labels, sum of votes
    values, starts = np.unique(votes[order], return_index=True)
    sums = np.add.reduceat(labels[order].astype(float), starts) if len(values) else np.zeros(0)
    counts = np.diff([*starts, len(votes)])
    for value, total, count in zip(values.tolist(), sums.tolist(), counts.tolist()):
        pools.append([count, total, value * count])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[2] / p[0] for p in pools]), np.array([p[1] / p[0] for p in pools])


@dataclass
class Model:
    vectors: Vectors
    index: Index
    prior: float
    curve: tuple[np.ndarray, np.ndarray]

    def score(self, text: str | None) -> tuple[float, list[tuple[float, int, int]]]:
        """The probability that a text is toxic, and the neighbours that say so."""
        near = self.index.nearest(*self.vectors.of(text))
        if not len(self.curve[0]):
            return 0.0, near
        return float(np.interp(vote(near, self.prior), *self.curve)), near


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """(id, label, text): at most ``examples`` labelled documents that are not held out, drawn by hash of their ids.

    Ids are drawn from the labels alone and sent to the documents, so no text is shuffled but theirs.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("label")).where(~held_out("id"))
    drawn = usable.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(examples)
    rows = docs.select(F.col("doc_id").cast("long").alias("d_id"), "text")
    found = rows.join(F.broadcast(drawn), F.col("d_id") == F.col("id")).select("id", "label", "text")  # at most ``examples`` rows
    # ids that several documents share: first by hash, so that the bound holds for rows as well
    found = stage(found.withColumn("drawn", F.xxhash64("id", "text")).dropDuplicates(["id", "drawn"]), "toxic-sample")
    keys = found.select("drawn").orderBy("drawn").limit(examples).agg(F.max("drawn").alias("last")).first()["last"]
    return found.where(F.col("drawn") <= F.lit(keys)) if keys is not None else found


def vocabulary(rows: DataFrame, size: int = VOCABULARY) -> DataFrame:
    """(term, docs): the terms whose share of examples differs most between the labels, by chi-squared."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in term_counts(text):
                    seen.setdefault(term, [0, 0])[label] += 1
            clean, toxic = zip(*seen.values()) if seen else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())], names=["term", "clean", "toxic"]
            )

    totals = rows.agg(F.count_if(F.col("label") == 0).alias("all_clean"), F.count_if(F.col("label") == 1).alias("all_toxic"))  # one row
    counted = rows.select("label", "text").mapInArrow(count, "term string, clean long, toxic long")
    counted = counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = counted.where(F.col("clean") + F.col("toxic") >= LEAST_DOCS).crossJoin(F.broadcast(totals))
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    c, d = F.col("all_toxic") - a, F.col("all_clean") - b
    chi2 = (a + b + c + d) * F.pow(a * d - b * c, 2) / F.greatest((a + b) * (c + d) * (a + c) * (b + d), F.lit(1.0))
    chosen = counted.withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2).orderBy(F.desc("chi2"), "term").limit(size)
    return chosen.select("term", (F.col("clean") + F.col("toxic")).alias("docs"))


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, terms: int = VOCABULARY, postings: int = POSTINGS) -> Model:
    """Vocabulary, index and curve from the sample. Collected: terms, vectors and votes of the sample, all bounded."""
    rows = sample(docs, labels, examples)
    chosen = sorted((r["term"], r["docs"]) for r in vocabulary(rows, terms).collect())
    n_rows = rows.count()
    idf = np.array([1 + np.log((n_rows + 1) / (docs_of + 1)) for _, docs_of in chosen])
    vectors = Vectors({term: i for i, (term, _) in enumerate(chosen)}, idf)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [vectors.of(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(3), pa.array([len(t) for t, _ in made], pa.int64()),
                pa.array([t for t, _ in made], pa.list_(pa.int64())), pa.array([w for _, w in made], pa.list_(pa.float64())),
            ], names=["id", "label", "drawn", "n", "terms", "weights"])

    embedded = stage(
        rows.select("id", "label", "text", "drawn").mapInArrow(embed, "id long, label int, drawn long, n long, terms array<long>, weights array<double>"),
        "toxic-vectors",
    )
    so_far = F.sum("n").over(Window.orderBy("drawn", "id").rowsBetween(Window.unboundedPreceding, 0))  # over the sample's ids and sizes
    last = embedded.select("drawn", "id", "n").withColumn("held", so_far).where(F.col("held") <= postings).agg(F.max("drawn").alias("last")).first()["last"]
    found = embedded.where(F.col("drawn") <= F.lit(last)).toArrow().to_pylist() if last is not None else []
    index = Index.build(
        [r["id"] for r in found], [r["label"] for r in found],
        [(np.array(r["terms"], np.int64), np.array(r["weights"])) for r in found], len(chosen),
    )
    prior = float(index.labels.mean()) if len(index.labels) else 0.0

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = [
                vote(index.nearest(np.array(terms, np.int64), np.array(weights), without=doc_id), prior)
                for doc_id, terms, weights in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(votes, pa.float64())], names=["label", "vote"])

    votes = embedded.select("id", "label", "terms", "weights").mapInArrow(left_out, "label int, vote double").toArrow()
    curve = monotone_curve(votes.column("vote").to_numpy(), votes.column("label").to_numpy())
    return Model(vectors, index, prior, curve)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, evidence) of every row; evidence lists the neighbours (example, cosine, label), nearest first."""
    kind = pa.list_(pa.struct([("example", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                some = batch.slice(at, 1024)
                made = [model.score(text) for text in some.column(1).to_pylist()]
                evidence = [[{"example": i, "cosine": c, "label": y} for c, i, y in near] for _, near in made]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([s for s, _ in made], pa.float64()), pa.array(evidence, kind)], names=["doc_id", "score", "evidence"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        score, "doc_id long, score double, evidence array<struct<example long, cosine double, label int>>"
    )


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every document."""
    found = scored(docs, fit(docs, labels))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence"
    )
