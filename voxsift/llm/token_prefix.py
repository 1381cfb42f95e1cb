"""Token counts at every prefix of a text, by dynamic programming over byte-pair tokens.

A byte-pair encoding is right exactly if each pair of neighbouring tokens is:
the merges of the pair's bytes give the pair again. So the last token of a
prefix is the one that fits to the last token of the prefix before it, and the
count of a prefix is one more than the count of that shorter prefix. One pass
over a word yields the counts of all its prefixes.

Words never share tokens, so the count of a text's prefix is the sum over its
whole words plus one look-up in the table of the word it ends in. That answers
how many tokens a text has, whether it fits a budget, and where to cut it,
without encoding any prefix again.

The vocabulary is a ``tokenizers`` file with a marker for the end of a word;
its normalizer and its splitting into words are the library's own.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NEVER = 1 << 60
_ASCII_UNIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")  # the file's pattern for ASCII (fixed value)
_CHUNK = re.compile(r"[^\t-\r ]+")
# characters that str.split() takes for white space and not every library does: then only ASCII white space divides
_OTHER_SPACE = "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_MOST_WORDS = 900_000  # tables kept per worker; full ones are emptied and filled again
_LONGEST_KEPT = 64  # characters of a word or chunk that is kept, so that the tables are bounded in bytes


@cache
def loaded(path: str) -> PrefixCounts:
    """One per worker process, so that what it has learned serves all tasks of the worker."""
    return PrefixCounts(path)


class PrefixCounts:
    """Counts under one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self._end = model["end_of_word_suffix"]
        self._rank = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self._parts = {left + right: (left, right, rank) for (left, right), rank in self._rank.items()}
        stands = {token for token in model["vocab"] if self._stands(token)}
        self._inner = {token for token in stands if not token.endswith(self._end)}
        self._last = {token.removesuffix(self._end) for token in stands if token.endswith(self._end)}
        self._longest = max(map(len, self._inner | self._last))
        special = [token.content for token in self._library.get_added_tokens_decoder().values()]
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._edges: tuple[dict, dict] = {}, {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._words: dict[str, int] = {}
        self._chunks: dict[str, int] = {}

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The symbols that form the token's right (1) or left (0) edge in turn, each with the rank that ends it."""
        known = self._edges[side]
        if token not in known:
            if token in self._parts:
                *parts, rank = self._parts[token]
                known[token] = self._edge(parts[side], side)[:-1] + [(parts[side], rank), (token, _NEVER)]
            else:
                known[token] = [(token, _NEVER)]
        return known[token]

    def fits(self, left: str, right: str) -> bool:
        """Whether the bytes of both tokens, merged together, give these two tokens.

        They don't if symbols that stand at the border at the same time have a
        merge that comes before the merges that end them. Equal merges are
        applied from the left.
        """
        pair = (left, right)
        if pair not in self._fits:
            if len(self._fits) > 4 * _MOST_WORDS:  # pairs of tokens, which are bounded in length
                self._fits.clear()
            before, after, i, j = self._edge(left, 1), self._edge(right, 0), 0, 0
            while True:
                (a, a_ends), (b, b_ends) = before[i], after[j]
                rank = self._rank.get((a, b), _NEVER)
                if rank < a_ends and rank <= b_ends and rank < _NEVER:
                    self._fits[pair] = False
                    break
                if a_ends == b_ends == _NEVER:
                    self._fits[pair] = True
                    break
                if a_ends <= b_ends:
                    i += 1
                else:
                    j += 1
        return self._fits[pair]

    def _stands(self, token: str) -> bool:
        """Whether the token's own bytes are merged into it."""
        symbols = list(token.removesuffix(self._end))
        symbols[-1] += token[len(token.removesuffix(self._end)):]
        while len(symbols) > 1:
            rank, at = min((self._rank.get(pair, _NEVER), at) for at, pair in enumerate(zip(symbols, symbols[1:])))
            if rank == _NEVER:
                return False
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return True

    def _last_tokens(self, word: str, upto: int) -> tuple[list[str], list[int]]:
        """For each start of the word, of ``upto`` letters at most, that the word goes on behind: last token, count."""
        last, count, inner, known, longest = [""], [0], self._inner, self._fits, self._longest
        for at in range(1, upto + 1):
            for start in range(at - longest if at > longest else 0, at):
                token = word[start:at]
                if token in inner:
                    if start:
                        fit = known.get((last[start], token))
                        if not (self.fits(last[start], token) if fit is None else fit):
                            continue
                    last.append(token)
                    count.append(count[start] + 1)
                    break
        return last, count

    def _ended(self, word: str, at: int, last: list[str], count: list[int]) -> int:
        """Tokens of word[:at] as a whole word."""
        for start in range(max(0, at - self._longest), at):
            token = word[start:at]
            if token in self._last and (start == 0 or self.fits(last[start], token + self._end)):
                return count[start] + 1
        raise ValueError(f"the vocabulary lacks letters of {word!r}")

    def word(self, word: str) -> list[int]:
        """Tokens of word[:1], word[:2], ..., each taken as a whole word.

        The word is one unit of the pre-tokenizer, in the letters that stand for bytes.
        """
        last, count = self._last_tokens(word, len(word))
        return [self._ended(word, at, last, count) for at in range(1, len(word) + 1)]

    def _of_word(self, word: str) -> int:
        if word not in self._words:
            if len(self._words) > _MOST_WORDS:
                self._words.clear()
            last, count = self._last_tokens(word, len(word) - 1)
            total = self._ended(word, len(word), last, count)
            if len(word) > _LONGEST_KEPT:
                return total
            self._words[word] = total
        return self._words[word]

    def _units(self, chunk: str) -> list[str]:
        """The chunk's words as the library splits them, in the letters that stand for bytes."""
        if chunk.isascii() and chunk.isprintable():  # these letters stand for themselves
            return _ASCII_UNIT.findall(chunk.lower())
        return [unit for unit, _ in self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(chunk))]

    def _of_chunk(self, chunk: str) -> int:
        if len(self._chunks) > _MOST_WORDS:
            self._chunks.clear()
        total, words = 0, self._words
        for unit in self._units(chunk):
            total += words[unit] if unit in words else self._of_word(unit)
        if len(chunk) <= _LONGEST_KEPT:
            self._chunks[chunk] = total
        return total

    def _parts_of(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """Special strings, and the runs of characters other than white space between them, in turn."""
        for number, piece in enumerate(self._special.split(text) if self._special else [text]):
            if number % 2:
                yield True, [piece]
            elif any(space in piece for space in _OTHER_SPACE):
                yield False, _CHUNK.findall(piece)
            else:
                yield False, piece.split()

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        total = 0
        for special, chunks in self._parts_of(text):
            if special:
                total += 1
                continue
            try:
                total += sum(map(self._chunks.__getitem__, chunks))
            except KeyError:
                total += sum(self._chunks[c] if c in self._chunks else self._of_chunk(c) for c in chunks)
        return total

    def prefixes(self, text: str) -> tuple[list[int], list[int]]:
        """Ends of the text's chunks, in code points, and the tokens up to each of them."""
        ends, tokens, at = [], [], 0
        for special, chunks in self._parts_of(text):
            for chunk in chunks:
                at = text.index(chunk, at) + len(chunk)
                ends.append(at)
                if special:
                    tokens.append(1)
                else:
                    tokens.append(self._chunks[chunk] if chunk in self._chunks else self._of_chunk(chunk))
        return ends, list(accumulate(tokens))

    def _within(self, chunk: str) -> list[int]:
        """Tokens of chunk[:1], chunk[:2], ...: from the tables of its units where each letter is normalized to one."""
        units = self._units(chunk)
        bytes_of = [len(letter.lower().encode()) for letter in chunk]
        if self._library.normalizer.normalize_str(chunk) != "".join(letter.lower() for letter in chunk) or any(
            len(letter.lower()) != 1 for letter in chunk
        ):
            return []
        tables = [count + sum(map(self._of_word, units[:n])) for n, unit in enumerate(units) for count in self.word(unit)]
        return [tables[end - 1] for end in accumulate(bytes_of)] if len(tables) == sum(bytes_of) else []

    def cut(self, text: str, budget: int) -> int:
        """Code points of the longest prefix that has at most ``budget`` tokens.

        The prefix ends within a chunk only if normalizing keeps the number of
        its characters; else, for instance at combining marks, before it.
        """
        ends, tokens = self.prefixes(text)
        whole = bisect_right(tokens, budget)
        if whole == len(ends):
            return len(text)
        before, left = (ends[whole - 1], budget - tokens[whole - 1]) if whole else (0, budget)
        start = text.index(text[before:ends[whole]].lstrip()[:1], before)
        inside = self._within(text[start:ends[whole]])
        fitting = [n for n, count in enumerate(inside, 1) if count <= left]
        return start + fitting[-1] if fitting else start


def token_counts(docs: DataFrame, tokenizer_path: str, budget: int = 2048) -> DataFrame:
    """Per document: bytes, tokens, whether they exceed the budget, and the code points of the prefix that keeps to it.

    A null text counts as empty: 0 bytes, 0 tokens. Special strings inside a
    text count as one token each. Repeated rows stay; columns other than
    ``doc_id`` and ``text`` are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = loaded(tokenizer_path)
        for batch in batches:
            tokens, kept = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                tokens.append(counts.count(text))
                kept.append(len(text) if tokens[-1] <= budget else counts.cut(text, budget))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(tokens, pa.int64()), pa.array(kept, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "prefix_chars"],
            )

    sized = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text"
    )
    counted = sized.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, prefix_chars long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > budget).alias("over_limit"), "prefix_chars")


def prefix_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document the ends of its chunks, in code points, and the tokens up to each: the stored prefix counts.

    Any later budget is answered from these two arrays. Null and empty texts
    have empty arrays.
    """

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = loaded(tokenizer_path)
        for batch in batches:
            ends, tokens = zip(*(counts.prefixes(text.as_py() or "") for text in batch.column(1)))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ends, kind), pa.array(tokens, kind)], names=["doc_id", "ends", "tokens"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        table, "doc_id long, ends array<long>, tokens array<long>"
    )
