"""Ids of whole texts under a byte-level vocabulary file of the ``tokenizers`` library.

The ids are those that ``tokenizers`` gives. Its own encoder takes four times as
long as ``tiktoken``'s with the same vocabulary, so the merge ranks are read from
the ``tokenizers`` file and ``tiktoken`` applies them; a text that holds one of
the file's special strings goes to ``tokenizers`` itself, as does a text that
``tiktoken`` refuses (it cannot match a run of a million white-space characters).
tests/llm/test_packing.py holds both against each other.
"""

from __future__ import annotations

import json

import numpy as np

#: The pattern that splits text before the merges of byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextIds:
    """``encode(text)`` gives the text's ids as an array of unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self._tokenizer = Tokenizer.from_file(path)
        self._special = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): number
            for token, number in vocabulary.items() if token not in self._special
        }
        self._encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if not any(mark in text for mark in self._special):
            try:
                return self._encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except ValueError:  # its pattern gives up on the text
                pass
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
