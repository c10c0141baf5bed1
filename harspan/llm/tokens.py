"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Folder with the vocabulary files; they are read where they lie and never copied.
TOKENIZER_DIR = os.environ.get("HARSPAN_TOKENIZERS", "/opt/tokenizers")
TOKENIZER_FILE = "byte_bpe_50k.tiktoken"
#: The pattern that divides a text before byte-level merging, as published with the vocabulary.
SPLIT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose token count a worker remembers; merging works within words, so equal words have equal counts.
REMEMBERED = 400_000
_COUNTERS: dict[str, "TokenCounter"] = {}


class _Counts(dict):
    """Token counts of words behind a blank, found when first asked for."""

    def __init__(self, encode) -> None:
        super().__init__()
        self._encode = encode

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self._encode(" " + word))
        return n


class TokenCounter:
    """Counts the tokens of texts; each distinct word is encoded once.

    Merging never crosses a single blank but for the blank itself, which goes with the word behind it. A text is
    therefore cut at its blanks and the counts of its words add up to that of the whole; a text with runs of blanks or
    with blanks at its ends is encoded as one.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self._encode = tiktoken.Encoding("public", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._known = _Counts(self._encode)

    def count(self, text: str | None) -> int:
        """The number of tokens of the whole ``text``; 0 for null and empty ones."""
        if not text:
            return 0
        first, *words = text.split(" ")
        if not first or "" in words:
            return len(self._encode(text))
        if len(self._known) > REMEMBERED:
            self._known.clear()
        return len(self._encode(first)) + sum(map(self._known.__getitem__, words))

    @classmethod
    def of(cls, path: str) -> "TokenCounter":
        """The counter of this process for ``path``."""
        if path not in _COUNTERS:
            _COUNTERS[path] = cls(path)
        return _COUNTERS[path]


def token_count(text: Column, directory: str = TOKENIZER_DIR, file: str = TOKENIZER_FILE) -> Column:
    """Tokens of ``text`` as an integer column."""
    path = os.path.join(directory, file)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = TokenCounter.of(path)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in texts], dtype="int32")

    return count(text)
