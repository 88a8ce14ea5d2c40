"""Token counts by byte-pair merging, without making the identifiers.

The count of a pre-token is its initial symbols less the merges that apply to it: a heap holds the
adjacent pairs by rank and place, a linked list the symbols still standing.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from pitchside.llm.common import bound_batches, text_or_empty

#: Words and pieces whose counts a worker remembers before it forgets them all.
WORDS_KEPT, PIECES_KEPT = 1_000_000, 500_000
#: One that it remembers has at most so many code points; longer ones are counted each time.
KEY_KEPT_CHARS = 64

#: The pre-tokens of byte-level vocabularies, as the library splits them.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: A space between white space: there the text can't be cut at single spaces.
INNER_SPACE = r"\s (?:\s|\Z)"


def byte_symbols() -> list[str]:
    """The letter that byte-level vocabularies write for each byte.

    Visible bytes stand for themselves, the others for the letters from code point 256 on.
    """
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class Merges:
    """The merge ranks of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        ids = told["model"]["vocab"]
        self.symbols = [ids[s] for s in byte_symbols()]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"])
        self.ranks = {
            (ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self.special = [t["content"] for t in told.get("added_tokens", [])]

    def count(self, data: bytes) -> int:
        """Symbols of ``data`` left when no pair can be merged any more."""
        ranks = self.ranks
        symbols = [self.symbols[b] for b in data]
        left = end = len(symbols)
        if end < 2:
            return end
        heap = []
        for at in range(end - 1):
            if found := ranks.get((symbols[at], symbols[at + 1])):
                heap.append((found[0], at, found[1]))
        if not heap:
            return end
        heapq.heapify(heap)
        after = list(range(1, end + 1))
        before = list(range(-1, end - 1))
        while heap:
            _, at, merged = heapq.heappop(heap)
            follower = after[at]
            # The entry is old when a symbol has gone or changed since it was pushed.
            if symbols[at] < 0 or follower >= end:
                continue
            found = ranks.get((symbols[at], symbols[follower]))
            if not found or found[1] != merged:
                continue
            symbols[at], symbols[follower] = merged, -1
            after[at] = beyond = after[follower]
            left -= 1
            if beyond < end:
                before[beyond] = at
                if found := ranks.get((merged, symbols[beyond])):
                    heapq.heappush(heap, (found[0], at, found[1]))
            if (earlier := before[at]) >= 0:
                if found := ranks.get((symbols[earlier], merged)):
                    heapq.heappush(heap, (found[0], earlier, found[1]))
        return left


class _Remembered(dict):
    """A dictionary that makes missing values and forgets all when it holds too many.

    Long keys are not held, so that its size is bounded in bytes too.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= KEY_KEPT_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.pre_tokens = regex.compile(PRE_TOKENS)
        self.inner_space = regex.compile(INNER_SPACE)
        self.special = (
            regex.compile("|".join(map(regex.escape, self.merges.special)))
            if self.merges.special
            else None
        )
        self.words = _Remembered(lambda x: self.merges.count(x.encode("utf-8")), WORDS_KEPT)
        self.spaced = _Remembered(lambda x: self._by_pattern(" " + x), PIECES_KEPT)

    def _by_pattern(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.pre_tokens.findall(text)))

    def _plain(self, text: str) -> int:
        if self.inner_space.search(text):
            return self._by_pattern(text)
        # No pre-token reaches over a space that follows or precedes other than white space.
        first, *pieces = text.split(" ")
        return self._by_pattern(first) + sum(map(self.spaced.__getitem__, pieces))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(part) for part in parts if part)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def with_token_counts(
    docs: DataFrame, vocabulary: str, *, text: str = "text", name: str = "n_tokens"
) -> DataFrame:
    """Adds the number of tokens that the vocabulary file gives each whole text.

    No begin, end or added tokens count; special strings inside a text count as one token each. A
    null or empty text has 0 tokens. Each row stands alone, so repeated rows and ties need no rule;
    other columns pass through, and a column called ``name`` is replaced.
    """
    bound_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(vocabulary).count
        for batch in texts:
            yield pd.Series([count(x) for x in batch], dtype="int64")

    return docs.withColumn(name, tokens(text_or_empty(text)))


def token_report(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """doc_id, bytes in UTF-8, tokens, and whether the tokens pass ``limit``."""
    counted = with_token_counts(docs.select("doc_id", "text"), vocabulary)
    return counted.select(
        "doc_id",
        F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
