"""Hashes of words and shingles of many texts at once, over the bytes of an Arrow column."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

#: An odd multiplier, so that its powers have inverses modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text whose sums are held at once.
PIECE = 1 << 17


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits from 64 bits, each depending on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(BASE), powers(INVERSE)


def _letters() -> np.ndarray:
    """Bytes of words: A-Z in lower case, white space 0, all others as they are."""
    out = np.arange(256, dtype=np.uint8)
    out[ord("A") : ord("Z") + 1] += 32
    out[[0x20, *range(0x09, 0x0E)]] = 0
    return out


LETTERS = _letters()
#: A NUL byte is a letter of words, so white space is told by another table.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _sums(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each word, the sum of its letters, each times the base to the power of its place.

    Words are summed by pieces of the text; one longer than a piece is summed alone, piece by piece. So
    memory goes by the piece, however long the texts are.
    """
    up, down = _powers(PIECE)

    def weighed(begin: int, end: int) -> np.ndarray:
        return (LETTERS[raw[begin:end]].astype(np.uint64) + np.uint64(1)) * up[: end - begin]

    out = np.empty(len(begins), np.uint64)
    word = 0
    while word < len(begins):
        first = int(begins[word])
        after = int(np.searchsorted(ends, first + PIECE, "right"))
        if after > word:
            some, last = slice(word, after), int(ends[after - 1])
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum(weighed(first, last), out=sums[1:])
            begin, end = begins[some] - first, ends[some] - first
            out[some] = (sums[end] - sums[begin]) * down[begin]
            word = after
        else:
            total, last = 0, int(ends[word])
            for at in range(first, last, PIECE):
                part = weighed(at, min(at + PIECE, last)).sum(dtype=np.uint64)
                total += int(part) * pow(BASE, at - first, 1 << 64)
            out[word] = np.uint64(total % (1 << 64))
            word += 1
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text (null: no words), and the words before each text.

    The second array has an entry more than there are texts.
    """
    data = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    first = int(offsets[0]) if len(offsets) else 0
    total = int(offsets[-1]) - first if len(offsets) else 0
    if not total:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data.buffers()[2], np.uint8, total, first)
    offsets = offsets - first
    space = SPACES[raw]
    # A word begins after white space or where a text begins.
    after = np.empty(total + 1, bool)
    after[0] = after[-1] = True
    after[1:-1] = space[:-1]
    after[offsets] = True
    begins = np.flatnonzero(~space & after[:-1])
    before = np.empty(total, bool)
    before[-1] = True
    before[:-1] = space[1:]
    cuts = offsets[(offsets > 0) & (offsets <= total)] - 1
    before[cuts] = True
    ends = np.flatnonzero(~space & before) + 1
    return mixed(_sums(raw, begins, ends)), np.searchsorted(begins, offsets)


def shingle_hashes(words: np.ndarray, upto: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text with words, but fewer than ``width``, has one shingle: its whole sequence.
    """
    scales = mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    sums = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        sums += words[i : i + len(sums)] * scales[i]
    windows = mixed(sums)
    out = []
    for a, b in zip(upto[:-1].tolist(), upto[1:].tolist()):
        if b - a >= width:
            found = np.sort(windows[a : b - width + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            out.append(found[keep])
        elif b > a:
            short = np.sum(words[a:b] * scales[: b - a], dtype=np.uint64) + np.uint64(b - a)
            out.append(mixed(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
