"""Plain versions of the operators, by other means, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(x): chr(x + 32) for x in range(65, 91)})


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_duplicates(
    docs: list[tuple[int, str | None]], percent: int = 85
) -> dict[int, tuple[int, int, bool]]:
    sets = {i: shingles(text) for i, text in docs}
    above = {i: i for i in sets}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, one in sets.items():
        for j, two in sets.items():
            if i < j and one and two and 100 * len(one & two) >= percent * len(one | two):
                x, y = root(i), root(j)
                above[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def base_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WORD.findall(text)
    threes = list(zip(words, words[1:], words[2:]))
    times = Counter(threes)
    covered = {i + k for i, x in enumerate(threes) if times[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(x in "#*$%&|<>" for x in text),
        len(lines) - len(set(lines)), len(covered),
    )


def normal(text: str | None) -> bytes:
    kept = re.sub(rb"[^0-9A-Za-z\x80-\xff]+", b" ", (text or "").lower().encode())
    return kept.lstrip(b" ")


def fits(window: bytes, text: bytes, edits: int) -> bool:
    """Whether the window lies anywhere in the text with at most so many edits."""
    row = list(range(len(window) + 1))
    best = row[-1]
    for letter in text:
        last, row[0] = 0, 0
        for i, x in enumerate(window, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (x != letter))
        best = min(best, row[-1])
    return best <= edits


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row: tuple) -> str:
    """``row`` is doc_id, source, lang, n_chars and text."""
    return sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def _tree(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def _sides(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    out = []
    for nodes in levels[:-1]:
        begin = i // 8 * 8
        out.append(("".join(nodes[begin:i]), "".join(nodes[i + 1 : begin + 8])))
        i //= 8
    return out


def manifest(rows: list[tuple]) -> list[tuple]:
    """doc_id, leaf, subroot, root, proof, folded root and verdict of each row."""
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: _tree([y[2] for y in sorted(trees[x], key=lambda y: y[:3])]) for x in names}
    upper = _tree([built[x][-1][0] for x in names])
    out = []
    for nth, name in enumerate(names):
        for i, (_, _, own, row) in enumerate(sorted(trees[name], key=lambda y: y[:3])):
            path = _sides(built[name], i) + _sides(upper, nth)
            end = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                end = leaf((*row[:4], row[4] and row[4].translate(LOWER)))
            for before, after in path:
                end = sha(before, end, after)
            root = upper[-1][0]
            shown = sha(*[before + after for before, after in path])
            out.append((row[0], own, built[name][-1][0], root, shown, end, end == root))
    return out
