"""Plain versions of the operators, and texts for small tests."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SEPARATORS = {" ", "\t", "\n", "\x0b", "\x0c", "\r"}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, size: int = 5) -> set[tuple[str, ...]]:
    own = words((text or "").translate(LOWER))
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


def components(docs: list[tuple[int, str | None]], percent: int = 75) -> dict[int, int]:
    """Smallest doc_id of each document's component, all pairs compared."""
    sets = [(i, shingles(t)) for i, t in docs]
    up = {i: i for i, _ in docs}

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i != j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: root(i) for i in up}


def random_words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
