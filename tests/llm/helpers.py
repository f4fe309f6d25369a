"""Texts with the awkward cases, and plain versions of the operators to compare with."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [None, "", " ", "\n\t", "word", "a b", "é É ß", "\x1c\xa0", "x" * 5000, "12 34 ?!", "a  b\n\nc"]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sentences(rng: random.Random, vocabulary: int, length: int) -> str:
    drawn = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
    return "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in drawn)


def corpus(seed: int = 7, n: int = 60) -> list[tuple[int, str | None]]:
    """(id, text): random texts, copies, near copies, shared passages and awkward ones."""
    rng = random.Random(seed)
    texts = [sentences(rng, 400, rng.randrange(1, 200)) for _ in range(n)]
    passage = sentences(rng, 400, 45)
    for i in range(0, n, 3):
        texts.append(texts[i])
        own = texts[i].split(" ")
        own[rng.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
        texts.append(sentences(rng, 400, 15) + passage + sentences(rng, 400, 9))
    texts += AWKWARD + AWKWARD
    texts.append(sentences(rng, 400, 9000))
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i, texts[j]) for i, j in enumerate(order)]


class Groups:
    """Least member of each group of linked things."""

    def __init__(self, members):
        self._up = {m: m for m in members}

    def least(self, a):
        while self._up[a] != a:
            a = self._up[a]
        return a

    def link(self, a, b):
        a, b = self.least(a), self.least(b)
        self._up[max(a, b)] = min(a, b)
