"""Brute-force counterparts shared by the tests of this folder."""

from __future__ import annotations

import itertools
import random
import re

WORD = re.compile(r"[^\W_]+")


def words(t):
    return WORD.findall((t or "").lower())


def shingles(t, k):
    w = words(t)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def similarity(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def sets(edges, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_sets(texts, k, s):
    sh = {i: shingles(t, k) for i, t in texts.items()}
    return sets([(a, b) for a, b in itertools.combinations(sorted(sh), 2) if similarity(sh[a], sh[b]) >= s - 1e-12], texts)


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i] = rng.choice(("neu", "anders", "weg")) + str(rng.randrange(99))
    return " ".join(w)


def corpus(seed=1, n=60, copies=4, length=60):
    """Texts by id: families of edited copies, exact copies in other spelling, short and empty ones."""
    rng = random.Random(seed)
    vocab = [f"wort{i}" for i in range(400)]
    out, i = {}, 1
    for _ in range(n):
        base = " ".join(rng.choice(vocab) for _ in range(rng.randrange(8, length)))
        for c in range(rng.randrange(1, copies)):
            out[i] = base if c == 0 else edited(rng, base, rng.randrange(0, 4))
            i += 1
    out[i], out[i + 1], out[i + 2], out[i + 3], out[i + 4] = None, "", "  \n", "zwei worte", out[1].upper().replace(" ", "\n ")
    return out
