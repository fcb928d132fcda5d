"""Lexical clusters: documents with like terms are routed to the same shards of an index."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DIMS = 2048
#: Branches of the two levels at most.
UPPER, LOWER = 64, 16


def bags(terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """A row of length one for each document: weights (1 + log count) * idf of its terms, hashed to DIMS columns with signs."""
    row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    term = np.concatenate([np.zeros(0, np.int64), *terms]).astype(np.uint64)
    spread = (term * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    weight = idf[term.astype(np.int64)] * (1 + np.log(np.concatenate([np.zeros(0), *counts]))) * (1.0 - 2.0 * (spread >> np.uint64(20) & np.uint64(1)))
    out = np.bincount(row * DIMS + (spread % np.uint64(DIMS)).astype(np.int64), weights=weight, minlength=len(terms) * DIMS).reshape(len(terms), DIMS).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def centres(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; a centre without rows stays where it was."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        sums = np.stack([x[near == k].sum(axis=0) for k in range(len(c))])
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.maximum(size, 1e-9), c).astype(np.float32)
    return c


@dataclass(frozen=True)
class Router:
    """Two levels of cluster centres; leaves are numbered through."""

    upper: np.ndarray
    lower: tuple[np.ndarray, ...]
    idf: np.ndarray

    def leaves(self, terms: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(terms), np.int64)
        for a in range(0, len(terms), 256):
            x = bags(terms[a : a + 256], counts[a : a + 256], self.idf)
            one = (x @ self.upper.T).argmax(axis=1)
            for k in np.unique(one):
                at = np.flatnonzero(one == k)
                out[a + at] = k * LOWER + (x[at] @ self.lower[k].T).argmax(axis=1)
        return out


def fit_router(terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, documents: int, leaf: int, seed: int) -> Router:
    """Clusters of about `leaf` of all documents each, UPPER * LOWER at most, fitted on a sample of them."""
    if not terms:
        return Router(np.zeros((1, DIMS), np.float32), (np.zeros((1, DIMS), np.float32),), idf)
    x = np.concatenate([bags(terms[a : a + 256], counts[a : a + 256], idf) for a in range(0, len(terms), 256)])
    wanted = max(1, documents // leaf)
    upper = centres(x, min(UPPER, wanted), seed)
    near = (x @ upper.T).argmax(axis=1)
    lower = []
    for k in range(len(upper)):
        own = x[near == k]
        branches = max(1, min(LOWER, round(wanted * len(own) / len(x)), len(own) // 16))
        lower.append(centres(own, branches, seed + k) if branches > 1 else upper[k : k + 1])
    return Router(upper, tuple(lower), idf)
