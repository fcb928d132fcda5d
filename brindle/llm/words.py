"""64-bit hashes of all words of a text at once, with numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTER = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
#: Bytes that are hashed at a time; arrays of eight bytes for each stand beside them.
SEGMENT = 1 << 20


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers["up"]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for key, factor in (("up", _BASE), ("down", _INVERSE)):
            table = np.ones(size, np.uint64)
            table[1:] = np.uint64(factor)
            _powers[key] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes data[start:end] of each span; data may have SEGMENT bytes or a little more."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of a whole text in order, with A-Z in lower case."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    out = []
    at = 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data) and not _SPACE[data[end]]:  # a word is never cut
            end += 1
        part = _LOWER[data[at:end]]
        inside = np.concatenate(([False], ~_SPACE[part], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        out.append(span_hashes(part, edges[::2], edges[1::2]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)
