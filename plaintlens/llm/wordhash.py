"""64-bit hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads the bits of sums and products."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word, in order.

    Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
    A byte counts by a random factor for its place in the word; `lower` reads A-Z as a-z.
    """
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    if lower:
        raw = raw + np.where((raw >= 65) & (raw <= 90), np.uint8(32), np.uint8(0))
    begins = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]])) if len(raw) else np.zeros(0, np.int64)
    if not len(begins):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    following = np.append(begins[1:], len(raw))
    place = np.arange(begins[0], len(raw)) - np.repeat(begins, following - begins)
    body, inside = raw[begins[0] :], inside[begins[0] :]
    place[~inside] = 0
    factors = mixed(np.arange(1, int(place.max()) + 2, dtype=np.uint64)) | np.uint64(1)
    value = (body.astype(np.uint64) + np.uint64(1)) * factors[place]
    value[~inside] = 0
    text = np.searchsorted(np.cumsum(sizes), begins, "right")
    return text, mixed(np.add.reduceat(value, begins - begins[0]))
