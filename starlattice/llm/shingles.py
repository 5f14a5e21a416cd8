"""Sets of word shingles as sorted 64-bit hashes, made in numpy for many texts at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

WORDS = 5
# Bytes of text that are hashed at once; a longer text is hashed alone.
CHUNK = 1 << 19

_rng = np.random.default_rng(20240229)
_LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of the bytes: a polynomial of its letters."""
    at = np.flatnonzero(~_SPACE[data])
    if not len(at):
        return np.zeros(0, np.uint64), at
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
    lengths = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    letters = _LETTER[_LOWER[data[at]]]
    letters *= powers[place]
    return _mixed(np.add.reduceat(letters, first) + lengths.astype(np.uint64)), at[first]


def _chunk(texts: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts), np.uint8)
    hashes, starts = _word_hashes(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    windows = max(0, len(hashes) - WORDS + 1)
    whole = np.zeros(windows, np.uint64)
    for i in range(WORDS):
        whole += hashes[i : i + windows] * _PLACE[i]
    whole = _mixed(whole)
    sets = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - low >= WORDS:
            sets.append(np.unique(whole[low : high - WORDS + 1]))
        elif high > low:
            # A short text is one token, told apart from longer ones by its length.
            few = hashes[low:high] * _PLACE[: high - low]
            sets.append(_mixed(np.array([few.sum() ^ np.uint64(high - low)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: five words, A-Z in lower case; none for null."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "replace")
        if held and size + len(data) > CHUNK:
            yield from _chunk(held)
            held, size = [], 0
        held.append(data)
        size += len(data)
    if held:
        yield from _chunk(held)


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
