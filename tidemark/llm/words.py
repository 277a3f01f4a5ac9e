"""Words and word-sequence hashes of whole texts, computed for many texts at once.

A word is a maximal run of bytes other than space and 0x09 to 0x0D of the UTF-8 text. All other
characters, control characters and no-break spaces included, belong to words. ``bytes.split()``
splits in exactly this way.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

#: The pattern of a word for Spark's and DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Odd 64-bit multipliers; two independent families make a 128-bit hash.
_BYTE_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: Words of more bytes are hashed by XXH3.
SHORT_BYTES = 64


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _power_table(base: int, size: int) -> np.ndarray:
    """base ** 0, 1, 2, ... mod 2**64, at least ``size`` of them."""
    return _powers(base, 1 << max(12, (size - 1).bit_length()))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of each slice [start, end) of ``values``, whatever its place."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power_table(base, len(values) + 1)[: len(values)], out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return mixed((sums[ends] - sums[starts]) * _power_table(inverse, len(values) + 1)[starts])


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of one text."""
    if not text:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inside = np.empty(len(text) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[np.frombuffer(text, dtype=np.uint8)], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(text: bytes, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each word of one text.

    Words are hashed all at once by a polynomial modulo 2 ** 64. Certain long words (Thue-Morse
    ones) have equal polynomials in every family; the few long words of a text get their XXH3.
    """
    starts, ends = word_bounds(text)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    hashes = _runs(raw, starts, ends, _BYTE_BASES[family])
    for i in np.flatnonzero(ends - starts > SHORT_BYTES):
        hashes[i] = xxhash.xxh3_64_intdigest(text[starts[i] : ends[i]], family)
    return hashes


def sequence_hashes(hashes: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """A hash of every ``length`` consecutive words, one for each start."""
    if len(hashes) < length:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(len(hashes) - length + 1)
    return _runs(hashes, starts, starts + length, _WORD_BASES[family])


def _sliding(values: np.ndarray, width: int, fold: np.ufunc) -> np.ndarray:
    """Fold over every ``width`` consecutive values by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = fold(out[: len(out) - step], out[step:])
        have += step
    return out


def least_phrases(hashes: np.ndarray, phrase: int, window: int) -> np.ndarray:
    """The least phrase hash in each window of ``window`` words, one for each start."""
    grams = sequence_hashes(hashes, phrase)
    reach = window - phrase + 1
    return _sliding(grams, reach, np.minimum) if len(grams) >= reach else grams[:0]


def anchors(hashes: np.ndarray, phrase: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of phrases that are the least of some window that holds them.

    Every window of ``window`` words holds one or more, chosen by the words of that window alone,
    so equal windows hold equal anchors. Ties are all chosen.
    """
    grams, reach = sequence_hashes(hashes, phrase), window - phrase + 1
    least = least_phrases(hashes, phrase, window)
    if not len(least):
        return np.zeros(0, dtype=np.int64), grams[:0]
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding(padded, reach, np.maximum) == grams)
    return chosen, grams[chosen]
