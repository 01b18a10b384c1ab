"""Words, k-gram hashes and winnowed fingerprints of many texts at once, as numpy arrays.

A window is ``window`` consecutive words of one text. Its fingerprint is the least hash among its
k-grams, the rightmost on ties. Equal windows have equal fingerprints, and neighbouring windows
mostly share one, so a text has about 2 fingerprints for each ``window - k + 2`` words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from courtlens.llm.common import mix

# Odd multiplier of the rolling word hash, its inverse modulo 2^64, k-gram multiplier.
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_G = np.uint64(0xD6E8FEB86659FD93)

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        values = np.ones(size, np.uint64)
        done = 1
        while done < size:
            values[done : 2 * done] = values[:done] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        have = _powers[base] = values
    return have[:n]


def prefix_hashes(data: np.ndarray):
    """A function that gives the rolling hash of any byte ranges of ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_R, len(data)), out=sums[1:])
    inverse = _power(_R_INVERSE, len(data) + 1)
    return lambda starts, ends: (sums[ends] - sums[starts]) * inverse[starts]


@dataclass
class Words:
    """Words of consecutive texts: byte ranges in ``folded``, hashes, text of each word."""

    folded: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    texts: np.ndarray
    counts: np.ndarray  # words of each text
    first: np.ndarray  # index of the first word of each text, with the total at the end

    def join(self, data: bytes, start: int, length: int) -> bytes:
        """Words ``start`` up to ``start + length`` of ``data``, joined by one space."""
        starts, ends = self.starts[start : start + length], self.ends[start : start + length]
        return b" ".join([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())])


def find_words(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray, hashed: bool = True
) -> Words:
    """Maximal runs of bytes with ``is_word`` in each text; ``fold`` maps bytes before hashing.

    Without ``hashed`` there are no hashes, which cost more than finding the words.
    """
    n = len(data)
    mask = is_word[data]
    opens, closes = mask.copy(), mask.copy()
    if n:
        opens[1:] &= ~mask[:-1]
        closes[:-1] &= ~mask[1:]
        nonempty = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][nonempty], offsets[1:][nonempty] - 1
        opens[heads] = mask[heads]
        closes[tails] = mask[tails]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    folded = fold[data]
    hashes = mix(prefix_hashes(folded)(starts, ends)) if hashed else np.empty(0, np.uint64)
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    texts = np.repeat(np.arange(len(counts)), counts)
    return Words(folded, starts, ends, hashes, texts, counts, first)


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each position on, and whether they belong to one text."""
    n = max(0, len(words.hashes) - k + 1)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * _G + words.hashes[j : j + n]
    return mix(total), words.texts[:n] == words.texts[k - 1 : k - 1 + n]


def run_hashes(words: Words, salt: int):
    """A function that gives the hash of any runs of words [start, end); salts are independent."""
    salted = mix(words.hashes ^ np.uint64(salt))
    n = len(salted)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(salted * _power(_R, n), out=sums[1:])
    inverse = _power(_R_INVERSE, n + 1)
    return lambda starts, ends: mix((sums[ends] - sums[starts]) * inverse[starts])


@dataclass
class Windows:
    """All windows: first word, fingerprint, and position of the fingerprint's k-gram."""

    start: np.ndarray
    print: np.ndarray
    at: np.ndarray


def winnow(words: Words, k: int, window: int) -> Windows:
    hashes, _ = grams(words, k)
    width = window - k + 1
    n = max(0, len(words.hashes) - window + 1)
    least, at = hashes[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, width):
        other = hashes[j : j + n]
        lower = other <= least
        least = np.where(lower, other, least)
        at[lower] = j
    start = np.flatnonzero(words.texts[:n] == words.texts[window - 1 : window - 1 + n])
    return Windows(start, least[start], at[start] + start)


def byte_table(ranges: list[tuple[int, int]], inside: bool = True) -> np.ndarray:
    """Which of the 256 bytes lie in one of the inclusive ranges (or in none)."""
    table = np.full(256, not inside)
    for low, high in ranges:
        table[low : high + 1] = inside
    return table


def ascii_lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


# Words between ASCII white space, and words of letters, digits and everything beyond ASCII.
SPACED = byte_table([(0x20, 0x20), (0x09, 0x0D)], inside=False)
ALNUM = byte_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
LOWER = ascii_lower()
UNCHANGED = np.arange(256, dtype=np.uint8)
