"""Words and shingles of texts as 64-bit hashes, many texts at a time in numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D. Hashes are sums of random 64-bit values
of the bytes times powers of an odd base, modulo 2**64, then mixed; equal words have equal hashes, and two
given words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of texts that are handled together; a longer text is handled alone.
CHUNK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers for a seed."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed) * U(0xD1342543DE82EF95) + U(1))


BASE = U(0x2545F4914F6CDD1D)  # odd
_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    """BASE**0 ... BASE**(n - 1) modulo 2**64."""
    global _powers
    with np.errstate(over="ignore"):
        while len(_powers) < n:
            _powers = np.concatenate([_powers, _powers * (_powers[-1] * BASE)])
    return _powers[:n]


def byte_values(seed: int = 1, fold: bool = False) -> np.ndarray:
    """A random value for each byte; with ``fold``, A-Z have those of a-z."""
    values = randoms(256, seed)
    if fold:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


_FOLDED, _PLAIN = byte_values(fold=True), byte_values()


class Words:
    """The words of some texts: ``hashes`` of all, those of text i at first[i]:first[i + 1]."""

    def __init__(self, docs: list[bytes], fold: bool) -> None:
        self.docs = docs
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        joined = b"\n".join([*docs, b""])
        self.bytes = np.frombuffer(joined, np.uint8)
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)])  # with a line break behind each text
        inside = ~BLANK[self.bytes]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate([[0], edge])
        starts, ends = edge[::2], edge[1::2]  # the last byte is a line break, so every word ends
        self.starts, self.ends = starts, ends
        self.first = np.searchsorted(starts, self.begins)
        if not len(starts):
            self.hashes = np.zeros(0, U)
            return
        width = ends - starts
        at = np.concatenate([[0], np.cumsum(width)[:-1]])
        own = self.bytes[inside]
        place = np.arange(len(own)) - np.repeat(at, width)
        with np.errstate(over="ignore"):
            values = (_FOLDED if fold else _PLAIN)[own] * powers(int(width.max()))[place]
            self.hashes = mix(np.add.reduceat(values, at) + width.astype(U))

    def grams(self, n: int, seed: int = 7) -> np.ndarray:
        """A hash for each n successive words, also across texts (the caller leaves those out)."""
        w, k = self.hashes, randoms(n, seed) | U(1)
        size = max(0, len(w) - n + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(size, U)
            for j in range(n):
                total += w[j:j + size] * k[j]
        return mix(total)


def chunks(docs: list[bytes], fold: bool, size: int = CHUNK) -> Iterator[tuple[int, Words]]:
    """The texts in groups of about ``size`` bytes: (index of the first, words)."""
    at = 0
    while at < len(docs):
        end, total = at, 0
        while end < len(docs) and (end == at or total + len(docs[end]) <= size):
            total += len(docs[end])
            end += 1
        yield at, Words(docs[at:end], fold)
        at = end


def shingle_sets(docs: list[bytes], n: int = 5) -> Iterator[np.ndarray]:
    """The sorted set of n-word shingles of each text, words lower-cased in A-Z.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    short = randoms(n, 11) | U(1)
    for _, words in chunks(docs, True):
        grams, first = words.grams(n), words.first
        for i in range(len(words.docs)):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= n:
                own = np.sort(grams[a:b - n + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif b > a:
                with np.errstate(over="ignore"):
                    whole = (words.hashes[a:b] * short[:b - a]).sum(dtype=U) + U(b - a) * U(0x9E3779B97F4A7C15)
                yield mix(np.array([whole], U))
            else:
                yield np.zeros(0, U)
