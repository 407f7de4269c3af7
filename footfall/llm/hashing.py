"""Vectorised words, word hashes and shingle hashes of whole Arrow text columns.

A text is taken as its UTF-8 bytes. A `Classes` table says for each byte value which
kind of word it belongs to (0: none) and what it is folded to; a word is a maximal run
of bytes of one kind. Words are compared by a 64-bit hash.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2**64)
SHINGLE_BASE = 0xD6E8FEB86659FD93
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Classes:
    kind: np.ndarray  # uint8[256]
    fold: np.ndarray  # uint64[256]


def byte_classes(words: list[range | list[int]], lower: bool) -> Classes:
    """A table in which the i-th entry of `words` lists the bytes of kind i + 1."""
    kind, fold = np.zeros(256, np.uint8), np.arange(1, 257, dtype=U)
    for i, values in enumerate(words):
        kind[list(values)] = i + 1
    if lower:
        fold[65:91] = fold[97:123]
    return Classes(kind, fold)


SPACES = [9, 10, 11, 12, 13, 32]
NOT_SPACE = byte_classes([[b for b in range(256) if b not in SPACES]], lower=False)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits of `x`."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES)
        factors = np.full(size, base, U)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if size <= 4 * SLICE_BYTES:  # what a very long text needs is not kept
            _POWERS[base] = have
    return have[:n]


@dataclass
class Words:
    """Words of the rows lo..hi-1; those of row lo+i are first[i]..first[i+1]-1."""

    lo: int
    hi: int
    hashes: np.ndarray
    kinds: np.ndarray
    first: np.ndarray


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about SLICE_BYTES of text (or one longer text) each."""
    if not len(texts):
        return
    offsets, data = text_buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), len(texts))
        yield lo, hi, offsets[lo : hi + 1] - offsets[lo], data[offsets[lo] : offsets[hi]]
        lo = hi


def words(texts: pa.Array, classes: Classes = NOT_SPACE) -> Iterator[Words]:
    """The words of every row, slice by slice."""
    for lo, hi, offsets, data in slices(texts):
        n = len(data)
        kind = classes.kind[data]
        change = np.ones(n + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=change[1:n])
        change[offsets] = True
        edges = np.flatnonzero(change)
        starts, ends = edges[:-1], edges[1:]
        kinds = kind[starts] if n else np.zeros(0, np.uint8)
        inside = kinds > 0
        starts, ends, kinds = starts[inside], ends[inside], kinds[inside]
        sums = np.zeros(n + 1, U)
        np.cumsum(classes.fold[data] * powers(BASE, n), out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * powers(INVERSE, n)[starts] if n else sums[:0])
        yield Words(lo, hi, hashes, kinds, np.searchsorted(starts, offsets))


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words of each row, and where each row's begin.

    A row of fewer words, but not none, has one shingle: all its words.
    """
    m = np.diff(w.first)
    counts = np.maximum(m - (k - 1), np.minimum(m, 1))
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(int(first[-1]), U)
    n = len(w.hashes)
    weights = powers(SHINGLE_BASE, k + 1)
    lengths = weights[k] * np.arange(k + 1, dtype=U)  # so that runs of different lengths differ
    if n >= k:
        h = np.full(n - k + 1, lengths[k])
        for j in range(k):
            h += w.hashes[j : n - k + 1 + j] * weights[j]
        row = np.repeat(np.arange(len(m)), m)
        whole = np.flatnonzero(row[: n - k + 1] == row[k - 1 :])
        out[first[row[whole]] + whole - w.first[row[whole]]] = h[whole]
    for i in np.flatnonzero((m > 0) & (m < k)):
        own = w.hashes[w.first[i] : w.first[i + 1]]
        out[first[i]] = np.append(own * weights[: len(own)], lengths[len(own)]).sum(dtype=U)
    return mix(out), first


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row its distinct shingle hashes, ascending."""
    for w in words(texts):
        values, first = shingles(w, k)
        for a, b in zip(first[:-1], first[1:]):
            yield np.unique(values[a:b])
