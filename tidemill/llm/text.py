"""Words and shingles of many texts at once, as 64-bit hashes, in numpy.

Spark hands a task Arrow batches; these helpers turn the UTF-8 bytes of a
bounded slice of a batch into word hashes without a Python loop over words.
Hashes find candidates: two given words that differ have the same one with a
chance of about 2^-64. Where an operator claims that texts share words, it
compares the words themselves (``joined`` gives them).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CAPITALS = LOWER != np.arange(256)
#: Bytes between words. SPACES: 20, 09-0D. MARKS: all ASCII but digits and lower-case letters.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
MARKS = np.zeros(256, bool)
MARKS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value scrambled, one to one."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def ordered(keys: np.ndarray) -> np.ndarray:
    """Order of 64-bit ``keys``, places ascending among equal ones: their upper bits, with their places below, are sorted as plain numbers, which is several times faster than ``argsort``."""
    bits = U(len(keys).bit_length())
    low = (U(1) << bits) - U(1)
    order = (np.sort(keys & ~low | np.arange(len(keys), dtype=U)) & low).astype(np.int64)
    found = keys[order]
    return np.argsort(keys, kind="stable") if (found[1:] < found[:-1]).any() else order


_LENGTHS, _BLOCKS = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
#: By length, which bytes of a block of eight belong to a word.
_INSIDE = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
#: Longer words, in bytes, are hashed one by one.
_LONG = 256
#: By length, what a word's hash begins with.
_SEEDS = mixed(np.arange(_LONG + 1).astype(U) * _LENGTHS)
#: Words hashed at once, so that what is worked on stays in a CPU's cache.
_AT_ONCE = 1 << 14


def _blocks(low: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``low``, which has eight more at its end, as one number."""
    return np.lib.stride_tricks.as_strided(low[:8].view("<u8"), (len(low) - 7,), (1,))


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word: its length, then its blocks of eight bytes in turn, each mixed in before the next."""
    out, blocks = np.empty(len(start), U), _blocks(low)
    for k in range(0, len(out), _AT_ONCE):
        here = slice(k, k + _AT_ONCE)
        out[here] = _hashed(low, blocks, start[here], end[here])
    return out


def _hashed(low: np.ndarray, blocks: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    long = np.flatnonzero(size > _LONG)
    out = _SEEDS[np.minimum(size, _LONG)]
    some = np.flatnonzero((size > 0) & (size <= _LONG)) if len(long) or not size.all() else slice(None)
    at, left = 0, size[some]
    while len(left):
        out[some] = mixed(out[some] ^ ((blocks[start[some] + at] & _INSIDE[np.minimum(left, 8)]) * _BLOCKS))
        at += 8
        some = np.arange(len(size))[some][left > 8]
        left = size[some] - at
    for k in long:
        out[k] = int.from_bytes(blake2b(low[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


class Words(NamedTuple):
    """Words of ``len(first) - 1`` texts: byte spans, hashes, each text's first word, and the bytes in lower case (eight more at the end)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    low: np.ndarray

    def prefixes(self, size: int) -> np.ndarray:
        """Hash of each word's first ``size`` bytes (8 at most); of the whole word where it is shorter."""
        return word_hashes(self.low, self.start, np.minimum(self.end, self.start + size))

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, begin and end of each word in them): words in lower case, one space after each but the last of a text."""
        last = np.zeros(len(self.start), bool)
        last[self.first[1:][np.diff(self.first) > 0] - 1] = True
        size = self.end - self.start + ~last
        end = np.cumsum(size)
        begin = end - size
        out = self.low[np.repeat(self.start - begin, size) + np.arange(int(end[-1]) if len(end) else 0)]
        out[end[~last] - 1] = 0x20
        return out, begin, end - ~last


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, bounds of texts in them), each of about ``limit`` bytes or one text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
        yield at, whole[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def among(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``table[data]`` of bytes, by comparing them with the first and last of each run that ``table`` marks."""
    edges = np.flatnonzero(np.diff(table.astype(np.int8), prepend=0, append=0))
    out = np.zeros(len(data), bool)
    for first, last in zip(edges[::2].astype(np.uint8), (edges[1::2] - 1).astype(np.uint8), strict=True):
        out |= data - first <= last - first
    return out


#: Scripts that put no blanks between words, by the first and last two bytes of their characters, and how many bytes those have.
UNSPACED = (
    (0xE0B8, 0xE0BF, 3),  # Thai, Lao, Tibetan
    (0xE180, 0xE182, 3),  # Myanmar
    (0xE19E, 0xE19F, 3),  # Khmer
    (0xE381, 0xE383, 3),  # Kana
    (0xE390, 0xE9BF, 3),  # Han
    (0xEFA4, 0xEFAB, 3),
    (0xF0A0, 0xF0AF, 4),
)


def words(data: np.ndarray, bounds: np.ndarray, between: np.ndarray, characters: bool = False) -> Words:
    """Words are runs of bytes not in ``between``; A-Z count as a-z. With ``characters``, each one of ``UNSPACED`` is a word."""
    n = len(data)
    low = np.zeros(n + 8, np.uint8)
    np.bitwise_or(data, among(data, CAPITALS).view(np.uint8) << 5, out=low[:n])
    inside = ~among(low[:n], between)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1] | edge[1:n]
        ends[:-1] &= ~inside[1:] | edge[1:n]
    if characters and len(lead := np.flatnonzero(data >= 0xE0)):
        two = low[lead].astype(np.int32) << 8 | low[lead + 1]
        for first, last, size in UNSPACED:
            alone = lead[(two >= first) & (two <= last)]
            cuts = np.concatenate([alone, alone + size])
            cuts = cuts[(cuts > 0) & (cuts < n)]
            cuts = cuts[inside[cuts]]
            begins[cuts] = True
            ends[cuts - 1] |= inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(start, end, word_hashes(low, start, end), np.searchsorted(start, bounds), low)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words; item i begins at word i."""
    if len(hashes) < k:
        return np.zeros(0, U)
    total = np.full(len(hashes) - k + 1, k, U)
    for j in range(k):
        total = (total ^ hashes[j : j + len(total)]) * U(0x9FB21C651E98DF25)
        total ^= total >> U(32)
    return mixed(total)


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, first word) of every ``k``-word shingle; a shorter text with words is one shingle as a whole."""
    n = np.diff(found.first)
    many = np.maximum(n - k + 1, 0)
    of = np.repeat(np.arange(len(n)), many)
    begin = found.first[:-1][of] + np.arange(len(of)) - (np.cumsum(many) - many)[of]
    out = runs(found.hash, k)[begin] if len(of) else np.zeros(0, U)
    for m in range(1, k):
        if len(short := np.flatnonzero(n == m)):
            at = found.first[short]
            of, out, begin = np.concatenate([of, short]), np.concatenate([out, runs(found.hash, m)[at]]), np.concatenate([begin, at])
    return of, out, begin


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list column: ``counts[i]`` of ``values``, in order, for row i."""
    bounds = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, type=kind))
