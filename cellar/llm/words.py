"""Vectorised words, word hashes and n-gram hashes over Arrow string columns.

Everything works on the UTF-8 buffer of a batch: no Python string per word. A
batch is cut into slices of whole texts of at most ``max_bytes`` (one longer
text is a slice of its own), so a task holds a small multiple of the slice.
Hashes are pairs of polynomials modulo the prime 2**31 - 1, at two points, over
the bytes of a word or over the hashes of consecutive words (62 bits, finished
with a bit mixer). Two different inputs of n bytes or words agree in a pair with
probability (n / 2**31)**2 at most, whatever their pattern; equal input gives
equal hashes on every machine and in every batch. Where equality of long or many
things decides, callers compare more than one such hash, or the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 17  # a power of two

_P = (1 << 31) - 1
#: points of the polynomials, drawn once: for bytes, for words, and for a second hash of words
_BYTE_POINTS, _WORD_POINTS, _OTHER_POINTS = (0x3C6EF372, 0x1B873593), (0x5BD1E995, 0x2545F491), (0x4CF5AD43, 0x27D4EB2F)

#: Bytes of a word in ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of a word in ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z and all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower case for A-Z, any other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE_CODE = (mix((np.arange(256, dtype=U) + U(1)) * U(0xA24BAED4963EE407)) >> U(34)) + U(1)  # below 2**31, not 0


@lru_cache(maxsize=8)
def _powers(point: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """point**i and point**-i for i < n, modulo _P."""
    out = []
    for x in (point % _P, pow(point, -1, _P)):
        p = np.ones(1, U)
        while len(p) < n:  # doubled: p[k + i] = x**k * p[i]
            p = np.concatenate((p, p * U(pow(x, len(p), _P)) % U(_P)))
        out.append(p[:n])
    return out[0], out[1]


def _polynomials(values: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray, points: tuple[int, int]) -> np.ndarray:
    """For each range, the polynomials of ``values`` (at most 2**31) at the points, mixed into one number."""
    out = U(0)
    for v, point in zip(values, points):
        up, down = _powers(point, _room(len(v)))
        x = v * up[: len(v)]
        total = np.zeros(len(v) + 1, U)
        np.cumsum((x & U(_P)) + (x >> U(31)), out=total[1:])  # terms below 2**33: no overflow
        out = out << U(31) | (total[ends] - total[starts]) % U(_P) * down[starts] % U(_P)
    return mix(out)


def _room(n: int) -> int:
    """A power of two above ``n``: the same for nearly all slices, so few tables of powers are held."""
    return max(SLICE_BYTES, 1 << n.bit_length())


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and UTF-8 bytes of a string column; null reads as the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, bytes) for runs of whole texts of about ``max_bytes``."""
    offsets, data = buffers(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        yield i, j, offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]
        i = j


class Words:
    """Words of the texts of one slice: ``starts``/``ends`` byte positions, ``doc`` the text of each."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, word_bytes: np.ndarray = NOT_SPACE):
        self.offsets, self.data, self.n_docs = offsets, data, len(offsets) - 1
        inside = word_bytes[data]
        edge = np.zeros(len(data) + 1, bool)  # a text's border parts words too
        edge[offsets] = True
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.n = np.bincount(self.doc, minlength=self.n_docs)
        #: first[i]: number of the first word of text i among all words of the slice
        self.first = np.concatenate(([0], np.cumsum(self.n)))

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def ngrams(self, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first word, hash) of each run of k words inside one text."""
        if len(h) < k:
            return np.zeros(0, np.int64), np.zeros(0, U)
        at = np.flatnonzero(self.doc[: len(h) - k + 1] == self.doc[k - 1 :])
        return at, run_hashes(h, at, at + k)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range; it depends on the bytes alone."""
    code = _BYTE_CODE[data]
    return _polynomials((code, code), starts, ends, _BYTE_POINTS)


def run_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: bool = False) -> np.ndarray:
    """Hash of each run of word hashes; with ``other``, a second hash that does not depend on the first."""
    parts = (h & U(_P)) + U(1), (h >> U(31) & U(_P)) + U(1)
    return _polynomials(parts, starts, ends, _OTHER_POINTS if other else _WORD_POINTS)


def within(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts too, so one sort groups equal items of each text."""
    return mix(h + mix(doc.astype(U) + U(1)))
