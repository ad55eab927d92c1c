"""Words and lines of a whole Arrow batch of texts at once, as positions and 64-bit hashes in numpy.

A batch's texts lie behind each other in one byte buffer.  Words are runs of
bytes other than ASCII white space, lines are split at ``\\n``; both are found
with a handful of vector operations for the batch instead of a loop over words.
Used inside Arrow UDFs; memory is bounded by ``PART`` bytes of text at a time
(or one longer text).
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PART = 1 << 19
_BLOCK = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("p", ())) < n:
        for k, base in (("p", _P), ("q", _P_INV)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POW[k] = np.cumprod(x)
    return _POW["p"], _POW["q"]


_libc = ctypes.CDLL(None)


def give_back() -> None:
    """Return freed memory to the system: an idle Python worker lives on beside the next stage's workers."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def trimmed(run):
    """``run`` (the body of an Arrow UDF), giving its memory back after every batch."""
    @functools.wraps(run)
    def body(*arrays: pa.Array) -> pa.Array:
        try:
            return run(*arrays)
        finally:
            give_back()
    return body


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer with full avalanche (splitmix64's constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """uint64 hash of each of the ordered, non-overlapping spans, from prefix sums of a polynomial hash."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        lo = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, lo + _BLOCK, "right")))
        part = buf[lo:int(ends[b - 1])]
        p, q = _powers(max(_BLOCK, len(part) + 1))
        h = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * p[:len(part)], out=h[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mix64((h[e] - h[s]) * q[s] + (e - s).astype(np.uint64))
        a = b
    return out


@dataclass
class Part:
    """Some whole texts of a batch: bytes, text offsets, words (CSR by text)."""
    first: int
    buf: np.ndarray
    offs: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    woffs: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(LOWER[self.buf] if lower else self.buf, self.starts, self.ends)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.woffs))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends (byte positions, without the newline) and text numbers of all lines."""
        nl = np.flatnonzero(self.buf == 10)
        starts = np.concatenate([self.offs[:-1], nl + 1])
        doc = np.concatenate([np.arange(len(self.offs) - 1), np.searchsorted(self.offs, nl, "right") - 1])
        order = np.lexsort((starts, doc))
        starts, doc = starts[order], doc[order]
        ends = np.empty(len(starts), np.int64)
        last = np.append(doc[1:] != doc[:-1], True)
        ends[:-1] = starts[1:] - 1
        ends[last] = self.offs[1:][doc[last]]
        return starts, ends, doc


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and n + 1 offsets of a string array; NULL counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    offs = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32,
                         n + 1, texts.offset * (8 if wide else 4)).astype(np.int64) if n else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def parts(texts: pa.Array, most: int = PART) -> Iterator[Part]:
    buf, offs = raw(texts)
    n, a = len(offs) - 1, 0
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1))
        o = offs[a:b + 1] - offs[a]
        x = buf[offs[a]:offs[b]]
        word = ~SPACE[x]
        edge = np.zeros(len(x) + 1, bool)
        edge[o] = True
        starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
        ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
        yield Part(a, x, o, starts, ends, np.searchsorted(starts, o))
        a = b


def per_text(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each range of a CSR offset array, as int64."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys found twice or more."""
    order = np.argsort(keys)
    k = keys[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    out = np.empty(len(k), bool)
    out[order] = same[:-1] | same[1:]
    return out


def windows(h: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``width`` words that lies in one text."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[:n] == doc[width - 1:])
    g = np.zeros(len(at), np.uint64)
    for j in range(width):
        g = g * _P + h[at + j]
    return at, mix64(g)
