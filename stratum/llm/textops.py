"""Vectorised byte and word primitives used inside tasks.

A batch of texts is one flat uint8 buffer plus document offsets (zero-copy
from Arrow).  Words are found with a byte table, hashed with a prefix
polynomial (one pass, no per-word Python), and every later step works on
arrays of word hashes.  All arithmetic is modulo 2**64.

Memory: ``blocks`` cuts a batch into runs of whole documents of at most
``BLOCK_BYTES`` bytes (one longer document forms its own block), so the
temporary arrays, about 40 bytes per text byte, stay bounded.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, hence invertible modulo 2**64
_rng = np.random.RandomState(20240607)
BYTE_CODES = _rng.randint(1, 1 << 62, size=256, dtype=np.int64).astype(np.uint64) | U(1)
_pow: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over the 256 byte values; each range is inclusive."""
    t = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        t[lo:hi + 1] = True
    return t


# Words separated by ASCII white space: [^\x20\x09-\x0D]+ (bytes >= 0x80 belong to words).
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
# Words of ASCII letters, digits and everything beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or its inverse) for i < n, modulo 2**64, kept per process."""
    key = "inv" if inverse else "fwd"
    have = _pow.get(key)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        size = max(n, 2 * BLOCK_BYTES + 1024)
        out = np.full(size, base, dtype=U)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        # A very long text makes a longer table once; it is not kept.
        if size > 16 * BLOCK_BYTES:
            return out
        _pow[key] = have = out
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads a polynomial hash over all 64 bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of code(b[j]) * BASE**j over j < i."""
    out = np.empty(len(buf) + 1, dtype=U)
    out[0] = 0
    np.cumsum(BYTE_CODES[buf] * powers(len(buf))[:len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent hash of bytes [start, end) (length not included)."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix), inverse=True)[start])


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type)
                                  or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32,
                        count=column.offset + len(column) + 1)[column.offset:].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges [i, j) of at most ``limit`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def give_back() -> None:
    """Return freed memory to the system: workers are reused, their peaks would add up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


class Words:
    """Words of a run of documents.

    ``start``/``end``: byte spans; ``doc``: row of each word; ``first``: index of
    the first word of each row, one more entry at the end; ``code``: word hash.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray,
                 hashes: bool = True):
        n = len(offsets) - 1
        keep = table[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[1:-1] = keep[1:] != keep[:-1]
        if len(data):
            edge[0] = keep[0]
            edge[-1] = keep[-1]
            # A document border ends a word even when both sides are word bytes.
            inner = offsets[1:-1]
            inner = np.unique(inner[(inner > 0) & (inner < len(data))])
            both = inner[keep[inner] & keep[inner - 1]]
            pos = np.flatnonzero(edge)
            if len(both):
                pos = np.sort(np.concatenate([pos, both, both]))
        else:
            pos = np.zeros(0, dtype=np.int64)
        self.start, self.end = pos[0::2], pos[1::2]
        self.first = np.searchsorted(self.start, offsets).astype(np.int64)
        self.first[-1] = len(self.start)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        if hashes:
            self.code = span_hash(prefix_hash(LOWER[data]), self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)


def run_hash(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive codes (length len(codes) - k + 1)."""
    m = len(codes) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=U)
    out = codes[:m].copy()
    for i in range(1, k):
        out *= U(_BASE)
        out += codes[i:i + m]
    return mix(out)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values: two running minima over blocks of w."""
    n = len(v)
    if n < w:
        return v[:0]
    if w <= 16:
        out = v[:n - w + 1].copy()
        for i in range(1, w):
            np.minimum(out, v[i:n - w + 1 + i], out=out)
        return out
    pad = -n % w
    x = np.concatenate([v, np.full(pad, np.iinfo(v.dtype).max, dtype=v.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])
