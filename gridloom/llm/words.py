"""Vectorised word splitting and hashing over Arrow string buffers.

Words are found on UTF-8 bytes: both word classes in use are unions of ASCII ranges and all bytes
from 0x80 up, so byte runs and code-point runs are the same. No Python string is made.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PIECE = 1 << 19
_P, _Q = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_M64 = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words are runs of anything but ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of ASCII digits, lower-case letters and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = _powers(_P, _PIECE + 1)
_INV = _powers(pow(_P, -1, 1 << 64), _PIECE + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a batch of texts in reading order; those of text i are ``at[i]:at[i + 1]``."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray
    n: int

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.at)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return mix(span_hash(self.buf, self.start, self.end))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets into them; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def split(texts: pa.Array, kind: np.ndarray, fold: bool = True, cut: np.ndarray | None = None) -> Words:
    """Words of every text; with ``cut`` (a class 0, 1 or 2 for each byte) also cut between bytes of
    classes 1 and 2."""
    buf, off = raw(texts)
    n = len(off) - 1
    if fold:
        buf = LOWER[buf]
    if not len(buf):
        z = np.zeros(0, np.int64)
        return Words(buf, z, z, np.zeros(n + 1, np.int64), n)
    ok = kind[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[off] = True
    lead = np.empty(len(buf), bool)
    lead[0] = True
    np.logical_not(ok[:-1], out=lead[1:])
    lead |= first[:-1]
    if cut is not None:
        turn = cut[buf]
        turn = turn[:-1] + turn[1:] == 3
        lead[1:] |= turn
    lead &= ok
    tail = np.empty(len(buf), bool)
    tail[-1] = True
    np.logical_not(ok[1:], out=tail[:-1])
    tail |= first[1:]
    if cut is not None:
        tail[:-1] |= turn
    tail &= ok
    start, end = np.flatnonzero(lead), np.flatnonzero(tail) + 1
    return Words(buf, start, end, np.searchsorted(start, off), n)


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes (modulo 2^64, with the length added) of sorted, disjoint byte spans."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        base = start[i]
        j = int(np.searchsorted(end, base + _PIECE, side="right"))
        if j <= i:  # one span longer than a piece
            out[i] = _long(buf[base : end[i]])
            i += 1
            continue
        last = end[j - 1]
        s = np.zeros(last - base + 1, np.uint64)
        np.cumsum(_BYTE[buf[base:last]] * _POW[: last - base], out=s[1:])
        a, b = start[i:j] - base, end[i:j] - base
        out[i:j] = (s[b] - s[a]) * _INV[a]
        i = j
    return out + (end - start).astype(np.uint64)


def _long(b: np.ndarray) -> np.uint64:
    h, scale = 0, 1
    for k in range(0, len(b), _PIECE):
        part = b[k : k + _PIECE]
        h += scale * int((_BYTE[part] * _POW[: len(part)]).sum(dtype=np.uint64))
        scale = scale * pow(_P, len(part), 1 << 64) & _M64
    return np.uint64(h & _M64)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive entries; result i covers entries i .. i + k - 1 (none at the tail)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    q = 1
    for t in range(k):
        out += h[t : len(h) - k + 1 + t] * np.uint64(q)
        q = q * _Q & _M64
    return mix(out)


def sequence_hash(h: np.ndarray) -> np.uint64:
    """Hash of a whole sequence of entries, told apart from shingles by its length."""
    if not len(h):
        return np.uint64(0)
    return mix(np.array([(h * _powers(_Q, len(h))).sum(dtype=np.uint64) ^ np.uint64(len(h) * 0x5851F42D4C957F2D & _M64)], np.uint64))[0]
