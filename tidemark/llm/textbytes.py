"""Vectorised helpers over the UTF-8 bytes of an Arrow text column.

Operators work on *slices*: runs of whole texts whose bytes sum to at most
``SLICE_BYTES`` (one longer text is a slice of its own), so that a task's
memory follows the slice and the longest text, never the partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
#: Null ids sort and join as this value.
NULL_ID = -(1 << 63)

_rng = np.random.default_rng(20240131)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 2 + 1
_CHUNK = 1 << 16


#: Span hashes are residues modulo this Mersenne prime.
_PRIME = np.uint64((1 << 61) - 1)
_PRIME_BASE = int(_rng.integers(1 << 40, 1 << 60))
#: A longer span has a digest of its own, so that sums below stay exact.
_LONGEST_SPAN = 1 << 24
_B30, _B31, _B61 = np.uint64(30), np.uint64(31), np.uint64(61)
_M30, _M31 = np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)


def _residue(x: np.ndarray) -> np.ndarray:
    x = (x & _PRIME) + (x >> _B61)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of residues, by halves of 31 bits (2**61 is 1)."""
    a1, a0, b1, b0 = a >> _B31, a & _M31, b >> _B31, b & _M31
    mid = a1 * b0 + a0 * b1
    return _residue((a1 * b1 << np.uint64(1)) + (mid >> _B30) + ((mid & _M30) << _B31) + a0 * b0)


def _powers(base: int, n: int, modulus: int = 1 << 64) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        done = 1
        while done < n:
            step = np.uint64(pow(base, done, modulus))
            more = min(done, n - done)
            out[done:done + more] = out[:more] * step if modulus == 1 << 64 else _times(out[:more], step)
            done += more
    return out


class _Pow:
    """Powers of the anchors' base and of its inverse, grown on demand."""

    up = _powers(_BASE, 1024)
    down = _powers(pow(_BASE, -1, 1 << 64), 1024)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            n = 1 << (n - 1).bit_length()
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up, cls.down


class _PrimePow:
    """The same modulo the prime, the powers split into 30 and 31 bits."""

    high = low = down = np.empty(0, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if n > len(cls.low):
            n = max(1024, 1 << (n - 1).bit_length())
            up = _powers(_PRIME_BASE, n, int(_PRIME))
            cls.high, cls.low = up >> _B31, up & _M31
            cls.down = _powers(pow(_PRIME_BASE, -1, int(_PRIME)), n, int(_PRIME))
        return cls.high, cls.low, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (public splitmix constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` per slice; offsets has one
    entry more than rows and starts at 0. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, int(offs[lo]) + max_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        rel = offs[lo:hi + 1].astype(np.int64)
        yield lo, hi, data[rel[0]:rel[-1]], rel - rel[0]
        lo = hi


def runs(flags: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of set flags; no run crosses a cut
    (the offsets of the texts)."""
    n = len(flags)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = flags.copy()
    first[1:] &= ~flags[:-1]
    last = flags.copy()
    last[:-1] &= ~flags[1:]
    inner = cuts[(cuts > 0) & (cuts < n)]
    first[inner] = flags[inner]
    last[inner - 1] = flags[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags in each text."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (starts and ends ascend; spans may
    overlap): a polynomial over the bytes modulo a prime of 61 bits, finalised.
    For a base drawn at random, two spans of n bytes collide with a chance of
    n / 2**61 whatever their bytes are."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(starts):
            at = int(starts[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, at + _CHUNK, "right")))
            n = int(ends[hi - 1]) - at
            if n > _LONGEST_SPAN:  # one span
                out[lo] = int.from_bytes(hashlib.blake2b(data[at:at + n].tobytes(), digest_size=8).digest(), "little")
                lo = hi
                continue
            high, low, down = _PrimePow.get(n + 1)
            byte = data[at:at + n].astype(np.uint64) + np.uint64(1)
            s, e = starts[lo:hi] - at, ends[lo:hi] - at
            c = np.zeros(n + 1, np.uint64)
            np.cumsum(byte * high[:n], out=c[1:])
            x = _times(_residue(c[e] - c[s]), np.uint64(1 << 31))
            np.cumsum(byte * low[:n], out=c[1:])
            x = _residue(x + _residue(c[e] - c[s]))
            out[lo:hi] = mix(_times(x, down[s]))
            lo = hi
    return out


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans ``data[start:start + length]``, concatenated."""
    total = int(lengths.sum())
    if not total:
        return data[:0]
    ends = np.cumsum(lengths)
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(starts - (ends - lengths), lengths)
    return data[index]


def classes(members: bytes | range | list) -> np.ndarray:
    """Byte class as a lookup table."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: ``[\x20\x09-\x0D]``
SPACE = classes([0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
