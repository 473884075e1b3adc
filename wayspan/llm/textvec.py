"""Vectorised views of Arrow text columns: bytes, words and 64-bit hashes.

A chunk is the UTF-8 of some rows laid end to end (``data``) with row borders
(``offs``).  Words and windows never cross a border.  Hashes of ranges are polynomials
modulo 2**61 - 1, taken from prefix sums, so any range costs O(1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 15
U = np.uint64

#: Separators of words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of alphanumeric words: 0-9 a-z A-Z and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_lo : _hi + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


#: Modulus of range hashes, a Mersenne prime.
P = U((1 << 61) - 1)
_M29, _M30, _M31 = U((1 << 29) - 1), U((1 << 30) - 1), U((1 << 31) - 1)
#: Powers of the base are tabled for so many places, and prefixes summed so many at a time.
SPAN, STEP = 1 << 20, 1 << 16


def _fold(x: np.ndarray) -> np.ndarray:
    """A number of the same residue modulo P, P + 7 at most."""
    return (x & P) + (x >> U(61))


def mulmod(a, b) -> np.ndarray:
    """a * b modulo P (not reduced in full), for factors up to P + 7."""
    ah, al, bh, bl = a >> U(31), a & _M31, b >> U(31), b & _M31
    mid = al * bh + ah * bl
    return _fold(((ah * bh) << U(1)) + (mid >> U(30)) + ((mid & _M30) << U(31)) + al * bl)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have, p = 1, int(P)
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = mulmod(out[:more], U(pow(base, have, p))) % P
        have += more
    return out


class Hasher:
    """Range hashes of a byte array: polynomials at a random base modulo 2**61 - 1.

    Two different ranges of n bytes agree for n of 2**61 bases at most, whatever the
    bytes are.
    """

    def __init__(self, seed: int):
        self.base = int(np.random.default_rng(seed).integers(2**40, 2**60))
        self._tables: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def _tabled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Powers of the base, cut into high and low bits, and of its inverse."""
        if self._tables is None:
            up = _powers(self.base, SPAN)
            self._tables = up >> U(32), up & U(0xFFFFFFFF), _powers(pow(self.base, -1, int(P)), SPAN)
        return self._tables

    def _blocks(self, base: int, n: int) -> np.ndarray:
        return _powers(pow(base, SPAN, int(P)), n // SPAN + 1)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Sums of byte times power up to each place."""
        n = len(data)
        high, low, _ = self._tabled()
        block = self._blocks(self.base, n)
        out = np.zeros(n + 1, np.uint64)
        for at in range(0, n, STEP):
            end, off = min(at + STEP, n), at % SPAN
            v = data[at:end].astype(np.uint64) + U(1)
            # a product has 41 bits at most, a sum of STEP of them 57
            lo, hi = np.cumsum(v * low[off : off + end - at]), np.cumsum(v * high[off : off + end - at])
            x = _fold(lo + (hi >> U(29)) + ((hi & _M29) << U(32)))
            if at >= SPAN:
                x = mulmod(x, block[at // SPAN])
            out[at + 1 : end + 1] = _fold(x + out[at])
        return out

    def ranges(self, pre: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each range [start, end)."""
        down = self._tabled()[2]
        h = mulmod(_fold(pre[ends] + (P << U(1)) - pre[starts]), down[starts % SPAN])
        if len(pre) > SPAN:
            h = mulmod(h, self._blocks(pow(self.base, -1, int(P)), len(pre))[starts // SPAN])
        return mix(h % P + (ends - starts).astype(np.uint64) * U(0xD1342543DE82EF95))


def grams(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit key of the k bytes from each place on, k up to 24: equal bytes have equal keys, others rarely do."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.zeros(len(data), np.uint64)
    for j in range(min(8, k)):
        eight[: len(data) - j] |= data[j:].astype(np.uint64) << U(8 * j)
    out = mix(eight[:n] + U(0x9E3779B97F4A7C15))
    for at in (8, k - 8) if k > 16 else (k - 8,) if k > 8 else ():
        out = mix(out * U(0xF1357AEA2E62A9C5) + eight[at : at + n])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the word."""
    h = h ^ (h >> U(31))
    h = h * U(0x9FB21C651E98DF25)
    h ^= h >> U(29)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    return h


MAIN = Hasher(20240501)


def text_slices(col: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows first..last with their bytes and borders, about ``most`` bytes at a time; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        width = np.int64
    else:
        width = np.int32
    if len(col) == 0:
        return
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, off_buf, data_buf = col.buffers()
    offs = np.frombuffer(off_buf, width)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    at, n = 0, len(col)
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n, at + CHUNK_ROWS)
        yield at, to, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


def words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of each maximal run of bytes that ``inside`` allows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    w = inside[data]
    border = np.zeros(n + 1, bool)
    border[offs] = True
    first = w.copy()
    first[1:] &= ~w[:-1] | border[1:n]
    last = w.copy()
    last[:-1] &= ~w[1:] | border[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def windows(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k consecutive words within a row, and the index of its first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * U(0xF1357AEA2E62A9C5) + (h[j : n + j] ^ (h[j : n + j] >> U(23)))
    ok = np.flatnonzero(row[:n] == row[k - 1 :])
    return mix(out[ok]), ok


def by_row(row: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, weights=weight, minlength=n).astype(np.int64)


def repeated(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item: occurs twice or more in its row; occurs earlier in its row."""
    n = len(key)
    if n == 0:
        z = np.zeros(0, bool)
        return z, z
    k = mix(key + row.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    order = np.argsort(k, kind="stable")
    s = k[order]
    same = np.zeros(n + 1, bool)
    same[1:n] = s[1:] == s[:-1]
    twice, later = np.zeros(n, bool), np.zeros(n, bool)
    twice[order] = same[:n] | same[1:]
    later[order] = same[:n]
    return twice, later
