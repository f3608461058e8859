"""Numpy helpers that hash words, word runs and character runs of many texts at once.

Everything works on chunks of about half a million bytes (one text at least), so memory stays bounded
whatever the Arrow batch holds. Hashes are polynomial sums over random 64-bit values: the hash of a
slice is a difference of two running sums times a power of the inverse base. Modulo 2^64 that is fast
but has slices of a thousand values and more that collide whatever the base (``slices``, for features and
short runs); long words and lines, where equal hashes mean equal, are taken modulo a prime, twice, as well (``identities``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 500_000

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240501)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = [np.uint64(int(x) * 2 + 1) for x in _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWERED = _BYTE.copy()
_LOWERED[65:91] = _BYTE[97:123]
_powers: dict[int, np.ndarray] = {}
#: Slices beyond this are hashed modulo the prime as well: shorter ones have no built collisions in 64 bits.
LONG = 64
#: The prime 2^31 - 1, so that products of two residues fit into 64 bits.
_PRIME = np.uint64((1 << 31) - 1)
_BASES = (0x5BD1E995, 0x27D4EB2F)
_residue_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
        if n > 4 * CHUNK:  # one very long text; not worth keeping
            del _powers[base]
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def slices(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each slice of a sequence of 64-bit values."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(_INVERSE, len(values) + 1)[starts])


def _residues(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime."""
    have = _residue_powers.get(base)
    if have is None or len(have) < n:
        have, step = np.ones(1, np.uint64), base
        while len(have) < max(n, 1 << 16):
            have, step = np.concatenate((have, have * np.uint64(step) % _PRIME)), step * step % int(_PRIME)
        if n <= 4 * CHUNK:
            _residue_powers[base] = have
    return have[:n]


def _by_prime(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two polynomials modulo 2^31 - 1 for each slice, over the lower and the upper half of each value."""
    out = np.zeros(len(starts), np.uint64)
    total, terms, carried = np.zeros(len(values) + 1, np.uint64), np.empty(len(values), np.uint64), np.empty(len(values), np.uint64)
    for base, half in zip(_BASES, (np.uint64(0), np.uint64(32))):
        np.right_shift(values, half, out=terms)
        np.bitwise_and(terms, _PRIME, out=terms)
        np.multiply(terms, _residues(base, len(values)), out=terms)
        np.right_shift(terms, np.uint64(31), out=carried)
        np.bitwise_and(terms, _PRIME, out=terms)
        np.add(terms, carried, out=terms)
        np.cumsum(terms, out=total[1:])
        own = (total[ends] - total[starts]) % _PRIME * _residues(pow(base, -1, int(_PRIME)), len(values) + 1)[starts] % _PRIME
        out = (out << np.uint64(32)) | own
    return mixed(out)


def identities(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each slice, by its length: up to LONG values as ``slices`` has it, else modulo the prime too."""
    out, sizes = slices(values, starts, ends), ends - starts
    long = np.flatnonzero(sizes > LONG)
    if len(long):
        sizes = sizes[long]
        stops = np.cumsum(sizes)
        own = values[np.repeat(starts[long] - (stops - sizes), sizes) + np.arange(stops[-1])]
        out[long] = mixed(out[long] ^ _by_prime(own, stops - sizes, stops))
    return out


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows; null texts count as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each run of characters other than ASCII white space, and where each text's runs begin."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    first[begins], last[ends] = inside[begins], inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return identities((_LOWERED if lower else _BYTE)[data], starts, stops), np.searchsorted(starts, offsets)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k neighbouring values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += hashes[i : i + n] * _PLACE[i]
    return mixed(out)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int, distinct: bool = True) -> Iterator[np.ndarray]:
    """For each text its hashed k-word shingles (a shorter text: all its words as one; without words: none)."""
    hashes, at = words(data, offsets)
    whole = runs(hashes, k)
    for i in range(len(offsets) - 1):
        n = at[i + 1] - at[i]
        if n >= k:
            own = whole[at[i] : at[i + 1] - k + 1]
        elif n:
            own = runs(hashes[at[i] : at[i + 1]], int(n)) ^ _PLACE[40 + int(n) % 20]
        else:
            own = whole[:0]
        yield np.unique(own) if distinct else own


def list_column(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrow lists from one array a row."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))
