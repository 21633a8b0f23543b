"""Whole-array text primitives over the UTF-8 buffers of Arrow string columns.

Everything here works on many rows at once and never makes a Python object per
word. A chunk is a run of whole rows; a row is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
#: Row numbers inside a chunk take 12 bits of a sort key.
CHUNK_ROWS = 1 << 12

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: The second modulus, a prime. A polynomial modulo 2^64 alone has known collisions (the Thue-Morse word and its complement).
_P = (1 << 31) - 1
_Q = 1_103_515_247
_BYTE_P = (_BYTE >> np.uint64(29)) % np.uint64(_P)

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of digits, letters and every byte of a non-ASCII character.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

#: Words of anything but ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

_powers: list[np.ndarray] = [np.ones(1, np.uint64)] * 4


def _power(n: int) -> list[np.ndarray]:
    """The powers of both bases and of their inverses, n of each."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 18)
        for at, base in ((0, _B), (1, _B_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[at] = np.multiply.accumulate(p)
        for at, base in ((2, _Q), (3, pow(_Q, -1, _P))):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), _P)) % np.uint64(_P)])
            _powers[at] = p[:size]
    return _powers


def _fold(x: np.ndarray) -> np.ndarray:
    """Congruent modulo _P and below 2^34."""
    return (x & np.uint64(_P)) + (x >> np.uint64(31))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of whole rows of about ``limit`` bytes."""
    data, offsets = buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), row + CHUNK_ROWS, rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lowered bytes, word starts, word ends, words before each row): words never cross rows."""
    low = LOWER[data]
    n = len(low)
    bounds = offsets
    if not n:
        none = np.zeros(0, np.int64)
        return low, none, none, np.zeros(len(offsets), np.int64)
    inside = kind[low]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    return low, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, of its length and its polynomials by two moduli."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse, power_p, inverse_p = _power(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE[low] * power[: len(low)], out=total[1:])
    out = mix((total[ends] - total[starts]) * inverse[starts])
    np.cumsum(_fold(_BYTE_P[low] * power_p[: len(low)]), out=total[1:])
    second = _fold(total[ends] - total[starts]) % np.uint64(_P) * inverse_p[starts] % np.uint64(_P)
    return mix(out ^ (second << np.uint64(32) | (ends - starts).astype(np.uint64)))


def shingles(hashes: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``width`` words of each row; a shorter, not empty row gives its whole run once."""
    n, rows = len(hashes), len(before) - 1
    counts = np.diff(before)
    row = np.repeat(np.arange(rows), counts)
    total = np.zeros(n, np.uint64)
    weight = np.uint64(1)
    for k in range(min(width, n)):
        weight = np.uint64((int(weight) * 0xD6E8FEB86659FD93) % (1 << 64))
        total[: n - k] += hashes[k:] * weight
    whole = np.arange(n) + width <= np.repeat(before[1:], counts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    out_row, out = row[whole], mix(total[whole])
    if len(short):
        own = np.array([_run(hashes[before[r] : before[r + 1]]) for r in short], np.uint64)
        out_row, out = np.concatenate([out_row, short]), np.concatenate([out, own])
    return out_row, out


def _run(hashes: np.ndarray) -> int:
    value = len(hashes)
    for h in hashes.tolist():
        value = ((value ^ h) * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) % (1 << 64)
    return value


def bags(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 52-bit hash, count) of the distinct hashes of each row, sorted. Rows below CHUNK_ROWS."""
    key = np.sort((row.astype(np.uint64) << np.uint64(52)) | (hashes >> np.uint64(12)))
    if not len(key):
        return np.zeros(0, np.int64), key, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    distinct = key[at]
    return (distinct >> np.uint64(52)).astype(np.int64), distinct & np.uint64((1 << 52) - 1), np.diff(np.append(at, len(key)))


def bag(text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, counts) of one text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    low, starts, ends, before = words(data, np.array([0, len(data)]))
    row, hashes = shingles(span_hashes(low, starts, ends), before, width)
    _, distinct, counts = bags(row, hashes)
    return distinct, counts


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller counts over sum of the larger counts of two multisets; 1 for two empty ones."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    shared = int(np.minimum(a[1][same], b[1][at[same]]).sum()) if same.any() else 0
    return shared / (total - shared)
