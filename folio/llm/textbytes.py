"""Numpy helpers on the UTF-8 bytes of a batch of texts; they run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values; bijective."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = U(0x9E3779B97F4A7C15)
#: A 64-bit value for each byte.
BYTE = mix(np.arange(1, 257, dtype=U) * BASE)
#: The same with A-Z folded to a-z.
FOLDED = BYTE[np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))]
#: Each byte with A-Z folded to a-z.
SMALL = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def chunks(texts: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo to hi of an Arrow string array with their bytes and n+1 offsets into them, about `most` bytes at a time."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, side="right")) - 1)
        yield lo, hi, data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo]
        lo = hi


def word_table(data: np.ndarray, ends: np.ndarray, table: np.ndarray = FOLDED, apart: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of each word of the texts, its start byte, and the n+1 offsets of each text's words. Words never cross texts; apart: the bytes between them."""
    inside = ~apart[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opens = ends[:-1][ends[:-1] < len(data)]
    first[opens] = inside[opens]
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, ends)
    if not len(starts):
        return np.zeros(0, U), starts, bounds
    kept = data[inside]
    at = np.cumsum(inside)[starts] - 1
    length = np.diff(np.append(at, len(kept)))
    place = np.arange(len(kept)) - np.repeat(at, length)
    powers = np.full(int(length.max()), BASE | U(1), dtype=U)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.add.reduceat(table[kept] * powers[place], at)
    return mix(sums ^ (length.astype(U) * U(0xD6E8FEB86659FD93))), starts, bounds


def joined_words(data: np.ndarray, ends: np.ndarray, apart: np.ndarray = IS_SPACE) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the texts, A-Z lower-cased, each followed by one space; where each starts and ends there; the n+1 offsets of
    each text's words. So the words i to j, joined by spaces, are the bytes from the start of i to the end of j."""
    inside = ~apart[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opens = ends[:-1][ends[:-1] < len(data)]
    first[opens] = inside[opens]
    starts = np.flatnonzero(first)
    kept = SMALL[data[inside]]
    at = np.cumsum(inside)[starts] - 1
    length = np.diff(np.append(at, len(kept)))
    out = np.full(len(kept) + len(starts), 32, np.uint8)
    out[np.arange(len(kept)) + np.repeat(np.arange(len(starts)), length)] = kept
    begin = at + np.arange(len(starts))
    return out.tobytes(), begin, begin + length, np.searchsorted(starts, ends)


def spread(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list array of the given arrays."""
    ends = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=ends[1:])
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64) if flat.dtype == U else flat, type=kind))
