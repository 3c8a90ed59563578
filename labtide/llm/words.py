"""Word and shingle hashes of whole Arrow text columns, computed on the bytes of a batch at once.

A word is a run of bytes outside a set of separators, with A-Z lower-cased; bytes of 0x80 and above belong to words, so
the words are those of the decoded text as long as all separators are ASCII. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 21
KNOWN = 1 << 12


def separators(codes: str) -> np.ndarray:
    """Table of 256 flags: the given ASCII characters separate words."""
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in codes]] = True
    return table


WHITE_SPACE = separators(" \t\n\x0b\x0c\r")
NOT_ALPHANUMERIC = separators("".join(chr(c) for c in range(128) if not chr(c).isalnum()))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def multipliers(places: np.ndarray) -> np.ndarray:
    """The random multiplier of each place in a word."""
    return mix(places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x5851F42D4C957F2D))


FIRST_PLACES = multipliers(np.arange(KNOWN))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a text column; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), ends


def _cuts(data: np.ndarray, ends: np.ndarray, separating: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``SEGMENT`` bytes that cut no word."""
    at, last = int(ends[0]), int(ends[-1])
    while at < last:
        stop, step = at + SEGMENT, SEGMENT
        while stop < last:
            edge = int(ends[np.searchsorted(ends, stop, "right") - 1])
            if edge > at:
                stop = edge
                break
            gaps = np.flatnonzero(separating[data[stop - step : stop]])
            if len(gaps):
                stop = stop - step + int(gaps[-1]) + 1
                break
            stop += step
        stop = min(stop, last)
        yield at, stop
        at = stop


def slices(part: pa.RecordBatch, column: int = 1, most: int = 4 * SEGMENT) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of at most about ``most`` bytes of text, one row at least."""
    _, ends = column_bytes(part.column(column))
    at = 0
    while at < part.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield part.slice(at, stop - at)
        at = stop


def word_hashes(column: pa.Array, separating: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column in order, and the n + 1 places where the rows' words begin."""
    data, ends = column_bytes(column)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in _cuts(data, ends, separating):
        part = LOWER[data[lo:hi]]
        gap = separating[part]
        after_gap = np.empty(len(part), dtype=bool)
        after_gap[0] = True
        after_gap[1:] = gap[:-1]
        edges = ends[np.searchsorted(ends, lo) : np.searchsorted(ends, hi)] - lo
        after_gap[edges] = True
        starts = np.flatnonzero(after_gap & ~gap)
        if not len(starts):
            continue
        values = part.astype(np.uint64) + np.uint64(1)
        values[gap] = 0
        lengths = np.diff(starts, append=len(part))
        place = np.arange(starts[0], len(part)) - np.repeat(starts, lengths)
        weights = FIRST_PLACES[np.minimum(place, KNOWN - 1)]
        if lengths.max() > KNOWN:
            far = np.flatnonzero(place >= KNOWN)
            weights[far] = multipliers(place[far])
        hashes.append(mix(np.add.reduceat(values[starts[0] :] * weights, starts - starts[0])))
        places.append(starts + lo)
    where = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(where, ends)


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words."""
    n = max(len(words) - width + 1, 0)
    out = np.full(n, width, dtype=np.uint64)
    for j in range(width):
        out = (out ^ words[j : j + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_lists(column: pa.Array, width: int, separating: np.ndarray = WHITE_SPACE) -> Iterator[np.ndarray]:
    """For each row, the hashes of its shingles of ``width`` words in order.

    A row with fewer words has one shingle, the whole sequence; a row without words has none.
    """
    words, first = word_hashes(column, separating)
    runs = fold(words, width)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= width:
            yield runs[lo : hi - width + 1]
        else:
            yield fold(words[lo:hi], hi - lo) if hi > lo else runs[:0]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(values) < 2:
        return values
    values = np.sort(values)
    keep = np.empty(len(values), dtype=bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]
