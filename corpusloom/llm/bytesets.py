"""Vectorised word work on Arrow text columns: bounds, counts and hashes.

Everything is computed on the UTF-8 bytes of a whole slice of texts at once.
Word definitions are sets of bytes; a byte of 0x80 or more is never a separator,
so a word never starts or ends inside a character.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; a single longer text is handled alone.
SLICE_BYTES = 2 << 20

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def _byte_table(ranges) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Words are runs of anything but space and 0x09 to 0x0D.
SPACED = ~_byte_table([(0x20, 0x20), (0x09, 0x0D)])
# Words are runs of ASCII digits and letters and of everything beyond ASCII.
PLAIN = ~_byte_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
# Lower-cased bytes with a space for every byte outside a plain word.
PLAIN_TEXT = bytes(int(LOWER[b]) if PLAIN[b] else 0x20 for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


_SEED = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x9E3779B97F4A7C55)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[kind] = have = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `limit` bytes of the column."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    total, start = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, ...]:
    """Byte starts and ends of all words, and how many words each row has."""
    inside = table[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    held = inside[cuts[:-1]] if len(cuts) > 1 else np.zeros(0, bool)
    starts, ends = cuts[:-1][held], cuts[1:][held]
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each lower-cased (A-Z) word."""
    terms = _SEED[LOWER[data]] * _power("up", _BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    down = _power("down", _BASE_INVERSE, len(data) + 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` words from each place on, in order."""
    total = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        total = mix(total + words[k : len(words) - width + 1 + k] * np.uint64(2 * k + 3))
    return total
