"""Whole batches of texts as numpy arrays: word hashes, shingle sets and rolling hashes of bytes.

All hashes are sums of M[byte] * R**position modulo 2**64 with random M and odd R, read off running sums and moved to
position 0 by the inverse power of R, then mixed; they are the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes handled at a time; a longer text is taken in parts.
CHUNK = 1 << 18
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.Generator(np.random.PCG64(20_240_613))
TABLES = _rng.integers(0, 1 << 64, size=(2, 256), dtype=np.uint64)
LOWERED = TABLES[0].copy()
LOWERED[65:91] = TABLES[0][97:123]
FACTORS = _rng.integers(0, 1 << 64, size=8, dtype=np.uint64) | np.uint64(1)
BASE = int(_rng.integers(0, 1 << 62)) * 4 + 1


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**0 .. R**(n-1) and their inverses modulo 2**64, n a power of two."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.ones(n, dtype=np.uint64)
        k = 1
        while k < n:
            p[k:2 * k] = p[:k] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        out.append(p)
    return out[0], out[1]


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(1 << max(n, 2 * CHUNK).bit_length())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Running sums with a leading 0: the hash of [i, j) is (out[j] - out[i]) * inverse power i."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * power_tables(len(data))[0][:len(data)], out=out[1:])
    return out


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; NULL has no bytes."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), offsets


def word_hashes(data: np.ndarray, table: np.ndarray = LOWERED) -> np.ndarray:
    """Hashes of the words of one text, A-Z taken as a-z unless another table of bytes is given."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data) and not SPACE[data[end - 1]]:  # a part ends after a space
            more = np.flatnonzero(SPACE[data[end:end + CHUNK]])
            end = end + int(more[0]) + 1 if len(more) else min(len(data), end + CHUNK)
        part = data[at:end]
        inside = np.zeros(len(part) + 2, dtype=np.int8)
        inside[1:-1] = ~SPACE[part]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, stop = edge[::2], edge[1::2]
        sums = running(part, table)
        parts.append(mix((sums[stop] - sums[start]) * power_tables(len(part))[1][start]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(data: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of one text; with fewer words, of the whole sequence."""
    words = word_hashes(data)
    n = len(words)
    if n == 0:
        return words
    if n < size:
        return mix((words * FACTORS[:n]).sum(keepdims=True) + np.uint64(n))
    out = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        out += words[k:n - size + 1 + k] * FACTORS[k]
    out = np.sort(mix(out))
    first = np.ones(len(out), dtype=bool)
    np.not_equal(out[1:], out[:-1], out=first[1:])
    return out[first]


def texts(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    """The bytes of each text of a batch."""
    data, offsets = bytes_of(batch.column(column))
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[a:b]


#: Bytes of text that a task turns into arrays at a time.
PART_BYTES = 8 << 20


def parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most PART_BYTES of text, or of one row."""
    for batch in batches:
        _, offsets = bytes_of(batch.column(column))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PART_BYTES, side="right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto
