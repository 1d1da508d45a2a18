"""Helpers for tasks that work on words: splitting, hashing and rolling windows in numpy.

Texts come as UTF-8 bytes. ``bytes.split()`` cuts exactly at runs of ``[\\x20\\x09-\\x0D]``
and ``bytes.lower()`` changes exactly A-Z, so neither depends on a locale or on Unicode tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

# Two odd multipliers of the rolling hashes, and those of the mixing step.
ROLL_A = 0x9FB21C651E98DF25
ROLL_B = 0xD6E8FEB86659FD93
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def utf8(name: str) -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).cast("binary")


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values, a slice at a time."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for start in range(0, batch.num_rows, 512):
            yield from zip(*(c.slice(start, 512).to_pylist() for c in columns))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit XXH3 of each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64; kept for sizes up to the next power of two."""
    return _powers(base, 1 << max(4, (size - 1).bit_length()))[:size]


def window_hashes(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of each window of ``length`` consecutive word hashes.

    The polynomial sum of a window is the difference of two prefix sums, shifted back by
    the inverse of the odd base, so it depends on the window's words alone.
    """
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(base, n), out=sums[1:])
    inverse = powers(pow(base, -1, 1 << 64), n)
    return mix((sums[length:] - sums[:-length]) * inverse[: n - length + 1])


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit hash: equal ranges of its upper half."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
