"""Whole texts as byte buffers inside tasks: vectorised word positions and hashes for many documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# Texts of one buffer hold about this many characters, so that a worker's arrays stay near 50 MB however
# large an Arrow batch is. A longer text is a buffer of its own: it is never cut.
BUFFER_CHARS = 1 << 19
# Bytes of an Arrow batch of texts: it exists several times over, in the JVM and in Python, for every task at once.
BATCH_BYTES = 8 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

U64 = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches no larger than suits whole texts."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    given = conf.get(name)  # a number of bytes, with a b behind it unless the user wrote another unit
    if not given.rstrip("b").isdigit() or int(given.rstrip("b")) > BATCH_BYTES:
        conf.set(name, f"{BATCH_BYTES}b")
    return df


def buffers(frames: Iterator[pd.DataFrame], column: str = "text") -> Iterator[pd.DataFrame]:
    """The rows of Arrow batches in slices of a bounded text size; a null text is an empty one."""
    for frame in frames:
        texts = frame[column].fillna("") if frame[column].dtype == object else frame[column].astype(object).fillna("")
        frame = frame.assign(**{column: texts})
        sizes = texts.str.len().to_numpy(dtype=np.int64) if len(frame) else np.zeros(0, dtype=np.int64)
        part = (np.cumsum(sizes) - sizes) // BUFFER_CHARS
        for _, rows in frame.groupby(part, sort=False):
            yield rows


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection, so equal only for equal values)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_held: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse; the longest asked for so far is held."""
    if base not in _held or len(_held[base][0]) < size:
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _held[base] = made[0], made[1]
    return _held[base]


class Prefix:
    """Polynomial prefix sums of a buffer: the hash of any byte range in constant time."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        size = 1 << max(16, int(len(values)).bit_length())
        power, self._inverse = _powers(base, size)
        self._sums = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum((values.astype(U64) + U64(1)) * power[: len(values)], out=self._sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(U64))


class Buffer:
    """Texts as one byte array with a line feed between any two, and where each begins and ends."""

    def __init__(self, texts: list[str]):
        parts = [t.encode() for t in texts]
        self.bytes = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.ends = self.starts + sizes

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last byte (exclusive) of every word, and the place of each text's first word (one more at the end)."""
        white = _WHITE[self.bytes]
        first = ~white
        first[1:] &= white[:-1]
        last = white[1:] & ~white[:-1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return begin, end, np.append(np.searchsorted(begin, self.starts), len(begin))

    def word_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit hash of every word in lower case (ASCII), and the place of each text's first word."""
        begin, end, place = self.words()
        return Prefix(_LOWER[self.bytes]).ranges(begin, end), place


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive word hashes of one text; one for the whole text when it has fewer words, none without any."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    out = np.zeros(n - k + 1, dtype=U64)
    for i in range(k):
        out = out * U64(BASES[1]) + hashes[i : n - k + 1 + i]
    return mix(out + U64(k))
