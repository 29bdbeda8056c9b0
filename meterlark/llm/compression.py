"""Quality rules by compression bands: text that packs far better, or far worse, than prose of its length is rejected.

Every whole text and every fixed chunk of it is compressed with zstandard. The ratio of a natural text grows slowly with its length,
so each band of lengths has limits of its own: above them a text repeats itself, below them it is noise. Plain counts of words, symbols,
repeated lines and repeated word windows come with the verdict.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from meterlark.llm.text import buffers, small_batches

# Fixed values of the plain rules: what a word is, symbols, the words of a window, the least words, and the largest share of repeated ones.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 0.5

# Bytes from which a band begins, the least ratio and the largest one. Natural prose (zstandard level 3) has about 1.4 at 128 bytes, 1.75 at
# 512, 2.1 at 2 KB, 2.4 at 16 KB and at most 3 beyond; base64 stays at 1.3 and a line said twice doubles the ratio. Limits leave room on both sides.
BANDS = (
    (0, 0.0, float("inf")),
    (64, 0.0, 2.5),
    (128, 0.95, 3.0),
    (256, 1.1, 3.5),
    (512, 1.25, 4.0),
    (1024, 1.4, 5.0),
    (4096, 1.5, 6.0),
    (16384, 1.6, 8.0),
)
_STARTS = [b[0] for b in BANDS]


@dataclass(frozen=True)
class Limits:
    """Level of compression, bytes of a chunk, and the share of a text's bytes that may lie in chunks outside their bands."""

    level: int = 3
    chunk: int = 4096
    bad_share: float = 0.25


def outside(ratio: float, size: int) -> int:
    """1 above the band of so many bytes, -1 below it, 0 inside."""
    _, low, high = BANDS[bisect_right(_STARTS, size) - 1]
    return 1 if ratio > high else -1 if ratio < low else 0


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of consecutive words which the text holds twice or more, each word once."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = pd.factorize(np.array(words, dtype=object))[0]
    if len(words) == ids.max() + 1:
        return 0
    # One number for each distinct window: numbers of pairs stay below the square of the text's words.
    at = ids[:n]
    for i in range(1, window):
        at = pd.factorize(at * np.int64(len(words)) + ids[i : n + i])[0]
    twice = np.bincount(at)[at] > 1
    # A window reaches `window` words from its first; counting ends instead of marking each keeps this linear.
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[:n] += twice
    cover[window : n + window] -= twice
    return int((np.cumsum(cover[:-1]) > 0).sum())


def plain_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)
    )


def compressed(compressor, data: bytes, limits: Limits) -> tuple[float, float, float, float]:
    """Ratio of the whole text, largest ratio of a chunk, and the shares of bytes in chunks above and below their bands."""
    if not data:
        return 0.0, 0.0, 0.0, 0.0
    whole = len(data) / len(compressor.compress(data))
    if len(data) <= limits.chunk:
        side = outside(whole, len(data))
        return whole, whole, float(side > 0), float(side < 0)
    most, above, below = 0.0, 0, 0
    view = memoryview(data)
    for at in range(0, len(data), limits.chunk):
        part = view[at : at + limits.chunk]
        ratio = len(part) / len(compressor.compress(part))
        side = outside(ratio, len(part))
        most, above, below = max(most, ratio), above + len(part) * (side > 0), below + len(part) * (side < 0)
    return whole, most, above / len(data), below / len(data)


RULES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_bytes long, ratio double, chunk_ratio double, repetitive_share double, incompressible_share double, reason string, kept boolean"
)


def verdict(n_bytes: int, ratio: float, above: float, below: float, limits: Limits) -> str | None:
    """Why the compression bands reject a text, or nothing."""
    side = outside(ratio, n_bytes)
    if side:
        return "repetitive" if side > 0 else "incompressible"
    if above > limits.bad_share:
        return "repetitive_chunks"
    if below > limits.bad_share:
        return "incompressible_chunks"
    return None


def judged(texts: Iterable[str], limits: Limits) -> pd.DataFrame:
    """The counts, ratios and verdicts of whole texts: the columns of ``RULES`` behind doc_id."""
    import zstandard

    compressor = zstandard.ZstdCompressor(level=limits.level)
    rows = []
    for text in texts:
        counts = plain_counts(text)
        data = text.encode("utf-8", "surrogatepass")
        ratio, most, above, below = compressed(compressor, data, limits)
        failed = counts[0] < LEAST_WORDS or counts[4] > MOST_REPEATED * counts[0]
        why = "words" if failed else verdict(len(data), ratio, above, below, limits)
        rows.append((*counts, failed, len(data), ratio, most, above, below, why, why is None))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in RULES.split(", ")][1:])


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs``: the plain counts, the ratios and the verdict (see ``RULES``).

    ``docs`` needs doc_id and text; other columns are ignored whatever their names. A text fails the plain rules (``base_failed``)
    with fewer than ``LEAST_WORDS`` words or when over half of its words lie in repeated windows; it is kept when it passes these and the
    compression bands, ``reason`` tells which of them it fails first. A null or empty text has no words, so it is not kept. Texts are
    counted and compressed whole, however long; each needs memory for itself alone. Repeated rows and rows without doc_id each
    keep their row. An empty table gives no rows. There is no shuffle: one pass, one row in, one row out.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in buffers(frames):
            out = judged(frame["text"], limits)
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    # As text, since pandas would turn the ids of a batch that holds a null into floating point.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = small_batches(rows).mapInPandas(run, RULES.replace("doc_id long", "doc_id string"))
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the rules keep: a filter in one pass."""

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series) -> pd.Series:
        return judged(texts.fillna(""), limits)["kept"].astype(bool)

    return small_batches(docs).filter(kept(F.col("text")))
