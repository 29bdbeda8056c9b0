"""Homomorphic document fingerprints: sums of wide vectors hashed from paragraphs, modulo powers of two.

The sum does not depend on the order of paragraphs, and a paragraph is inserted or deleted by adding or
subtracting its vector. A vector has two parts. ``STRONG`` 64-bit lanes are hashes of the whole paragraph,
for equality. ``LANES`` 64-bit lanes are signed counts of its three-word shingles, so that the angle between two sums
tells how much two documents share; no text is long enough to overflow one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from meterlark.llm.text import BASES, BUFFER_CHARS, U64, Buffer, Prefix, buffers, mix, small_batches

STRONG = 4
LANES = 128
WORDS = 3


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each text's paragraphs: (texts x STRONG) uint64 and (texts x LANES) int64.

    A paragraph is what stands between line feeds; a text without any is one paragraph, so the empty text has one.
    """
    n = len(texts)
    buffer = Buffer(texts)
    line_end = np.flatnonzero(buffer.bytes == 10)
    line_start = np.append(0, line_end[:-1] + 1)
    owner = np.searchsorted(buffer.starts, line_start, side="right") - 1
    whole = mix(Prefix(buffer.bytes, BASES[0]).ranges(line_start, line_end) ^ U64(len(BASES)))
    other = Prefix(buffer.bytes, BASES[1]).ranges(line_start, line_end)
    bounds = np.searchsorted(owner, np.arange(n))
    strong = np.empty((n, STRONG), dtype=U64)
    for lane in range(STRONG):
        strong[:, lane] = np.add.reduceat(mix(whole * U64(2 * lane + 1) + mix(other + U64(lane))), bounds)

    begin, _, _ = buffer.words()
    counts = np.zeros(n * LANES, dtype=np.int64)
    if len(begin):
        words, _ = buffer.word_hashes()
        line = np.searchsorted(line_start, begin, side="right") - 1
        text = owner[line]
        # A shingle of up to three words that never leaves its paragraph: near its end it holds fewer.
        shingle = words.copy()
        for i in range(1, WORDS):
            same = np.zeros(len(words), dtype=bool)
            same[:-i] = line[i:] == line[:-i]
            shingle[:-i] = np.where(same[:-i], shingle[:-i] * U64(BASES[1]) + words[i:], shingle[:-i])
        # Only shingles of full length count, and the first one of a shorter paragraph.
        full = np.zeros(len(words), dtype=bool)
        full[: -(WORDS - 1)] = line[WORDS - 1 :] == line[: -(WORDS - 1)]
        first = np.append(True, line[1:] != line[:-1])
        taken = full | first
        h = mix(shingle[taken])
        at = text[taken] * LANES + (h % U64(LANES)).astype(np.int64)
        sign = ((h >> U64(40)) & U64(1)).astype(np.int64) * 2 - 1
        counts = np.bincount(at, weights=sign, minlength=n * LANES).astype(np.int64)
    return strong, counts.reshape(n, LANES)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Cosine of the counted lanes, 0 to 1; exactly 1 for equal fingerprints and below 1 for others."""
    equal = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    size = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.divide((x * y).sum(axis=1), size, out=np.zeros(len(x)), where=size > 0)
    return np.where(equal, 1.0, np.clip(cosine, 0.0, 1.0 - 1e-9))


def written(print_: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """Both parts as lowercase hex, big-endian lanes in order."""
    strong, counts = print_[0].astype(">u8"), print_[1].astype(">i8")
    return [strong[i].tobytes().hex() + counts[i].tobytes().hex() for i in range(len(strong))]


def read(prints: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    raw = [bytes.fromhex(p) for p in prints]
    strong = np.array([np.frombuffer(r[: 8 * STRONG], dtype=">u8") for r in raw], dtype=U64).reshape(-1, STRONG)
    counts = np.array([np.frombuffer(r[8 * STRONG :], dtype=">i8") for r in raw], dtype=np.int64).reshape(-1, LANES)
    return strong, counts


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of the following text."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text is an empty one. Nothing is shuffled."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in buffers(frames):
            prints = written(fingerprints(frame["text"].tolist()))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "fingerprint": prints})

    return small_batches(docs).select("doc_id", "text").mapInPandas(run, "doc_id long, fingerprint string")


# Ranges hold this many documents, unless that gives more than this many ranges per shuffle partition.
ROWS_PER_RANGE = 4_000
RANGES_PER_PARTITION = 4
COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def ranges(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> list[int]:
    """Ids that cut the documents into ranges of about equal numbers of rows; reads the ids only."""
    rows, low = docs.agg(F.count("doc_id"), F.min("doc_id")).first()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(-(-rows // rows_per_range), RANGES_PER_PARTITION * partitions)
    if n < 2:
        return []
    found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0]
    return sorted({int(x) for x in found} - {low})


def constant(values: list[int | None]) -> Column:
    """An array literal, written as one value rather than an expression per element."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every document with its edited text and its likeness to that and to the next document.

    ``docs`` needs doc_id (long) and text; other columns are ignored whatever their names. The next document is that of
    the next doc_id, after the last the first; rows with equal doc_id follow each other by text, and rows without doc_id come
    last. A single document follows itself. A null text is empty. An empty table gives no rows.

    The texts are shuffled once, to ranges of ids. Each range also receives the first document of the range
    behind it, so a range knows all its followers.
    """
    key = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = ranges(docs)
    # Bisection in a constant array: the number of bounds at or below the id.
    place = F.lit(0)
    if bounds:
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
        place = F.aggregate(
            steps, place, lambda at, s: F.when(F.get(constant(bounds), at + s - 1) <= key, at + s).otherwise(at)
        )
    ranged = docs.withColumn("range", place)
    firsts = dict(ranged.groupBy("range").agg(F.min(key)).collect())  # one row per range
    # The range that a range's first document visits as the follower of the last document there.
    visits = F.lit(None).cast("int")
    if firsts:
        order = sorted(firsts)
        before = dict(zip(order, [order[-1], *order[:-1]]))
        every = range(order[-1] + 1)
        first = F.get(constant([firsts.get(r) for r in every]), F.col("range"))
        visits = F.when(key == first, F.get(constant([before.get(r) for r in every]), F.col("range"))).cast("int")
    stays = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(visits.alias("range"), F.lit(True).alias("guest"))
    dealt = ranged.select(
        "doc_id", "text", F.explode(F.when(visits.isNull(), F.array(stays)).otherwise(F.array(stays, guest))).alias("at")
    ).select("doc_id", "text", "at.*")
    dealt = dealt.repartition("range").sortWithinPartitions("range", "guest", key, "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, pending, size = None, [], 0  # the document waiting for its follower; finished pairs

        def done() -> pd.DataFrame:
            ids, texts, followers = zip(*pending)
            edits = [edited(t, f) for t, f in zip(texts, followers)]
            own, changed, after = (fingerprints(list(x)) for x in (texts, edits, followers))
            return pd.DataFrame({
                "doc_id": pd.array(ids, dtype="Int64"), "n_chars": [len(t) for t in texts],
                "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edits],
                "fingerprint": written(own), "edited_fingerprint": written(changed),
                "near_edited": likeness(own, changed), "near_next": likeness(own, after),
            })

        for frame in buffers(frames):
            for doc_id, text, at, visitor in zip(frame["doc_id"], frame["text"], frame["range"], frame["guest"]):
                if held is not None and held[2] == at:
                    pending.append((held[0], held[1], text))
                    size += len(text)
                # Of several guests only the first follows; a guest has no follower here.
                held = None if visitor else (None if pd.isna(doc_id) else int(doc_id), text, at)
                if size > BUFFER_CHARS // 2:
                    yield done()
                    pending, size = [], 0
        if pending:
            yield done()

    return small_batches(dealt).mapInPandas(run, COMPARED)
