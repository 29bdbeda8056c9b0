"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A length belongs to the reciprocal class k when it lies in (capacity / (k + 1), capacity / k]; a bin of
that class takes exactly k pieces, whatever they are. Every worker fills its own bins. Documents may be
cut, so a length far below its class's bound gives up a piece of exactly capacity / (k + 1) first.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from meterlark.llm.text import buffers, small_batches
from meterlark.session import stage

CAPACITY = 2048
END_ID = 1
# A piece may fall short of its class's bound by this share; otherwise it is cut.
TOLERANCE = 0.02
# No cut leaves a rest shorter than this.
SHORTEST = 32
# Workers whose open bins meet in one group at each step of the merge.
MERGED = 64

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, class int, bin long, offset long"
)
_FIRST_STEP = 58  # sequence ids: the step of the merge above this bit


def cuts(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document, in order; at most one of them leaves more than rounding in its slot."""
    whole, rest = divmod(tokens, capacity)
    pieces = [capacity] * whole
    while rest:
        slot = capacity // (capacity // rest)
        exact = capacity // (capacity // rest + 1)
        if slot - rest <= TOLERANCE * rest or exact < 2 * SHORTEST:
            pieces.append(rest)
            break
        exact -= max(0, SHORTEST - (rest - exact))
        pieces.append(exact)
        rest -= exact
    return pieces


class Encoder:
    """Token ids of a text as the given byte-level BPE file defines them.

    ``ranks`` may name the same vocabulary as a rank file; its library gives the same ids several times
    faster. A text that spells a special token goes to the tokenizer itself, which knows it.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(path)
        self._special = [t.content for t in self._slow.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self._fast is None or any(s in text for s in self._special):
            return self._slow.encode(text, add_special_tokens=False).ids
        return self._fast.encode_ordinary(text)


_encoders: dict[tuple, Encoder] = {}


def encoder(*names: str | None) -> Encoder:
    """One per worker process: loading a vocabulary takes half a second."""
    if names not in _encoders:
        _encoders[names] = Encoder(*names)
    return _encoders[names]


def fill(pieces: Iterator[tuple], worker: int, capacity: int = CAPACITY) -> Iterator[tuple]:
    """Give (doc_id, start, length, crc, doc_tokens) a class, bin and offset; bins left open have no number.

    A bin's rows leave as soon as it is full; at most one open bin per class is held.
    """
    opened: dict[int, list[tuple]] = {}
    made = 0
    for piece in pieces:
        k = capacity // piece[2]
        rows = opened.setdefault(k, [])
        offset = rows[-1][8] + rows[-1][2] if rows else 0
        rows.append((*piece, worker, k, None, offset))
        if len(rows) == k:
            for row in opened.pop(k):
                yield (*row[:7], made, row[8])
            made += 1
    for rows in opened.values():
        yield from rows


def token_pieces(docs: DataFrame, tokenizer: tuple, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document in the bins of its worker: one pass over the texts, nothing shuffled."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, worker = encoder(*tokenizer), TaskContext.get().partitionId()

        def pieces() -> Iterator[tuple]:
            for frame in buffers(frames):
                for doc_id, text in zip(frame["doc_id"], frame["text"]):
                    ids = np.array([*encode(text), end_id], dtype="<u4").tobytes()
                    tokens, start = len(ids) // 4, 0
                    for length in cuts(tokens, capacity):
                        yield doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), tokens
                        start += length

        names, rows = [c.split()[0] for c in PIECES.split(", ")], []
        for row in fill(pieces(), worker, capacity):
            rows.append(row)
            if len(rows) == 20_000:
                yield frame_of(rows, names)
                rows = []
        yield frame_of(rows, names)

    return small_batches(docs).select("doc_id", "text").mapInPandas(run, PIECES)


def frame_of(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"doc_id": "Int64", "bin": "Int64"})


def first_fit(frame: pd.DataFrame, capacity: int = CAPACITY) -> pd.DataFrame:
    """Sequence numbers and offsets by first fit of decreasing lengths, for the few pieces left at the end."""
    frame = frame.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
    used: list[int] = []
    bins, offsets = [], []
    for length in frame["length"]:
        at = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
        if at == len(used):
            used.append(0)
        bins.append(at)
        offsets.append(used[at])
        used[at] += length
    return frame.assign(sequence_id=bins, offset=offsets)


OUT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: tuple, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` needs doc_id and text; other columns are ignored whatever their names. A null text is empty and
    still holds the end id. Repeated rows are packed as often as they come; a null doc_id stays null. An empty
    table gives no rows. ``tokenizer``: arguments of ``Encoder``.

    Bins that a worker could not fill meet those of other workers of the same class, group by group of
    workers, and are filled by the same count. What remains in the end is less than one bin per class, a
    number of pieces bounded by the capacity alone; first fit closes it.
    """
    pieces = stage(token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    workers = pieces.agg(F.max("worker")).first()[0]
    step = F.col("worker").cast("long") * (1 << 32) + F.col("bin")
    done = [pieces.filter("bin IS NOT NULL").withColumn("sequence_id", step).select(*OUT)]
    rest, level, groups = pieces.filter("bin IS NULL"), 1, (workers or 0) + 1
    while True:
        groups = -(-groups // MERGED)
        rest = rest.withColumn("worker", F.floor(F.col("worker") / MERGED).cast("int"))
        # Null ids and repeated rows: the order ends on everything that tells two pieces apart.
        group = Window.partitionBy("class", "worker")
        order = group.orderBy("doc_id", "start", "length", "ids_crc32", "doc_tokens")
        rest = rest.withColumn("nth", F.row_number().over(order) - 1).withColumn("of", F.count(F.lit(1)).over(group))
        rest = rest.withColumn("bin", F.floor(F.col("nth") / F.col("class")))
        full = (F.col("bin") + 1) * F.col("class") <= F.col("of")
        before = Window.partitionBy("class", "worker", "bin").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
        number = (
            F.lit(level << _FIRST_STEP) + F.col("worker").cast("long") * (1 << 34)
            + F.col("class").cast("long") * (1 << 22) + F.col("bin")
        )
        filled = rest.filter(full).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
        done.append(filled.withColumn("sequence_id", number).select(*OUT))
        rest = rest.filter(~full)
        if groups == 1:
            break
        rest, level = stage(rest, "open-bins"), level + 1

    def close(frame: pd.DataFrame) -> pd.DataFrame:
        last = first_fit(frame, capacity)
        return last.assign(sequence_id=last["sequence_id"] + ((level + 1) << _FIRST_STEP))[list(OUT)]

    schema = ", ".join(f"{c} long" for c in OUT)
    ending = rest.select(*OUT[:5], F.lit(0).alias("one"), F.lit(0).cast("long").alias("sequence_id"), "offset")
    done.append(ending.groupBy("one").applyInPandas(close, schema))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
