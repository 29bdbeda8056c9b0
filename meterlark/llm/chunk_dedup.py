"""Substring deduplication by content-defined chunks.

A gear hash of the last bytes decides where a text is cut, so an insertion moves only the cuts beside it and equal passages fall into
equal chunks wherever they stand. Chunks are compared by digest; runs of chunks that earlier documents hold are extended at both ends as far as
the texts agree, and what the runs then cover are the repeated passages. Texts never travel in pairs: each is read once for the few
code points around the ends of its runs.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlark.llm.text import BASES, U64, Buffer, Prefix, buffers, small_batches
from meterlark.session import stage

# Bytes that decide on a cut, the share of places that are cuts, and the bounds of a chunk in bytes: chunks of 45 bytes on average.
GEAR_WIDTH = 16
CUT_BITS = 5
SHORTEST = 16
LONGEST = 80
# A repeated stretch of text, at its true ends, is a passage from so many whole words on.
LEAST_WORDS = 20
# A longer stretch without a blank, as in Chinese or Japanese, counts as a word for every so many code points.
LONG_WORD = 30
POINTS_A_WORD = 6

_GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, dtype=np.uint32)

# Code points before and behind the end of a run that are compared at first; where they all agree, so many times more in the next round, until
# the texts differ or end. Texts that agree further than a chunk behind a chunk of both are cut alike there, so few ends need a second round.
BEFORE, BEHIND = 256, 96
WIDER = 16
# Code points inside a run that must agree before its end is moved.
ANCHOR = 16

# A chunk is two numbers beside its document: a digest of 96 bits, and one of its text's tag, its start and its length.
CHUNKS = "doc_id long, place long, h1 long, h2 int"
TAG_BITS, LENGTH_BITS = 24, 8
START_BITS = 63 - TAG_BITS - LENGTH_BITS


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash behind every byte.

    The hash shifts by one bit a byte, so the bits looked at depend on the last ``GEAR_WIDTH`` bytes only.
    """
    gear = _GEAR[data]
    h = gear.copy()
    for i in range(1, min(GEAR_WIDTH, len(data))):
        h[i:] += gear[:-i] << np.uint32(i)
    return h & np.uint32((1 << GEAR_WIDTH) - 1)


def chunk_ends(h: np.ndarray, cuts: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the bytes start..end: allowed cuts, none nearer than ``SHORTEST``, none further than ``LONGEST``.

    Where no cut is allowed within ``LONGEST``, the largest hash there decides: also in a text that repeats a word for ever,
    which may hold no allowed cut at all, equal passages are cut alike.
    """
    out, last = [], start

    def forced(at: int) -> int:
        return at + SHORTEST + int(h[at + SHORTEST - 1 : at + LONGEST].argmax())

    for cut in cuts:
        while cut - last > LONGEST:
            last = forced(last)
            out.append(last)
        if cut - last >= SHORTEST:
            out.append(cut)
            last = cut
    while end - last > LONGEST:
        last = forced(last)
        out.append(last)
    if end > last:
        out.append(end)
    return out


def chunks_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Text number, start and end (code points), words begun and two digests of every chunk."""
    buffer = Buffer(texts)
    data = buffer.bytes
    h = gear_hashes(data)
    cuts = np.flatnonzero(h >> np.uint32(GEAR_WIDTH - CUT_BITS) == 0) + 1
    bounds = np.searchsorted(cuts, [buffer.starts, buffer.ends], side="right")
    ends, counts = [], []
    listed = cuts.tolist()
    for i in range(len(texts)):
        own = chunk_ends(h, listed[bounds[0][i] : bounds[1][i]], int(buffer.starts[i]), int(buffer.ends[i]))
        ends.extend(own)
        counts.append(len(own))
    text = np.repeat(np.arange(len(texts)), counts)
    end = np.array(ends, dtype=np.int64)
    start = np.empty_like(end)
    start[1:] = end[:-1]
    first = np.append(True, text[1:] != text[:-1]) if len(text) else np.zeros(0, dtype=bool)
    start[first] = buffer.starts[text[first]]
    # Chunks are cut between bytes; a place inside a code point counts as the place before it.
    points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    words = np.zeros(len(data) + 1, dtype=np.int64)
    words[buffer.words()[0] + 1] = 1
    words = np.cumsum(words)
    base = points[buffer.starts[text]]
    digests = [Prefix(data, b).ranges(start, end).view(np.int64) for b in BASES]
    return text, points[start] - base, points[end] - base, words[end] - words[start], *digests


def text_tag() -> Column:
    """A short hash of a text: tells rows with the same doc_id and other texts apart."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 64 - TAG_BITS)


def start_of(place: Column) -> Column:
    return F.shiftright(place, LENGTH_BITS).bitwiseAND((1 << START_BITS) - 1)


def end_of(place: Column) -> Column:
    return start_of(place) + place.bitwiseAND((1 << LENGTH_BITS) - 1)


def tag_of(place: Column) -> Column:
    return F.shiftright(place, START_BITS + LENGTH_BITS)


def chunks(docs: DataFrame, once: bool = False) -> DataFrame:
    """Every chunk of every document that has a doc_id; with ``once`` only the first of equal ones of a text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in buffers(frames):
            text, start, end, _, h1, h2 = chunks_of(frame["text"].tolist())
            tag = frame["tag"].to_numpy()[text]
            out = pd.DataFrame({
                "doc_id": frame["doc_id"].to_numpy()[text], "place": (tag << (START_BITS + LENGTH_BITS)) | (start << LENGTH_BITS) | (end - start),
                "h1": h1, "h2": (h2 >> 32).astype(np.int32),
            })
            yield out.loc[~pd.DataFrame({"t": text, "a": h1, "b": h2}).duplicated()] if once else out

    rows = small_batches(docs).filter("doc_id IS NOT NULL").select(
        "doc_id", text_tag().alias("tag"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, CHUNKS)


_UNIT = re.compile(r"[^\t-\r\x1c- ]+")


def units(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends (code points) of the words of a text; a stretch of over ``LONG_WORD`` is cut into pieces of ``POINTS_A_WORD``."""
    begin, end = [], []
    for m in _UNIT.finditer(text):
        a, b = m.span()
        if b - a > LONG_WORD:
            begin.extend(range(a, b - POINTS_A_WORD + 1, POINTS_A_WORD))
            end.extend(range(a + POINTS_A_WORD, b + 1, POINTS_A_WORD))
        else:
            begin.append(a)
            end.append(b)
    return np.array(begin, dtype=np.int64), np.array(end, dtype=np.int64)


# The surroundings of one place of a text. ``piece`` holds ``left`` code points before the place; ``marks`` has a bit for each that a
# word begins at (side 0, before a run) or ends behind (side 1), and ``words`` counts those before the place.
AROUND = "doc_id long, tag long, at long, side int, piece string, left int, marks binary, words long"


def surroundings(wanted: DataFrame, docs: DataFrame, before: int, behind: int) -> DataFrame:
    """``AROUND`` for every wanted (doc_id, tag, at, side): the only step that moves texts, each of them once."""
    places = wanted.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("at", "side")).alias("places"))
    texts = docs.select("doc_id", text_tag().alias("tag"), F.coalesce("text", F.lit("")).alias("text"))
    # The places build the hash side: texts are shuffled once and never sorted. Of rows that repeat a document each answers, once in the end.
    held = texts.join(places.hint("shuffle_hash"), ["doc_id", "tag"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in buffers(frames):
            rows = []
            for doc_id, tag, text, places in frame[["doc_id", "tag", "text", "places"]].itertuples(index=False):
                begin, end = units(text)
                for place in places:
                    at, side = place["at"], place["side"]
                    if not 0 <= at <= len(text):
                        continue
                    low, high = max(0, at - (ANCHOR if side else before)), at + (behind if side else ANCHOR)
                    piece = text[low:high]
                    marks = np.zeros(len(piece), dtype=bool)
                    ends = end - 1 if side else begin
                    marks[ends[np.searchsorted(ends, low) : np.searchsorted(ends, high)] - low] = True
                    rows.append((doc_id, tag, at, side, piece, at - low, np.packbits(marks).tobytes(), int(np.searchsorted(ends, at))))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in AROUND.split(", ")])

    return small_batches(held).mapInPandas(run, AROUND)


def agreement(a: str, b: str) -> int:
    """How many code points two texts share from their beginnings."""
    return len(os.path.commonprefix((a, b)))


def moved(own: str, left: int, other: str | None, other_left: int, side: int, limit: int) -> tuple[int, bool]:
    """By how many code points an end of a run moves outwards, and whether a wider look could move it further.

    The last code point of a run may belong to it in part only: then it moves inwards by one.
    """
    if other is None:
        return 0, False
    inside, there = (own[:left], other[:other_left]) if side else (own[left:], other[other_left:])
    out, beyond = (own[left:], other[other_left:]) if side else (own[:left][::-1], other[:other_left][::-1])
    if side:
        if inside and there and inside[-1] != there[-1]:
            return -1, False
        inside, there = inside[::-1], there[::-1]
    if agreement(inside, there) < min(ANCHOR, len(inside), len(there)):
        return 0, False
    m = agreement(out, beyond)
    return m, m == limit


ENDS = "doc_id long, tag long, run long, side int, first_doc_id long, reach long, words long, more boolean"


def run_ends(stretches: DataFrame, docs: DataFrame, before: int, behind: int) -> DataFrame:
    """``ENDS`` for both ends of every stretch (a run and one document that holds chunks of it first).

    ``stretches``: doc_id, tag, run, side, at, first_doc_id, first_tag, first_at: an end and the place in the other text that stands for it.
    """
    own = stretches.select("doc_id", "tag", "at", "side")
    other = stretches.select(F.col("first_doc_id").alias("doc_id"), F.col("first_tag").alias("tag"), F.col("first_at").alias("at"), "side")
    around = stage(surroundings(own.unionByName(other).distinct(), docs, before, behind), "run-surroundings").dropDuplicates(
        ["doc_id", "tag", "at", "side"])
    right = around.select(
        F.col("doc_id").alias("first_doc_id"), F.col("tag").alias("first_tag"), F.col("at").alias("first_at"), "side",
        F.col("piece").alias("other"), F.col("left").alias("other_left"))
    met = stretches.join(around, ["doc_id", "tag", "at", "side"]).join(right, ["first_doc_id", "first_tag", "first_at", "side"], "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                other = None if r.other is None or r.other != r.other else r.other
                side = int(r.side)
                by, more = moved(r.piece, int(r.left), other, 0 if other is None else int(r.other_left), side, behind if side else before)
                bits = np.unpackbits(np.frombuffer(r.marks, dtype=np.uint8)) if by else None
                words = int(r.words)
                if by > 0 and side:
                    words += int(bits[r.left : r.left + by].sum())
                elif by > 0:
                    words -= int(bits[r.left - by : r.left].sum())
                elif by < 0:
                    words -= int(bits[r.left - 1])
                rows.append((r.doc_id, r.tag, r.run, side, r.first_doc_id, r.at + by if side else r.at - by, words, more))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ENDS.split(", ")])

    return met.mapInPandas(run, ENDS)


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, start, end, n_words, n_chunks, first_doc_id: the passages that a document repeats from smaller doc_ids.

    Places are code points, the end exclusive, at the true ends of what is repeated; ``n_words`` counts whole words (see ``units``),
    ``n_chunks`` the repeated chunks inside; ``first_doc_id`` is the smallest document that holds the most of the passage's
    chunks' first occurrences. ``docs`` needs doc_id and text; other columns are ignored whatever their names. The
    smallest doc_id that holds a chunk keeps it; repeats inside one document stay. Null and empty texts and rows without
    doc_id have no passages. Rows that share a doc_id are one document and do not repeat each other; equal rows give
    equal passages once. An empty table gives no rows.

    Digests are counted with a sum per task before the shuffle, so a chunk that a third of all documents hold is one row per task; the
    chunks then meet the repeated digests in a join that adaptive execution splits where a digest is hot. Chunks that follow each
    other are a run; each document that holds some of its chunks first says how far its text agrees beyond the run's ends (of a chunk
    that it holds several times the first counts). Runs that touch are one passage, before short ones are dropped.
    """
    seen = chunks(docs, once=True).groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("n"), F.min_by("place", "doc_id").alias("first_place"))
    repeated = seen.filter("n > 1").drop("n")
    later = chunks(docs).join(repeated, ["h1", "h2"]).filter("doc_id > first_doc_id").select(
        "doc_id", tag_of(F.col("place")).alias("tag"), start_of(F.col("place")).alias("start"), end_of(F.col("place")).alias("end"),
        "first_doc_id", tag_of(F.col("first_place")).alias("first_tag"), start_of(F.col("first_place")).alias("first_start"))
    key = ["doc_id", "tag"]
    # A document's repeated chunks in order; a gap begins a new run. Bounded by the document.
    order = Window.partitionBy(*key).orderBy("start", "end")
    begins = F.when(F.col("start") <= F.lag("end").over(order), 0).otherwise(1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    chunked = later.distinct().withColumn("begins", begins).withColumn("run", F.sum("begins").over(upto))
    shift = F.col("first_start") - F.col("start")
    parts = stage(chunked.groupBy(*key, "run", "first_doc_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"),
        F.min_by("first_tag", "start").alias("left_tag"), F.min_by(shift, "start").alias("left_shift"),
        F.max_by("first_tag", "start").alias("right_tag"), F.max_by(shift, "start").alias("right_shift")), "run-parts")
    whole = parts.groupBy(*key, "run").agg(F.min("start").alias("run_start"), F.max("end").alias("run_end"))
    ends = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("run_start").alias("at"), F.col("left_tag").alias("first_tag"), (F.col("run_start") + F.col("left_shift")).alias("first_at")),
        F.struct(F.lit(1).alias("side"), F.col("run_end").alias("at"), F.col("right_tag").alias("first_tag"), (F.col("run_end") + F.col("right_shift")).alias("first_at"))))
    open_ends = stage(parts.join(whole, [*key, "run"]).select(*key, "run", "first_doc_id", ends.alias("e")).select(*key, "run", "first_doc_id", "e.*"), "run-open")
    before, behind, found = BEFORE, BEHIND, []
    while True:
        found.append(stage(run_ends(open_ends, docs, before, behind), "run-ends"))
        more = found[-1].filter("more")
        if not more.limit(1).count():
            break
        # Few texts agree for longer; they are looked at again, and their first answer is outdone by the next.
        open_ends = stage(open_ends.join(more.select(*key, "run", "side", "first_doc_id"), [*key, "run", "side", "first_doc_id"], "left_semi"), "run-open")
        before, behind = before * WIDER, behind * WIDER
    reached = found[0]
    for wider in found[1:]:
        reached = reached.unionByName(wider)
    runs = reached.groupBy(*key, "run").agg(
        F.min(F.when(F.col("side") == 0, F.col("reach"))).alias("start"), F.max(F.when(F.col("side") == 1, F.col("reach"))).alias("end"),
        F.min(F.when(F.col("side") == 0, F.col("words"))).alias("before"), F.max(F.when(F.col("side") == 1, F.col("words"))).alias("behind"))
    beside = Window.partitionBy(*key).orderBy("start", "end", "run")
    apart = F.when(F.col("start") <= F.max("end").over(beside.rowsBetween(Window.unboundedPreceding, -1)), 0).otherwise(1)
    passages = runs.withColumn("apart", apart).withColumn("passage", F.sum("apart").over(beside.rowsBetween(Window.unboundedPreceding, 0)))
    counted = parts.select(*key, "run", "first_doc_id", "n").join(passages, [*key, "run"]).groupBy(*key, "passage", "first_doc_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("before").alias("before"), F.max("behind").alias("behind"), F.sum("n").alias("n"),
    ).groupBy(*key, "passage").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("behind") - F.min("before")).alias("n_words"),
        F.sum("n").alias("n_chunks"), F.max_by("first_doc_id", F.struct("n", -F.col("first_doc_id"))).alias("first_doc_id"),
    )
    return counted.filter(F.col("n_words") >= least_words).select(
        "doc_id", "start", "end", "n_words", "n_chunks", "first_doc_id").distinct()


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the text outside the passages: what a training set keeps."""
    cuts = passages.groupBy(F.col("doc_id").alias("_id")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_cuts"))
    kept = F.aggregate(
        F.coalesce("_cuts", F.expr("cast(array() as array<struct<start bigint, end bigint>>)")),
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, c: F.struct(
            F.greatest(acc["at"], c["end"]).alias("at"),
            F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(c["start"] - acc["at"], F.lit(0)).cast("int"))).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text"))),
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text").join(cuts, F.col("doc_id") == F.col("_id"), "left")
    return rows.select(F.col("row").withField("text", kept).alias("row")).select("row.*")
