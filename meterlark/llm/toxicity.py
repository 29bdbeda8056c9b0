"""Toxicity scores: a bidirectional gated recurrent network over word and character inputs of all overlapping windows.

A document is as toxic as its most toxic window, so training looks for the window that makes a labelled
document toxic (multiple instances): first by word evidence, then by the network itself.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from meterlark.llm import gru
from meterlark.llm.text import BUFFER_CHARS, U64, Buffer, Prefix, buffers, mix, small_batches

WINDOW = 32
STRIDE = 16
WIDTH = 16
HIDDEN = 8
EPOCHS = 6
BATCH = 64
SEED = 20
# The bounds of the training sample: toxic documents, clean documents for each of these, and code points of a
# document that may enter it.
SAMPLE = 1000
CLEAN_PER_TOXIC = 2
LONGEST_SAMPLED = 20_000
# A word or gram is known when so many sampled documents hold it, at most so many of each.
LEAST_DOCUMENTS = 3
KNOWN = 20_000
# Windows scored at once.
SCORED = 2048

FOLDS = 5
HELD_FOR_SCALE = 5

_WORD = np.zeros(256, dtype=bool)
_WORD[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _WORD[_a:_b] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


@dataclass
class Words:
    """The words of a buffer: hashes of the distinct ones, the number of each token, tokens per text, and grams."""

    hashes: np.ndarray
    token: np.ndarray
    place: np.ndarray
    grams: np.ndarray
    owner: np.ndarray


def split_words(texts: list[str]) -> Words:
    """Words are runs of letters and digits (all bytes beyond ASCII count as letters), lower-cased.

    Grams of a word: its first four and five bytes, marked as a beginning, and every three bytes within.
    """
    buffer = Buffer(texts)
    data = _LOWER[buffer.bytes]
    inside = _WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    place = np.append(np.searchsorted(begin, buffer.starts), len(begin))
    prefix = Prefix(data)
    hashes, at, token = np.unique(prefix.ranges(begin, end), return_index=True, return_inverse=True)
    begin, end = begin[at], end[at]
    numbers = np.arange(len(begin))
    grams, owners = [], []
    for size in (4, 5):
        long = end - begin >= size
        grams.append(mix(prefix.ranges(begin[long], begin[long] + size) + U64(size)))
        owners.append(numbers[long])
    counts = np.maximum(end - begin - 2, 0)
    owner = np.repeat(numbers, counts)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[owner]
    wide = data.astype(U64)
    grams.append(mix((wide[start] << U64(16)) | (wide[start + 1] << U64(8)) | wide[start + 2]) if len(start) else np.zeros(0, U64))
    owners.append(owner)
    grams, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return Words(hashes, token, place, grams[order], owner[order])


def split_sample(texts: list[str]) -> Words:
    """``split_words`` of many texts a buffer at a time: the byte arrays of the whole sample would crowd the driver."""
    sizes = np.array([len(t) for t in texts])
    part = (np.cumsum(sizes) - sizes) // BUFFER_CHARS
    parts = [split_words([texts[i] for i in np.flatnonzero(part == n)]) for n in np.unique(part)]
    start = np.cumsum([0, *(len(w.hashes) for w in parts)])
    hashes, first, number = np.unique(np.concatenate([w.hashes for w in parts]), return_index=True, return_inverse=True)
    grams, owners = [], []
    for w, at in zip(parts, start):
        new = first[number[at + w.owner]] == at + w.owner  # a word's grams come from the first part that holds it
        grams.append(w.grams[new])
        owners.append(number[at + w.owner[new]])
    grams, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    token = np.concatenate([number[at + w.token] for w, at in zip(parts, start)])
    place = np.append(0, np.cumsum(np.concatenate([np.diff(w.place) for w in parts])))
    return Words(hashes, token, place, grams[order], owner[order])


def lookup(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The row (from 1) of each wanted hash among the sorted known ones, 0 when it is none of them."""
    at = np.searchsorted(known, wanted)
    at[at == len(known)] = 0
    return np.where(known[at] == wanted, at + 1, 0) if len(known) else np.zeros(len(wanted), dtype=np.int64)


def windows_of(words: Words, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of token numbers, the last one padded, and the text each belongs to; a text without words has one empty window."""
    sizes = np.diff(words.place)
    per_text = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(sizes)), per_text)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    at = (words.place[owner] + nth * STRIDE)[:, None] + np.arange(WINDOW)
    beyond = at >= words.place[owner + 1][:, None]
    token = np.append(words.token, pad)
    return np.where(beyond, pad, token[np.minimum(at, len(token) - 1)]).astype(np.int32), owner


@dataclass
class Model:
    """Everything a worker needs; its size is bounded by ``KNOWN``."""

    parameters: dict[str, np.ndarray]
    words: np.ndarray
    grams: np.ndarray
    scale: float
    shift: float

    def table(self, words: Words) -> gru.WordTable:
        gram = lookup(self.grams, words.grams)
        held = gram > 0
        return gru.WordTable(lookup(self.words, words.hashes), gram[held], words.owner[held])

    def window_logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        table = self.table(words).inputs(self.parameters)
        windows, owner = windows_of(words, len(table) - 1)
        parts = [gru.forward(self.parameters, table, windows[i : i + SCORED]) for i in range(0, len(windows), SCORED)]
        return np.concatenate(parts) if parts else np.zeros(0), owner

    def scores(self, texts: list[str]) -> np.ndarray:
        logit, owner = self.window_logits(split_words(texts))
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, owner, logit)
        return 1 / (1 + np.exp(-np.clip(self.scale * worst + self.shift, -60, 60)))


def evidence(rows: np.ndarray, texts: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Known hashes (sorted) and how much likelier each makes a toxic document, as a smoothed log ratio."""
    known, number = np.unique(rows, return_inverse=True)
    pairs = np.unique(number * len(toxic) + texts)  # one per hash and text
    number, text = pairs // len(toxic), pairs % len(toxic)
    count = np.bincount(number, minlength=len(known))
    held = np.bincount(number, weights=toxic[text], minlength=len(known))
    frequent = count >= LEAST_DOCUMENTS
    if frequent.sum() > KNOWN:
        frequent = frequent & (count >= np.sort(count)[-KNOWN])
    n1, n0 = toxic.sum() + 1.0, (1 - toxic).sum() + 1.0
    ratio = np.log((held + 0.5) / n1) - np.log((count - held + 0.5) / n0)
    keep = np.flatnonzero(frequent)
    if len(keep) > KNOWN:
        keep = np.sort(keep[np.argsort(-np.abs(ratio[keep]), kind="stable")[:KNOWN]])
    return known[keep], ratio[keep]


def train(texts: list[str], toxic: np.ndarray, natural_share: float, seed: int = SEED) -> Model:
    """Fit to labelled texts; ``natural_share``: toxic documents among all labelled ones, for the scale of scores.

    One text in ``HELD_FOR_SCALE`` of each label only sets the scale: the network has not seen it.
    """
    aside = np.zeros(len(texts), dtype=bool)
    for label in (0, 1):
        aside[np.flatnonzero(toxic == label)[HELD_FOR_SCALE - 1 :: HELD_FOR_SCALE]] = True
    later = [t for t, a in zip(texts, aside) if a], toxic[aside]
    texts, toxic = [t for t, a in zip(texts, aside) if not a], toxic[~aside]
    words = split_sample(texts)
    text_of = np.repeat(np.arange(len(texts)), np.diff(words.place))
    known_words, word_ratio = evidence(words.hashes[words.token], text_of, toxic)
    # The distinct words of each text carry its grams.
    pairs = np.unique(text_of * len(words.hashes) + words.token)
    pairs = np.stack([pairs // len(words.hashes), pairs % len(words.hashes)], axis=1)
    by_word = np.searchsorted(words.owner, np.arange(len(words.hashes) + 1))
    counts = np.diff(by_word)[pairs[:, 1]]
    flat = np.repeat(by_word[pairs[:, 1]], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    known_grams, gram_ratio = evidence(words.grams[flat], np.repeat(pairs[:, 0], counts), toxic)
    p = gru.new_parameters(len(known_words) + 1, len(known_grams) + 1, WIDTH, HIDDEN, seed)
    p["word"][1:, 0], p["gram"][1:, 1] = word_ratio / 4, gram_ratio / 4
    model = Model(p, known_words, known_grams, 1.0, 0.0)
    table = model.table(words)
    windows, owner = windows_of(words, len(words.hashes))
    first = np.searchsorted(owner, np.arange(len(texts)))
    # Evidence of a word: its own, or the strongest of its beginnings and other grams.
    word_score = np.append(np.append(0, word_ratio)[table.word], -np.inf)
    if len(table.gram):
        np.maximum.at(word_score, table.owner, np.append(0, gram_ratio)[table.gram])
    logit = word_score[windows].max(axis=1)
    rng = np.random.default_rng(seed)
    adam = gru.Adam(p)

    def strongest() -> np.ndarray:
        order = np.lexsort((-logit, owner))
        return order[first]

    for _ in range(EPOCHS):
        worst = strongest()
        clean = toxic == 0
        sizes = np.diff(np.append(first, len(owner)))
        other = first + (rng.random(len(first)) * sizes).astype(np.int64)
        chosen = np.concatenate([worst, other[clean]])
        target = np.concatenate([toxic, np.zeros(clean.sum())]).astype(gru.F32)
        # Both labels weigh the same.
        weight = np.where(target == 1, len(target) / max(1, 2 * target.sum()), len(target) / max(1, 2 * (1 - target).sum()))
        order = rng.permutation(len(chosen))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            tokens, local = np.unique(windows[chosen[rows]], return_inverse=True)
            if tokens[-1] != len(words.hashes):
                tokens = np.append(tokens, len(words.hashes))
            batch = part_of(table, tokens[:-1])
            adam.step(p, gru.gradients(p, batch, local.reshape(-1, WINDOW), target[rows], weight[rows].astype(gru.F32)))
        inputs = table.inputs(p)
        logit = np.concatenate([gru.forward(p, inputs, windows[i : i + SCORED]) for i in range(0, len(windows), SCORED)])
    unseen, of = model.window_logits(split_sample(later[0]))
    worst = np.full(len(later[0]), -np.inf)
    np.maximum.at(worst, of, unseen)
    y = later[1]
    if len(set(y.tolist())) < 2:
        worst, y = logit[strongest()], toxic
    share = np.where(y == 1, natural_share / y.sum(), (1 - natural_share) / (1 - y).sum())
    model.scale, model.shift = calibrate(worst, y, share / share.sum())
    return model


def part_of(table: gru.WordTable, tokens: np.ndarray) -> gru.WordTable:
    """The rows of some words, renumbered from 0."""
    low, high = np.searchsorted(table.owner, tokens), np.searchsorted(table.owner, tokens, side="right")
    counts = high - low
    flat = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return gru.WordTable(table.word[tokens], table.gram[flat], np.repeat(np.arange(len(tokens)), counts))


def calibrate(logit: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic scale and shift by Newton steps with a slight pull, so that separable labels stay finite."""
    x = np.stack([logit, np.ones(len(logit))], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        pull = np.array([1e-3, 0.0])
        gradient = x.T @ (weight * (q - toxic)) + pull * (b - np.array([1.0, 0.0]))
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + np.diag(pull + 1e-6)
        b = b - np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return max(float(b[0]), 0.05), float(b[1])


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, text, place, toxic, share): at most ``size`` toxic documents and ``CLEAN_PER_TOXIC`` times as many clean ones outside the
    held-out fold, with the share of toxic ones among all.

    Chosen by a hash of the id among the labelled rows; a document with two labels counts by the larger one.
    """
    learnt = labels.filter(fold(F.col("doc_id")) != 0).filter("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = dict(learnt.groupBy("toxic").count().collect())
    # Twice the bound of ids are looked up, since some are absent from the documents or too long for the sample.
    order, most = F.xxhash64("doc_id"), {0: CLEAN_PER_TOXIC * size, 1: size}
    held = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= LONGEST_SAMPLED)
    parts = []
    for t, n in most.items():
        ids = learnt.filter(F.col("toxic") == t).orderBy(order, "doc_id").limit(2 * n)
        # A broadcast of at most 2 * n rows of two numbers each.
        parts.append(held.join(F.broadcast(ids), "doc_id").orderBy(order, "doc_id", "text").limit(n))
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    return parts[0].unionByName(parts[1]).select("doc_id", "text", order.alias("place"), F.col("toxic").cast("long").alias("toxic"), F.lit(share).alias("share"))


SCORES = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``, one pass over the whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in buffers(frames):
            found = shared.value.scores(frame["text"].tolist())
            yield frame.drop(columns="text").assign(score=found, predicted=(found >= 0.5).astype("int32"))

    rows = small_batches(docs).select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInPandas(run, SCORES).select("doc_id", "held_out", "score", "predicted")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5. Each row is judged where it lies; nothing is joined."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        parts = [shared.value.scores(rows["text"].tolist()) for rows in buffers(iter([texts.rename("text").to_frame()]))]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return small_batches(docs).filter(toxic(F.col("text")) < 0.5)


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model | None:
    """A model from labelled documents, or None when one of the two labels is missing.

    The bounded sample is learnt from in one task, so the texts and the training need no memory of the driver; it receives the
    parameters only. A retried task gives the same model.
    """

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["toxic", "place", "doc_id", "text"])
        toxic = rows["toxic"].to_numpy(dtype=np.int64)
        made = [pickle.dumps(train(rows["text"].tolist(), toxic, rows["share"].iloc[0]))] if 0 < toxic.sum() < len(toxic) else []
        return pd.DataFrame({"model": pd.Series(made, dtype=object)})

    chosen = sample(docs, labels, size).withColumn("one", F.lit(0))
    found = chosen.groupBy("one").applyInPandas(learn, "model binary").first()
    return None if found is None else pickle.loads(found["model"])


def toxicity(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on), one row per row of ``docs``.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are ignored whatever their
    names, and no label, language, source or id enters a score. Null and empty texts get the score of an empty window.
    Repeated rows each keep their row; a null doc_id is never held out. An empty table gives no rows. Without both
    labels among the learnt rows nothing can be told apart: every score is 0.
    """
    model = fit(docs, labels, size)
    if model is None:
        held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
        return docs.select("doc_id", held.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return score(docs, model)
