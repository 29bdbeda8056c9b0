"""Document quality by hierarchical empirical Bayes: a text classifier's evidence, and what its host and path have earned.

The classifier says how likely a text is good on its own. Grouped sums of these likelihoods give each host
a posterior share of good documents, shrunk toward the global share, and each path one shrunk toward its host; how
strongly is estimated from the spread between sites. The document's odds are then those of its path times its own evidence.
What a document adds to its own sites is taken out first, so that its evidence counts once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from meterlark.llm.text import Buffer, Prefix, buffers, small_batches
from meterlark.llm.toxicity import fold
from meterlark.session import stage

# The bounds of the training sample: documents per label and code points of a document that may enter it.
SAMPLE = 2000
LONGEST_SAMPLED = 20_000
PULL = 1e-3
# Bounds of what a group may weigh: a prior worth this many documents at least and at most.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6
# The text can move the odds by this factor at most, so that no rounding makes it certain.
MOST_EVIDENCE = 12.0

# 0 symbols, 1 lower case (and all letters beyond ASCII), 2 upper case, 3 digits, 4 white space, 5 marks of prose.
_CLASSES = np.zeros(256, dtype=np.int64)
for _first, _last, _kind in ((97, 123, 1), (65, 91, 2), (48, 58, 3), (128, 256, 1)):
    _CLASSES[_first:_last] = _kind
for _byte in (9, 10, 11, 12, 13, 32):
    _CLASSES[_byte] = 4
for _byte in b".,;:'\"()-":
    _CLASSES[_byte] = 5

FEATURES = (
    "log_words", "upper", "digit", "symbol", "white", "mark", "repeated_words", "repeated_pairs", "repeated_lines", "word_length",
    "word_spread", "line_length", "symbol_words", "capital_words",
)


def features(texts: list[str]) -> np.ndarray:
    """(texts x FEATURES) of whole texts; an empty text is all zeros."""
    buffer = Buffer(texts)
    n, data = len(texts), buffer.bytes
    sizes = buffer.ends - buffer.starts
    kind = _CLASSES[data]
    counts = np.stack([np.append(0, np.cumsum(kind == k)) for k in range(6)], axis=1)
    held = counts[buffer.ends] - counts[buffer.starts]
    lead = np.append(0, np.cumsum((data & 0xC0) == 0x80))
    points = np.maximum(1, sizes - (lead[buffer.ends] - lead[buffer.starts]))
    begin, end, place = buffer.words()
    hashes, _ = buffer.word_hashes()
    words = np.diff(place)
    text = np.repeat(np.arange(n), words)
    some = np.maximum(1, words)

    def repeated(values: np.ndarray, owner: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Share of values that equal an earlier one of their text."""
        order = np.lexsort((values, owner))
        v, o = values[order], owner[order]
        same = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
        return np.bincount(o[1:][same], minlength=n) / np.maximum(1, total)

    inside = text[1:] == text[:-1]
    pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[inside]
    length = end - begin
    mean = np.bincount(text, weights=length, minlength=n) / some
    spread = np.sqrt(np.maximum(0, np.bincount(text, weights=length * length, minlength=n) / some - mean * mean))
    breaks = np.flatnonzero(data == 10)
    starts = np.append(0, breaks[:-1] + 1)
    line_owner = np.searchsorted(buffer.starts, starts, side="right") - 1
    lines = np.bincount(line_owner, minlength=n)
    line_hash = Prefix(data).ranges(starts, breaks)
    symbols = counts[end, 0] - counts[begin, 0]
    capitals = counts[end, 2] - counts[begin, 2]
    out = np.stack([
        np.log1p(words), held[:, 2] / points, held[:, 3] / points, held[:, 0] / points, held[:, 4] / points, held[:, 5] / points,
        repeated(hashes, text, words), repeated(pairs, text[1:][inside], words - 1), repeated(line_hash, line_owner, lines),
        mean / 10, spread / 10, np.log1p(points / np.maximum(1, lines)),
        np.bincount(text, weights=symbols > 0, minlength=n) / some,
        np.bincount(text, weights=capitals > 1, minlength=n) / some,
    ], axis=1)
    out[words == 0] = 0
    return out


@dataclass
class Classifier:
    """A logistic model of standardised features and their squares; ``share``: good documents among those it learnt from."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    share: float

    @staticmethod
    def _wide(z: np.ndarray) -> np.ndarray:
        z = np.clip(z, -6, 6)
        return np.concatenate([z, z * z, np.ones((len(z), 1))], axis=1)

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Log likelihood ratio of good against bad: the model's odds over the odds of its sample."""
        odds = self._wide((features(texts) - self.mean) / self.scale) @ self.weights
        return np.clip(odds - np.log(self.share / (1 - self.share)), -MOST_EVIDENCE, MOST_EVIDENCE)


def learn(texts: list[str], good: np.ndarray) -> Classifier:
    """Ridge logistic regression by Newton steps. The features are made a few texts at a time, for the task's memory."""
    x = np.concatenate([features(texts[i : i + 64]) for i in range(0, len(texts), 64)])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    wide = Classifier._wide((x - mean) / scale)
    w = np.zeros(wide.shape[1])
    ridge = np.full(wide.shape[1], PULL)
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(wide @ w, -30, 30)))
        gradient = wide.T @ (q - good) / len(good) + ridge * w
        curve = (wide * (q * (1 - q))[:, None]).T @ wide / len(good) + np.diag(ridge)
        w = w - np.clip(np.linalg.solve(curve, gradient), -3, 3)
    return Classifier(mean, scale, w, float(np.clip(good.mean(), 1e-6, 1 - 1e-6)))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, text, place, quality) of at most ``size`` documents per label, by a hash of the id, outside the held-out fold.

    A document with two labels counts by the smaller one.
    """
    learnt = labels.filter("quality IN (0, 1)").filter(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= LONGEST_SAMPLED)
    order, parts = F.xxhash64("doc_id"), []
    for q in (0, 1):
        # Some ids are absent or too long for the sample: twice the bound are looked up, rows of two numbers.
        ids = learnt.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(2 * size)
        parts.append(held.join(F.broadcast(ids), "doc_id").orderBy(order, "doc_id", "text").limit(size))
    return parts[0].unionByName(parts[1]).select("doc_id", "text", order.alias("place"), F.col("quality").cast("long").alias("quality"))


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Classifier | None:
    """A classifier from labelled documents, or None when one of the two labels is missing.

    The bounded sample is learnt from in one task; the driver receives the parameters only. A retried task gives the same model.
    """

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["quality", "place", "doc_id", "text"])
        good = rows["quality"].to_numpy(dtype=np.int64)
        made = [pickle.dumps(learn(rows["text"].tolist(), good))] if 0 < good.sum() < len(good) else []
        return pd.DataFrame({"model": pd.Series(made, dtype=object)})

    found = sample(docs, labels, size).withColumn("one", F.lit(0)).groupBy("one").applyInPandas(train, "model binary").first()
    return None if found is None else pickle.loads(found["model"])


EVIDENCE = "doc_id long, host string, path string, held_out boolean, evidence double"


def evidence(docs: DataFrame, model: Classifier) -> DataFrame:
    """``EVIDENCE`` of every row of (doc_id, host, path, held_out, text): the only pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in buffers(frames):
            yield frame.drop(columns="text").assign(evidence=shared.value.evidence(frame["text"].tolist()))

    return small_batches(docs).select("doc_id", "host", "path", "held_out", "text").mapInPandas(run, EVIDENCE)


def strength(groups: DataFrame, mean: str, prior: str) -> float:
    """How many documents a group's prior is worth, by moments over groups (n, ``mean``, ``prior``) of two or more.

    The spread between group means beyond what chance gives decides: none makes the prior as strong as it may be.
    """
    between = F.sum(F.col("n") * (F.col(mean) - F.col(prior)) ** 2)
    row = groups.filter("n > 1").agg(
        between.alias("spread"), F.sum(F.col(prior) * (1 - F.col(prior))).alias("chance"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"), F.sum(F.col("n") * F.col(prior) * (1 - F.col(prior))).alias("full"),
    ).first()
    if not row["groups"]:
        return MOST_STRENGTH
    excess = row["spread"] - row["chance"]
    full = row["full"] - row["chance"]
    if excess <= 0 or full <= 0:
        return MOST_STRENGTH
    # Var(group mean) = share * (1 - share) * rho, and a beta prior of strength s has rho = 1 / (s + 1).
    return float(np.clip(full / excess - 1, LEAST_STRENGTH, MOST_STRENGTH))


def without_own(good: str, n: str, own: Column, strength_: float, prior: Column) -> Column:
    """The posterior share of a site's other documents: their sum and ``strength_`` documents of the prior."""
    return (F.greatest(F.col(good) - own, F.lit(0.0)) + strength_ * prior) / (F.col(n) - 1 + strength_)


def combine(scored: DataFrame, share: float) -> DataFrame:
    """Rows of ``EVIDENCE`` with text_score, host_share, path_share, score.

    ``share`` is the global prior share of good documents before any document of the table is seen; it weighs as much as one. A document's
    host_share and path_share are those of the other documents of its sites: alone on its site, it is judged by what the host, or
    the whole table, has earned without it. Sites without a name are the site "". Sums are made per task before the shuffle; what is shuffled
    to meet its site is a few numbers per document, and adaptive execution splits a site that holds a third of them.
    """
    prior = float(np.log(share / (1 - share)))

    def chance(odds):
        return 1 / (1 + F.exp(-odds))

    named = scored.withColumns({
        "host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit("")),
        "text_score": chance(F.col("evidence") + prior),
    })
    paths = stage(named.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("text_score").alias("good")), "site-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    if total["n"] is None:
        return named.select("*", F.lit(0.0).alias("host_share"), F.lit(0.0).alias("path_share"), F.lit(0.0).alias("score"))
    overall = F.lit((total["good"] + share) / (total["n"] + 1))
    means = hosts.select(F.col("host_n").alias("n"), (F.col("host_good") / F.col("host_n")).alias("mean"), overall.alias("prior"))
    host_strength = strength(means, "mean", "prior")
    nested = paths.join(hosts, "host").withColumns({
        "mean": F.col("good") / F.col("n"), "shrunk": (F.col("host_good") + host_strength * overall) / (F.col("host_n") + host_strength)})
    path_strength = strength(nested, "mean", "shrunk")
    sites = nested.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "good", "host_n", "host_good")
    out = named.join(sites, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")))
    own = F.col("text_score")
    others = (F.lit(total["good"] + share) - own) / float(total["n"])
    out = out.withColumn("host_share", without_own("host_good", "host_n", own, host_strength, others))
    out = out.withColumn("path_share", without_own("good", "n", own, path_strength, F.col("host_share")))
    within = F.least(F.greatest(F.col("path_share"), F.lit(1e-9)), F.lit(1 - 1e-9))
    return out.drop("_host", "_path", "n", "good", "host_n", "host_good").withColumn("score", chance(F.col("evidence") + F.log(within / (1 - within))))


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, text_score, host_share, path_share, score (0 to 1) and keep (score >= 0.5), one row per row of ``docs``.

    ``docs`` needs doc_id, text and the columns named by ``host`` and ``path`` (a path counts within its host); ``labels``
    needs doc_id and quality; other columns are ignored whatever their names. A null text is empty and is scored as such. A missing host or
    path is a site of its own. Repeated rows each keep their row and count each. An empty table gives no rows. Where no row with one of the two labels
    can be learnt from there is no evidence: every score is 1 and everything is kept.
    """
    rows = docs.select(
        "doc_id", F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"),
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    columns = ("doc_id", "held_out", "text_score", "host_share", "path_share", "score")
    model = fit(docs, labels, size)
    if model is None:
        ones = [F.lit(1.0).alias(c) for c in columns[2:]]
        return rows.select("doc_id", "held_out", *ones, F.lit(True).alias("keep"))
    learnt = labels.filter("quality IN (0, 1)").filter(fold(F.col("doc_id")) != 0)
    share = float(np.clip(learnt.agg(F.avg("quality")).first()[0], 1e-6, 1 - 1e-6))
    scored = stage(evidence(rows, model), "quality-evidence")
    return combine(scored, share).select(*columns, (F.col("score") >= 0.5).alias("keep"))
