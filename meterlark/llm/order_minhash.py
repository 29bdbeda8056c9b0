"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document is the sequence of its five-word shingles, each labelled with its occurrence (the first, the second and so on), so that no two
are equal (after Marcais et al., "Locality-sensitive hashing for the edit distance", 2019). A table of the sketch samples the
``SAMPLED`` labelled shingles with the smallest hashes and keeps them in the order of the text; documents that agree
on one table are candidates. The similarity of two documents is that of their best alignment over all occurrences: shingles matched in
common order, over all shingles of both less the matched ones.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from meterlark.llm.components import connected_components
from meterlark.llm.text import BASES, U64, Buffer, buffers, mix, shingles, small_batches
from meterlark.session import stage

WORDS = 5
LEAST_SIMILARITY = 0.8
# A table agrees for about similarity ** SAMPLED of all pairs: of pairs at 0.8 one in 4,600 agrees in none of 16 tables.
SAMPLED = 4
TABLES = 16
# Documents of a bucket that still belong to several groups are joined pair by pair up to this size;
# a larger bucket is compared whole, two blocks at a time, of about so many documents and distinct shingles each.
COMPARED = 32
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
# Shingles counted by one matrix product.
COUNTED = 4096

_SALTS = mix(np.arange(1, TABLES + 1, dtype=U64) * U64(BASES[0])) | U64(1)


def labelled(s: np.ndarray) -> np.ndarray:
    """The shingles of one text, each made unique by its occurrence."""
    order = np.argsort(s, kind="stable")
    ordered = s[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(s) else np.zeros(0, dtype=bool)
    if new.all():
        return mix(s)
    at = np.arange(len(s))
    before = np.empty(len(s), dtype=np.int64)
    before[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(s + before.astype(U64) * U64(BASES[0]))


def sketch(s: np.ndarray) -> np.ndarray:
    """One hash per table of the sampled shingles in text order."""
    out, taken = np.zeros(TABLES, dtype=U64), min(SAMPLED, len(s))
    step = max(1, min(TABLES, (1 << 20) // len(s)))  # tables at once, so that a very long text needs little more memory
    for j in range(0, TABLES, step):
        chosen = np.argpartition(s * _SALTS[j : j + step, None], taken - 1, axis=1)[:, :taken]
        for column in np.sort(chosen, axis=1).T:
            out[j : j + step] = out[j : j + step] * U64(BASES[1]) + s[column]
    return mix(out + U64(taken))


def in_common_order(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The most shingles that two texts hold in common order, no matched pair of places further apart than the band.

    Columns of the alignment table are bits of one number, so a row is a few operations on whole numbers; a shingle's bits outside
    the band of its row are left out.
    """
    places: dict[int, int] = {}
    for i, h in enumerate(a.tolist()):
        places[h] = places.get(h, 0) | 1 << i
    every = (1 << len(a)) - 1
    width, open_ = (1 << (2 * band + 1)) - 1, every
    for j, h in enumerate(b.tolist()):
        hit = places.get(h, 0)
        hit &= width << (j - band) if j >= band else width >> (band - j)
        if hit:
            met = open_ & hit
            open_ = ((open_ + met) | (open_ - met)) & every
    return len(a) - open_.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = LEAST_SIMILARITY) -> float:
    """Matched shingles of two texts (all occurrences, in common order) over all, by alignment within a band; 0 when ``least`` is out of reach.

    Two sequences that reach ``least`` shift no matched shingle by more than (1 - least) of the longer one, so the band loses
    no alignment that counts. Labelled shingles match at most once, which makes their alignment a longest increasing run; it is never more than
    the best one, and is the answer where it reaches ``least`` or no shingle is repeated. Else an occurrence may match one of
    another number, and the shingles are aligned as they are.
    """
    if not len(a) or not len(b):
        return 0.0

    def share(matched: int) -> float:
        return matched / (len(a) + len(b) - matched)

    if share(min(len(a), len(b))) < least:
        return 0.0
    x, y = labelled(a), labelled(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    # Labels that both hold are as many as the occurrences that could match at all.
    if share(len(i)) < least:
        return 0.0
    band = int((1 - least) * max(len(a), len(b))) + 1
    near = np.abs(i - j) <= band
    run: list[int] = []
    for place in j[near][np.argsort(i[near])].tolist():
        at = bisect_left(run, place)
        run[at : at + 1] = [place]
    if share(len(run)) >= least or len(np.unique(a)) == len(a) and len(np.unique(b)) == len(b):
        return share(len(run))
    return share(in_common_order(a, b, band))


SKETCHES = "doc_id long, text_key long, h1 long, h2 long, size int, sketch array<long>"


def sketches(docs: DataFrame) -> DataFrame:
    """Digest of the words, number of shingles and sketch of every document that has a doc_id and a word."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in buffers(frames):
            words, place = Buffer(frame["text"].tolist()).word_hashes()
            rows = []
            for n, (doc_id, key) in enumerate(zip(frame["doc_id"], frame["text_key"])):
                own = words[place[n] : place[n + 1]]
                if len(own):
                    s = labelled(shingles(own, WORDS))
                    at = np.arange(1, len(own) + 1, dtype=U64)
                    digest = [int(mix(own * mix(at + U64(b))).sum(dtype=U64).view(np.int64)) for b in (0, BASES[1])]
                    rows.append((doc_id, key, *digest, len(s), sketch(s).view(np.int64)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SKETCHES.split(", ")])

    text = F.coalesce(F.col("text"), F.lit(""))
    return small_batches(docs).filter("doc_id IS NOT NULL").select("doc_id", F.xxhash64(text).alias("text_key"), text.alias("text")).mapInPandas(run, SKETCHES)


def texts_of(wanted: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """(id, key, text) of the wanted (id, key), fetched once into a stage table of that name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    # The ids are the few, and build the hash side: texts are shuffled once and never sorted. Rows that repeat a document hold one
    # text: one of them answers.
    return stage(texts.join(wanted.distinct().hint("shuffle_hash"), ["id", "key"]).groupBy("id", "key").agg(F.first("text").alias("text")), name)


def verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """(a, b) of the candidate pairs (a, a_key, b, b_key) that are similar enough.

    The texts that some pair needs are fetched once, then joined to both sides.
    """
    pairs = stage(pairs, "near-pairs")
    wanted = pairs.select(F.col("a").alias("id"), F.col("a_key").alias("key")).unionByName(
        pairs.select(F.col("b").alias("id"), F.col("b_key").alias("key")))
    held = texts_of(wanted, docs, "near-texts")
    left = held.select(F.col("id").alias("a"), F.col("key").alias("a_key"), F.col("text").alias("a_text"))
    right = held.select(F.col("id").alias("b"), F.col("key").alias("b_key"), F.col("text").alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in buffers(frames):
            one, at_one = Buffer(frame["a_text"].tolist()).word_hashes()
            two, at_two = Buffer(frame["text"].tolist()).word_hashes()
            similar = [
                similarity(*(shingles(w[at[n] : at[n + 1]], WORDS) for w, at in ((one, at_one), (two, at_two))), least) >= least
                for n in range(len(frame))
            ]
            yield frame.loc[similar, ["a", "b"]]

    joined = pairs.join(left, ["a", "a_key"]).join(right, ["b", "b_key"]).select("a", "b", "a_text", "text")
    return small_batches(joined).mapInPandas(run, "a long, b long")


def ordered_pair(x: str, y: str) -> list:
    """Columns a, a_key, b, b_key of two documents given as structs (id, key, size)."""
    swap = F.col(f"{x}.id") > F.col(f"{y}.id")
    return [
        F.when(swap, F.col(f"{y}.{c}")).otherwise(F.col(f"{x}.{c}")).alias(n) for c, n in (("id", "a"), ("key", "a_key"))
    ] + [F.when(swap, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(n) for c, n in (("id", "b"), ("key", "b_key"))]


def reachable(x: str, y: str, least: float):
    """Two documents whose lengths alone do not rule the similarity out."""
    return F.least(f"{x}.size", f"{y}.size") >= least * F.greatest(f"{x}.size", f"{y}.size")


def star_pairs(members: DataFrame, key: list[str], least: float, choice: int = 0) -> DataFrame:
    """Every member (struct ``doc``) of a bucket with one leader of the bucket, unless both are in one group already.

    The leader is chosen by a hash that differs between buckets and choices.
    """
    chosen = F.xxhash64(F.col("doc.id"), F.lit(choice), *key)
    fields = ("id", "key", "size", "group")
    # Field by field, since sums of plain numbers need no sorting.
    leaders = members.groupBy(*key).agg(
        *[F.min_by(f"doc.{c}", chosen).alias(f"leader_{c}") for c in fields], F.count(F.lit(1)).alias("held")
    ).filter("held > 1").select(*key, F.struct(*[F.col(f"leader_{c}").alias(c) for c in fields]).alias("leader"))
    met = members.join(leaders, key).filter(F.col("doc.group") != F.col("leader.group")).filter(reachable("doc", "leader", least))
    return met.select(*ordered_pair("doc", "leader")).distinct()


def remaining(members: DataFrame) -> DataFrame:
    """Members (table, value, doc) of the buckets whose documents belong to different groups so far, with the bucket's size."""
    key, group = ["table", "value"], F.col("doc.group")
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("held"), F.min(group).alias("low"), F.max(group).alias("high"))
    return members.join(sizes.filter("low < high").drop("low", "high"), key)


def small_pairs(members: DataFrame, least: float) -> DataFrame:
    """All pairs of ``remaining`` members of a bucket of up to ``COMPARED`` documents that belong to different groups."""
    rows = members.filter(F.col("held") <= COMPARED).select("table", "value", "doc")
    other = rows.select(F.col("table").alias("_table"), F.col("value").alias("_value"), F.col("doc").alias("other"))
    on = (F.col("table") == F.col("_table")) & (F.col("value") == F.col("_value")) & (F.col("doc.id") < F.col("other.id"))
    on = on & (F.col("doc.group") != F.col("other.group")) & reachable("doc", "other", least)
    return rows.join(other, on).select(*ordered_pair("doc", "other")).distinct()


def common(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """How many shingles each text of one list shares with each of the other, or of the same list without another."""
    sides = [left] if right is None else [left, right]
    every = [np.concatenate(x) for x in sides]
    if right is None:
        found, counts = np.unique(every[0], return_counts=True)
        shared = found[counts > 1]
    else:
        shared = np.intersect1d(*every)
    placed = []
    for x, hashes in zip(sides, every):
        at, text = np.searchsorted(shared, hashes), np.repeat(np.arange(len(x)), [len(t) for t in x])
        held = at < len(shared)
        held[held] = shared[at[held]] == hashes[held]
        at, text = at[held], text[held]
        order = np.argsort(at, kind="stable")
        placed.append((at[order], text[order]))
    out = np.zeros((len(left), len(sides[-1])))
    for begin in range(0, len(shared), COUNTED):
        ones = []
        for x, (at, text) in zip(sides, placed):
            low, high = np.searchsorted(at, [begin, begin + COUNTED])
            ones.append(np.zeros((len(x), min(COUNTED, len(shared) - begin)), dtype=np.float32))
            ones[-1][text[low:high], at[low:high] - begin] = 1
        out += ones[0] @ ones[-1].T  # every product is a whole number of at most COUNTED: exact
    return out


def compared(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """Similar pairs (a, b) of one pair of blocks that connect all groups which any of its similar pairs connects.

    Rows of ``frame`` on side 0 meet those on side 1; a block that meets itself has side 0 only. The similarity of the labelled sets is
    never below that of the alignment, so only pairs that reach ``least`` by it are aligned.
    """
    words, place = Buffer(frame["text"].tolist()).word_hashes()
    texts = [shingles(words[place[n] : place[n + 1]], WORDS) for n in range(len(frame))]
    side, sizes = frame["side"].to_numpy(), np.array([len(t) for t in texts])
    ids, groups, home = frame["id"].to_numpy(), frame["group"].to_numpy(), frame["home"].to_numpy(dtype=bool)
    same = bool(frame["own"].iloc[0] == frame["other"].iloc[0])
    x = np.flatnonzero(side == 0)
    y = x if same else np.flatnonzero(side == 1)
    links: list[tuple[int, int]] = []
    if len(x) and len(y):
        shared = common([labelled(texts[n]) for n in x], None if same else [labelled(texts[n]) for n in y])
        near = shared / (sizes[x][:, None] + sizes[y] - shared) >= least
        # Two documents that are both guests of a window meet in their own.
        near &= (groups[x][:, None] != groups[y]) & (home[x][:, None] | home[y])
        i, j = np.nonzero(np.triu(near, 1) if same else near)
        root: dict[int, int] = {}

        def find(n: int) -> int:
            while n in root:
                n = root[n]
            return n

        for p, q in zip(x[i].tolist(), y[j].tolist()):
            one, two = find(int(groups[p])), find(int(groups[q]))
            if one != two and similarity(texts[p], texts[q], least) >= least:
                root[max(one, two)] = min(one, two)
                links.append((ids[p], ids[q]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def large_links(members: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """Similar pairs (a, b) of ``remaining`` members of a bucket of more than ``COMPARED`` documents, whole: enough of them to
    connect all groups that its similar pairs connect.

    Lengths that rule a similarity out are never compared: documents go into bands of lengths so wide that similar ones are in one
    band or in neighbours, and a window is a band with the one below it as guests. A window is cut into blocks by a hash; every
    two blocks meet in a task of their own, so that a window of any size is compared whole.
    """
    key = ["table", "value", "window"]
    width = -math.log(least) * (1 + 1e-9) + 1e-12
    band = F.floor(F.log("doc.size") / width)
    windows = F.array(*[F.struct((band + n).alias("window"), F.lit(n == 0).alias("home")) for n in (0, 1)])
    rows = members.filter(F.col("held") > COMPARED).select("table", "value", "doc.*", F.explode(windows).alias("w")).select(
        "table", "value", "id", F.col("key").alias("text_key"), "size", "group", "w.*")
    counted = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("held"), F.sum("size").alias("sizes"), F.max("home").alias("homes"),
        F.min("group").alias("low"), F.max("group").alias("high")).filter("homes AND low < high")
    blocks = F.greatest(F.ceil(F.col("held") / BLOCK), F.ceil(F.col("sizes") / BLOCK_SHINGLES)).cast("int")
    cut = rows.join(counted.select(*key, blocks.alias("blocks")), key)
    cut = cut.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # Block i meets itself and every later one: as side 0 under (i, j >= i), as side 1 under (j < i, i).
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least("block", k).alias("own"), F.greatest("block", k).alias("other"), F.when(k >= F.col("block"), 0).otherwise(1).alias("side")))
    cut = stage(cut, "near-blocks")
    texts = texts_of(cut.select("id", F.col("text_key").alias("key")), docs, "near-block-texts").withColumnRenamed("key", "text_key")
    dealt = cut.withColumn("m", F.explode(meets)).select(*key, "id", "text_key", "group", "home", "m.*")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return compared(frame, least)

    return small_batches(dealt.join(texts, ["id", "text_key"])).groupBy(*key, "own", "other").applyInPandas(run, "a long, b long")


def classes_of(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """(_id, _key, class): the class of every document that has words, by doc_id and hash of its text."""
    found = stage(sketches(docs), "near-sketches")
    classes = stage(found.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.min_by("text_key", "doc_id").alias("key"),
        F.first("size").alias("size"), F.first("sketch").alias("sketch")), "near-classes")
    doc = F.struct(F.col("rep").alias("id"), "key", "size", F.col("rep").alias("group"))
    buckets = classes.select(F.posexplode("sketch").alias("table", "value"), doc.alias("doc"))
    first = stage(verified(star_pairs(buckets, ["table", "value"], least), docs, least), "near-links")
    groups = connected_components(first)
    known = classes.join(groups, F.col("rep") == F.col("id"), "left").drop("id").withColumn(
        "doc", F.struct(F.col("rep").alias("id"), "key", "size", F.coalesce("component", "rep").alias("group")))
    members = stage(remaining(known.select("doc", F.posexplode("sketch").alias("table", "value"))), "near-open")
    second = verified(small_pairs(members, least), docs, least).unionByName(large_links(members, docs, least))
    # One document with two texts links its two classes, which are both named after it or after a smaller copy.
    twice = found.join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).filter("a <> b")
    shared = twice.join(found.groupBy("doc_id").agg(F.min("text_key").alias("x"), F.max("text_key").alias("y")).filter("x <> y").select(F.col("doc_id").alias("a")), "a")
    links = first.unionByName(second).unionByName(shared.select("a", "b"))
    groups = connected_components(links)
    return (
        found.select("doc_id", "text_key", "h1", "h2").distinct().join(classes.select("h1", "h2", "rep"), ["h1", "h2"])
        .join(groups, F.col("rep") == F.col("id"), "left")
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.coalesce("component", "rep").alias("class"))
        .groupBy("_id", "_key").agg(F.min("class").alias("class"))
    )


def near_duplicates(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """doc_id, class_id, kept: one row per row of ``docs``; the smallest doc_id of a class is kept.

    ``docs`` needs doc_id and text; other columns are ignored whatever their names. Documents with the same words are one
    class at once, and only one of them is compared. Links between classes are similar pairs; classes are what links connect.
    A null, empty or blank text has no shingle and is alone, also among its like; so is a row without doc_id, whose
    class is null. Rows that share a doc_id are one document, in the class of either text. An empty table gives no rows.

    First every document meets one leader per table. Then only buckets whose documents are still in several groups are looked
    at again, and every two of their documents that are not in one group are compared, see ``small_pairs`` and ``large_links``.
    """
    named = classes_of(docs, least)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"))
    out = rows.join(named, (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    class_id = F.coalesce("class", "doc_id")
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, least: float = LEAST_SIMILARITY, one_blank: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, of the documents that are the smallest of their class.

    Rows that share a doc_id are one document and stay or go together; see ``near_duplicates``. Documents without a word are each
    alone and stay, unless ``one_blank`` makes them one class.
    """
    later = classes_of(docs, least).filter("class < _id").select("_id")
    if one_blank:
        worded = F.coalesce("text", F.lit("")).rlike(r"[^\t-\r\x1c- ]")
        blank = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.bool_or(worded).alias("worded")).filter("NOT worded")
        smallest = blank.agg(F.min("_id")).first()[0]
        later = later.unionByName(blank.filter(F.col("_id") > F.lit(smallest)).select("_id"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id")
    return rows.join(later.distinct().hint("shuffle_hash"), F.col("doc_id") == F.col("_id"), "left_anti").select("row.*")
