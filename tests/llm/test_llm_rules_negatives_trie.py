import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from meterlark.llm import compression, hard_negatives, prefix_trie, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- compression bands ---------------------------------------------------------------------------

def brute_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(len(w) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_counts_equal_a_plain_loop(spark, docs_of, prose, monkeypatch):
    rng = random.Random(4)
    texts = [
        "", None, " \n\t\r\x0b\x0c ", "one", "a b a b a b a b", "x " * 4000, "a b c d\x1ce", "#*$%&|<> <a>\n<a>\n\n\n <a>", "é 😀 é 😀 é 😀 q",
        prose(300, 1), prose(40, 2) + "\n" + prose(40, 2) + "\r\n" + prose(40, 2), prose(20_000, 3), " ".join(rng.choice("ab") for _ in range(5000)),
        *[" ".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(60)],
    ]
    rows = list(enumerate(texts)) + [(3, "one"), (None, "one")]
    docs = docs_of(rows).withColumn("kept", F.lit("mine")).withColumn("ratio", F.lit(1))
    monkeypatch.setattr(queries, "documents", lambda spark, sf_dir: docs)
    out = queries.QUERIES["op11_compression_bands"](spark, "").collect()
    assert len(out) == len(rows)
    for r in out:
        want = brute_counts((texts[r["doc_id"]] if r["doc_id"] is not None else "one") or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, r
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"]) and r["kept"] == (r["reason"] is None)
    assert compression.quality_rules(docs_of([])).count() == 0


def test_large_ids_survive_beside_a_missing_one(docs_of):
    big = (1 << 60) + 1
    assert {r["doc_id"] for r in compression.quality_rules(docs_of([(big, "a"), (None, "b")])).collect()} == {big, None}


def test_bands_reject_what_repeats_and_what_is_noise(docs_of, prose):
    rng = random.Random(9)
    letters = "".join(chr(c) for c in range(33, 127))
    noise = " ".join("".join(rng.choice(letters) for _ in range(60)) for _ in range(200))
    # Every paragraph says the same with another number between the words, so no window of three words occurs twice.
    template = prose(40, 5).split()
    forms = "\n".join(" ".join(f"{w * 4} {w} {i}" for w in template) for i in range(120))
    half = prose(2500, 6) + " " + " ".join(f"{w} {i}" for i in range(900) for w in ("aaaaaaaaaaaaaaaaaaaa",))
    rows = [(1, prose(60, 1)), (2, prose(500, 2)), (3, prose(30_000, 3)), (4, noise), (5, forms), (6, half), (7, prose(30, 8)), (8, "word " * 500)]
    docs = docs_of(rows).withColumn("reason", F.lit("mine"))
    why = {r["doc_id"]: r["reason"] for r in compression.quality_rules(docs).collect()}
    assert why == {1: None, 2: None, 3: None, 4: "incompressible", 5: why[5], 6: "repetitive_chunks", 7: "words", 8: "words"}
    assert why[5] in ("repetitive", "repetitive_chunks")
    kept = compression.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3]


def test_ratios_are_those_of_plain_chunks(docs_of, prose):
    text = prose(3000, 11)
    row = compression.quality_rules(docs_of([(1, text)])).first()
    c, data = zstandard.ZstdCompressor(level=3), text.encode()
    parts = [data[i : i + 4096] for i in range(0, len(data), 4096)]
    assert row["n_bytes"] == len(data) and math.isclose(row["ratio"], len(data) / len(c.compress(data)))
    assert math.isclose(row["chunk_ratio"], max(len(p) / len(c.compress(p)) for p in parts))


# --- hard negatives ------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_negatives(rows):
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        key = (label, tuple(v))
        best[i] = min(best.get(i, key), key)
    own = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in best.items()}
    out = []
    for a, (label, v) in own.items():
        if a % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in own.items() if i != a and len(w) == len(v))
        for p, pid, _ in [s for s in scored if s[2] == label][:5]:
            p = -p
            fit = [(-n, i) for n, i, other in scored if other != label and 80 * p <= -100 * n <= 100 * p]
            out += [(a, pid, rank, i, p, n) for rank, (n, i) in enumerate(fit[:5], 1)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, VECTORS).withColumn("q", F.lit(1)).withColumn("width", F.lit("mine"))
    out = hard_negatives.mine(df)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def test_hard_negatives_equal_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "VECTOR_BLOCK", 97)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 2)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 19))
    rows = []
    for i in range(700):
        v = centres[i % 6] + 0.3 * rng.standard_normal(19)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], int(rng.integers(0, 4)) if i % 3 else 1))
    rows += [(700 + i, rows[5][1], 2) for i in range(40)]  # many equal vectors: ties
    rows += [
        (800, None, 1), (801, [float("nan")] * 19, 1), (802, [None] * 19, 1), (803, rows[0][1], None), (None, rows[0][1], 1),
        (900, [0.0] * 19, 1), (1000, [0.5, 0.5], 1), (1001, [0.5, 0.25], 2), (1002, [0.5, 0.5], 1), (1100, [], 3), (1101, [], 3), (1102, [], 4),
        (100, rows[100][1], 9), (0, rows[0][1], rows[0][2]), (1201, [float("inf")] + [0.0] * 18, 2),
    ]
    want = brute_negatives(rows)
    assert len(want) > 100 and mined(spark, rows) == want


def test_negative_scores_and_empty_tables(spark):
    # The only positive of an anchor points away: no score lies between 80 and 100 hundredths of a negative one.
    assert mined(spark, [(100, [1.0, 0.0], 1), (101, [-1.0, 0.0], 1), (102, [-1.0, 0.1], 2), (103, [1.0, 0.0], 3)]) == []
    assert mined(spark, []) == []


def test_bounds_hold_every_score():
    rng = np.random.default_rng(8)
    for width in (1, 3, 16, 50):
        a, b = (np.floor(rng.standard_normal((30, width)) * 256 + 100) for _ in range(2))
        (am, ad), (bm, bd) = hard_negatives.summaries(a), hard_negatives.summaries(b)
        spread = []
        for columns, size in hard_negatives.level_columns(width):
            middle, room = (am[:, columns] * size) @ bm[:, columns].T, ad[:, columns] @ bd[:, columns].T
            assert (np.abs(a @ b.T - middle) <= room + 1e-6 * np.abs(middle) + 1e-3).all()
            spread.append(room.mean())
        assert spread == sorted(spread, reverse=True)  # finer segments, narrower bounds


def test_huge_components_are_held_at_the_bound(spark):
    most = hard_negatives.largest(2)
    got = mined(spark, [(100, [1e200, 0.0], 1), (101, [1.0, 0.0], 1), (102, [0.9, 0.0], 2)])
    assert got == [(100, 101, 1, 102, most * 256, most * 230)]


# --- prefix trie ---------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in convs.items()}
    members, ends = {}, {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        s = tuple(convs.get(c - c % 20, [])[:h] + convs[c][h:])
        ends.setdefault(s, []).append(c)
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    saved = {k: (len(m) - 1) * len(WORD.findall(k[-1][1])) if k else 0 for k, m in members.items()}
    out = []
    for k, m in members.items():
        below = [x for x in members if x[: len(k)] == k]
        out.append((
            min(m), len(k), min(members[k[:-1]]) if k else None, len(m), sum(len(x) == len(k) + 1 for x in below),
            sum(not any(len(y) == len(x) + 1 and y[:-1] == x for y in members) for x in below), sum(saved[x] for x in below),
            hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()))
    return sorted(out, key=repr)


def tried(spark, rows, **options):
    turns = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit(1)).withColumn("pos", F.lit("mine")).withColumn("x1", F.lit(2))
    return sorted((tuple(r) for r in prefix_trie.trie(turns, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(12)
    rows = []
    for c in list(range(0, 75)) + [200, 203, 207, 211]:
        if c == 40:
            continue  # a family without its head
        for t in range(rng.randint(1, 6)):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]), rng.choice(["hello there", "b", "", None, "c d e"])))
    for c in range(300, 420):  # one conversation many times, some of them cut
        rows += [(c, t, "user", f"turn number {t}") for t in range(1 + c % 3 * 2)]
    rng.shuffle(rows)
    return rows


def test_trie_equals_a_plain_loop(spark, talk):
    rows = talk + [(None, 1, "user", "nobody")]
    want = brute_trie(rows)
    assert tried(spark, rows) == want
    assert tried(spark, rows, piece=7) == want  # end lists in pieces, streamed


def test_trie_of_repeated_turns_and_empty_tables(spark):
    rows = [(20, 0, "u", "a"), (20, 0, "u", "a"), (20, 1, "u", "b c")]
    assert tried(spark, rows) == brute_trie(rows)
    # Nothing of its own, no head: a member of the root alone. h is at least one for it.
    lone = next(c for c in range(61, 80) if zlib.crc32(str(c).encode()) % 4)
    assert tried(spark, [(lone, 0, "u", "gone")]) == brute_trie([(lone, 0, "u", "gone")])
    assert tried(spark, []) == []
