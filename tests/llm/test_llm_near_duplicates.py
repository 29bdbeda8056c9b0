import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlark.llm import embedding_dedup, order_minhash
from meterlark.llm.components import connected_components
from meterlark.llm.text import Buffer


def smallest(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 5)]
    edges += [(rng.randint(1000, 1300), rng.randint(1000, 1300)) for _ in range(200)]
    found = connected_components(spark.createDataFrame(edges + edges[:9], "a long, b long")).collect()
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert {r["id"]: r["component"] for r in found} == smallest([e for e in edges if e[0] != e[1]], nodes) and len(found) == len(nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingled(text):
    return order_minhash.shingles(Buffer([text]).word_hashes()[0], order_minhash.WORDS)


def plain_shingles(text):
    words = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    k = min(5, len(words))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if words else []


def plain_similarity(a, b, least=0.8):
    """Longest common subsequence of all shingles over all of them, row by row; without hashes, labels or a band."""
    if not a or not b:
        return 0.0
    bound = sum((Counter(a) & Counter(b)).values())  # never less than what can be matched
    if bound / (len(a) + len(b) - bound) < least:
        return 0.0
    number = {}
    x, y = (np.array([number.setdefault(t, len(number)) for t in ts]) for ts in (a, b))
    row = np.zeros(len(y) + 1, dtype=np.int64)
    for t in x:
        row[1:] = np.maximum.accumulate(np.where(y == t, row[:-1] + 1, row[1:]))
    return row[-1] / (len(a) + len(b) - row[-1])


def edited_copy(text, seed, edits):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def brute_classes(rows):
    texts = {}
    for i, t in rows:
        if i is not None:
            texts.setdefault(i, []).append(t or "")
    ids, pairs = sorted(texts), []
    s = {i: [plain_shingles(t) for t in texts[i]] for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if any(plain_similarity(x, y) >= 0.8 for x in s[i] for y in s[j]):
                pairs.append((i, j))
    return smallest(pairs, ids)


def test_near_duplicates_equal_all_pairs(docs_of, prose, monkeypatch):
    monkeypatch.setattr(order_minhash, "COMPARED", 6)
    rows = [(i, prose(60 + i, i)) for i in range(60)]
    rows += [(100 + i, edited_copy(rows[i][1], i, 1 + i % 4)) for i in range(0, 60, 2)]
    rows += [(300 + i, rows[3][1] + (" tail" if i % 2 else "")) for i in range(20)]  # exact and near copies of one text
    passage = prose(40, 999)
    rows += [(400 + i, passage + " " + prose(50, 400 + i)) for i in range(40)]  # a passage many texts share
    rows += [(500, prose(8000, 77)), (501, edited_copy(prose(8000, 77), 1, 100)), (502, "short text"), (503, "Short  TEXT"), (504, "the " * 300), (505, "the " * 290)]
    rows += [(600, None), (601, ""), (602, " \n "), (603, ""), (None, rows[3][1]), (5, rows[5][1]), (9, rows[11][1])]
    docs = docs_of(rows).withColumns({c: F.lit(1) for c in ("class", "kept", "text_key", "_id", "row", "sketch")})
    found = order_minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    expected = brute_classes([(i, t) for i, t in rows])
    assert {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None} == expected
    assert all(r["kept"] == (r["doc_id"] is None or r["class_id"] == r["doc_id"]) for r in found)
    kept = order_minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted({r["doc_id"] for r in kept.collect() if r["doc_id"] is not None}) == sorted(set(expected.values()))
    assert order_minhash.near_duplicates(docs_of([])).count() == 0


def table_hashes(text):
    return order_minhash.sketch(order_minhash.labelled(shingled(text)))


@pytest.mark.parametrize("block, shingles", [(64, 1 << 20), (512, 40_000)])
def test_pairs_of_a_large_bucket_are_all_compared(docs_of, prose, monkeypatch, block, shingles):
    """Texts that share a long template and are not similar by it, with pairs among them that are: none that shares a table is lost."""
    monkeypatch.setattr(order_minhash, "BLOCK", block, raising=False)
    monkeypatch.setattr(order_minhash, "BLOCK_SHINGLES", shingles, raising=False)
    template, rows = prose(250, 4), []
    for i in range(400):
        own = prose(32, 5000 + i).split()
        rows.append((i, " ".join([template, *own])))
        if i % 5 == 0:
            rows.append((1000 + i, " ".join([template, *own[: 3 + i % 4], prose(29 - i % 4, 9000 + i)])))
    tables = {i: table_hashes(t) for i, t in rows}
    s = {i: shingled(t) for i, t in rows}
    pairs = [(a, b) for a in s for b in s if a < b and (tables[a] == tables[b]).any() and order_minhash.similarity(s[a], s[b]) >= 0.8]
    assert len(pairs) >= 60 and all(b == a + 1000 for a, b in pairs)
    found = order_minhash.near_duplicates(docs_of(rows)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == smallest(pairs, list(s))


def test_a_text_said_several_times_is_another_text(docs_of, prose):
    """All occurrences count: a text and its double are apart, their own near copies are not."""
    rows = [(i, prose(120, 700 + i)) for i in range(40)]
    rows += [(100 + i, " ".join([t] * (2 + i % 6))) for i, t in rows]
    rows += [(200 + i, rows[40 + i][1].replace(" ", " one ", 1)) for i in range(40)]
    rows += [(300, "the " * 5), (301, "the " * 300), (302, "the " * 280), (303, "ha " * 40)]
    expected = brute_classes(rows)
    assert all(expected[100 + i] == 100 + i and expected[200 + i] == 100 + i for i in range(40))
    assert expected[301] == 301 == expected[302] and expected[300] == 300 and expected[303] == 303
    assert {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs_of(rows)).collect()} == expected


def test_alignment_counts_order_and_every_occurrence():
    words = [f"w{i}" for i in range(100)]
    a, moved = shingled(" ".join(words)), shingled(" ".join(words[50:] + words[:50]))
    assert order_minhash.similarity(a, a) == 1 and order_minhash.similarity(a, moved, 0.8) == 0
    assert order_minhash.similarity(a, shingled(" ".join(words[:90])), 0.8) == pytest.approx(86 / 96)
    spam = shingled("the " * 300)
    assert len(np.unique(spam)) == 1 and len(np.unique(order_minhash.labelled(spam))) == len(spam) == 296
    # A block goes from the front: its second occurrence has another number, and is matched all the same.
    block, rest = words[:14], words[14:]
    x, y = " ".join(block + rest + block), " ".join(rest + block)
    want = plain_similarity(plain_shingles(x), plain_shingles(y))
    assert want > 0.8 and order_minhash.similarity(shingled(x), shingled(y)) == pytest.approx(want)


def test_similarity_decides_as_a_plain_alignment():
    rng = random.Random(6)
    for n in range(300):
        base = [rng.choice("abc") if n % 3 else f"v{rng.randrange(30)}" for _ in range(rng.randint(1, 90))]
        other = list(base)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(other) + 1)
            other[at : at + rng.randint(0, 2)] = [rng.choice("abc") for _ in range(rng.randint(0, 2))]
        x, y = " ".join(base), " ".join(other)
        want = plain_similarity(plain_shingles(x), plain_shingles(y))
        got = order_minhash.similarity(shingled(x), shingled(y))
        # The labels may settle that a pair is similar before the best alignment is known.
        assert (got >= 0.8) == (want >= 0.8) and got <= want + 1e-9


def test_recall_of_edited_copies(docs_of, prose):
    """Of pairs at 0.8 or a little more, nine in ten or more are found."""
    rows, near = [], []
    for i in range(300):
        text = prose(150, 40_000 + i)
        copy = edited_copy(text, i, 3)
        rows += [(2 * i, text), (2 * i + 1, copy)]
        if plain_similarity(plain_shingles(text), plain_shingles(copy)) >= 0.8:
            near.append(2 * i + 1)
    found = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs_of(rows)).collect()}
    assert len(near) > 100 and sum(found[i] == i - 1 for i in near) >= 0.95 * len(near)
    assert all(found[2 * i + 1] == 2 * i + 1 for i in range(300) if 2 * i + 1 not in near)


def test_blank_texts_are_one_class_where_asked(docs_of):
    docs = docs_of([(4, ""), (2, None), (3, " \n"), (7, "a word"), (None, "")])
    assert order_minhash.keep_first(docs).count() == 5
    assert sorted(repr(r["doc_id"]) for r in order_minhash.keep_first(docs, one_blank=True).collect()) == ["2", "7", "None"]
    assert order_minhash.keep_first(docs_of([]), one_blank=True).count() == 0


def brute_vectors(rows, least=0.93):
    ok = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float32).astype(float)
            ok.append((i, x / np.linalg.norm(x), label))
    pairs, n = [], [0] * len(rows)
    count = {}
    for p, (i, x, a) in enumerate(ok):
        for j, y, b in ok[:p]:
            if a == b and len(x) == len(y) and x @ y >= least:
                pairs.append((i, j))
                count[i], count[j] = count.get(i, 0) + 1, count.get(j, 0) + 1
    return count, smallest(pairs, {i for i, *_ in rows if i is not None})


@pytest.mark.parametrize("block", [8, 512])
def test_vectors_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(16).tolist(), i % 3) for i in range(90)]
    rows += [(100 + i, (np.array(rows[i % 7][1]) + 0.15 * rng.standard_normal(16)).tolist(), (i % 7) % 3) for i in range(60)]
    rows += [(200 + i, rows[4][1], 1) for i in range(40)]  # a very common vector
    rows += [
        (300, None, 1), (301, [], 1), (302, [0.0] * 16, 1), (303, [float("nan")] + [1.0] * 15, 1), (304, [None] + [1.0] * 15, 1),
        (305, [float("inf")] * 16, 1), (306, rows[4][1], None), (307, rows[4][1][:8], 1), (308, (np.array(rows[4][1]) * 1e30).tolist(), 1), (None, rows[4][1], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("v", "key", "rep", "codes")})
    found = embedding_dedup.dedup_embeddings(df).collect()
    count, component = brute_vectors(rows)
    assert len(found) == len(rows)
    for r in found:
        if r["vec_id"] is None:
            assert r["n_links"] == 0 and r["kept"]
        else:
            assert (r["n_links"], r["component_id"]) == (count.get(r["vec_id"], 0), component[r["vec_id"]])
            assert r["kept"] == (r["vec_id"] == r["component_id"])
    assert embedding_dedup.dedup_embeddings(df.limit(0)).count() == 0


def test_more_vectors_get_more_bits_and_tables():
    (a, s), (b, t) = embedding_dedup.sizes(5_000), embedding_dedup.sizes(5_000_000)
    assert b - a in (9, 10, 11) and t > s
