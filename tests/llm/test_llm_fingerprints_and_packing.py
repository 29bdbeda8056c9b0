import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlark.llm import fingerprints, packing, queries

TEXTS = ["", None, "a", "one paragraph of some words", "first line\nsecond line is longer\nthird", "third\nfirst line\nsecond line is longer", "é😀" * 20, "\n\n"]


def followers(rows):
    ordered = sorted(((i is None, i or 0, t or "") for i, t in rows))
    return [(None if none else i, t, ordered[(n + 1) % len(ordered)][2]) for n, (none, i, t) in enumerate(ordered)]


@pytest.mark.parametrize("rows_per_range", [3, 1000])
def test_edited_texts_equal_a_plain_loop(docs_of, prose, monkeypatch, rows_per_range):
    monkeypatch.setattr(fingerprints.ranges, "__defaults__", (rows_per_range,))
    rows = [(10 * i, t) for i, t in enumerate(TEXTS)] + [(100 + i, prose(30, i, " " if i % 3 else "\n")) for i in range(20)]
    rows += [(500, prose(60_000, 1)), (None, "without id"), (100, "same id")]
    out = fingerprints.compare_with_next(docs_of(rows).withColumn("range", F.lit(1)).withColumn("guest", F.lit(1))).collect()
    expected = sorted(((i, len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest()) for i, t, n in followers(rows)), key=repr)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out), key=repr) == expected
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    prints = {}
    for r in out:
        for i, t in rows:
            if i == r["doc_id"] and len(t or "") == r["n_chars"]:
                prints[t or ""] = r["fingerprint"]
    assert prints[TEXTS[4]] == prints[TEXTS[5]]  # the order of paragraphs does not count
    assert len(set(prints.values())) == len(prints) - 1


def test_one_document_and_none(docs_of):
    (row,) = fingerprints.compare_with_next(docs_of([(4, "abcdef")])).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()
    assert fingerprints.compare_with_next(docs_of([])).count() == 0


def test_sums_insert_and_delete_paragraphs():
    whole = fingerprints.fingerprints(["one two three four\nfive six\nseven"])
    parts = fingerprints.fingerprints(["one two three four", "five six", "seven"])
    assert (parts[0].sum(axis=0, dtype=np.uint64) == whole[0][0]).all() and (parts[1].sum(axis=0) == whole[1][0]).all()
    again = fingerprints.fingerprints(["seven\none two three four"])
    assert (whole[0][0] - parts[0][1] == again[0][0]).all() and (whole[1][0] - parts[1][1] == again[1][0]).all()
    import pandas as pd

    read = fingerprints.read(pd.Series(fingerprints.written(whole)))
    assert (read[0] == whole[0]).all() and (read[1] == whole[1]).all()


def test_likeness_follows_shared_text(prose):
    a, b = prose(400, 1), prose(400, 2)
    half = a[: len(a) // 2] + b[: len(b) // 2]
    near = fingerprints.likeness(fingerprints.fingerprints([a, a, a]), fingerprints.fingerprints([a, half, b]))
    assert near[0] == 1 and 0.3 < near[1] < 0.7 and near[2] < 0.25


def test_lanes_hold_the_counts_of_a_text_of_equal_words(prose):
    text = "log " * 100_000
    prints = [fingerprints.fingerprints([t]) for t in (text, text[: len(text) // 2] + prose(50, 1), prose(400, 2))]
    assert np.abs(prints[0][1]).max() == 99_998
    assert fingerprints.likeness(prints[0], prints[1])[0] > 0.99 and fingerprints.likeness(prints[0], prints[2])[0] < 0.25
    import pandas as pd

    assert (fingerprints.read(pd.Series(fingerprints.written(prints[0])))[1] == prints[0][1]).all()


TOKENIZER = queries.public_bpe()


def check_packing(rows, out, capacity):
    """Every id in exactly one piece, no sequence overfull, offsets without gaps."""
    slow = packing.Encoder(TOKENIZER[0])
    expected, got = [], {}
    for i, t in rows:
        ids = np.array([*slow(t or ""), 1], dtype="<u4")
        expected.append((i, len(ids), zlib.crc32(ids.tobytes())))
    for r in out:
        got.setdefault((r["sequence_id"]), []).append(r)
    for pieces in got.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
    assert sum(r["length"] for r in out) == sum(n for _, n, _ in expected)
    for i, t in rows:
        ids = np.array([*slow(t or ""), 1], dtype="<u4")
        if [x for x, _ in rows].count(i) == 1:
            own = sorted((r for r in out if r["doc_id"] == i), key=lambda r: r["start"])
            at = 0
            for r in own:
                assert r["start"] == at and r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
                at += r["length"]
            assert at == len(ids)
    return sum(r["length"] for r in out) / (capacity * len(got))


def test_packing_is_whole_and_tight(docs_of, prose, monkeypatch):
    monkeypatch.setattr(packing, "MERGED", 2)
    rows = [(i, prose(5 + 37 * (i % 29), i)) for i in range(160)]
    rows += [(900, None), (901, ""), (902, "say <|endoftext|> aloud"), (903, prose(20_000, 5)), (904, "é😀\n\n  x"), (5, "same id"), (None, "no id"), (7, rows[7][1])]
    docs = docs_of(rows).withColumn("length", F.lit("x")).withColumn("class", F.lit("x")).repartition(7)
    out = packing.pack(docs, TOKENIZER, capacity=256).collect()
    assert check_packing(rows, out, 256) > 0.9
    assert packing.pack(docs_of([]), TOKENIZER).count() == 0


def test_fast_ids_equal_the_tokenizers():
    fast, slow = packing.Encoder(*TOKENIZER), packing.Encoder(TOKENIZER[0])
    for text in ("", "It's  a\ttest\n\n of 123½²x __ ünïcödé 漢字 😀", "  lead", "a" * 3000, "x<|endoftext|>y", "    'll 'S"):
        assert list(fast(text)) == list(slow(text))


@pytest.mark.parametrize("tokens", [1, 31, 32, 33, 682, 683, 1025, 2047, 2048, 2049, 5000, 100_003])
def test_cuts_waste_little(tokens):
    pieces = packing.cuts(tokens)
    assert sum(pieces) == tokens and max(pieces) <= 2048
    waste = sum(2048 / (2048 // p) - p for p in pieces)
    assert waste <= 0.03 * tokens + 34
