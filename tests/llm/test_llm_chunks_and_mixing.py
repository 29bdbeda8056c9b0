import random

import duckdb
import pytest
from pyspark.sql import functions as F

from meterlark.llm import chunk_dedup, mixing, queries


def brute_repeats(rows, words):
    """Documents with ``words`` consecutive words that a smaller document holds."""
    seen, out = {}, set()
    for i, t in sorted(rows):
        own = (t or "").split()
        for a in range(len(own) - words + 1):
            first = seen.setdefault(tuple(own[a : a + words]), i)
            if first != i:
                out.add(i)
    return out


def test_every_long_passage_is_found_and_nothing_else(docs_of, prose):
    rng = random.Random(4)
    passages = [prose(52, 1000 + i) for i in range(12)]
    rows = []
    for i in range(120):
        own = prose(rng.randint(20, 300), i).split()
        if i % 3 == 0:
            at = rng.randrange(len(own))
            own[at:at] = passages[rng.randrange(12)].split()
        rows.append((i, " ".join(own)))
    rows += [(500, "la " * 400), (501, "x " + "la " * 400), (502, prose(40_000, 9)), (503, "Title " + prose(40_000, 9)), (504, None), (505, ""), (506, "licence line of a few words only"), (507, "licence line of a few words only")]
    docs = docs_of(rows + [(None, passages[0]), (3, rows[3][1]), (502, "another text of the same id")])
    found = chunk_dedup.repeated_passages(docs.withColumns({c: F.lit(1) for c in ("start", "end", "place", "h1")}))
    got = found.collect()
    flagged = {r["doc_id"] for r in got}
    assert brute_repeats(rows, 50) <= flagged <= brute_repeats(rows, 15)
    texts = dict(rows)
    for r in got:
        assert 0 <= r["start"] < r["end"] <= len(texts[r["doc_id"]]) and r["first_doc_id"] < r["doc_id"]
    kept = {r["doc_id"]: r["text"] for r in chunk_dedup.without_passages(docs_of(rows), found).collect()}
    for i, t in rows:
        cut = sorted((r["start"], r["end"]) for r in got if r["doc_id"] == i)
        expected, at = "", 0
        for a, b in cut:
            expected, at = expected + (t or "")[at:a], b
        assert (kept[i] or "") == expected + (t or "")[at:]
    assert chunk_dedup.repeated_passages(docs_of([])).count() == 0


def test_places_are_code_points(docs_of, prose):
    passage = prose(60, 5).replace("a", "é😀")
    text = "ü" * 33 + " " + passage
    (r,) = chunk_dedup.repeated_passages(docs_of([(1, passage), (2, text)])).collect()
    assert text[r["start"] : r["end"]] in passage and r["end"] - r["start"] > 0.5 * len(passage)


def test_short_words_and_texts_without_blanks_are_found_to_their_ends(docs_of):
    rng = random.Random(8)

    def short(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 4))) for _ in range(n))

    def unblanked(n):
        return "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n))

    rows, truth = [], {}
    for i in range(300):
        passage = short(51) if i % 3 else unblanked(200)
        for at in (2 * i, 2 * i + 1):
            before, behind = (short(20), short(20)) if i % 3 else (unblanked(50), unblanked(50))
            # Letters that differ at both ends, so that the passage's ends are its own.
            rows.append((at, f"{before}{'XY'[at % 2]} {passage} {'VW'[at % 2]}{behind}"))
        truth[2 * i + 1] = (f" {passage} ", 51 if i % 3 else 33)
    texts = dict(rows)
    found = {r["doc_id"]: r for r in chunk_dedup.repeated_passages(docs_of(rows)).collect()}
    assert set(found) == set(truth)
    for i, r in found.items():
        assert (texts[i][r["start"] : r["end"]], r["n_words"]) == truth[i] and r["first_doc_id"] == i - 1


def test_ends_are_the_same_however_little_is_compared_at_first(docs_of, prose, monkeypatch):
    passage = prose(80, 41)
    rows = [(2 * i + k, f"{prose(20, 100 + i)}{'XY'[k]} {passage[i * 7 :]} {'VW'[k]}{prose(20, 200 + i + k)}") for i in range(12) for k in (0, 1)]
    rows += [(90, "la " * 300), (91, "no " + "la " * 300), (92, "la " * 299 + "end of it"), (93, prose(300, 7)), (94, prose(300, 7) + " more")]
    docs = docs_of(rows)
    want = sorted(map(tuple, chunk_dedup.repeated_passages(docs).collect()))
    assert {r[0] for r in want} >= {2 * i + 1 for i in range(12)} | {91, 92, 94}
    monkeypatch.setattr(chunk_dedup, "BEFORE", 3)
    monkeypatch.setattr(chunk_dedup, "BEHIND", 2)
    assert sorted(map(tuple, chunk_dedup.repeated_passages(docs).collect())) == want


def test_an_insertion_moves_only_the_cuts_beside_it(prose):
    text = prose(2000, 3)
    a = chunk_dedup.chunks_of([text])
    b = chunk_dedup.chunks_of([text[:5000] + " inserted" + text[5000:]])
    assert len(set(a[4]) - set(b[4])) <= 4
    sizes = a[2] - a[1]
    assert sizes[:-1].min() >= chunk_dedup.SHORTEST and sizes.max() <= chunk_dedup.LONGEST and (a[1][1:] == a[2][:-1]).all()


def mixed_by_duckdb(rows, cover):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, 'en', ?, 0)", rows)
    sql = f"WITH RECURSIVE {queries.mixing_sql('documents', cover)} SELECT doc_id, src, n_tokens, epoch, block, block_rank, weight FROM mix"
    return sorted(con.execute(sql).fetchall(), key=repr)


@pytest.mark.parametrize("cover", [False, True])
def test_mix_equals_its_sql_with_a_hot_source(docs_of, prose, cover):
    rng = random.Random(2)
    rows = [(i, prose(rng.randint(0, 40), i), rng.choice(["big"] * 12 + ["b", "c", "d d", "é"])) for i in range(600)]
    rows += [(700, None, "b"), (701, "", "c"), (702, "", "only empty"), (None, "one two", "big"), (None, "one two", "big"), (5, *rows[5][1:]), (703, "x y z", None), (704, prose(9000, 3), "big")]
    target = mixing.Target(repetition=1.25, cover=cover)
    docs = docs_of(rows).withColumns({c: F.lit(1) for c in ("epoch", "block", "_block", "row", "weight")})
    got = mixing.mix(docs, target)
    assert sorted((tuple(r)[:7] for r in got.collect()), key=repr) == mixed_by_duckdb(rows, cover)
    uses = got.groupBy("source").agg(F.sum("n_tokens").alias("used")).join(
        docs_of(rows).groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.sum(mixing.token_count(F.col("text"))).alias("held")), "source")
    shares = {r["source"]: r["used"] / r["held"] for r in uses.collect() if r["held"]}
    assert max(shares.values()) <= 1.26 and (not cover or min(shares.values()) >= 1)
    out = mixing.mixed(docs, target)
    assert out.columns == docs.columns and out.count() == got.count()
    if cover:
        assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_target_entropy_is_met(docs_of, prose):
    rows = [(i, prose(10, i), "big" if i % 10 else f"s{i % 30}") for i in range(900)]
    plan = mixing.mixing_plan(mixing.document_tokens(docs_of(rows)).drop("doc_id"), mixing.Target(entropy=1.2))
    weights = [r["weight"] for r in plan.select("source", "weight").distinct().collect()]
    import math

    assert -sum(w * math.log(w) for w in weights) == pytest.approx(1.2, abs=1e-6)
    assert mixing.mix(docs_of([])).count() == 0
