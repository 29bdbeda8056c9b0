import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterlark.llm import gru, order_minhash, packing, queries, site_quality, toxicity

INSULTS = ("dolt", "rotter", "knave")


@pytest.fixture(scope="module")
def corpus(docs_of, prose, spark):
    """Clean, toxic and junk documents; a word or a word beginning makes one toxic, symbols or repeats make one bad."""
    rows, labels = [], []
    for i in range(420):
        words = prose(40 + i % 90, i).split()
        toxic, good = int(i % 4 == 0), int(i % 5 != 0)
        if toxic:
            for n in range(3):
                words[(7 + 11 * n) % len(words)] = INSULTS[(i + n) % 3] if i % 8 else "blurg" + words[n]
        if not good:
            words = [w + "%%%" for w in words] if i % 2 else [words[0]] * len(words)
            if toxic and i % 2 == 0:
                words[3:3] = [INSULTS[0]]
        rows.append((i, " ".join(words), f"src{i % 3}"))
        labels.append((i, good, toxic))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(gru, "F32", np.float64)
    p = {k: v.astype(np.float64) for k, v in gru.new_parameters(6, 5, 4, 3, 1).items()}
    words = gru.WordTable(np.array([1, 2, 3, 0]), np.array([1, 2, 3, 4]), np.array([0, 0, 1, 3]))
    windows, target, weight = np.array([[0, 1, 2, 4], [3, 2, 4, 4]]), np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        q = 1 / (1 + np.exp(-gru.forward(p, words.inputs(p), windows)))
        return -(weight * (target * np.log(q) + (1 - target) * np.log(1 - q))).sum() / weight.sum()

    found = gru.gradients(p, words, windows, target, weight)
    for k, values in p.items():
        flat, rows = values.reshape(-1), found[k].reshape(-1)
        for i in range(values.shape[1] if k in ("word", "gram") else 0, len(flat)):
            kept = flat[i]
            flat[i] = kept + 1e-5
            up = loss()
            flat[i] = kept - 1e-5
            assert rows[i] == pytest.approx((up - loss()) / 2e-5, abs=1e-8)
            flat[i] = kept


def test_windows_cover_every_word():
    texts = ["", "a", " ".join(["w"] * 31), " ".join(f"w{i}" for i in range(100)), "..."]
    words = toxicity.split_words(texts)
    windows, owner = toxicity.windows_of(words, len(words.hashes))
    sizes = np.diff(words.place)
    assert sizes.tolist() == [0, 1, 31, 100, 0]
    for t, n in enumerate(sizes):
        own = windows[owner == t]
        assert len(own) == max(1, -(-(n - 32) // 16) + 1)
        seen = {int(w) for w in own.reshape(-1)} - {len(words.hashes)}
        assert seen == set(words.token[words.place[t] : words.place[t + 1]].tolist())
    joined = toxicity.split_sample(texts)
    assert (joined.hashes == words.hashes).all() and (joined.token == words.token).all() and (joined.place == words.place).all()
    assert (joined.grams == words.grams).all() and (joined.owner == words.owner).all()


def test_toxicity_is_learnt_from_the_other_folds_only(corpus, prose):
    docs, labels, rows, truth = corpus
    wrong = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.toxicity(docs.withColumn("score", F.lit("x")), labels).toPandas().set_index("doc_id")
    b = toxicity.toxicity(docs.drop("lang"), wrong).toPandas().set_index("doc_id")
    assert (a["score"] == b["score"].loc[a.index]).all()
    assert all(a["held_out"][i] == held_out(i) for i in a.index)
    y = pd.Series({i: t for i, _, t in truth})
    held = a[a["held_out"]]
    assert ((held["predicted"] == 1) == (y[held.index] == 1)).mean() > 0.85  # 84 toxic documents to learn from
    assert ((a["score"] >= 0.5) == (a["predicted"] == 1)).all() and a["score"].between(0, 1).all()


def test_toxicity_of_odd_rows(corpus, docs_of, prose, spark):
    docs, labels, *_ = corpus
    far = prose(3000, 5) + " dolt knave rotter " + prose(3000, 6)
    odd = docs_of([(9000, None), (9001, ""), (None, "x y"), (9002, far), (9002, far), (9003, prose(6000, 7))])
    found = toxicity.toxicity(docs.unionByName(odd), labels.unionByName(labels.limit(3))).toPandas()
    assert len(found) == 426
    scores = found.set_index("doc_id")["score"]
    assert scores[9000] == scores[9001] and (scores[9002] > 0.5).all() and scores[9003] < 0.5
    assert not found[found["doc_id"].isna()]["held_out"].any()
    assert toxicity.toxicity(docs, labels.filter("toxic = 0")).agg(F.max("score")).first()[0] == 0
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_quality_is_learnt_and_shrunk(corpus, docs_of):
    docs, labels, rows, truth = corpus
    odd = docs_of([(9000, None, None), (9001, "", "lonely"), (None, "x y")])
    found = site_quality.quality(docs.unionByName(odd).withColumns({"host": F.lit(1), "path": F.lit(2)}), labels).toPandas()
    assert len(found) == 423 and found["score"].between(0, 1).all() and ((found["score"] >= 0.5) == found["keep"]).all()
    y = pd.Series({i: g for i, g, _ in truth})
    held = found[found["held_out"]].dropna().set_index("doc_id")
    held = held[held.index < 9000]
    assert (held["keep"] == (y[held.index] == 1)).mean() > 0.95
    assert site_quality.quality(docs, labels.filter("quality = 1")).filter("keep").count() == 420
    assert site_quality.quality(docs.limit(0), labels.limit(0)).count() == 0


def test_sites_shrink_towards_host_and_whole(spark):
    """Sparse sites stay near their prior, large ones near their own mean, by the formula of a plain loop."""
    rng, rows, n = np.random.default_rng(0), [], 0
    for h in range(30):
        share = rng.beta(4, 2)
        for p in range(3):
            for _ in range(1 if h % 10 == 0 else 60):
                rows.append((n, f"h{h}", f"p{p}" if n % 7 else None, False, 4.0 if rng.random() < share else -4.0))
                n += 1
    df = spark.createDataFrame(rows, site_quality.EVIDENCE)
    found = site_quality.combine(df, 0.6).toPandas()
    text = 1 / (1 + np.exp(-(found["evidence"] + np.log(0.6 / 0.4))))
    assert np.allclose(found["text_score"], text)
    # The other documents of the whole, the host and the path, by a plain loop over what the method defines.
    n = len(found)
    found["others"] = (text.sum() + 0.6 - text) / n

    def moments(groups):
        """How many documents a prior is worth, from (documents, mean, prior) of each group."""
        big = [g for g in groups if g[0] > 1]
        chance = sum(q * (1 - q) for _, _, q in big)
        excess = sum(k * (m - q) ** 2 for k, m, q in big) - chance
        if excess <= 0:  # no spread beyond chance: the prior is as strong as it may be
            return site_quality.MOST_STRENGTH
        return min(max((sum(k * q * (1 - q) for k, _, q in big) - chance) / excess - 1, site_quality.LEAST_STRENGTH), site_quality.MOST_STRENGTH)

    overall = (text.sum() + 0.6) / (n + 1)
    hosts = {h: (len(g), g.mean()) for h, g in text.groupby(found["host"])}
    paths = {s: (len(g), g.mean()) for s, g in text.groupby([found["host"], found["path"]])}
    host_pull = moments([(k, m, overall) for k, m in hosts.values()])
    path_pull = moments([(k, m, (hosts[s[0]][0] * hosts[s[0]][1] + host_pull * overall) / (hosts[s[0]][0] + host_pull)) for s, (k, m) in paths.items()])
    assert 1 < host_pull < 50
    for i, row in found.iterrows():
        (hn, hm), (pn, pm) = hosts[row["host"]], paths[row["host"], row["path"]]
        host = (hn * hm - text[i] + host_pull * row["others"]) / (hn - 1 + host_pull)
        path = (pn * pm - text[i] + path_pull * host) / (pn - 1 + path_pull)
        odds = row["evidence"] + np.log(path / (1 - path))
        assert np.allclose([row["host_share"], row["path_share"], row["score"]], [host, path, 1 / (1 + np.exp(-odds))], rtol=1e-6)
    assert (found["path"] == "").any()
    # Without spread between sites the prior rules.
    same = spark.createDataFrame([(i, f"h{i % 40}", "p", False, 4.0 if i % 3 else -4.0) for i in range(4800)], site_quality.EVIDENCE)
    assert site_quality.combine(same, 0.5).agg(F.max("host_share") - F.min("host_share")).first()[0] < 1e-3


def test_a_document_alone_on_its_site_is_no_evidence_for_itself(spark):
    """Turning one document's evidence changes the shares of its sites for the others, never for itself."""
    rows = [(i, "big", "p", False, 3.0 if i % 2 else -3.0) for i in range(100)] + [(100, "alone", "p", False, 3.0), (101, "big", "own", False, 3.0)]
    turned = [(*r[:4], -r[4]) if r[0] >= 100 else r for r in rows]

    def shares(data):
        return site_quality.combine(spark.createDataFrame(data, site_quality.EVIDENCE), 0.5).toPandas().set_index("doc_id").sort_index()

    a, b = shares(rows), shares(turned)
    # The strengths are fitted to all sites, single documents of hosts left out; the other one of the two moves the whole by 1 %.
    assert abs(a["path_share"][100] - b["path_share"][100]) < 0.02 and abs(a["path_share"][101] - b["path_share"][101]) < 0.02
    assert a["score"][100] > 0.8 and b["score"][100] < 0.2
    one = shares([(7, "h", "p", False, 2.0)])
    assert np.allclose(one["path_share"][7], 0.5)  # nothing else is known but the share it was given
    hot = [(i, "hot" if i % 3 == 0 else f"h{i % 97}", f"p{i % 5}", False, float(i % 7 - 3)) for i in range(3000)]
    assert len(shares(hot)) == 3000


def test_the_pipeline_equals_its_stages_by_brute_force(corpus, docs_of, prose, spark, tmp_path):
    docs, labels, rows, truth = corpus
    more = [(1000 + i, f"the line that they all repeat\n{prose(30, 5000 + i)}", "src0") for i in range(20)]
    more += [(2000 + i, rows[i * 4 + 1][1] + " end", "src1") for i in range(10)] + [(3000, None, "src2"), (3001, "", "src2")]
    docs.unionByName(docs_of(more)).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now, seen = queries.documents(spark, str(tmp_path)), {}
    for name, function in corpus_pipeline.STAGES:
        columns = now.columns
        out = function(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}.parquet")
        seen[name] = now = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        assert now.columns == columns or name == "packing"
    frames = {k: v.toPandas() for k, v in seen.items()}
    start = {i: t or "" for i, t, *_ in rows + more}
    y = {i: t for i, _, t in truth}
    clean = set(frames["toxicity"]["doc_id"])
    assert sum(y.get(i, 0) for i in clean) < 12 and sum(1 - y.get(i, 0) for i in start if i not in clean) < 12
    first = min(i for i in clean if 1000 <= i < 1020)
    lines = frames["line_dedup"].set_index("doc_id")
    assert set(lines.index) == clean
    for i in clean:
        if 1000 <= i < 1020 and i != first:
            assert lines["text"][i] == start[i].split("\n")[1] and lines["n_chars"][i] == len(lines["text"][i])
    ids = sorted(clean)
    s = {i: order_minhash.shingles(order_minhash.Buffer([lines["text"][i] or ""]).word_hashes()[0], order_minhash.WORDS) for i in ids}
    group = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if order_minhash.similarity(s[i], s[j]) >= 0.8 or not len(s[i]) and not len(s[j]):
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    near = frames["near_duplicates"]
    assert sorted(near["doc_id"]) == sorted(set(group.values()))
    mixed = frames["mixing"]
    assert set(mixed["doc_id"]) == set(near["doc_id"]) and len(mixed) >= len(near)
    pieces = frames["packing"]
    slow = packing.Encoder(queries.public_bpe()[0])
    assert pieces["length"].sum() == sum(len(slow(t or "")) + 1 for t in mixed["text"])
    assert pieces.groupby("sequence_id")["length"].sum().max() <= packing.CAPACITY
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == list(frames)


def test_sql_of_the_queries_that_have_one(spark):
    import duckdb

    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for name in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name, sql in queries.ORACLES.items():
        df, found = queries.QUERIES[name](spark, sf), con.execute(sql)
        names = [c[0] for c in found.description]
        assert sorted(map(repr, df.select(*names).collect())) != [] and df.columns == names
        assert sorted(tuple(r) for r in df.collect()) == sorted(found.fetchall())
