"""The operators over their whole tables, with production parameters: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterlark.llm import (
    chunk_dedup, compression, embedding_dedup, fingerprints, hard_negatives, line_dedup, mixing, order_minhash, packing, prefix_trie, secrets,
    site_quality, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def public_bpe() -> tuple:
    """The public byte-level BPE of 50,257 ids, and the same vocabulary as ranks."""
    import public_tokenizers as files

    return files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN


@query
def op1_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(documents(spark, sf_dir))


@query
def op2_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"),
        F.array_join("keep_runs", ",").alias("keep_runs"),
    )


ORACLES["op2_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents),
keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
flagged AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > f.first_doc, false) AS dropped
    FROM keyed k LEFT JOIN firsts f ON k.key = f.key AND length(k.key) >= 10),
changes AS (
    SELECT *, CASE WHEN dropped = lag(dropped) OVER (PARTITION BY doc_id ORDER BY pos) THEN 0 ELSE 1 END AS change
    FROM flagged),
runs AS (SELECT *, sum(change) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM changes),
lengths AS (SELECT doc_id, run, bool_or(dropped) AS dropped, count(*) AS n FROM runs GROUP BY doc_id, run),
bitmaps AS (
    SELECT doc_id, CASE WHEN bool_or(dropped AND run = 1) THEN '0,' ELSE '' END
                   || string_agg(CAST(n AS VARCHAR), ',' ORDER BY run) AS keep_runs
    FROM lengths GROUP BY doc_id)
SELECT r.doc_id, count(*) AS n_lines, count_if(dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256,
       any_value(b.keep_runs) AS keep_runs
FROM runs r JOIN bitmaps b ON r.doc_id = b.doc_id GROUP BY r.doc_id
"""


@query
def op3_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


def mixing_sql(documents: str, cover: bool) -> str:
    """Common table expressions ending in ``mix``: every use of every row of ``documents``. Values written out on purpose."""
    most = "max(pow(share, m - 1)) * max(pow(share, 1 - m))" if cover else "max(pow(share, m - 1)) / sum(pow(share, m))"
    most_zero = most.replace("m - 1", "-1").replace("1 - m", "1").replace(", m)", ", 0)")
    budget = "total * s * c" if cover else "CAST(total AS DOUBLE)"
    return rf"""
counted AS (
    SELECT *, coalesce(CAST(source AS VARCHAR), '') AS src,
           CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 6)) AS BIGINT) % 1024 AS block,
           len(regexp_extract_all(coalesce(text, ''), '[^	-
 ]+')) AS n_tokens
    FROM {documents}),
blocks AS (SELECT src, block, sum(n_tokens)::BIGINT AS tokens FROM counted GROUP BY src, block),
sources AS (SELECT src, sum(tokens)::BIGINT AS all_tokens FROM blocks GROUP BY src),
total AS (SELECT sum(all_tokens)::BIGINT AS total FROM sources),
shares AS (SELECT src, all_tokens / CAST(total AS DOUBLE) AS share FROM sources, total WHERE all_tokens > 0),
ends AS (SELECT {most_zero} <= 1.25 AS flat FROM shares),
bisected AS (
    SELECT 0 AS step, CAST(0 AS DOUBLE) AS low, CASE WHEN flat THEN CAST(0 AS DOUBLE) ELSE 1 END AS high FROM ends
    UNION ALL
    SELECT step + 1, CASE WHEN ok THEN low ELSE m END, CASE WHEN ok THEN m ELSE high END
    FROM (SELECT step, low, high, m, (SELECT {most} <= 1.25 FROM shares) AS ok
          FROM (SELECT *, (low + high) / 2 AS m FROM bisected WHERE step < 40))),
exponent AS (SELECT high AS a FROM bisected WHERE step = 40),
norm AS (SELECT any_value(a) AS a, sum(pow(share, a)) AS s, max(pow(share, 1 - a)) AS c FROM shares, exponent),
uses AS (
    SELECT sources.src, round(coalesce(pow(share, a) / s, 0), 9) AS weight, all_tokens, a,
           round(coalesce(pow(share, a) / s * ({budget}) / all_tokens, 1), 9) AS repetition
    FROM sources LEFT JOIN shares ON sources.src = shares.src, norm, total),
dealt AS (
    SELECT blocks.src, blocks.block, tokens, weight, a, floor(repetition) AS whole,
           floor((repetition - floor(repetition)) * all_tokens) AS rest, unnest(range(CAST(floor(repetition) AS BIGINT) + 1)) AS epoch
    FROM blocks JOIN uses ON blocks.src = uses.src),
ranked AS (
    SELECT *, row_number() OVER o AS block_rank, sum(tokens) OVER (o ROWS UNBOUNDED PRECEDING) AS used FROM dealt
    WINDOW o AS (PARTITION BY src, epoch ORDER BY md5('mix:' || src || ':' || epoch || ':' || block), block)),
plan AS (SELECT * FROM ranked WHERE epoch < whole OR (rest > 0 AND used <= rest)),
mix AS (
    SELECT counted.*, plan.epoch, plan.block_rank, plan.weight, plan.a
    FROM counted JOIN plan ON counted.src = plan.src AND counted.block = plan.block)"""


ORACLES["op3_mixing"] = f"""
WITH RECURSIVE {mixing_sql('documents', cover=False)}
SELECT doc_id, src AS source, n_tokens, epoch, block, block_rank, weight, round(a, 9) AS exponent FROM mix
"""


@query
def op4_site_quality(spark, sf_dir):
    return site_quality.quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op5_chunk_dedup(spark, sf_dir):
    return chunk_dedup.repeated_passages(documents(spark, sf_dir))


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op7_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_next(documents(spark, sf_dir))


@query
def op8_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), public_bpe())


@query
def op10_secrets(spark, sf_dir):
    found = secrets.scan(documents(spark, sf_dir))
    counts = [
        F.size(F.expr(f"filter(base, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}")
        for kind, *_ in secrets.STRONG
    ]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listing(F.col("base")), 256).alias("base_sha256"),
        secrets.listing(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"),
    )


@query
def op9_embedding_dedup(spark, sf_dir):
    return embedding_dedup.dedup_embeddings(table(spark, sf_dir, "embeddings"))


@query
def op11_compression_bands(spark, sf_dir):
    return compression.quality_rules(documents(spark, sf_dir))


@query
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


ORACLES["op12_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, CAST(list_inner_product(a.q, o.q) AS BIGINT) AS score
    FROM v a JOIN v o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
     AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


# The checksum of a conversation's decimal number, bit by bit; then every prefix as a list of turns.
ORACLES["op13_prefix_trie"] = """
WITH owned AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
summed AS (
    SELECT *, xor(4294967295, list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce(
            list_concat([xor(crc, byte)], range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 4 AS h
    FROM owned),
rebuilt AS (
    SELECT c.conv_id, list_concat(list_slice(coalesce(b.own, []), 1, c.h), list_slice(c.own, c.h + 1, len(c.own))) AS s
    FROM summed c LEFT JOIN owned b ON b.conv_id = c.conv_id - c.conv_id % 20),
steps AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM rebuilt),
members AS (SELECT conv_id, depth, list_slice(s, 1, depth) AS key, depth = len(s) AS ends FROM steps),
nodes AS (
    SELECT key, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY key),
worded AS (
    SELECT *, list_slice(key, 1, depth - 1) AS parent,
           CASE WHEN depth = 0 THEN 0
                ELSE (n_convs - 1) * len(regexp_extract_all(key[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
    FROM nodes),
children AS (SELECT parent, count(*) AS n FROM worded WHERE depth > 0 GROUP BY parent),
whole AS (SELECT w.*, coalesce(c.n, 0) AS n_children FROM worded w LEFT JOIN children c ON w.key = c.parent),
upward AS (SELECT *, unnest(range(depth + 1)) AS up FROM whole),
sums AS (
    SELECT list_slice(key, 1, up) AS top, count_if(n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM upward GROUP BY top)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM whole w JOIN sums s ON w.key = s.top LEFT JOIN nodes p ON w.depth > 0 AND p.key = w.parent
"""
