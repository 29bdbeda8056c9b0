"""Secret scans with multipart credential linking, as column functions and joins only.

Strong patterns are reported wherever they match. Weaker ones (account names, short assigned values, long
base64 runs, endpoints) are common in clean text and are reported only where the complementary part of a
credential stands within reach: an identifier or an endpoint beside a secret, an endpoint beside an identifier with a secret.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterlark.session import stage

# The patterns of the strong kinds, in the order in which they are listed. The group and the
# length (code points) a match must have; a shorter match is dropped, and the search goes on behind it.
STRONG = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Weak parts of a credential: what it is, its pattern, group and least length. Every kind's name sorts after the
# strong kinds at the same start by WEAK_RANK.
WEAK = (
    ("name", r"""(?i)(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""", 1, 3),
    ("value", r"""(?i)(?:pass|pwd|pin|private_?key|credential)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 4),
    ("blob", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])", 0, 40),
    ("endpoint", r"""(?i)(?:https?|ftp|s3|jdbc:[a-z]{1,16}|mongodb|postgres(?:ql)?|mysql|redis|amqp)://[^\s"'<>]+""", 0, 10),
    ("host", r"""(?i)(?:host(?:name)?|server|endpoint)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.:_-]+)""", 1, 4),
)
ROLES = {
    "access": "identifier", "name": "identifier", "assign": "secret", "hex": "secret", "value": "secret",
    "blob": "secret", "endpoint": "endpoint", "host": "endpoint",
}
RANK = {kind: i for i, (kind, *_) in enumerate(STRONG + WEAK)}
# Parts of one credential lie at most this many code points apart.
REACH = 200
# Matches of a text whose places are added up in one array; more go into further blocks, so a text of only matches stays cheap.
BLOCK = 256

SPAN = "struct<kind string, start long, end long>"


def spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of the leftmost non-overlapping matches whose group is long enough, in code points, end exclusive.

    What lies between two matches and the matches themselves alternate, so their lengths give the places. The
    text is searched for a first match before anything is built.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    steps = F.filter(F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(found, F.length).alias("size"),
        F.transform(held, F.length).alias("held"),
    ), lambda s: s["size"].isNotNull())
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    zero = F.lit(0).cast("long")

    def block(some: Column, at: Column) -> Column:
        """The spans of a block of matches that begins behind ``at`` code points."""
        return F.aggregate(
            some,
            F.struct(at.alias("at"), none.alias("out")),
            lambda acc, s: F.struct(
                (acc["at"] + s["gap"] + s["size"]).alias("at"),
                F.when(
                    s["held"] >= least,
                    F.concat(acc["out"], F.array(F.struct(
                        F.lit(kind).alias("kind"), (acc["at"] + s["gap"]).cast("long").alias("start"),
                        (acc["at"] + s["gap"] + s["size"]).cast("long").alias("end"),
                    ).cast(SPAN))),
                ).otherwise(acc["out"]).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    def part(every: Column, n: Column) -> Column:
        return F.slice(every, n * BLOCK + 1, F.lit(BLOCK))

    def walked(every: Column) -> Column:
        """Blocks know how long those before them are, so an array grows within its block only."""
        numbers = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int"))
        sizes = F.transform(numbers, lambda n: F.aggregate(part(every, n), zero, lambda sum_, s: sum_ + s["gap"] + s["size"]))
        return F.transform(F.array(sizes), lambda known: F.flatten(F.transform(
            numbers, lambda n: block(part(every, n), F.aggregate(F.slice(known, F.lit(1), n), zero, lambda sum_, s: sum_ + s)))))[0]

    return F.when(text.rlike(pattern), F.transform(F.array(steps), walked)[0]).otherwise(none)


def ranked(span: Column) -> Column:
    """A span with the place of its kind in the listing."""
    rank = F.create_map(*[F.lit(x) for pair in RANK.items() for x in pair])
    return F.struct(
        span["start"].alias("start"), rank[span["kind"]].alias("rank"), span["end"].alias("end"), span["kind"].alias("kind")
    )


def listing(all_spans: Column) -> Column:
    """kind:start:end, comma-joined, by start, then kind as listed."""
    ordered = F.array_sort(F.transform(all_spans, ranked))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def found_parts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base, weak: the spans of every document; the only pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(*[spans(text, *p) for p in STRONG])
    weak = F.concat(*[spans(text, *p) for p in WEAK])
    return docs.select("doc_id", F.xxhash64(text).alias("text_key"), base.alias("base"), weak.alias("weak"))


def linked_spans(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, text_key, linked: the weak spans of each document that complementary parts confirm.

    ``parts``: doc_id, text_key, base and weak. The scope of a credential is its document. An interval join on cells of the
    reach: a part stands in every cell it touches, and the other in every cell its widened interval touches, so a pair within reach
    meets in one cell or more, and only near parts of a document are paired. Only documents that hold a secret and another role are joined.
    """
    every = F.concat("base", "weak")
    role_of = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    roles = F.transform(every, lambda s: role_of[s["kind"]])
    both = F.array_contains(roles, "secret") & (F.array_contains(roles, "identifier") | F.array_contains(roles, "endpoint"))
    part = (
        parts.filter((F.size("weak") > 0) & both).select("doc_id", "text_key", every.alias("spans")).distinct()
        .select("doc_id", "text_key", F.explode("spans").alias("s"))
        .select("doc_id", "text_key", "s.*", role_of[F.col("s.kind")].alias("role"))
    )

    def near(points: DataFrame, others: DataFrame, same: tuple = ("doc_id", "text_key")) -> DataFrame:
        """Pairs (left columns, right as ``o_*``) whose intervals lie within reach of each other."""
        a = points.withColumn("cell", F.floor(F.col("start") / reach))
        b = others.select(*[F.col(c).alias(f"o_{c}") for c in others.columns])
        b = b.withColumn("o_cell", F.explode(F.sequence(
            F.floor((F.col("o_start") - reach) / reach) - 1, F.floor((F.col("o_end") + reach) / reach))))
        # The left's start may lie up to its own length before the reach; long parts therefore stand in all their cells.
        a = a.withColumn("cell", F.explode(F.sequence(F.col("cell"), F.floor(F.col("end") / reach))))
        on = F.col("cell") == F.col("o_cell")
        for c in same:
            on = on & F.col(c).eqNullSafe(F.col(f"o_{c}"))
        within = (F.col("start") <= F.col("o_end") + reach) & (F.col("o_start") <= F.col("end") + reach)
        apart = (F.col("end") <= F.col("o_start")) | (F.col("o_end") <= F.col("start"))
        return a.join(b, on & within & apart).drop("cell", "o_cell").distinct()

    identifiers, found, endpoints = (part.filter(F.col("role") == r).drop("role") for r in ("identifier", "secret", "endpoint"))
    pairs = near(identifiers, found)
    guarded = near(endpoints, found)
    credential = pairs.select("doc_id", "text_key", F.least("start", "o_start").alias("start"), F.greatest("end", "o_end").alias("end")).distinct()
    ends = near(endpoints, credential)
    columns = ("doc_id", "text_key", "kind", "start", "end")
    linked = (
        pairs.select(*columns)
        .unionByName(pairs.select("doc_id", "text_key", *[F.col(f"o_{c}").alias(c) for c in columns[2:]]))
        .unionByName(ends.select(*columns))
        .unionByName(guarded.select(*columns))
        .unionByName(guarded.select("doc_id", "text_key", *[F.col(f"o_{c}").alias(c) for c in columns[2:]]))
        .filter(~F.col("kind").isin([kind for kind, *_ in STRONG]))
    )
    return linked.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("kind", "start", "end")).cast(f"array<{SPAN}>").alias("linked"))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and linked, arrays of (kind, start, end).

    ``docs`` needs doc_id and text; other columns are ignored whatever their names. A null or empty text has
    no spans. Repeated rows each keep their row and find the same spans; rows that share a doc_id, or have
    none, are told apart by their text. An empty table gives no rows.
    """
    parts = stage(found_parts(docs), "secret-parts")
    linked = linked_spans(parts, reach)
    right = linked.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "linked")
    joined = parts.join(right, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    return joined.select("doc_id", "base", F.coalesce("linked", F.expr(f"cast(array() as array<{SPAN}>)")).alias("linked"))
