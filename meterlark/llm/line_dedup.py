"""Line deduplication: repeated lines stay only in the first document that holds them.

Lines travel as 128-bit hashes with their place, never as text. Range partitions sorted by document and
position stream the first occurrences; the answer is a run-length compressed bitmap per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SHORTEST_KEY = 10

_BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANK)), _UPPER, _LOWER)


def hashed_lines(docs: DataFrame, shortest: int = SHORTEST_KEY) -> DataFrame:
    """(h1, h2, doc_id, text_key, pos) of every line whose key is long enough."""
    text = whole_text()
    # The hash of the text comes first: beside the lines it would be computed anew for every one of them.
    whole = docs.select("doc_id", F.xxhash64(text).alias("text_key"), lines_of(text).alias("lines"))
    lines = whole.select("doc_id", "text_key", F.posexplode("lines").alias("pos", "line"))
    keyed = lines.select("doc_id", "text_key", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= shortest)
    return keyed.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_key", "pos"
    )


def dropped_lines(lines: DataFrame, tasks: int) -> DataFrame:
    """(doc_id, text_key, pos) of the lines whose key a smaller document holds.

    Twice the same step: hashes are dealt out by range, sorted by document and position, and the first
    document of each hash streams by. First within one of as many groups of documents as there are ranges, so that a line of
    all documents is no more than its share of rows in each; then among the groups' first documents, one per group and hash.
    A null doc_id counts as one document behind all others.
    """
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(tasks)).cast("int"))

    def behind_first(df: DataFrame, *keys: str) -> DataFrame:
        ordered = Window.partitionBy(*keys).orderBy(F.col("doc_id").asc_nulls_last(), "text_key", "pos")
        first = F.first("doc_id").over(ordered)
        return df.repartitionByRange(tasks, *keys).withColumn("later", ~F.col("doc_id").eqNullSafe(first))

    within = behind_first(salted, "h1", "h2", "salt")
    across = behind_first(within.filter(~F.col("later")).drop("later"), "h1", "h2")
    place = ("doc_id", "text_key", "pos")
    return within.filter("later").select(*place).unionByName(across.filter("later").select(*place))


def run_lengths(dropped: Column, total: Column) -> Column:
    """Lengths of alternating runs of kept and dropped lines, the first run being kept (perhaps of length 0).

    Each position is compared with its neighbours by index, so the work is linear in the lines. A value that every step
    looks at is bound once, as the only element of an array.
    """

    def bound(value: Column, then) -> Column:
        return F.transform(F.array(value), then)[0]

    def edges(lines: Column) -> Column:
        """First and last positions of the runs of dropped lines."""
        first = F.filter(lines, lambda p, i: (i == 0) | (F.get(lines, i - 1) != p - 1))
        last = F.filter(lines, lambda p, i: (i == F.size(lines) - 1) | (F.get(lines, i + 1) != p + 1))
        return F.struct(first.alias("first"), last.alias("last"))

    def lengths(e: Column) -> Column:
        pairs = F.transform(e["first"], lambda p, i: F.array(
            p - F.when(i == 0, F.lit(0)).otherwise(F.get(e["last"], i - 1) + 1), F.get(e["last"], i) - p + 1))
        tail = total - F.element_at(e["last"], -1) - 1
        return F.when(tail > 0, F.concat(F.flatten(pairs), F.array(tail))).otherwise(F.flatten(pairs))

    return F.when(F.size(dropped) == 0, F.array(total)).otherwise(bound(dropped, lambda lines: bound(edges(lines), lengths)))


def keep_bitmaps(docs: DataFrame, shortest: int = SHORTEST_KEY, tasks: int | None = None) -> DataFrame:
    """(doc_id, text_key, dropped): the positions to drop of every document that loses lines, ascending.

    ``text_key`` tells rows with the same doc_id (or none) and other texts apart.
    """
    tasks = tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A set: rows that repeat a whole document name each of their lines more than once.
    return dropped_lines(hashed_lines(docs, shortest), tasks).groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set("pos")).alias("dropped")
    )


def dedup_lines(docs: DataFrame, shortest: int = SHORTEST_KEY) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped``, ``keep_runs`` (the bitmap as run lengths) and ``kept_text``.

    ``docs`` needs doc_id and text; other columns pass through, except those with the names of the new
    ones, which are replaced. A null or empty text is one empty line. Of a key's holders the smallest doc_id
    keeps its lines, all of them; rows with the same doc_id are one document. A null doc_id is one document
    behind all others. An empty table gives no rows.
    """
    made = ("n_lines", "n_dropped", "keep_runs", "kept_text")
    # The columns of ``docs`` travel as one, whatever their names.
    carried = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in made])
    maps = keep_bitmaps(docs, shortest).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "dropped")
    joined = docs.select(carried.alias("row"), "doc_id", F.xxhash64(whole_text()).alias("text_key")).join(
        maps.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left"
    )
    text = F.coalesce("row.text", F.lit(""))
    lines = lines_of(text)
    dropped = F.coalesce("dropped", F.expr("cast(array() as array<int>)"))
    # One flag per line, so that each line is looked up once however many are dropped.
    flags = F.flatten(F.transform(F.col("keep_runs"), lambda n, i: F.array_repeat(i % 2 == 0, n)))
    out = joined.select(
        "row", F.size(lines).cast("long").alias("n_lines"), F.size(dropped).cast("long").alias("n_dropped"),
        run_lengths(dropped, F.size(lines)).alias("keep_runs"),
    )
    kept = F.when(F.col("n_dropped") == 0, text).otherwise(
        F.transform(F.array(flags), lambda f: F.array_join(F.filter(lines, lambda _, i: F.get(f, i)), "\n"))[0])
    return out.withColumn("kept_text", kept).select("row.*", *made)
