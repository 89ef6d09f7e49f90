"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal if they are identical after deleting every space and control white space
``[\\x20\\x09-\\x0D]``. Narrow fingerprints are shuffled, not texts:

1. length of the normalised text and a hash of its first ``PREFIX`` characters, counted together:
   rows that share neither with another row are unique at once;
2. of the rest, the SHA-256 of the whole normalised text decides.

The rows that survive the first step, and those that are dropped in the end, are marked where the
texts are read: their keys are broadcast as long as they are at most ``BROADCAST_ROWS`` rows. Beyond
that, all texts are hashed in the scan instead of the survivors only, and ``drop_exact_copies``
takes dropped rows out by a sort-merge join, which moves the texts.

Groups are counted with map-side partial sums and looked up again by a sort-merge join, which
Spark splits where a key is hot; a group of copies is never gathered in one place.

Defined results: null text counts as empty; all empty texts are equal. Null ids are ordinary
rows that lose every tie. Of repeated rows (same id, same text) each gets an output row and at
most one of them is kept. Very long texts are normalised and hashed whole. Extra columns are
neither read nor touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import BROADCAST_ROWS, few, written

#: The deleted characters, in code point order.
SPACES = "\t\n\x0b\x0c\r "
#: Characters of the normalised text that the prefix hash covers.
PREFIX = 256


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACES, "")


def full_hash(norm: Column) -> Column:
    return F.sha2(F.encode(norm, "UTF-8"), 256)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per distinct (id, text): ``copies`` of that row, length, prefix hash, code points."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    norm = normalised(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.char_length(text).alias("points"),
        F.char_length(norm).alias("norm_len"),
        F.xxhash64(F.substring(norm, 1, PREFIX)).alias("prefix"),
    )


def surviving_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key) of rows that share length and prefix hash with another row."""
    rows = written(fingerprints(docs, id_col, text_col), "exact-fingerprints")
    counts = rows.groupBy("norm_len", "prefix").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return written(rows.join(counts, ["norm_len", "prefix"]).select("doc_id", "text_key").distinct(), "exact-survivors")


def row_verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False
) -> DataFrame:
    """Per distinct (doc_id, text_key): copies, keep_id, group_size, is_keeper and sha.

    ``sha`` is null for rows that refinement already proved unique, unless ``hash_all``; then
    every row's hash is computed where its text is read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("_text")
    )
    survivors = surviving_rows(docs, id_col, text_col)
    points, sha = F.char_length("_text").alias("points"), full_hash(normalised(F.col("_text")))

    def marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
        a, b = rows.alias("a"), keys.withColumn("_in", F.lit(True)).alias("b")
        on = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
        on = on & (F.col("a.text_key") == F.col("b.text_key"))
        return a.join(b, on, "left").select("a.*", F.col("_in").isNotNull().alias("survives"))

    if hash_all or not few(survivors, BROADCAST_ROWS):
        # Every text is hashed in the scan; only the hash takes part in the shuffle.
        rows = marked(source.select("doc_id", "text_key", points, sha.alias("sha")), survivors)
        if not hash_all:
            rows = rows.withColumn("sha", F.when(F.col("survives"), F.col("sha")))
    else:
        rows = marked(source, F.broadcast(survivors)).select(
            "doc_id", "text_key", points, "survives", F.when(F.col("survives"), sha).alias("sha")
        )
    # Repeated rows are one row with a count from here on.
    rows = rows.groupBy("doc_id", "text_key", "points", "survives", "sha").agg(
        F.count(F.lit(1)).alias("copies")
    )
    rows = written(rows, "exact-rows")
    alone = rows.where(~F.col("survives")).withColumns(
        {"keep_id": F.col("doc_id"), "group_size": F.col("copies"), "is_keeper": F.lit(True)}
    )
    grouped = _groups(rows.where("survives"))
    names = ["doc_id", "text_key", "copies", "keep_id", "group_size", "is_keeper", "sha"]
    return alone.select(*names).unionByName(grouped.select(*names))


def _groups(rows: DataFrame) -> DataFrame:
    """Adds keep_id, group_size and whether the row is its group's keeper."""
    sizes = rows.groupBy("sha").agg(F.sum("copies").alias("group_size"), F.max("points").alias("_most"))
    longest = rows.join(sizes, "sha").where("points = _most")
    # min() skips nulls, so a null id is kept only if no longest text of the group has an id.
    ids = longest.groupBy("sha").agg(
        F.max("group_size").alias("group_size"),
        F.max("_most").alias("_most"),
        F.min("doc_id").alias("keep_id"),
    )
    # Rows of one id and length can still differ in white space: the smallest key settles it.
    same = longest.select("sha", "doc_id", "text_key").join(ids.select("sha", "keep_id"), "sha")
    keys = same.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    keys = keys.groupBy("sha").agg(F.min("text_key").alias("_keep_key"))
    return rows.join(ids.join(keys, "sha"), "sha").withColumn(
        "is_keeper",
        F.col("doc_id").eqNullSafe(F.col("keep_id"))
        & (F.col("points") == F.col("_most"))
        & (F.col("text_key") == F.col("_keep_key")),
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The kept row of a group has the most code points in its original text, then the smallest
    id. ``text_sha256`` is null for rows proved unique before hashing, unless ``hash_all``.
    """
    rows = row_verdicts(docs, id_col, text_col, hash_all)
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    return rows.select("*", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("is_keeper") & (F.col("_copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all its columns, without the rows that ``exact_dedup`` does not keep. Of
    repeated keeper rows that differ in other columns an arbitrary one stays."""
    verdicts = row_verdicts(docs, id_col, text_col).where("not is_keeper or copies > 1")
    # Most rows are no copies of others and pass where they are read.
    apart = verdicts.select(F.col("doc_id").alias("_kid"), F.col("text_key").alias("_kkey"), "is_keeper")
    apart = written(apart, "exact-apart")
    keys = F.broadcast(apart) if few(apart, BROADCAST_ROWS) else apart
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"))
    on = F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_key") == F.col("_kkey"))
    plain = keyed.join(keys, on, "left_anti").select("_row")
    repeated = keyed.join(keys.where("is_keeper"), on, "left_semi").groupBy("_id", "_key").agg(F.first("_row").alias("_row"))
    return plain.unionByName(repeated.select("_row")).select("_row.*")
