"""Document fingerprints: bottom-k sketches of word shingles, in built-in functions only.

A fingerprint is the ``K`` smallest hashes among those of a text's distinct shingles of ``SHINGLE``
words (a text of fewer words, but not none, is one shingle), ascending, ``DIGITS`` hex digits each and
written without separators. With fewer than ``K`` distinct shingles it holds them all. Hashes are the
leading digits of a shingle's MD5, its words joined by spaces; words are those of ``WORD_PATTERN``
after lower-casing A-Z.

Sketches of parts merge: the K smallest of both are the sketch of the whole's shingles. From two
sketches come estimates of resemblance (share of the merged sketch's hashes that both hold) and
containment; from one, how many distinct shingles there are.

The edited text of a document takes the end of its text from the next document. The next of a
document is found by sorting ids alone, in ranges: the successor within the range, or the first id of
the next range that has one. Texts are shuffled by id once, and once more to the document before.

Defined results: null text is empty; a text without words has the empty fingerprint, which is like
another empty one (1) and unlike all others (0). Rows that share an id all go to the same next
document: of the next greater id (a null id comes first; after the last, the first) the text whose
SHA-256 is smallest. Repeated rows give equal rows. An empty table gives none. A long text is held by
its task as an array of its shingles' hashes. Columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import LOWER, UPPER, written

K, SHINGLE, DIGITS = 128, 5, 16
#: Separators of words: whatever ``WORD_PATTERN`` does not take.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


# ----------------------------------------------------------------------------- sketches
def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), _SEPARATORS), "")


def shingle_hashes(text: Column) -> Column:
    """The hashes of a text's shingles, one per place."""
    words = word_array(text)

    def of(ws: Column) -> Column:
        def at(w: Column, i: Column) -> Column:
            parts = [w, *(F.get(ws, i + k) for k in range(1, SHINGLE))]
            return F.substring(F.md5(F.concat_ws(" ", *parts).cast("binary")), 1, DIGITS)

        places = F.greatest(F.size(ws) - (SHINGLE - 1), F.least(F.size(ws), F.lit(1)))
        return F.slice(F.transform(ws, at), 1, places)

    return _let(words, of)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sketch(text: Column) -> Column:
    """A text's sketch as an array of hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text))), 1, K)


def merged(a: Column, b: Column) -> Column:
    """The sketch of two parts' shingles taken together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, K)


def fingerprint(sketch_: Column) -> Column:
    return F.array_join(sketch_, "")


def hashes(fingerprint_: Column) -> Column:
    """A fingerprint's sketch."""
    n = (F.length(fingerprint_) / DIGITS).cast("int")
    return F.transform(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.substring(fingerprint_, i * DIGITS + 1, F.lit(DIGITS)),
    )


def _both(a: Column, b: Column) -> Column:
    """How many hashes of the merged sketch both hold."""
    return F.size(F.array_intersect(F.array_intersect(a, b), merged(a, b)))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of either text that are in both; two empty ones: 1."""
    of = F.size(merged(a, b))
    return F.when(of == 0, F.lit(1.0)).otherwise(_both(a, b).cast("double") / F.greatest(of, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has too, from the hashes of the merged sketch; with
    none of a's among those, a's shingles are too few to tell and the estimate is 0. Empty: 1."""
    own = F.size(F.array_intersect(a, merged(a, b)))
    share = F.when(own == 0, F.lit(0.0)).otherwise(_both(a, b).cast("double") / F.greatest(own, F.lit(1)))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(share)


def distinct_shingles(a: Column) -> Column:
    """Estimated number of distinct shingles: exact below K, else from the K-th hash."""
    last = F.conv(F.substring(F.element_at(a, K), 1, 13), 16, 10).cast("double")
    return F.when(F.size(a) < K, F.size(a).cast("double")).otherwise(
        F.lit(float((K - 1) * 2**52)) / (last + F.lit(1.0))
    )


def merge_parts(parts: DataFrame, key: str, sketch_col: str = "sketch", salts: int = 64) -> DataFrame:
    """One sketch per key from the sketches of its parts. Hot keys are merged in salted groups: a
    hash is counted once per group, and a group passes on its K smallest."""
    rows = parts.select(key, F.explode(sketch_col).alias("_h"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_h"), F.lit(salts))).distinct()

    def smallest(rows: DataFrame, *keys: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))
        return rows.withColumn("_place", place).where(F.col("_place") <= K).drop("_place")

    few = smallest(smallest(salted, key, "_salt"), key)
    sketches = few.groupBy(key).agg(F.sort_array(F.collect_list("_h")).alias(sketch_col))
    every = parts.select(key).distinct()
    joined = every.join(sketches.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "left")
    return joined.select(key, F.coalesce(sketch_col, F.array().cast("array<string>")).alias(sketch_col))


# ----------------------------------------------------------------------------- next documents
def _key(id_: Column) -> Column:
    """An id as text that is never null, for joins that null ids take part in."""
    return F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit(""))


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id) from distinct ``id``: the next greater, after the last the first."""
    # Boundaries are sampled, so what follows reads the written rows only.
    rows = written(ids.repartitionByRange("id").withColumn("range", F.spark_partition_id()), "id-ranges")
    # A row per range: bounded by the shuffle's partitions.
    edges = rows.groupBy("range").agg(F.min(F.struct("id"))["id"].alias("first"))
    following = F.lead(F.struct("first")).over(Window.orderBy("range"))
    very_first = F.min(F.struct("range", "first")).over(Window.partitionBy())
    edges = edges.select("range", following.alias("after"), very_first["first"].alias("very_first"))
    inside = F.lead(F.struct("id")).over(Window.partitionBy("range").orderBy("id"))
    placed = rows.withColumn("inside", inside).join(edges, "range")
    after = F.when(F.col("after").isNull(), F.col("very_first")).otherwise(F.col("after.first"))
    return placed.select("id", F.when(F.col("inside").isNull(), after).otherwise(F.col("inside.id")).alias("next_id"))


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, next_text), a row per document."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text, sha = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.sha2(F.col("text").cast("binary"), 256)
    rows = docs.select(_key(F.col(id_col)).alias("key"), text.alias("text"))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    texts = texts.groupBy("id", sha.alias("sha")).agg(F.count(F.lit(1)).alias("copies"))
    firsts = texts.groupBy("id").agg(F.min(F.struct("sha", "copies")).alias("text")).select("id", "text.*")
    firsts = written(firsts, "first-texts")
    after = next_ids(firsts.select("id")).select(_key(F.col("id")).alias("before"), _key(F.col("next_id")).alias("key"))
    wanted = firsts.select(_key(F.col("id")).alias("key"), "sha", "copies").join(after, "key")
    wanted = written(wanted.select("key", F.col("sha").alias("wanted"), "copies", "before"), "next-texts")
    # No join key, so that this join and the last one share one shuffle of the texts.
    taken = rows.join(wanted, "key").where(F.startswith(sha, F.col("wanted")))
    taken = taken.select(F.col("before").alias("key"), F.col("text").alias("next_text"), "copies")
    # Repeated rows give their text once; all others need no grouping.
    once = taken.where("copies = 1").unionByName(taken.where("copies > 1").dropDuplicates(["key"])).drop("copies")
    id_ = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(id_type).alias("id")
    return rows.join(once, "key").select(id_, "text", "next_text")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last half, rounded down, replaced by as much of ``next_text``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_chars, the edited text's SHA-256, both fingerprints, their likeness, that to
    the next document's, the estimated number of distinct shingles, and the estimated share of
    them that the edited text has."""
    rows = with_next_text(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    own, other, after = F.col("own"), F.col("other"), F.col("after")
    rows = rows.select(
        "id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("other"), sketch(F.col("next_text")).alias("after"),
    )
    return rows.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        fingerprint(own).alias("fingerprint"), fingerprint(other).alias("edited_fingerprint"),
        resemblance(own, other).alias("near_edited"), resemblance(own, after).alias("near_next"),
        distinct_shingles(own).alias("n_shingles"), containment(own, other).alias("in_edited"),
    )
