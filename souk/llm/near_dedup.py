"""Near-duplicate classes by DartMinHash signatures, banding and exact verification.

Two documents are linked if the weighted Jaccard similarity of their five-word shingles
(weights: how often each occurs) is at least ``SIMILARITY``; classes are the connected
components of the links.

Signature. Every shingle of weight w owns the unit regions 1..w ("cells"). Darts hit a cell at
the arrival times of a unit-rate Poisson process that is a hash of the cell; each dart has a
hashed coordinate. A signature keeps the earliest dart of each of ``K`` coordinates. About
K ln K + 2K darts are enumerated per document (those earlier than that number divided by the
document's weight); a document with an empty coordinate is thrown again up to twice the time.
Two signatures agree in a coordinate with probability equal to the weighted Jaccard similarity.

Joining. Equal word sequences are one node, known by the key (of id and text) of the document that
stands for them. Nodes sharing a band of ``ROWS`` coordinates meet in
a bucket. Large buckets are never expanded into pairs. A bucket's smallest document, its pivot, is
compared with the others, and verified links merge classes. In buckets that still hold several
classes, a prefix filter on what documents have beside the pivot (see ``_beside_pivots``) makes
new buckets of those that can still be linked. They are worked off with further pivots until the
pairs of different classes left are no more than ``REST`` times the first buckets' rows; those
are compared outright. So every pair of nodes that share a bucket is compared, already in one
class, or proved less similar.

A pair at similarity 0.8 shares none of the ``BANDS`` bands with probability 6e-5; more similar
ones with less.

Defined results: documents without words (null, empty) are alone. A document of one to four
words is one shingle. Repeated rows are copies of each other. An id may name several texts; each is
a document of its own, and within a class the smallest id stays (of several texts of that id, the
one whose key is smallest). Classes of different texts of one id share its number but not their
members. Rows with a null id take no part: class null, kept. Extra columns are not touched. Very
long texts are compared whole; a task holds one cell of eight bytes per word.
"""

from __future__ import annotations

import hashlib
import math
from array import array

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import few, map_rows, text_udf, words, written
from souk.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 6, 32
K = ROWS * BANDS
#: Darts per document.
DARTS = math.ceil(K * math.log(K) + 2 * K)
REST = 2
#: Cells handled at once by a worker.
_CELLS = 20_000

_U = np.uint64
#: Odd multipliers that make a shingle's hash depend on the order of its words.
_POWERS = [_U(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64)) for j in range(SHINGLE)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def cells(ws: list[bytes]) -> np.ndarray:
    """The sorted unit cells of a document's shingles: one 64-bit hash per (shingle,
    occurrence). Jaccard of cells is weighted Jaccard of shingles."""
    if not ws:
        return np.zeros(0, dtype=_U)
    h = np.frombuffer(array("Q", map(xxhash.xxh3_64_intdigest, ws)), dtype=_U)
    span = min(SHINGLE, len(h))
    n = len(h) - span + 1
    s = h[:n] * _POWERS[0]
    for j in range(1, span):
        s += h[j : j + n] * _POWERS[j]
    s = _mix(s + _U(span))
    s.sort()
    at = np.arange(n)
    first = np.concatenate(([True], s[1:] != s[:-1]))
    if first.all():
        return s
    nth = at - np.maximum.accumulate(np.where(first, at, 0))
    out = np.where(nth == 0, s, _mix(s + nth.astype(_U) * _U(0xD6E8FEB86659FD93)))
    out.sort()
    return out


def _throw(cell: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All darts earlier than ``until`` per cell: index of the cell, time and the dart's hash."""
    index, time, dart = [], [], []
    live, clock, j, step = np.arange(len(cell)), np.zeros(len(cell)), 1, 2
    while len(live):
        numbers = np.arange(j, j + step, dtype=_U) * _U(0xA0761D6478BD642F)
        h = _mix(cell[live][:, None] + numbers)
        at = (h >> _U(24)).astype(np.float64)
        at += 0.5
        at *= 2.0**-40
        np.log(at, out=at)
        np.negative(at, out=at)
        at[:, 0] += clock[live]
        np.cumsum(at, axis=1, out=at)
        hit = at < until[live][:, None]
        row, _ = np.nonzero(hit)
        index.append(live[row])
        time.append(at[hit])
        dart.append(h[hit])
        clock[live] = at[:, -1]
        live = live[hit[:, -1]]
        j, step = j + step, min(2 * step, 256)
    return np.concatenate(index), np.concatenate(time), np.concatenate(dart)


def signatures(docs: list[np.ndarray]) -> np.ndarray:
    """One row of K dart hashes per document; documents must have cells."""
    out = np.zeros((len(docs), K), dtype=_U)
    todo, darts = np.arange(len(docs)), DARTS
    while len(todo):
        sizes = np.array([len(docs[i]) for i in todo])
        owner = np.repeat(np.arange(len(todo)), sizes)
        index, time, dart = _throw(np.concatenate([docs[i] for i in todo]), np.repeat(darts / sizes, sizes))
        place = owner[index] * K + ((dart & _U(0xFFFFFF)) * _U(K) >> _U(24)).astype(np.int64)
        earliest = np.full(len(todo) * K, np.inf)
        np.minimum.at(earliest, place, time)
        won = time == earliest[place]
        found = np.zeros(len(todo) * K, dtype=_U)
        found[place[won]] = dart[won]
        full = np.isfinite(earliest).reshape(len(todo), K).all(axis=1)
        out[todo[full]] = found.reshape(len(todo), K)[full]
        todo, darts = todo[~full], darts * 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different for each band."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U) + _U(1), parts.shape[:2]).copy()
    for r in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common) if len(both) else 0.0


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, key (of id and text), n_words, print (of the word sequence) and its band
    keys."""

    def sign(batch: pd.DataFrame) -> pd.DataFrame:
        n, prints, bands = [], [], [None] * len(batch)
        held: list[np.ndarray] = []
        rows: list[int] = []

        def flush() -> None:
            if rows:
                for i, keys in zip(rows, band_keys(signatures(held)), strict=True):
                    bands[i] = keys
                held.clear()
                rows.clear()

        weight = 0
        for i, text in enumerate(batch["_text"]):
            ws = words(text)
            n.append(len(ws))
            prints.append(hashlib.blake2b(b" ".join(ws), digest_size=16).digest())
            if ws:
                held.append(cells(ws))
                rows.append(i)
                weight += max(len(ws), DARTS // 4)
                if weight > _CELLS:
                    flush()
                    weight = 0
        flush()
        own = {"doc_id": batch["doc_id"], "key": batch["key"]}
        return pd.DataFrame(own | {"n_words": n, "print": prints, "bands": bands})

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    rows = _texts(docs, id_col, text_col).select(F.col("id").cast("string").alias("doc_id"), "key", "_text")
    out = map_rows(rows, sign, "doc_id string, key long, n_words long, print binary, bands array<long>")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key and text of each row."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("_text"))


def _cells_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, cells) of the documents that ``nodes`` names by their keys."""

    def cut(batch: pd.DataFrame) -> pd.DataFrame:
        made = [cells(words(t)).tobytes() for t in batch["_text"]]
        return pd.DataFrame({"node": batch["node"], "cells": made})

    rows = _texts(docs, id_col, text_col).select(F.col("key").alias("node"), "_text").join(nodes, "node", "left_semi")
    rows = rows.groupBy("node").agg(F.first("_text").alias("_text"))
    return map_rows(rows, cut, "node long, cells binary")


def verified(pairs: DataFrame, table: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold."""

    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            short, long = sorted((len(x), len(y)))
            near = short >= similarity * long
            out.append(near and jaccard(np.frombuffer(x, _U), np.frombuffer(y, _U)) >= similarity)
        return pd.Series(out, dtype=bool)

    left, right = table.toDF("a", "cells_a"), table.toDF("b", "cells_b")
    joined = pairs.join(left, "a").join(right, "b")
    test = text_udf(linked, "boolean")
    return written(joined.where(test("cells_a", "cells_b")).select("a", "b"), "near-links")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, cls) after merging the classes that ``links`` connect."""
    found = links.count()
    if not found:
        return labels
    ends = links.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b")
    roots = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), 2 * found)
    new = labels.join(roots.toDF("cls", "root"), "cls", "left")
    new = new.select("node", F.coalesce("root", "cls").alias("cls"))
    return written(new, "near-labels", labels.count())


def _open(buckets: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """(band, node, n, cls) of the buckets that still hold more than one class."""
    rows = buckets.select("band", "node", "n").join(labels, "node")
    several = rows.groupBy("band").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"))
    several = several.where("lo <> hi").select("band")
    return written(rows.join(several, "band").select("band", "node", "n", "cls"), "near-open", total)


def _pairs_left(rows: DataFrame) -> int:
    """How many pairs of different classes the buckets hold, from counts alone."""
    per_class = rows.groupBy("band", "cls").agg(F.count(F.lit(1)).cast("double").alias("n"))
    per_band = per_class.groupBy("band").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q"))
    return int(per_band.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()[0] or 0)


def _pivots(rows: DataFrame) -> DataFrame:
    """Per bucket its smallest document (ties: smallest id) as ``pivot`` and ``n_pivot``."""
    least = rows.groupBy("band").agg(F.min(F.struct("n", "node")).alias("p"))
    return least.select("band", F.col("p.node").alias("pivot"), F.col("p.n").alias("n_pivot"))


def _beside_pivots(rows: DataFrame, table: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """New, much smaller buckets (band, node, n) in place of ``rows``, whose pivots have met all
    other classes of their buckets.

    Let x, y be in a bucket with pivot p, in different classes and linked. One of them, say x, is
    not in p's class, so it shares less than s (n_x + n_p) cells with p, s = similarity / (1 +
    similarity). As n_y >= n_p, they share at least need = s (n_x + n_p) - common(x, p) cells
    that p lacks. Only cells that documents of different classes have beside p can be among
    these. So x and y meet in one of their rarest such cells, by one order, if x drops its
    need - 1 commonest ones and members of p's class drop none. What a whole bucket has in
    common, such as a passage, makes no new bucket.
    """
    share = similarity / (1 + similarity)
    met = rows.join(_pivots(rows), "band").where("node <> pivot")
    classes = labels.toDF("pivot", "pivot_cls")
    met = met.select("node", "n", "cls", "pivot", "n_pivot").distinct().join(classes, "pivot")
    met = met.join(table, "node").join(table.toDF("pivot", "pivot_cells"), "pivot")

    def beside(cells_x: pd.Series, cells_p: pd.Series) -> pd.Series:
        return pd.Series(
            [
                np.setdiff1d(np.frombuffer(x, _U), np.frombuffer(p, _U), assume_unique=True).view(np.int64)
                for x, p in zip(cells_x, cells_p, strict=True)
            ]
        )

    added = text_udf(beside, "array<long>")("cells", "pivot_cells")
    apart = (F.col("cls") != F.col("pivot_cls")).alias("apart")
    met = met.select("node", "n", "cls", "pivot", "n_pivot", apart, added.alias("added"))
    common = F.col("n") - F.size("added")
    need = F.ceil(F.lit(share) * (F.col("n") + F.col("n_pivot")) - 1e-6) - common
    need = F.when(F.col("apart"), F.greatest(need, F.lit(1))).otherwise(F.lit(1)).alias("need")
    met = met.select("node", "n", "cls", "pivot", "added", need).where("need <= size(added)")
    each = written(met, "near-beside").select("node", "n", "cls", "pivot", "need", F.explode("added").alias("cell"))
    cells_of = each.groupBy("pivot", "cell").agg(
        F.count(F.lit(1)).alias("f"), F.min("cls").alias("lo"), F.max("cls").alias("hi")
    )
    shared = each.join(cells_of.where("lo <> hi").select("pivot", "cell", "f"), ["pivot", "cell"])
    own = Window.partitionBy("pivot", "node")  # at most a document's cells
    shared = shared.withColumn("all", F.count(F.lit(1)).over(own))
    shared = shared.withColumn("at", F.row_number().over(own.orderBy("f", "cell")))
    shared = shared.where("at <= all - need + 1")
    return shared.select(F.xxhash64("pivot", "cell").alias("band"), "node", "n").distinct()


def _merged(buckets: DataFrame, table: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    # One pair a node: the smallest pivot over all its buckets. This merges most of a large group
    # of near copies at one comparison each.
    mine = buckets.join(_pivots(buckets), "band").groupBy(F.col("node").alias("b"))
    mine = mine.agg(F.min(F.struct("n_pivot", "pivot")).alias("p")).select(F.col("p.pivot").alias("a"), "b")
    labels = _relabelled(labels, verified(mine.where("a <> b"), table, similarity))
    total = buckets.count()
    rows = _open(buckets, labels, total)
    classes = labels.toDF("pivot", "x")
    stars = rows.join(_pivots(rows), "band").join(classes, "pivot").where("cls <> x")
    stars = stars.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    labels = _relabelled(labels, verified(stars, table, similarity))
    rows = _open(rows.drop("cls"), labels, total)
    rows = _open(_beside_pivots(rows, table, labels, similarity), labels, total)
    pivots = 1
    while left := _pairs_left(rows):
        if left <= REST * total:
            x, y = rows.select("band", F.col("node").alias("a"), F.col("cls").alias("x")), rows.select("band", F.col("node").alias("b"), F.col("cls").alias("y"))
            pairs = x.join(y, "band").where("a < b and x <> y").select("a", "b").distinct()
            return _relabelled(labels, verified(pairs, table, similarity))
        salt = F.pmod(F.xxhash64("node"), F.lit(pivots))
        chosen = rows.withColumn("_salt", salt).groupBy("band", "_salt").agg(F.min("node").alias("a"))
        chosen = written(chosen.select("band", "a"), "near-pivots", total)
        classes = labels.toDF("a", "x")
        against = rows.join(chosen.join(classes, "a"), "band").where("cls <> x")
        pairs = against.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        labels = _relabelled(labels, verified(pairs, table, similarity))
        # A pivot has met all others of its bucket.
        rest = rows.join(chosen.toDF("band", "node"), ["band", "node"], "left_anti")
        rows, pivots = _open(rest, labels, total), min(pivots * 4, 64)
    return labels


def classified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per input row: doc_id, key (of id and text), class_id (the smallest id of its
    class), class_size (in rows), kept (the row is its class's, or takes no part)."""
    rows = written(signed(docs, id_col, text_col), "near-signed")
    able = rows.where("doc_id is not null and n_words > 0")
    # The document that stands for a word sequence.
    nodes = able.groupBy("print").agg(F.min(F.struct("doc_id", "key")).alias("own"))
    nodes = written(nodes.select("print", F.col("own.doc_id").alias("own_id"), F.col("own.key").alias("node")), "near-nodes")
    stands = ((F.col("doc_id") == F.col("own_id")) & (F.col("key") == F.col("node"))).alias("stands")
    n = F.greatest(F.col("n_words") - SHINGLE + 1, F.lit(1)).alias("n")
    member = able.join(nodes, "print")
    member = member.select("doc_id", "key", "node", "own_id", n, stands, F.when(stands, F.col("bands")).alias("bands"))
    member = written(member, "near-members")
    in_band = member.where("bands is not null").select(F.explode("bands").alias("band"), "node", "n")
    several = in_band.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    buckets = written(in_band.join(several.select("band"), "band").distinct(), "near-buckets")
    meeting = written(buckets.select("node").distinct(), "near-meeting")
    table = written(_cells_of(docs, meeting, id_col, text_col), "near-cells")
    labels = _merged(buckets, table, meeting.withColumn("cls", F.col("node")), similarity)
    best = labels.join(nodes.select("node", "own_id"), "node").groupBy("cls").agg(F.min(F.struct("own_id", "node")).alias("best"))
    merged = labels.join(best, "cls").select(
        "node", "cls", F.col("best.own_id").alias("first_id"), F.col("best.node").alias("best")
    )
    # Nodes that met no other are classes of their own.
    placed = member.select("doc_id", "key", "node", "stands", "own_id").join(merged, "node", "left")
    placed = placed.select(
        "doc_id", "key", F.coalesce("cls", "node").alias("cls"), F.coalesce("first_id", "own_id").alias("class_id"),
        (F.coalesce(F.col("best") == F.col("node"), F.lit(True)) & F.col("stands")).alias("kept"),
    )
    result = written(placed, "near-classes")
    sizes = result.groupBy("cls").agg(F.count(F.lit(1)).alias("class_size"))
    result = result.join(sizes, "cls").select("doc_id", "key", "class_id", "class_size", "kept")
    apart = rows.where("doc_id is null or n_words <= 0")
    one, yes = F.lit(1).cast("bigint").alias("class_size"), F.lit(True).alias("kept")
    return result.unionByName(apart.select("doc_id", "key", F.col("doc_id").alias("class_id"), one, yes))


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per input row: doc_id, class_id, class_size and kept (see ``classified``)."""
    return classified(docs, id_col, text_col, similarity).drop("key")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all its columns, with one document of each class: that with the smallest id. Of
    repeated rows of it one stays."""
    verdict = classified(docs, id_col, text_col).where("class_id is not null")
    keys = verdict.groupBy("key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    apart = written(keys.where("not kept or n > 1"), "near-apart")
    apart = F.broadcast(apart) if few(apart) else apart
    text = F.col(text_col).cast("string")
    inner = docs.select(F.struct("*").alias("_row"), F.xxhash64(F.col(id_col), text).alias("key"))
    # Most documents are in neither list and pass as they are.
    plain = inner.join(apart, "key", "left_anti").select("_row")
    again = inner.join(apart.where("kept"), "key", "left_semi")
    again = again.groupBy("key").agg(F.first("_row").alias("_row")).select("_row")
    return plain.unionByName(again).select("_row.*")
