"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

An item's windows are its runs of ``WINDOW`` consecutive words (one shorter window if the item
has fewer). A document contains a window exactly if the window's words stand consecutively in
it. The tokens of a window are ordered by their rarity over the whole corpus; as containment
must be complete, the necessary prefix of a window is its rarest token alone.

1. One pass over all documents counts the corpus frequency of the items' words.
2. The prefix index maps each window's rarest token to the (offset, length) pairs at which
   windows hold it. Per document, only occurrences of prefix tokens are looked at: the length
   bound asks for as many words as the window has, the positional bound that the window fits
   between the document's first and last word, and then the words themselves are compared.

The items are the stated query set. They go to the executors in blocks of at most
``BLOCK_BYTES`` (the bound on what is broadcast); a larger benchmark makes more blocks, each its
own pass over the documents, and never a larger broadcast. With one block documents are not
shuffled at all; with more, each block's finds are joined back to them.

Defined results: null and empty texts have no words and no hits; items without words are never
found; repeated rows are judged one by one; items with a null id count as hits, but not in
``n_items`` and the digest; very long texts are searched whole; extra columns are not touched.
"""

from __future__ import annotations

import functools
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm.common import map_rows, text_udf, words, written

WINDOW = 10
#: Most bytes of item texts in one broadcast block.
BLOCK_BYTES = 4 << 20
ADDED = ("n_words", "n_hit", "hit_spans", "found_items", "_found", "_key", "_spans", "_items")


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The items, dealt by hash into blocks of about half of ``block_bytes`` each, so that chance
    does not carry one over it. Their number follows from one count over all items."""
    total = items.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    if total <= block_bytes:
        return [items]
    n = -(-2 * total // block_bytes)
    block = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n))
    return [items.where(block == i) for i in range(n)]


class PrefixIndex:
    """The windows of one block of items, indexed by their rarest token."""

    def __init__(self, items: list[tuple], frequency: dict[bytes, int], window: int):
        #: window text -> ids of the items that have it
        self.windows: dict[bytes, set] = defaultdict(set)
        #: rarest token -> the (offset, length) at which windows hold it
        self.places: dict[bytes, set[tuple[int, int]]] = defaultdict(set)
        for item_id, text in items:
            ws = words(text)
            n = min(window, len(ws))
            for start in range(len(ws) - n + 1 if n else 0):
                part = ws[start : start + n]
                self.windows[b" ".join(part)].add(item_id)
                token = min(part, key=lambda w: (frequency.get(w, 0), w))
                self.places[token].add((part.index(token), n))
        self.tokens = frozenset(self.places)
        self.places = {k: tuple(sorted(v)) for k, v in self.places.items()}
        self.windows = {k: tuple(v) for k, v in self.windows.items()}

    def find(self, ws: list[bytes]) -> tuple[set[int], set]:
        """Hit word positions and found item ids of one document."""
        hits: set[int] = set()
        found: set = set()
        if self.tokens.isdisjoint(ws):
            return hits, found
        total, tokens, places, windows = len(ws), self.tokens, self.places, self.windows
        for at in [i for i, w in enumerate(ws) if w in tokens]:
            for offset, n in places[ws[at]]:
                start = at - offset
                if start < 0 or start + n > total:
                    continue
                ids = windows.get(b" ".join(ws[start : start + n]))
                if ids is not None:
                    found.update(ids)
                    hits.update(range(start, start + n))
        return hits, found


def corpus_frequency(docs: DataFrame, text_col: str, vocabulary) -> dict[bytes, int]:
    """How often each word of a broadcast vocabulary stands in all documents together."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        known, counts = vocabulary.value, Counter()
        for text in batch["_text"]:
            counts.update(filter(known.__contains__, words(text)))
        return pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    text = docs.select(F.col(text_col).cast("string").alias("_text"))
    sums = map_rows(text, count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # At most the vocabulary, which the block bounds.
    return {bytes(r["word"]): r["n"] for r in sums.collect()}


def _prepared(spark: SparkSession, docs, block, item_id, item_text, text_col, window):
    rows = [(r[0], r[1]) for r in block.select(item_id, item_text).collect()]  # bounded block
    vocabulary = spark.sparkContext.broadcast(frozenset(w for _, t in rows for w in words(t)))
    frequency = corpus_frequency(docs, text_col, vocabulary) if vocabulary.value else {}
    return spark.sparkContext.broadcast(PrefixIndex(rows, frequency, window))


def _judged(docs: DataFrame, text_col: str, index) -> DataFrame:
    """Adds n_words, n_hit, hit_spans and found_items for one block's broadcast index."""

    def judge(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            ws = words(text)
            hits, found = index.value.find(ws)
            ids = sorted({str(x) for x in found if x is not None})
            out.append((len(ws), len(hits), _spans(hits), ids))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "hit_spans", "found_items"])

    schema = "n_words long, n_hit long, hit_spans array<array<long>>, found_items array<string>"
    judged = text_udf(judge, schema)(F.col(text_col).cast("string"))
    return docs.withColumn("_found", judged).select("*", "_found.*").drop("_found")


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_spans`` (array of [start, end) word ranges)
    and ``found_items`` (distinct ids as strings, sorted) added. Columns of these names that
    ``docs`` has already give way to the new ones."""
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED and c != text_col])
    blocks = item_blocks(items, item_id, item_text, block_bytes)
    prepare = lambda block: _prepared(spark, docs, block, item_id, item_text, text_col, window)
    if len(blocks) == 1:
        return _judged(docs, text_col, prepare(blocks[0]))
    # One pass per block; only finds are kept, under a key of the text they depend on.
    key = F.xxhash64(F.col(text_col).cast("string"))
    text = docs.select(F.col(text_col).cast("string").alias("_text"))
    finds = [
        written(
            _judged(text, "_text", prepare(block))
            .where("n_hit > 0")
            .select(F.xxhash64("_text").alias("_key"), "hit_spans", "found_items"),
            "decontaminate-block",
        )
        for block in blocks
    ]
    every = functools.reduce(DataFrame.unionByName, finds).distinct()
    merged = every.groupBy("_key").agg(
        F.flatten(F.collect_list("hit_spans")).alias("_spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("found_items")))).alias("_items"),
    )

    def settle(texts: pd.Series, spans: pd.Series, ids: pd.Series) -> pd.DataFrame:
        out = []
        for text, some, found in zip(texts, spans, ids, strict=True):
            hits = {i for a, b in (some if some is not None else ()) for i in range(a, b)}
            out.append((len(words(text)), len(hits), _spans(hits), list(found if found is not None else ())))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "hit_spans", "found_items"])

    schema = "n_words long, n_hit long, hit_spans array<array<long>>, found_items array<string>"
    settled = text_udf(settle, schema)(F.col(text_col).cast("string"), "_spans", "_items")
    joined = docs.withColumn("_key", key).join(merged, "_key", "left")
    return joined.withColumn("_found", settled).select(*docs.columns, "_found.*")


def _spans(hits: set[int]) -> list[list[int]]:
    spans: list[list[int]] = []
    for i in sorted(hits):
        if spans and spans[-1][1] == i:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return spans


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no window of ``items`` occurs."""
    names = docs.columns
    inner = docs.select(F.struct("*").alias("_row"), F.col(options.pop("text_col", "text")).alias("_text"))
    found = find_contamination(inner, items, text_col="_text", **options)
    return found.where("n_hit = 0").select("_row.*").toDF(*names)


def digest(found: DataFrame) -> DataFrame:
    """The per-document columns of the query."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("found_items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("found_items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
