"""Line dedup by pairwise alignment.

Lines (trimmed, not blank) and pairs of neighbouring lines are hashed together with their
occurrence number, so a key stands once in a document and pairing makes common lines rare. So
are the shortest runs of lines that reach ``MIN_WORDS`` words, one from each line on and one up
to each line, and the whole document: every line of a block that can be deleted stands in such a
run. The earliest document (smallest id) that has a key holds it; every later document with the
key is linked to the holder, which has the run whole. That gives one link per key and document,
however many documents share a line, and needs no cap on frequency.

A later document's links are grouped by holder, rarest shared key first. Each pair of documents
is aligned by patience diff: of the shared keys the longest run whose positions ascend in both
documents is kept, and matched lines that follow each other in both form blocks. Blocks of at
least ``MIN_WORDS`` words are deleted from the later document; the holder keeps its lines. What is
left over is aligned with the same holder again, as long as that finds much; common runs of
lines still left, such as blocks in another order or further copies of one, are aligned each on
its own. So a line goes exactly if it stands in a run of ``MIN_WORDS`` words or more that an earlier
document has as well. Lines that went count in later blocks, as the runs of a block can have
different holders.

Defined results: null and empty texts have no lines and stay as they are. Rows with a null id
neither give nor lose lines. Rows of one id are one document and do not lose lines to each
other; rows equal in id and text get equal results. Blank lines stay. Extra columns are ignored.
Very long texts are cut up whole; a task holds one text's keys and links at a time.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import map_rows, text_udf, with_text_key, words, written

MIN_WORDS = 10
#: Polynomial hashing of runs of lines: modulus and base.
_MOD, _BASE = (1 << 61) - 1, 1_445_088_963_704_212_871


def min_runs(sizes: list[int], min_words: int) -> list[tuple[int, int]]:
    """(from, to) of the shortest runs of ``min_words`` words from each line on and up to each
    line, and of all lines; without runs of one or two lines."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    n = len(sizes)
    if n < 3 or total[-1] < min_words:
        return []
    ends = np.searchsorted(total, total[:-1] + min_words, "left").tolist()
    starts = (np.searchsorted(total, total[1:] - min_words, "right") - 1).tolist()
    runs = {(i, e) for i, e in enumerate(ends) if i + 2 < e <= n}
    runs.update((s, e) for e, s in enumerate(starts, 1) if 0 <= s < e - 2)
    runs.add((0, n))
    return sorted(runs)


def keyed_lines(
    text: str | None, min_words: int = MIN_WORDS
) -> tuple[list[int], list[int], list[int], list[int], list[bool]]:
    """Per key: its hash, line position, number of lines, words of those lines, and whether the
    row repeats the hash of a key's first occurrence for a later one. Positions count the lines
    that are not blank."""
    lines = [s for x in (text or "").split("\n") if (s := x.strip())]
    plain = [xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) for x in lines]
    sizes = [len(words(x)) for x in lines]
    out: tuple[list[int], list[int], list[int], list[int], list[bool]] = ([], [], [], [], [])

    def add(nth: int, at: int, span: int, size: int, key: tuple) -> None:
        for k in (nth, 1) if nth > 1 and size >= min_words else (nth,):
            packed = np.array([span, k, *key], dtype=np.uint64).tobytes()
            out[0].append(xxhash.xxh3_64_intdigest(packed) - (1 << 63))
            out[1].append(at)
            out[2].append(span)
            out[3].append(size)
            out[4].append(k != nth)

    for span in (1, 2):
        seen: dict[tuple, int] = defaultdict(int)
        for i in range(len(lines) - span + 1):
            key = tuple(plain[i : i + span])
            seen[key] += 1
            add(seen[key], i, span, sum(sizes[i : i + span]), key)
    if runs := min_runs(sizes, min_words):
        # Hashes of prefixes: a run costs the same however many lines without words it holds.
        prefix, power, total = [0], [1], [0, *accumulate(sizes)]
        for x in plain:
            prefix.append((prefix[-1] * _BASE + x) % _MOD)
            power.append(power[-1] * _BASE % _MOD)
        seen = defaultdict(int)
        for i, e in runs:
            key = (e - i, (prefix[e] - prefix[i] * power[e - i]) % _MOD)
            seen[key] += 1
            add(seen[key], i, e - i, total[e] - total[i], key[1:])
    return out


def line_keys(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, key row) per line key of ``rows`` (_id, _key, _text): _id, _key, line, at, span,
    repeat."""

    def explode(batch: pd.DataFrame) -> pd.DataFrame:
        found = [keyed_lines(t, min_words) for t in batch["_text"]]
        n = [len(f[0]) for f in found]
        return pd.DataFrame(
            {
                "_id": np.repeat(batch["_id"].to_numpy(), n),
                "_key": np.repeat(batch["_key"].to_numpy(), n),
                "line": np.array([x for f in found for x in f[0]], dtype=np.int64),
                "at": np.array([x for f in found for x in f[1]], dtype=np.int32),
                "span": np.array([x for f in found for x in f[2]], dtype=np.int32),
                "repeat": np.array([x for f in found for x in f[4]], dtype=bool),
            }
        )

    kind = rows.schema["_id"].dataType.simpleString()
    text = rows.withColumn("_id", F.col("_id").cast("string"))
    out = map_rows(text, explode, "_id string, _key long, line long, at int, span int, repeat boolean")
    return out.withColumn("_id", F.col("_id").cast(kind))


def _ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of (later, earlier) positions that ascends in both (patience sorting);
    ``pairs`` come in ascending later position."""
    tops: list[int] = []
    where: list[int] = []
    before: list[int] = []
    for i, (_, at) in enumerate(pairs):
        pile = bisect.bisect_left(tops, at)
        before.append(where[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [at]
        where[pile : pile + 1] = [i]
    out, i = [], where[-1] if where else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def common_blocks(matches: set[tuple[int, int]]) -> list[list[int]]:
    """Blocks of later positions from (later, earlier) matches of two documents."""
    # Of several matches of one line the nearest earlier position is tried first by the order.
    blocks: list[list[int]] = []
    last = (-2, -2)
    for later, earlier in _ascending(sorted(matches, key=lambda p: (p[0], -p[1]))):
        if blocks and (later, earlier) == (last[0] + 1, last[1] + 1):
            blocks[-1].append(later)
        else:
            blocks.append([later])
        last = (later, earlier)
    return blocks


def common_runs(matches: set[tuple[int, int]]) -> list[list[int]]:
    """The longest runs of later positions whose matches stay side by side."""
    runs: list[list[int]] = []
    last = None
    for shift, later in sorted((earlier - later, later) for later, earlier in matches):
        if last == (shift, later - 1):
            runs[-1].append(later)
        else:
            runs.append([later])
        last = (shift, later)
    return runs


def aligned_lines(matches: set[tuple[int, int]], sizes: list[int], min_words: int) -> set[int]:
    """The later positions in common blocks of ``min_words`` words, from one pair of documents."""
    gone: set[int] = set()
    free = matches
    while free:
        blocks = [b for b in common_blocks(free) if sum(sizes[i] for i in b) >= min_words]
        gone.update(i for block in blocks for i in block)
        rest = {p for p in free if p[0] not in gone}
        few = 8 * (len(free) - len(rest)) < len(free)
        free = rest
        if few:
            break
    if free:
        for run in common_runs(matches):
            if sum(sizes[i] for i in run) >= min_words:
                gone.update(run)
    return gone


def deleted_lines(links: list[dict], sizes: list[int], min_words: int) -> list[int]:
    """The positions to delete from one later document, given its links to all holders."""
    by_holder: dict = defaultdict(lambda: [float("inf"), set()])
    # Overlapping runs of one holder and shift add each match once.
    reach: dict[tuple, int] = defaultdict(int)
    for link in sorted(links, key=lambda x: x["at"]):
        entry = by_holder[link["holder"]]
        entry[0] = min(entry[0], link["df"])
        shift, end = link["held_at"] - link["at"], link["at"] + link["span"]
        way = (link["holder"], shift)
        for at in range(max(link["at"], reach[way]), end):
            entry[1].add((at, at + shift))
        reach[way] = max(reach[way], end)
    gone: set[int] = set()
    for holder in sorted(by_holder, key=lambda h: (by_holder[h][0], -len(by_holder[h][1]), h)):
        matches = by_holder[holder][1]
        if any(p[0] not in gone for p in matches):
            gone |= aligned_lines(matches, sizes, min_words)
    return sorted(gone)


def links_to_holders(keys: DataFrame) -> DataFrame:
    """Per later document (_id, _key): its links to the holders of its keys."""
    # One row per key and document: its position in the row read first for that id.
    held = keys.where("_id is not null").groupBy("line").agg(
        F.min("_id").alias("holder"), F.max("_id").alias("_last"), F.count_if(~F.col("repeat")).alias("df")
    )
    held = held.where("holder <> _last").drop("_last")
    linked = keys.join(held, "line")
    own = linked.where(F.col("_id") == F.col("holder")).groupBy("line").agg(F.min("at").alias("held_at"))
    later = linked.where(F.col("_id") > F.col("holder")).join(own, "line")
    rows = later.select("_id", "_key", "at", "span", "holder", "held_at", "df", "repeat").distinct()
    link = F.struct("at", "span", "holder", "held_at", "df", "repeat")
    return rows.groupBy("_id", "_key").agg(F.collect_list(link).alias("links"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, removed (positions among the lines
    that are not blank), removed_words and clean_text."""
    rows = with_text_key(docs, id_col, text_col)
    keys = written(line_keys(rows.where("_id is not null"), min_words), "line-keys")
    links = written(links_to_holders(keys), "line-links").withColumnRenamed("_id", "_lid")
    on = (F.col("r._key") == F.col("l._key")) & (F.col("r._id") == F.col("l._lid"))
    joined = rows.alias("r").join(links.alias("l"), on, "left").select("r._id", "r._text", "l.links")

    def clean(texts: pd.Series, links: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, links, strict=True):
            lines = (text or "").split("\n")
            full = [i for i, x in enumerate(lines) if x.strip()]
            sizes, gone = [], []
            if found is not None:
                sizes = [len(words(lines[i])) for i in full]
                gone = deleted_lines([dict(x) for x in found], sizes, min_words)
            if gone:
                dropped = {full[i] for i in gone}
                text = "\n".join(x for i, x in enumerate(lines) if i not in dropped)
            out.append((len(full), len(gone), gone, sum(sizes[i] for i in gone), text))
        return pd.DataFrame(out, columns=["n_lines", "n_removed", "removed", "removed_words", "clean_text"])

    schema = "n_lines long, n_removed long, removed array<int>, removed_words long, clean_text string"
    cleaned = text_udf(clean, schema)("_text", "links")
    return joined.withColumn("_c", cleaned).select(F.col("_id").alias("doc_id"), "_c.*")
