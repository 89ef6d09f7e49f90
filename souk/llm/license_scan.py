"""License scan by diagonal voting.

Templates are license phrases, sentences and whole notices. All rolling word k-gram hashes of all
documents are joined with the templates' k-gram positions: k is ``SHORT_K`` for short templates
(below ``FUZZY_FROM`` words) and ``LONG_K`` for the others. A match of document position p with
template position t votes for diagonal p - t. Votes are summed up per document, template and
diagonal as bit masks of the template positions, 64 to a row.

* Short templates need every vote of one diagonal.
* Longer ones may have words inserted or left out: neighbouring diagonals (at most ``SLACK``
  apart) are merged, and a quarter of the votes makes a candidate (a changed word costs k votes).

Candidate spans are verified on the words themselves: short templates word by word. For longer
ones the words that the span has in the template's order are counted, and their share of the
longer of the two, template or span, must reach ``SIMILARITY``; so words scattered over a longer
text are no match. A verified span runs from its first matching word to its last.

The templates' k-grams are a constant of the code and broadcast (beyond ``MAX_GRAMS`` the join is
left to Spark). Votes per document are bounded by its own words, and documents without any vote
are never looked at again.

Defined results: null text is empty; without spans there are no labels and the score is 0. Rows
equal in id and text get equal results. Very long texts are scanned whole, candidate regions in
windows of a few template lengths. Extra columns are ignored.
"""

from __future__ import annotations

from array import array
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.llm.common import map_rows, text_udf, with_text_key, words, written
from souk.llm.license_texts import WHOLE_NOTICES

FUZZY_FROM = 8
SHORT_K, LONG_K = 2, 3
SLACK = 2
SIMILARITY = 0.8
MAX_GRAMS = 100_000

#: The base phrases: (phrase, label). Fixed values.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: The method's own templates.
NOTICES = (
    ("cc by nc", "cc-by-nc"),
    ("cc by nd", "cc-by-nd"),
    ("cc by sa", "cc-by-sa"),
    ("cc0 1 0 universal", "cc0"),
    ("creative commons attribution", "cc-by"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu free documentation license", "gfdl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "bsl"),
    ("bsd license", "bsd"),
    ("isc license", "isc"),
    ("all rights reserved", "reserved"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl"),
    ("unless required by applicable law or agreed to in writing software distributed under the license", "apache"),
    ("this work is licensed under a creative commons attribution international license", "cc-by"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    *((text, label) for label, text in WHOLE_NOTICES),
)

Template = tuple[str, str]


def gram_hashes(ws: list[bytes], k: int = SHORT_K) -> np.ndarray:
    """One 64-bit hash per run of ``k`` neighbouring words, by position."""
    if len(ws) < k:
        return np.zeros(0, dtype=np.int64)
    h = np.frombuffer(array("Q", map(xxhash.xxh3_64_intdigest, ws)), dtype=np.uint64)
    n = len(ws) - k + 1
    x = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        x = x * np.uint64(0x9E3779B97F4A7C15) + (h[i : i + n] ^ (h[i : i + n] >> np.uint64(29)))
        x ^= x >> np.uint64(32)
    return (x * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(gram, template, t, fuzzy, n_grams, n_words) of all templates; each has 2 words at least."""
    rows = []
    for number, (phrase, _) in enumerate(templates):
        ws = words(phrase)
        if len(ws) < 2:
            raise ValueError(f"a template needs 2 words at least: {phrase!r}")
        fuzzy = len(ws) >= FUZZY_FROM
        grams = gram_hashes(ws, LONG_K if fuzzy else SHORT_K)
        rows += [(int(g), number, t, fuzzy, len(grams), len(ws)) for t, g in enumerate(grams)]
    frame = spark.createDataFrame(rows, "gram long, template int, t int, fuzzy boolean, n_grams int, n_words int")
    return F.broadcast(frame) if len(rows) <= MAX_GRAMS else frame


def candidate_spans(rows: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """Per voted document (_key): ``spans``, structs of template and word range [start, end)."""

    def roll(batch: pd.DataFrame) -> pd.DataFrame:
        short, long = [], []
        for text in batch["_text"]:
            ws = words(text)
            short.append(gram_hashes(ws))
            long.append(gram_hashes(ws, LONG_K))
        return pd.DataFrame({"_key": batch["_key"], "short": short, "long": long})

    rolled = map_rows(rows.select("_key", "_text"), roll, "_key long, short array<long>, long array<long>")
    places = F.posexplode(F.concat("short", "long")).alias("at", "gram")
    n_short = F.size("short")
    grams = rolled.select("_key", n_short.alias("n_short"), places)
    votes = grams.join(template_grams(rows.sparkSession, templates), "gram")
    # Long grams stand behind the short ones; their hashes start from k, so the two never meet.
    p = F.when(F.col("fuzzy"), F.col("at") - F.col("n_short")).otherwise(F.col("at"))
    diagonal = (p - F.col("t")).alias("diagonal")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("t", F.lit(64)))
    keys = ("_key", "template", "fuzzy", "n_grams", "n_words")
    lines = votes.groupBy(*keys, diagonal, F.floor(F.col("t") / 64).alias("block")).agg(F.bit_or(bit).alias("mask"))
    exact = lines.where((~F.col("fuzzy")) & (F.bit_count("mask") == F.col("n_grams")))
    exact = exact.select("_key", "template", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("n_words")).alias("end"))
    # Neighbouring diagonals: a gap of more than SLACK starts a new bundle.
    order = Window.partitionBy("_key", "template").orderBy("diagonal", "block")
    gap = F.col("diagonal") - F.lag("diagonal").over(order) > SLACK
    bundled = lines.where("fuzzy").withColumn("_new", F.when(gap, 1).otherwise(0))
    bundled = bundled.withColumn("bundle", F.sum("_new").over(order))
    masks = bundled.groupBy("_key", "template", "bundle", "n_grams", "n_words", "block").agg(
        F.bit_or("mask").alias("mask"), F.min("diagonal").alias("lo"), F.max("diagonal").alias("hi")
    )
    near = masks.groupBy("_key", "template", "bundle", "n_grams", "n_words").agg(
        F.sum(F.bit_count("mask")).alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    near = near.where(4 * F.col("votes") >= F.col("n_grams")).select(
        "_key", "template", F.greatest("lo", F.lit(0)).alias("start"), (F.col("hi") + F.col("n_words")).alias("end")
    )
    spans = exact.unionByName(near)
    return spans.groupBy("_key").agg(F.collect_list(F.struct("template", "start", "end")).alias("spans"))


def best_match(template: list[bytes], part: list[bytes]) -> tuple[float, int, int]:
    """(similarity, start, end) of the stretch of ``part`` that matches best: the words in the
    template's order, as a share of the longer of template and stretch."""
    blocks = SequenceMatcher(None, template, part, autojunk=False).get_matching_blocks()[:-1]
    best = (0.0, 0, 0)
    for i, first in enumerate(blocks):
        held = 0
        for last in blocks[i:]:
            held += last.size
            start, end = first.b, last.b + last.size
            best = max(best, (held / max(len(template), end - start), start, end), key=lambda x: (x[0], -x[1]))
    return best


def fuzzy_matches(template: list[bytes], part: list[bytes]) -> list[tuple[float, int, int]]:
    """The matches in a candidate region, best first, none overlapping; long regions are looked
    at in windows that overlap by more than a match can be long."""
    size = 3 * len(template)
    step = max(len(template) * 3 // 2, 1)
    found = []
    for at in range(0, max(len(part) - size, 0) + step, step):
        s, a, b = best_match(template, part[at : at + size])
        if s >= SIMILARITY:
            found.append((s, at + a, at + b))
    out: list[tuple[float, int, int]] = []
    for s, a, b in sorted(set(found), key=lambda x: (-x[0], x[1])):
        if all(b <= x or a >= y for _, x, y in out):
            out.append((s, a, b))
    return out


def verify(ws: list[bytes], spans: list, templates: list[list[bytes]]) -> list[tuple[int, int, int, float]]:
    """(start, end, template, similarity) of the spans that hold, in order."""
    out = []
    for span in spans:
        k, start, end = span["template"], span["start"], span["end"]
        template, part = templates[k], ws[max(start, 0) : end]
        if len(template) < FUZZY_FROM:
            if start >= 0 and part == template:
                out.append((start, end, k, 1.0))
        else:
            out += [(start + a, start + b, k, s) for s, a, b in fuzzy_matches(template, part)]
    return sorted(set(out))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: tuple[Template, ...] = BASE,
    notices: tuple[Template, ...] = NOTICES,
) -> DataFrame:
    """One row per input row: doc_id, n_words, ``places`` (start, end, label, base, similarity
    of every verified span) and the columns of the query."""
    templates = (*base, *notices)
    rows = with_text_key(docs, id_col, text_col)
    spans = written(candidate_spans(rows, templates), "license-spans")
    joined = rows.join(spans, "_key", "left")
    cut = [words(p) for p, _ in templates]

    def judge(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(texts, spans, strict=True):
            ws = words(text)
            held = verify(ws, found, cut) if found is not None else []
            starts = [s for s, _, k, _ in held if k < len(base)]
            own = sorted({templates[k][1] for _, _, k, _ in held if k < len(base)})
            every = sorted({templates[k][1] for _, _, k, _ in held})
            out.append(
                {
                    "n_words": len(ws),
                    "n_base": len(starts),
                    "first_word": min(starts, default=None),
                    "last_word": max(starts, default=None),
                    "base_labels": ",".join(own),
                    "labels": ",".join(every),
                    "score": max((s for *_, s in held), default=0.0),
                    "places": [
                        {"start": s, "end": e, "label": templates[k][1], "base": k < len(base), "similarity": x}
                        for s, e, k, x in held
                    ],
                }
            )
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]
        made = pd.DataFrame(out, columns=names)
        return made.astype({"first_word": "Int64", "last_word": "Int64"})

    schema = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, places array<struct<start: long, end: long, label: string, base: boolean, similarity: double>>"
    )
    judged = text_udf(judge, schema)("_text", "spans")
    return joined.withColumn("_j", judged).select(F.col("_id").alias("doc_id"), "_j.*")
