"""Language identification of whole texts, with spans for mixed-language ones.

Words are runs of letters, lower-cased. A word's script (by code point range of its first
letter) narrows the languages to those learnt with that script; hashed character trigrams give
each candidate a log-likelihood. Viterbi over a text's words, with a penalty for switching,
labels spans. The text's language is the one whose spans hold most letters; the score is their
share of all letters.

Training counts trigrams and scripts per language over all labelled rows as Spark sums. All
languages are learnt; the model keeps the buckets that a language has and one number for all it has
not. More than ``MAX_LANGUAGES`` different labels are refused with an error, as they are no
languages and their sums would not fit the driver.

Most texts are in one language. Whether any detour through other languages could pay for its
switches is decided exactly from running sums; only where it could does the word by word
recursion run.

Defined results: null text or text without letters: ``und``, score 0, no spans. A numeral inside a
word ends it (``m²`` holds the word ``m``). Very long texts are scored whole, their distinct words
in bounded steps. Without any
labelled row every text is ``und``. Ties fall to the smaller language name. Repeated rows get
equal results. Extra columns are not touched.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import small_batches, text_udf

BUCKETS = 1 << 15
MAX_LANGUAGES = 10_000
#: Numbers that a worker scores at once, about.
CELLS = 1 << 22
#: Cost of a switch, in nats.
PENALTY = 15.0
#: A language is a candidate in a script that at least this share of its words is written in.
SCRIPT_SHARE = 0.01
#: A word's lead for languages outside its script's candidates.
OUTSIDE = -50.0
SMOOTHING = 0.5
UNKNOWN = "und"
#: Documents handled at once by a worker.
_SLICE = 256

#: Script ranges: (first code point, script). A range ends where the next one starts.
SCRIPT_STARTS = (
    (0x0000, "other"), (0x0041, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"),
    (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x323B0, "other"),
)
_STARTS = [s for s, _ in SCRIPT_STARTS]
_WORD = re.compile(r"[^\W\d_]+")


def script(word: str) -> str:
    return SCRIPT_STARTS[bisect_right(_STARTS, ord(word[0])) - 1][1]


def script_ranges(ws: list[str]) -> np.ndarray:
    """The entry of SCRIPT_STARTS that each word's first letter falls into."""
    first = np.fromiter((ord(w[0]) for w in ws), dtype=np.int64, count=len(ws))
    return np.searchsorted(_STARTS, first, side="right") - 1


def letters(text: str | None) -> list[str]:
    """The lower-cased words of a text. Numerals that the pattern lets through end a word."""
    found = _WORD.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for part in found for w in "".join(c if c.isalpha() else " " for c in part).split()]


def trigrams(ws: list[str]) -> np.ndarray:
    """Hashed trigrams of the words with a space at either end: as many per word as it has
    letters, in order."""
    u = np.frombuffer(f" {' '.join(ws)} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    code = u[:-2] * np.uint32(73_856_093) + u[1:-1] * np.uint32(19_349_663) + u[2:] * np.uint32(83_492_791)
    code = (code ^ (code >> np.uint32(15))) * np.uint32(2_654_435_761)
    return (code >> np.uint32(17))[u[1:-1] != 32]


@dataclass
class LanguageModel:
    names: list[str]
    #: log-likelihood per language of a bucket it was never seen with
    unseen: np.ndarray
    #: the buckets' languages, bucket after bucket: starts, language, what to add to ``unseen``
    starts: np.ndarray
    langs: np.ndarray
    more: np.ndarray
    #: per script the lead (0 or OUTSIDE) of each language
    leads: dict[str, np.ndarray]

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        """Log-likelihoods of the given buckets, a row each."""
        out = np.repeat(self.unseen[None, :], len(buckets), axis=0)
        n = self.starts[buckets + 1] - self.starts[buckets]
        row = np.repeat(np.arange(len(buckets)), n)
        at = np.repeat(self.starts[buckets] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out[row, self.langs[at]] += self.more[at]
        return out

    def word_scores(self, ws: list[str]) -> np.ndarray:
        out = np.empty((len(ws), len(self.names)), dtype=np.float32)
        sizes = np.array([len(w) for w in ws])
        ends = np.cumsum(sizes)
        grams = trigrams(ws)
        place = np.zeros(BUCKETS, dtype=np.int64)
        first, room = 0, max(CELLS // max(len(self.names), 1), 1)
        while first < len(ws):
            begin = ends[first] - sizes[first]
            stop = max(int(np.searchsorted(ends, begin + room, side="right")), first + 1)
            some = grams[begin : ends[stop - 1]]
            used = np.flatnonzero(np.bincount(some, minlength=BUCKETS))
            place[used] = np.arange(len(used))
            out[first:stop] = np.add.reduceat(self.rows(used)[place[some]], (ends - sizes)[first:stop] - begin, axis=0)
            first = stop
        lead = np.zeros((len(SCRIPT_STARTS), len(self.names)), dtype=np.float32)
        unknown = np.ones(len(SCRIPT_STARTS), dtype=bool)
        for i, (_, name) in enumerate(SCRIPT_STARTS):
            if name in self.leads:
                lead[i], unknown[i] = self.leads[name], False
        ranges = script_ranges(ws)
        out += lead[ranges]
        out[unknown[ranges]] = 0
        return out

    def spans(self, scores: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, language) runs of the best labelling of one text's words."""
        best = int(scores.sum(axis=0).argmax())
        if len(self.names) == 1 or not detour_pays(scores, best):
            return [(0, len(scores), best)]
        labels = viterbi(scores)
        cuts = np.flatnonzero(np.diff(labels)) + 1
        edges = [0, *map(int, cuts), len(labels)]
        return [(a, b, int(labels[a])) for a, b in zip(edges, edges[1:], strict=False)]


def detour_pays(scores: np.ndarray, best: int) -> bool:
    """False only if no labelling that leaves ``best`` anywhere can beat it: any stretch gains
    at most the pointwise best of the others, and pays one switch at either end within the text."""
    others = scores.copy()
    others[:, best] = -np.inf
    gain = np.concatenate(([0.0], np.cumsum(others.max(axis=1) - scores[:, best], dtype=np.float64)))
    lowest = np.minimum.accumulate(gain)
    return bool(
        gain.max() > PENALTY or gain[-1] - lowest[-1] > PENALTY or (gain - lowest).max() > 2 * PENALTY
    )


def viterbi(scores: np.ndarray) -> np.ndarray:
    """The labels with the greatest sum of scores less switching penalties. A step touches a few
    numbers only, for which plain lists are faster than arrays."""
    n, k = scores.shape
    stay = list(range(k))
    came: list[list[int]] = []
    rows = scores.tolist() if k <= 64 else (row.tolist() for row in scores)
    value: list[float] = []
    for row in rows:
        if not value:
            value = row
            continue
        best = max(value)
        switch = best - PENALTY
        if min(value) >= switch:
            came.append(stay)
            value = [v + r for v, r in zip(value, row, strict=True)]
        else:
            top = value.index(best)
            came.append([top if switch > v else i for i, v in enumerate(value)])
            value = [(switch if switch > v else v) + r for v, r in zip(value, row, strict=True)]
    out = np.zeros(n, dtype=np.int32)
    label = value.index(max(value))
    out[-1] = label
    for t in range(n - 1, 0, -1):
        label = came[t - 1][label]
        out[t - 1] = label
    return out


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageModel:
    """A model from all rows of ``docs`` with a language."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.where("lang is not null")
    names = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different languages")
    number = {name: i for i, name in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[str, np.ndarray] = {}
        scripts: Counter = Counter()

        def sums() -> Iterator[pd.DataFrame]:
            for lang, found in grams.items():
                at = np.flatnonzero(found)
                yield pd.DataFrame({"lang": shared.value[lang], "script": None, "bucket": at, "n": found[at]})
            if scripts:
                pairs, n = zip(*scripts.items(), strict=True)
                ids = [shared.value[a] for a, _ in pairs]
                yield pd.DataFrame({"lang": ids, "script": [b for _, b in pairs], "bucket": -1, "n": n})
            grams.clear()
            scripts.clear()

        for batch in batches:
            for at in range(0, len(batch), _SLICE):
                seen: dict[str, Counter] = {}
                for lang, text in batch.iloc[at : at + _SLICE][["lang", "_text"]].itertuples(index=False):
                    seen.setdefault(lang, Counter()).update(letters(text))
                for lang, found in seen.items():
                    ws = list(found)
                    if not ws:
                        continue
                    weight = np.repeat(list(found.values()), [len(w) for w in ws])
                    total = np.bincount(trigrams(ws), weights=weight, minlength=BUCKETS).astype(np.int64)
                    grams[lang] = grams.get(lang, 0) + total
                    held = np.bincount(script_ranges(ws), weights=list(found.values()), minlength=len(SCRIPT_STARTS))
                    for k in np.flatnonzero(held):
                        scripts[lang, SCRIPT_STARTS[k][1]] += int(held[k])
                if len(grams) * BUCKETS > 16 * CELLS:  # many languages: pass on what there is
                    yield from sums()
        yield from sums()

    small_batches(docs.sparkSession)
    counted = rows.mapInPandas(count, "lang int, script string, bucket int, n long")
    total = counted.groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n"))
    grams = total.where("bucket >= 0").select("lang", "bucket", "n").toPandas()  # those that occur
    grams = grams.sort_values(["bucket", "lang"])
    lang, bucket, n = (grams[c].to_numpy(dtype=np.int64) for c in ("lang", "bucket", "n"))
    mass = np.bincount(lang, weights=n, minlength=len(names)) + SMOOTHING * BUCKETS
    unseen = np.log(SMOOTHING / mass)
    more = np.log((n + SMOOTHING) / mass[lang]) - unseen[lang]
    starts = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))))
    leads = {}
    used = total.where("bucket < 0").select("lang", "script", "n").toPandas()  # languages x scripts
    totals = used.groupby("lang")["n"].sum()
    for name, part in used.groupby("script"):
        lead = np.full(len(names), OUTSIDE)
        for k, n in zip(part["lang"], part["n"], strict=True):
            if n >= SCRIPT_SHARE * totals[k]:
                lead[k] = 0.0
        if (lead == 0).any():
            leads[name] = lead.astype(np.float32)
    return LanguageModel(names, unseen.astype(np.float32), starts, lang.astype(np.int32), more.astype(np.float32), leads)


def label(model: LanguageModel, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans) per text; spans are ranges of its words."""
    vocabulary: dict[str, int] = {}
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in letters(t)], dtype=np.int64) for t in texts]
    if not vocabulary or not model.names:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    table = model.word_scores(list(vocabulary))
    sizes = np.array([len(w) for w in vocabulary])
    out = []
    for at in ids:
        if not len(at):
            out.append((UNKNOWN, 0.0, []))
            continue
        spans = model.spans(table[at])
        held = np.zeros(len(model.names))
        for a, b, k in spans:
            held[k] += sizes[at[a:b]].sum()
        best = int(held.argmax())
        out.append((model.names[best], float(held[best] / held.sum()), [(a, b, model.names[k]) for a, b, k in spans]))
    return out


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``spans`` (array of start, end, lang) added. Columns
    of these names that ``docs`` has already give way to the new ones."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pd.Series) -> pd.DataFrame:
        out = []
        # Fewer texts at once the more languages there are.
        step = max(1, _SLICE * 16 // max(16, len(shared.value.names)))
        for at in range(0, len(texts), step):
            out += label(shared.value, list(texts.iloc[at : at + step]))
        spans = [[{"start": a, "end": b, "lang": x} for a, b, x in s] for *_, s in out]
        return pd.DataFrame({"lang_pred": [x for x, *_ in out], "score": [s for _, s, _ in out], "spans": spans})

    schema = "lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>"
    predicted = text_udf(predict, schema)(F.col(text_col).cast("string"))
    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "spans", "_p")]
    return docs.select(*[F.col(f"`{c}`") for c in own], predicted.alias("_p")).select(*[f"`{c}`" for c in own], "_p.*")


def fold(id_col: Column) -> Column:
    """The id's fold, 0 to 2; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3))
