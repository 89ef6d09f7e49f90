"""Quality classifier from weak labels.

Nine overlapping heuristic labellers look at a whole text and vote good, bad or abstain.
Expectation-maximisation estimates how often each labeller votes bad on bad and on good documents,
and the share of good documents, from how often each combination of votes occurs over the whole
corpus (at most 3^9 counts, whatever the corpus size). Agreement tells the classes apart: it
starts from two bad votes or more, and a labeller that keeps voting bad alone comes out with false
alarms and is outvoted. Each kind of junk should therefore show in two labellers. The posterior of a document's votes is its label, and these labels
train a hashed linear scorer (logistic regression over hashed trigrams of character classes and
binned statistics). The scorer decides.

Statistics and features count characters (code points), not bytes, and know the sentence marks of
all scripts. Where most letters are of scripts without spaces between words, the labellers for
word length and sentence ends abstain: tokens are no words there.

The scorer is fitted on a sample of about ``TRAIN_ROWS`` documents, chosen by a hash of id and
text, repeated rows once; votes are counted and scores given over all rows.

Defined results: a text without any word (null, empty, separators only) scores 0 and is
rejected; repeated rows get equal scores; an empty table yields an empty table. Scores depend on
the text alone. Very long texts are measured whole. Extra columns are not touched; one named like
the score's column gives way to it, unless it is the text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import map_rows, text_udf

#: Bound of the training sample, in documents.
TRAIN_ROWS = 10_000
#: Hashed dimensions of the character class trigrams; statistics follow behind them.
SHAPES = 4096
BINS = 16
MIN_SCORE = 0.5

STATISTICS = (
    "symbols", "capitals", "bare", "stutter", "ratio", "repeated_lines", "word_length", "sentence_ends", "runs",
)
N_FEATURES = SHAPES + BINS * len(STATISTICS) + 1

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_DIGITS = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_PLAIN_MARKS = b".,;:'\"?-()"


def _classes() -> bytes:
    """A small class for each byte: letters by case, digits, spaces, beyond ASCII, and each
    ASCII mark its own."""
    out = bytearray(range(256))
    for b in range(256):
        c = bytes([b])
        if b >= 0x80:
            out[b] = 1
        elif c in _LETTERS:
            out[b] = 2 if c.isupper() else 1
        elif c in _DIGITS:
            out[b] = 3
        elif b == 0x0A:
            out[b] = 4
        elif c in _SPACE:
            out[b] = 5
    return bytes(out)


_CLASS = _classes()
#: Spaces, sentence ends, other marks, and "a" for all the rest.
_SHAPE = bytes(
    0x20 if bytes([b]) in _SPACE else 0x2E if b in b".?!" else 0x61 if c in (1, 2, 3) else 0x23
    for b, c in enumerate(_CLASS)
)
_BARE = re.compile(rb" [#.]+(?= )")
#: The same mark twice in a row; full stops, hyphens and underscores make lines and ellipses.
_RUN = re.compile(rb"([!-,/:-@\[-^`{-~])\1+")
#: Bytes that continue a character in UTF-8; all others begin one.
_CONTINUE = bytes(range(0x80, 0xC0))
#: Marks that end a sentence beyond ASCII (Unicode's Sentence_Terminal), one or more in a row.
_ENDS = re.compile(
    "[\u037e\u0589\u061d-\u061f\u06d4\u0700-\u0702\u07f9\u0837\u0839\u083d\u083e\u0964\u0965\u104a\u104b"
    "\u1362\u1367\u1368\u166e\u1735\u1736\u17d4\u17d5\u1803\u1809\u1944\u1945\u1aa8-\u1aab\u1b5a\u1b5b"
    "\u1b5e\u1b5f\u1c3b\u1c3c\u1c7e\u1c7f\u203c\u203d\u2047-\u2049\u2e2e\u2e3c\u3002\ua4ff\ua60e\ua60f"
    "\ua6f3\ua6f7\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c8\ua9c9\uaa5d-\uaa5f\uaaf0\uaaf1\uabeb\ufe52\ufe56"
    "\ufe57\uff01\uff0e\uff1f\uff61]+"
)
#: Characters of scripts without spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer and
#: their neighbours, kana, bopomofo, Han, Yi, Javanese and others.
_UNSPACED = re.compile(
    "[\u0e01-\u0e4e\u0e81-\u0edf\u0f00-\u0fbc\u1000-\u109f\u1780-\u17d3\u1950-\u19df\u1a20-\u1aad"
    "\u1b00-\u1b4c\u3005-\u3007\u3031-\u3035\u3041-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua48c\ua980-\ua9c0\ua9e0-\ua9fe\uaa60-\uaadf\uf900-\ufaff"
    "\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]+"
)
_WORD = re.compile(r"[^\W\d_]+")


def _other_scripts(text: str) -> tuple[bool, int]:
    """Whether most letters are of scripts without spaces between words, and how many sentence
    ends have other marks than ASCII's."""
    ends = len(_ENDS.findall(text))
    unspaced = sum(map(len, _UNSPACED.findall(text)))
    # Letters that are left; vowel signs and tone marks of the removed scripts go with them.
    return unspaced > 0 and unspaced > sum(map(len, _WORD.findall(_UNSPACED.sub(" ", text)))), ends


def statistics(text: str | None) -> tuple[float, ...] | None:
    """The labellers' measurements of a whole text, in the order of STATISTICS; None without
    words. NaN where a statistic says nothing (too short a text)."""
    data = (text or "").encode("utf-8", "replace")
    tokens = data.split()
    solid = len(data.translate(None, _SPACE))
    marks = len(data.translate(None, _SPACE + _LETTERS + _DIGITS + bytes(range(128, 256))))
    if solid == marks:
        return None
    plain = len(data) - len(data.translate(None, _PLAIN_MARKS))
    letters = len(data) - len(data.translate(None, _LETTERS))
    capitals = len(data) - len(data.translate(None, _LETTERS[:26]))
    n, nan = len(tokens), float("nan")
    lines = [x for x in data.split(b"\n") if x.strip()]
    again = len(data) - sum(map(len, set(lines))) - (len(lines) - 1) if len(lines) > 1 else 0
    shape = data.translate(_SHAPE)
    ends = shape.count(b". ") + shape.endswith(b".")
    bare = len(_BARE.findall(b" " + shape + b" "))
    continued = 0 if data.isascii() else len(data) - len(data.translate(None, _CONTINUE))
    unspaced = False
    if continued:
        unspaced, more = _other_scripts(text)
        ends += more
    solid -= continued
    return (
        (marks - plain) / solid,
        capitals / letters if letters >= 20 else nan,
        bare / n,
        sum(map(eq, tokens, tokens[1:])) / (n - 1) if n >= 8 else nan,
        # By characters, as all of a script's letters begin with the same bytes; one with more than
        # a byte of news says no more than that it does not repeat.
        min(len(zlib.compress(data, 1)) / (len(data) - continued), 1.0) if len(data) >= 400 else nan,
        again / len(data) if len(lines) > 3 else nan,
        nan if unspaced else solid / n,
        nan if unspaced or n < 30 else ends / n,
        len(_RUN.findall(data)) / n,
    )


#: Per statistic: bad below, good from, good to, bad above. Between them a labeller abstains.
LIMITS = {
    "symbols": (-1.0, 0.0, 0.02, 0.06),
    "capitals": (-1.0, 0.0, 0.25, 0.5),
    "bare": (-1.0, 0.0, 0.04, 0.15),
    "stutter": (-1.0, 0.0, 0.03, 0.15),
    "ratio": (0.22, 0.34, 1.5, 2.0),
    "repeated_lines": (-1.0, 0.0, 0.2, 0.5),
    "word_length": (2.0, 3.0, 10.0, 14.0),
    "sentence_ends": (0.004, 0.02, 0.35, 0.6),
    "runs": (-1.0, 0.0, 0.02, 0.1),
}
GOOD, BAD, ABSTAIN = 1, 0, 2
#: What is assumed of a labeller before any vote: so many votes, so many of them bad, on good and on
#: bad documents. Some thousand documents overrule it.
ON_GOOD, ON_BAD = (100, 0.2), (10, 3.0)


def votes(stats: tuple[float, ...]) -> tuple[int, ...]:
    out = []
    for name, value in zip(STATISTICS, stats, strict=True):
        low, start, end, high = LIMITS[name]
        if start <= value <= end:
            out.append(GOOD)
        else:
            out.append(BAD if value < low or value > high else ABSTAIN)
    return tuple(out)


@dataclass
class LabelModel:
    """Two classes; per labeller the chance of a bad vote when it votes, on good and bad documents."""

    prior: float = 0.5
    on_good: np.ndarray = field(default_factory=lambda: np.full(len(STATISTICS), 0.5))
    on_bad: np.ndarray = field(default_factory=lambda: np.full(len(STATISTICS), 0.5))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good | votes) per row; abstentions say nothing."""
        bad, good = (patterns == BAD).astype(float), (patterns == GOOD).astype(float)
        for_good = np.log(self.prior) + bad @ np.log(self.on_good) + good @ np.log(1 - self.on_good)
        for_bad = np.log(1 - self.prior) + bad @ np.log(self.on_bad) + good @ np.log(1 - self.on_bad)
        return 1 / (1 + np.exp(np.clip(for_bad - for_good, -500, 500)))


def fit_label_model(counts: dict[tuple[int, ...], int], rounds: int = 500) -> LabelModel:
    """EM over vote patterns and how often each occurs. It starts from agreement: two bad votes or
    more make a bad document, one leaves it open. A labeller that votes bad on bad documents no
    more than on good ones is taken to say nothing."""
    if not counts:
        return LabelModel()
    patterns, weight = np.array(list(counts)), np.array(list(counts.values()), dtype=float)
    bad, good = (patterns == BAD).astype(float), (patterns == GOOD).astype(float)
    q = np.select([bad.sum(axis=1) >= 2, bad.sum(axis=1) == 1], [0.05, 0.4], 0.98)
    for _ in range(rounds):
        prior = float(np.clip((weight * q).sum() / weight.sum(), 1e-3, 1 - 1e-3))
        rates = []
        for share, (votes_before, bad_before) in ((q, ON_GOOD), (1 - q, ON_BAD)):
            mass = weight * share
            rates.append((mass @ bad + bad_before) / (mass @ (bad + good) + votes_before))
        model = LabelModel(prior, rates[0], np.maximum(rates[1], rates[0]))
        old, q = q, model.posterior(patterns)
        if np.abs(q - old).max() < 1e-9:
            break
    return model


def features(text: str, stats: tuple[float, ...]) -> np.ndarray:
    """Dense hashed features: square roots of trigram shares, one bin per statistic, a constant."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    c = np.frombuffer(text.encode("utf-8", "replace").translate(_CLASS, _CONTINUE), np.uint8).astype(np.uint32)
    if len(c) >= 3:
        code = c[:-2] * np.uint32(65_599) + c[1:-1] * np.uint32(2_654_435_761) + c[2:] * np.uint32(40_503)
        code = (code * np.uint32(2_246_822_519)) >> np.uint32(20)
        out[:SHAPES] = np.sqrt(np.bincount(code, minlength=SHAPES) / len(code))
    for j, (name, value) in enumerate(zip(STATISTICS, stats, strict=True)):
        low, start, end, high = LIMITS[name]
        if value == value:
            top = high * 1.5
            bottom = max(low, 0.0) * 0.5
            k = min(max(int((value - bottom) / (top - bottom) * (BINS - 1)), 0), BINS - 2)
        else:
            k = BINS - 1
        out[SHAPES + j * BINS + k] = 1.0
    out[-1] = 1.0
    return out


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, steps: int = 150) -> np.ndarray:
    """Logistic regression on soft labels by Adam over all rows; rows are (index, value)."""
    w = np.zeros(N_FEATURES)
    if not rows:
        w[-1] = 1.0
        return w
    index = np.concatenate([i for i, _ in rows])
    value = np.concatenate([v for _, v in rows]).astype(float)
    row = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    # Both classes weigh alike, so that rare junk is learnt without tilting the threshold.
    mass = np.where(target >= 0.5, 0.5 / max((target >= 0.5).sum(), 1), 0.5 / max((target < 0.5).sum(), 1))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=w[index] * value, minlength=len(rows))
        error = mass * (1 / (1 + np.exp(-z)) - target)
        grad = np.bincount(index, weights=error[row] * value, minlength=N_FEATURES) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        stats = statistics(text)
        if stats is None:
            return 0.0
        z = float(features(text, stats) @ self.weights)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def vote_counts(docs: DataFrame, text_col: str = "text") -> dict[tuple[int, ...], int]:
    """How many documents got each combination of votes, over all documents."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        seen: dict[str, int] = {}
        for text in batch["_text"]:
            if (stats := statistics(text)) is not None:
                key = "".join(map(str, votes(stats)))
                seen[key] = seen.get(key, 0) + 1
        return pd.DataFrame({"votes": list(seen), "n": list(seen.values())})

    text = docs.select(F.col(text_col).cast("string").alias("_text"))
    sums = map_rows(text, count, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    return {tuple(map(int, r["votes"])): r["n"] for r in sums.collect()}  # at most 3^9 rows


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> QualityModel:
    counts = vote_counts(docs, text_col)
    labels, total = fit_label_model(counts), sum(counts.values())
    share = min(1.0, train_rows / total) if total else 0.0
    text = F.col(text_col).cast("string")
    key = F.xxhash64(F.col(id_col), text, F.lit("train"))
    rows = docs.select(key.alias("_key"), text.alias("_text"))
    sample = rows.where(F.pmod("_key", F.lit(1 << 40)) < int(share * (1 << 40)))
    sample = sample.groupBy("_key").agg(F.first("_text").alias("_text")).select("_text")

    def sparse(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in batch["_text"]:
            if (stats := statistics(text)) is not None:
                x = features(text, stats)
                at = np.flatnonzero(x)
                out.append((list(votes(stats)), at.astype(np.int32), x[at]))
        return pd.DataFrame(out, columns=["votes", "at", "value"])

    rows = map_rows(sample, sparse, "votes array<int>, at array<int>, value array<float>").toPandas()
    if not len(rows):
        return QualityModel(labels, fit_scorer([], np.zeros(0)))
    target = labels.posterior(np.array(rows["votes"].tolist()))
    pairs = [(np.asarray(a), np.asarray(v)) for a, v in zip(rows["at"], rows["value"], strict=True)]
    return QualityModel(labels, fit_scorer(pairs, target))


def scored(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the scorer's estimate, 0 to 1, in the new column ``name``, which must not be that
    of the text."""
    if name == text_col:
        raise ValueError(f"the score needs another column than the text's, {text_col!r}")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return docs.withColumn(name, text_udf(score, "double")(F.col(text_col).cast("string")))


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches MIN_SCORE, all columns unchanged."""
    inner = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"))
    model = fit(docs, id_col, text_col)
    return scored(inner, model, "_text", "_score").where(F.col("_score") >= MIN_SCORE).select("_row.*")
