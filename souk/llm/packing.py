"""Best-two-fit packing of tokenised documents into sequences of ``CAPACITY`` tokens.

Lengths are integers from 1 to the capacity, so the corpus is packed through its histogram of
lengths: one number per length, whatever the corpus size. The plan is a list of patterns (which
lengths share a sequence) with a multiplicity each:

* a sequence starts with the longest unpacked length and is filled greedily with the longest
  one that fits;
* if a gap is left, its smallest document is taken out when two unpacked documents fit the
  expanded gap at least twice as tightly, and the tightest two go in (a smaller gain is not worth
  two short documents);
* the pattern is repeated for as long as its lengths last.

Each repetition run uses up a length, so the plan has a few patterns per length at most; it
is the only thing that is broadcast. Pieces find their place by their rank within their length,
ranked in salted groups, so that neither a frequent length nor a large group of copies meets in
one task. Token ids never leave the task that made them, unless asked for.

Tokenising: ids are those of ``tokenizers`` with ``add_special_tokens=False``; a special token's string
inside a text is that token. Where a tokenizer file is a byte-level BPE whose ids ascend in merge
order and whose every token encodes to itself, any two neighbours that make up a token are that
token's own merge, so merging by id, as ``tiktoken`` does, takes the same steps; it is used for such
files because it is faster. For all others ``tokenizers`` itself encodes. Nothing is remembered
between texts.

Defined results: null text is empty; an empty document is the end id alone. Longer documents
are cut into full pieces after a first one that may be shorter. Repeated rows are packed one
by one. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import map_rows, written

CAPACITY = 1024
END_ID = 2
#: Pieces in a salted group that is ranked together, about.
RANK_GROUP = 20_000
#: Texts encoded together.
_SLICE = 64

#: Fixed value: how a byte-level pre-tokeniser splits a text.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes of Latin-1 are
    themselves, the others follow each other from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _is_plain(spec: dict, key: str, **values) -> bool:
    part = spec.get(key) or {}
    return all(part.get(k, v) == v for k, v in values.items())


def by_merge_order(path: str, tokenizer):
    """A ``tiktoken`` encoding with the ids of the tokenizer file, or None where merging by id is
    not the same (see above)."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, added = spec["model"].get("vocab"), spec.get("added_tokens") or []
    same = (
        spec["model"].get("type") == "BPE"
        and not spec.get("normalizer")
        and _is_plain(spec, "pre_tokenizer", type="ByteLevel", add_prefix_space=False, use_regex=True)
        and _is_plain(
            spec, "model", dropout=None, continuing_subword_prefix=None, end_of_word_suffix=None, ignore_merges=False
        )
        and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not same:
        return None
    alphabet, special = byte_alphabet(), {t["content"]: t["id"] for t in added}
    tokens = {t: i for t, i in vocab.items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [tokens.get(a + b, -1) for a, b in merges]
    bytes_first = all(len(t) == 1 for t, i in tokens.items() if i < 256) and sum(len(t) == 1 for t in tokens) == 256
    if not bytes_first or made != sorted(set(made)) or len(made) + 256 != len(tokens):
        return None
    if any([x.id for x in tokenizer.model.tokenize(t)] != [i] for t, i in tokens.items()):
        return None
    ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in tokens.items()}
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special)


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, one per worker and tokenizer file."""

    _cached: dict[str, Encoder] = {}

    def __init__(self, path: str):
        # One thread per task: Spark spreads the work.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = by_merge_order(path, self.tokenizer)

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._cached:
            cls._cached[path] = cls(path)
        return cls._cached[path]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.fast:
            found = (self.fast.encode_to_numpy(t, allowed_special="all") for t in texts)
        else:
            found = (e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        return [np.asarray(ids, dtype="<u4").tobytes() for ids in found]


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter than full."""
    first = n_ids % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n_ids, capacity))]


def tokenised_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and the ids if asked for."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def pieces(batch: pd.DataFrame) -> pd.DataFrame:
        encoder, out = Encoder.of(tokenizer), []
        for at in range(0, len(batch), _SLICE):
            some = batch.iloc[at : at + _SLICE]
            encoded = encoder.encode([t or "" for t in some["_text"]])
            for doc_id, ids in zip(some["doc_id"].array, encoded, strict=True):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + n)]
                    row = (doc_id, k, start, n, zlib.crc32(part))
                    out.append((*row, np.frombuffer(part, "<u4").astype(np.int64)) if with_ids else row)
        made = pd.DataFrame(out, columns=columns)
        return made.astype({"doc_id": batch["doc_id"].dtype})

    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<long>" if with_ids else ""
    # Ids travel as strings: pandas would turn integers beside nulls into floats.
    rows = docs.select(
        F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("_text")
    )
    made = map_rows(rows, pieces, schema.replace(f"doc_id {id_type}", "doc_id string"))
    return made.withColumn("doc_id", F.col("doc_id").cast(id_type))


@dataclass
class Plan:
    """Where the pieces of each length go: run ``i`` of a length starts at its rank
    ``first[length][i]`` and fills sequences from ``sequence[length][i]`` on, at ``offset``."""

    first: dict[int, np.ndarray]
    sequence: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]
    sequences: int


def _longest_upto(left: np.ndarray) -> np.ndarray:
    """For each x the longest length <= x with something left (0: none)."""
    lengths = np.arange(len(left))
    return np.maximum.accumulate(np.where(left > 0, lengths, 0))


def _tightest_two(left: np.ndarray, room: int) -> tuple[int, int]:
    """The two unpacked lengths whose sum comes nearest to ``room`` from below (0, 0: none); of
    equally tight pairs the one with the longest, as long ones are hardest to place later."""
    upto = _longest_upto(left)
    a = np.flatnonzero(left[: max(room, 1)])
    a = a[a > 0]
    if not len(a):
        return 0, 0
    b = upto[np.minimum(room - a, a)]
    b = np.where((b == a) & (left[a] < 2), upto[a - 1], b)
    total = np.where(b > 0, a + b, 0)
    best = len(total) - 1 - int(total[::-1].argmax())
    return (int(a[best]), int(b[best])) if total[best] else (0, 0)


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns (lengths in a sequence) with their multiplicity."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    total, patterns = left.copy(), []
    while longest := int(_longest_upto(left)[capacity]):
        pattern, gap = [longest], capacity - longest
        left[longest] -= 1
        while gap and (fit := int(_longest_upto(left)[gap])):
            pattern.append(fit)
            left[fit] -= 1
            gap -= fit
        if gap and len(pattern) > 1:
            smallest = pattern[-1]
            a, b = _tightest_two(left, gap + smallest)
            if a and 2 * (gap + smallest - a - b) <= gap:
                pattern[-1:] = [a, b]
                left[[smallest, a, b]] += np.array([1, 0, 0])
                left[a] -= 1
                left[b] -= 1
        uses = np.bincount(pattern, minlength=capacity + 1)
        used = np.flatnonzero(uses)
        again = int((left[used] // uses[used]).min())
        left -= uses * again
        patterns.append((pattern, again + 1))
    assert sum(m * sum(p) for p, m in patterns) == int((total * np.arange(capacity + 1)).sum())
    return patterns


def plan_of(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequences = 0
    for pattern, times in best_two_fit(counts, capacity):
        at = 0
        for length in pattern:
            runs.setdefault(length, []).append((times, sequences, at))
            at += length
        sequences += times
    first, sequence, offset = {}, {}, {}
    for length, rows in runs.items():
        times, where, at = np.array(rows, dtype=np.int64).T
        first[length], sequence[length], offset[length] = np.cumsum(times) - times, where, at
    return Plan(first, sequence, offset, sequences)


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """Adds ``rank``, 0, 1, ... within each length, over salted groups of pieces. Salts come from a
    piece's ``place`` in the written table, so repeated rows spread as well."""
    salts = -(-max(total, 1) // RANK_GROUP)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("place"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32", "place")
    numbered = salted.withColumn("_row", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["length", "_salt"]).withColumn("rank", F.col("_row") + F.col("_start"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    made = tokenised_pieces(docs, tokenizer, id_col, text_col, capacity, with_ids)
    pieces = written(made.withColumn("place", F.monotonically_increasing_id()), "pack-pieces")
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.sparkContext.broadcast(plan_of(counts, capacity))

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((2, len(length)), dtype=np.int64)
        lengths, ranks, p = length.to_numpy(), rank.to_numpy(), plan.value
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            run = np.searchsorted(p.first[n], ranks[at], side="right") - 1
            out[0, at] = p.sequence[n][run] + ranks[at] - p.first[n][run]
            out[1, at] = p.offset[n][run]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    placed = F.pandas_udf(place, "sequence_id long, offset long")(F.col("length"), F.col("rank"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = ranked(pieces, sum(counts.values())).withColumn("_place", placed)
    return rows.select(*names, "_place.*", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, from ``pack(..., with_ids=True)``; a group holds at most
    the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
