"""Merkle manifest: against plain Python, odd rows, multiproofs, and several levels of building."""

import hashlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def run(frame, **kw):
    cols = [F.col(c) for c in FIELDS]
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(frame, merkle.leaf_hash(*cols), F.when(even, merkle.leaf_hash(*cols[:-1], cut)), **kw)


def key(row):
    return tuple((v is not None, v) for v in row)


def rows_of(frame):
    return sorted((tuple(r)[:7] for r in frame.collect()), key=key)


def test_odd_rows(odd, empty):
    """Null groups, ids and texts, repeated rows and ids, and columns with clashing names."""
    want = sorted(brute.merkle_manifest(brute_rows()), key=key)
    assert rows_of(run(odd)) == want
    assert run(empty).count() == 0


def brute_rows():
    return [(i, s, lang, n, t) for i, t, lang, s, n in brute.odd_documents()]


@pytest.mark.parametrize(("step", "part"), [(1, 2), (2, 5), (6, 4096)])
def test_levels_and_parts(spark, step, part):
    """Trees over several jobs and parts give the same hashes, whatever the cut."""
    sizes = {None: 1, "a": 1, "hot": 31, "m": 9, "z": 10}
    rows = [(i, s, "en", i, f"line {i}\nnext") for s, n in sizes.items() for i in range(100, 100 + n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = run(frame.repartition(3), with_proof=True, step=step, part_size=part).collect()
    bare = [(*r[:6], r.verified) for r in got]
    assert sorted(bare, key=key) == sorted(brute.merkle_manifest(rows), key=key)
    for r in got:
        assert merkle.fold(r.leaf, r.proof) == r.root
        assert hashlib.sha256("".join(a + b for a, b in r.proof).encode()).hexdigest() == r.proof_sha256


def test_a_single_row(spark):
    rows = [(2, "a", "en", 1, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    [r] = run(frame).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_octopus_is_minimal():
    """Every requested node is needed by some proof and not derivable; together they suffice."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 4, 10, 27, 82, 500):
        chosen = np.unique(rng.integers(0, n, max(1, n // 7)))
        asked = {(level, int(p)) for level, pos in merkle.missing_nodes(chosen, n) for p in pos}
        known, need = set(map(int, chosen)), set()
        for level, size in enumerate(merkle.level_sizes(n)[:-1]):
            beside = {q for p in known for q in range(p // 3 * 3, min(p // 3 * 3 + 3, size))}
            need |= {(level, q) for q in beside - known}
            known = {p // 3 for p in known}
        assert asked == need
