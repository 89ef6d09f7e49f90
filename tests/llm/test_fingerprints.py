"""Fingerprints: against plain Python, merging, estimates, and a plan without Python."""

import hashlib

import brute
import pytest
from pyspark.sql import functions as F

from souk.llm import fingerprints as fp


def key(row):
    return tuple((v is not None, v) for v in row)


def compared(frame):
    return sorted((tuple(r)[:7] for r in fp.compare_edited(frame).collect()), key=key)


def test_odd_rows(odd, empty):
    rows = [(r[0], r[1]) for r in brute.odd_documents()]
    assert compared(odd) == sorted(brute.compared_fingerprints(rows), key=key)
    assert compared(empty) == []


def test_one_document_is_its_own_next(spark):
    frame = spark.createDataFrame([(7, "a b c d e f g")], "doc_id long, text string")
    [r] = fp.compare_edited(frame).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b c da b c ").hexdigest()


def test_text_ids(spark):
    frame = spark.createDataFrame([("b", "x"), ("a", "y y"), (None, "z z z")], "doc_id string, text string")
    got = {r.doc_id: r.edited_sha256 for r in fp.compare_edited(frame).collect()}
    want = {"b": "x", "a": "y x", None: "z zy "}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def texts_of(spark):
    a = " ".join(f"w{i}" for i in range(3000))
    b = " ".join(f"w{i}" for i in range(1500, 4500))
    return spark.createDataFrame([(a, b)], "a string, b string")


def test_estimates(spark):
    """1,500 - 4 of 4,500 shingles are shared; a's are about half in b."""
    a, b = fp.sketch(F.col("a")), fp.sketch(F.col("b"))
    frame = texts_of(spark).select(
        fp.resemblance(a, b).alias("r"), fp.containment(a, b).alias("c"), fp.distinct_shingles(a).alias("n"),
        fp.resemblance(a, a).alias("same"),
    )
    [row] = frame.collect()
    assert row.r == pytest.approx(1 / 3, abs=0.13) and row.c == pytest.approx(0.5, abs=0.2)
    assert row.n == pytest.approx(2996, rel=0.3) and row.same == 1.0


def test_parts_merge_to_the_whole(spark):
    """Sketches of overlapping parts, merged by column and by key, are the whole text's."""
    ws = [f"w{i * i % 701}" for i in range(2000)]
    parts = [("k", " ".join(ws[i : i + 204])) for i in range(0, 2000, 200)] + [("short", "one two"), ("none", "-"), (None, "x")]
    frame = spark.createDataFrame(parts, "key string, text string").select("key", fp.sketch(F.col("text")).alias("sketch"))
    got = {r.key: r.sketch for r in fp.merge_parts(frame, "key", salts=3).collect()}
    assert got == {"k": brute.sketch(" ".join(ws)), "short": brute.sketch("one two"), "none": [], None: brute.sketch("x")}
    pair = spark.createDataFrame([(parts[0][1], parts[1][1])], "a string, b string")
    [m] = pair.select(fp.merged(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("m")).collect()
    assert m.m == brute.sketch(" ".join(ws[:404]))
    back = frame.select("sketch", fp.hashes(fp.fingerprint(F.col("sketch"))).alias("again")).collect()
    assert all(r.sketch == r.again for r in back)


def test_no_python_in_the_plan(odd):
    plan = fp.compare_edited(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
