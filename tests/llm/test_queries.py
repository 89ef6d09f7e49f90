"""Registered queries against their SQL, and the pipeline against plain Python."""

import os
import sys

import brute
import public_tokenizers
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

from compare import digest, duck  # noqa: E402

import corpus_pipeline  # noqa: E402
from souk.llm import common, quality  # noqa: E402
from souk.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = os.environ.get("SOUK_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, key):
    frame = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in frame.collect()]
    table = {"op2_warc_zip": "pages", "op7_url_filter": "pages", "op13_vector_codes": "embeddings"}.get(key, "documents")
    total = common.read_table(spark, SF, table).count()
    assert len(rows) >= total if key == "op6_best_fit_pack" else len(rows) == total
    if key in ORACLE_SQL:
        cur = duck(SF).execute(ORACLE_SQL[key])
        names = [d[0] for d in cur.description]
        want = cur.fetchall()
        assert sorted(names) == sorted(frame.columns)
        assert digest(frame.columns, rows)[0] == digest(names, want)[0]


def test_entry_registers_all(spark):
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


def by_hand(spark, rows, items):
    """The documents that every stage but packing keeps; rows: (doc_id, text)."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(frame)
    rows = [r for r in rows if model.score(r[1]) >= quality.MIN_SCORE]
    verdict = brute.exact_groups(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault((i, brute.SPACES.sub("", t or "")), t)
    import hashlib

    sha = {(i, hashlib.sha256(n.encode()).hexdigest()): t for (i, n), t in texts.items()}
    rows = [(v[0], sha[v[0], v[4]]) for v in verdict if v[3]]
    classes = brute.near_classes(rows)
    rows = [r for r in rows if r[0] is None or classes[r[0]] == r[0]]
    return [r for r in rows if not brute.contamination(r[1], items)[-1]]


def test_pipeline_on_the_documents(spark):
    docs = common.read_table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in common.read_table(spark, SF, "benchmark").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = by_hand(spark, rows, items)
    packed = corpus_pipeline.run(spark, SF).collect()
    used, least = brute.check_packing(kept, packed, public_tokenizers.path("byte_bpe_50k.json"))
    assert used <= least + 1 and 0 < len(kept) < len(rows)


def test_stages_on_odd_rows(spark, odd, empty):
    for frame in (odd, empty):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.written(stage(spark, docs, SF), f"test-{name}")
            assert docs.columns == frame.columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert {"doc_id", "sequence_id", "offset"} <= set(out.columns)
        assert (out.count() > 0) == (docs.count() > 0)
