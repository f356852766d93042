"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

import os
import zlib

import numpy as np
import pytest
from oracle import compare, connect

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from midyear.llm.catalog import ORACLES, QUERIES
from midyear.llm.decontamination import RUN
from midyear.llm.simhash import fingerprint
from test_texts import _hits, _late_lines

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_as_in_sql(spark, name):
    assert not compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name])[1]


def test_simhash_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    points = {d: fingerprint(t.encode()) & (2**64 - 1) for d, t in docs.items()}
    component = {d: d for d in docs}

    def find(d):
        while component[d] != d:
            d = component[d]
        return d

    for a in docs:
        for b in docs:
            if a < b and bin(points[a] ^ points[b]).count("1") <= 2:
                x, y = find(a), find(b)
                component[max(x, y)] = min(x, y)
    for r in QUERIES["op1_simhash"](spark, SF).collect():
        assert (r.fingerprint, r.component_id) == (f"{points[r.doc_id]:016x}", find(r.doc_id))


def test_spark_has_the_same_shingle_hash(spark):
    import xxhash

    got = spark.sql("SELECT xxhash64('a b é') AS h").first().h
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest("a b é".encode(), 42)


def test_every_query_is_registered():
    names = {name.split("_")[0] for name in queries()}
    assert {f"op{n}" for n in range(1, 14)} <= names and "pipeline" in queries()
    assert set(ORACLES) <= set(oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination",
        "mixing sources to target weights"]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = {r.doc_id for r in QUERIES["op5_quality_rules"](spark, SF).filter("kept").collect()}
    left = corpus_pipeline.quality(spark, docs, SF)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == judged

    texts = sorted((r.doc_id, r.text) for r in left.collect())
    late = _late_lines(texts, (4, 5))
    plain = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in late) for d, t in texts}
    lined = corpus_pipeline.lines(spark, left, SF)
    got = {r.doc_id: r for r in lined.collect()}
    assert {d: r.text for d, r in got.items()} == {d: t for d, t in plain.items() if t.split()}
    assert all(r.n_chars == len(r.text) for r in got.values())

    points = {d: np.uint64(fingerprint(r.text.encode()) & (2**64 - 1)) for d, r in got.items()}
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, lined, SF).collect()}
    assert kept <= set(points)
    for d in set(points) - kept:  # a document that goes has one before it in its group
        assert any(e != d and np.bitwise_count(points[d] ^ points[e]) <= 2 for e in points)
    for d in kept:
        assert not any(e < d and np.bitwise_count(points[d] ^ points[e]) <= 2 for e in kept)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id: r.text for r in corpus_pipeline.decontaminate(spark, lined, SF).collect()}
    for d, r in got.items():
        words = _hits(r.text, items, 10)[3]
        if words:
            assert [w.decode() for w in (x.lower() for x in RUN.findall(clean[d].encode()))] == words
        else:
            assert d not in clean or not _hits(r.text, [], 10)[0]

    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(0 < r.taken <= 2 * r.size for r in rows)


def test_rollup_query_against_a_recount(spark):
    from midyear.llm.rollup import rank_counter

    counters = {"words-1": lambda t: len(t.encode().split()), "byte_bpe_multi_50k-1": rank_counter("byte_bpe_multi_50k")()}
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        crc = zlib.crc32(str(r.doc_id).encode())
        if crc % 5 != 1 and crc % 7 == 3:
            continue
        text = r.text if crc % 5 != 1 else "\n".join([r.text] * 2) if r.text is not None else ""
        for name, count in counters.items():
            n, tokens = want.get((r.source, r.lang, name), (0, 0))
            want[r.source, r.lang, name] = (n + 1, tokens + count(text or ""))
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in QUERIES["op2_token_rollup"](spark, SF).collect()}
    assert got == want
