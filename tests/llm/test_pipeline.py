"""The pipeline stage by stage against brute force, on odd rows and on empty tables."""

import os
import sys

import corpus_pipeline as P

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_on_small_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    one = P.identify_language(spark, docs, SF)
    kept = {r["doc_id"] for r in one.collect()}
    assert one.columns == docs.columns and kept <= set(rows) and len(kept) >= 0.95 * len(rows)
    two = P.drop_exact_copies(spark, docs, SF)
    last = {}
    for i, r in rows.items():
        last[brute.lower(r["text"])] = max(i, last.get(brute.lower(r["text"]), -1))
    assert two.columns == docs.columns and sorted(r["doc_id"] for r in two.collect()) == sorted(last.values())
    three = P.drop_near_copies(spark, docs, SF)
    want = sorted({c for _, _, c in brute.near([(i, r["text"]) for i, r in rows.items()], width=5)})
    assert three.columns == docs.columns and sorted(r["doc_id"] for r in three.collect()) == want
    four = P.mix_sources(spark, docs, SF)
    assert four.columns == docs.columns and {tuple(r) for r in four.collect()} <= {tuple(r) for r in docs.collect()}
    five = P.tokenise(spark, docs, SF)
    tokens = {i: (n, s) for i, n, s, _ in brute.bpe([(i, r["text"]) for i, r in rows.items()])}
    for r in five.collect():
        assert (r["n_tokens"], brute.sha(bytes(r["ids"]))) == tokens[r["doc_id"]]
        assert r["decoded_sha256"] == brute.sha(rows[r["doc_id"]]["text"])


def test_run_and_odd_tables(spark):
    result = P.run(spark, SF)
    assert result.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and result.count() > 0
    for rows in ([], brute.rows()):
        docs = spark.createDataFrame(rows, brute.SCHEMA)
        for name, out in P.results(spark, docs, SF):
            assert out.columns == (["doc_id", "n_tokens", "ids", "decoded_sha256"] if name == "bpe" else brute.SCHEMA.names), name
            if name == "bpe":
                assert out.count() == docs.count()
            docs = out
        assert rows or docs.count() == 0
