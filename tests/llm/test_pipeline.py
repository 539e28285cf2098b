from __future__ import annotations

import hashlib

import public_tokenizers as P
import pytest
from test_bpe import own
from test_decontaminate import brute as plain_hits
from test_passages import brute as plain_copies
from test_quality import LABELS
from test_simhash import plain_result

import corpus_pipeline
from tagpulse.llm import queries
from tagpulse.llm.words import words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


def rows_of(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


@pytest.fixture(scope="module")
def outputs(spark):
    """What each stage gets and returns on generated documents."""
    sf_dir = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.settle(stage(spark, docs, sf_dir), name)
        out[name] = docs, result
        docs = result
    return out


def test_columns(outputs):
    for name, (docs, result) in outputs.items():
        assert docs.columns == COLUMNS
        if name != "token_ids":
            assert result.columns == COLUMNS and result.dtypes == docs.dtypes


def test_quality_stage(spark, outputs):
    docs, result = outputs["quality"]
    judged = queries.QUERIES["op7_quality"](spark, "/root/testdata/sf0.01").collect()
    assert set(rows_of(result)) == {r["doc_id"] for r in judged if r["score"] >= 0.3}
    assert 0 < result.count() < docs.count()


def test_near_duplicates_stage(outputs):
    docs, result = outputs["near_duplicates"]
    texts = rows_of(docs)
    roots = {r[0]: r[2] for r in map(eval, plain_result(list(texts.items())))}
    assert rows_of(result) == {i: texts[i] for i in texts if roots[i] == i}


def test_copied_passages_stage(outputs):
    docs, result = outputs["copied_passages"]
    before, after = rows_of(docs), rows_of(result)
    copied = plain_copies(list(before.items()))
    for i, text in before.items():
        found = words(text.encode())
        left = words(after.get(i, "").encode())
        assert len(left) <= len(found) - len(copied[i])
        if after.get(i) != text:
            assert len(found) - len(left) >= 50
    again = plain_copies(list(after.items()))
    assert not any(again.values())
    assert all(r["n_chars"] == len(r["text"]) for r in result.collect())


def test_benchmark_stage(spark, outputs):
    docs, result = outputs["benchmark"]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    before, after = rows_of(docs), rows_of(result)
    for i, text in before.items():
        n, hit, _ = plain_hits(text, items, 10)
        assert (i in after) == (len(hit) <= n / 2)
        if i in after:
            kept = [w for k, w in enumerate(words(text.encode())) if k not in hit]
            assert words(after[i].encode()) == kept
            assert hit or after[i] == text


def test_token_stage(outputs):
    docs, result = outputs["token_ids"]
    theirs, texts = own(), rows_of(docs)
    got = result.collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["ids"] == theirs.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run_is_all_stages(spark, outputs):
    whole = corpus_pipeline.run(spark, "/root/testdata/sf0.01").select("doc_id", "ids_sha256").collect()
    assert sorted(whole) == sorted(outputs["token_ids"][1].select("doc_id", "ids_sha256").collect())
    assert P.path("byte_bpe_50k.tiktoken")


def test_odd_and_empty_documents(spark, documents):
    benchmark = ([(1, "one two three")], "item_id bigint, text string")
    labels = ([(2, 1, 0), (3, 1, 0)], LABELS)
    same = "a text of some words that is repeated " * 10
    rows = [(1, None), (2, ""), (3, same), (4, same), (4, same), (None, same), (5, "one two three"), (6, "word " * 50_000)]
    for given in (rows, []):
        where = documents(given, benchmark=benchmark, labels=labels)
        got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in corpus_pipeline.run(spark, where).collect())
        expected = [("1", 0), ("3", None), ("6", None), ("None", None)] if given else []
        assert [i for i, _ in got] == [i for i, _ in expected]


def test_versions_of_one_id_stay(spark):
    rows = [(1, None, "a"), (1, "one text of five words", "b"), (1, "another text of six words here", "c"), (2, None, "d"), (1, "one text of five words", "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string")
    left = STAGES["near_duplicates"](spark, docs, "")
    assert left.columns == docs.columns
    kept = sorted((r["doc_id"], r["text"]) for r in left.collect() if r["doc_id"] == 1)
    assert kept == [(1, "another text of six words here"), (1, "one text of five words")]


def test_documents_without_counts(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, shared), (2, shared + " more of it")], "doc_id bigint, text string")
    left = STAGES["copied_passages"](spark, docs, "")
    assert left.columns == docs.columns and rows_of(left) == {1: shared, 2: "more of it"}
