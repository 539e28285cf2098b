from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import random

import pytest
from oracle_check import connect, differences

from tagpulse.llm import queries, warc

PAGES = "page_id bigint, url string, html string"


def expected(rows):
    """Per page, in plain Python."""
    heads = {}
    for key, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and (body not in heads or heads[body] is None or (key is not None and key > heads[body])):
            heads[body] = key
    out = []
    for key, url, html in rows:
        body = (html or "").encode()
        again = body in heads and key != heads[body]
        out.append(
            (
                None if key is None else str(key),
                "revisit" if again else "response",
                str(heads[body]) if again else None,
                url,
                len(body),
                hashlib.sha1(body).hexdigest(),
            )
        )
    return sorted(map(str, out))


def written(spark, rows, folder, schema=PAGES, **names):
    return warc.write(spark.createDataFrame(rows, schema).repartition(3), str(folder), **names)


def check(spark, rows, folder):
    manifest = written(spark, rows, folder)
    columns = ["key", "record_type", "refers_to", "url", "payload_bytes", "payload_digest"]
    found = warc.records(warc.read(manifest)).select(*columns).collect()
    assert sorted(str(tuple(r)) for r in found) == expected(rows)
    return manifest


def pages(seed=0, n=60):
    rng = random.Random(seed)
    bodies = ["", "short", "é" * 500, "x" * 999, "x" * 1000, "long 😀\r\n\r\nWARC/1.1\r\n" * 200, "y" * 5000]
    return [(i, f"http://a.example/{i}", rng.choice(bodies)) for i in range(n)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    ours = queries.QUERIES["op12_warc"](spark, sf_dir)
    assert differences(ours, connect(sf_dir), queries.ORACLE["op12_warc"]) is None


def test_copies_become_revisits(spark, tmp_path):
    check(spark, pages(), tmp_path)


def test_query_with_copies_against_sql(spark, tables):
    sf_dir = tables(pages=(pages(1), PAGES))
    engine = connect(sf_dir)
    engine.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet/*.parquet'")
    assert differences(queries.QUERIES["op12_warc"](spark, sf_dir), engine, queries.ORACLE["op12_warc"]) is None


def test_payloads_come_back_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 700)
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    rows = pages(2)
    manifest = check(spark, rows, tmp_path)
    assert manifest.count() > 3  # files are rolled over
    whole = {}
    for r in sorted(warc.read(manifest).collect(), key=lambda r: (int(r["key"]), r["chunk"])):
        assert len(r["data"]) <= 700
        whole[r["key"]] = whole.get(r["key"], b"") + bytes(r["data"])
        if r["record_type"] == "response":
            assert r["payload_so_far"] == len(whole[r["key"]])
            assert r["payload_digest"] == hashlib.sha1(whole[r["key"]]).hexdigest()
    kinds = {r["key"]: r["record_type"] for r in warc.records(warc.read(manifest)).collect()}
    assert {k: v for k, v in whole.items() if kinds[k] == "response"} == {
        str(k): h.encode() for k, _, h in rows if kinds[str(k)] == "response"
    }
    assert {v for k, v in whole.items() if kinds[k] == "revisit"} == {b""}


def test_files_are_archives_to_another_reader(spark, tmp_path):
    manifest = written(spark, [(7, "http://a.example/ü x\r\n", "é" * 600), (9, None, "é" * 600)], tmp_path)
    text = b"".join(gzip.open(r["path"]).read() for r in manifest.collect())
    assert text.count(b"WARC/1.1\r\n") == 2 and text.endswith(b"\r\n\r\n")
    assert b"WARC-Target-URI: http://a.example/\xc3\xbc%20x%0D%0A\r\n" in text
    digest = base64.b32encode(hashlib.sha1(("é" * 600).encode()).digest())
    assert text.count(b"WARC-Payload-Digest: sha1:" + digest) == 2
    assert b"WARC-Refers-To: <urn:record:k9>" in text and text.count("é".encode() * 600) == 1
    assert text.count(b"Content-Length: 1200\r\n") == 2


def test_nulls_repeats_and_clashing_names(spark, tmp_path):
    long = "z" * 2000
    rows = [(None, "u", long), (None, None, None), (4, "u", long), (4, "u", long), (2, "u", long), (1, "", ""), (1, "", "")]
    check(spark, rows, tmp_path)
    frame = spark.createDataFrame([(*r, "x") for r in rows], f"{PAGES}, head string")
    for name in ("body", "size", "same", "id", "chunk", "data", "key"):
        frame = frame.withColumn(name, frame["head"])
    found = warc.records(warc.read(warc.write(frame, f"{tmp_path}/more")))
    assert found.count() == len(rows)


def test_keys_of_any_text(spark, tmp_path):
    keys = ["a b", "", "k", "<x>", "é/%41"]
    rows = [(k, None, "p" * 1500) for k in keys]
    manifest = written(spark, rows, tmp_path, "name string, link string, content string", key="name", url="link", payload="content")
    found = {r["key"]: r["refers_to"] for r in warc.records(warc.read(manifest)).collect()}
    assert found == {k: None if k == max(keys) else max(keys) for k in keys}


def test_empty_table(spark, tmp_path):
    assert warc.read(written(spark, [], tmp_path)).collect() == []


def test_files_of_lost_tasks_are_not_read(spark, tmp_path):
    manifest = written(spark, pages(3, 5), tmp_path)
    before = sorted(r["key"] for r in warc.records(warc.read(manifest)).collect())
    for path in glob.glob(f"{tmp_path}/*.warc.gz"):
        with open(path, "rb") as file, open(path.replace("part-", "part-lost-"), "wb") as copy:
            copy.write(file.read()[:50])
    assert sorted(r["key"] for r in warc.records(warc.read(manifest)).collect()) == before


def test_damaged_payloads_are_noticed(spark, tmp_path):
    manifest = written(spark, [(1, None, "p" * 3000)], tmp_path)
    path = next(r["path"] for r in manifest.collect())
    text = gzip.open(path).read()
    with gzip.open(path, "wb") as out:
        out.write(text.replace(b"ppp", b"pqp", 1))
    with pytest.raises(Exception, match="another payload than it declares"):
        warc.read(manifest).collect()
