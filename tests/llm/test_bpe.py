from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc

import public_tokenizers as P
import pyarrow as pa
import tiktoken

from tagpulse.llm import bpe, queries

PATH = P.path("byte_bpe_50k.tiktoken")


def own() -> tiktoken.Encoding:
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_finds_every_key():
    keys = [str(i).encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.at) == list(range(5000))
    assert [table.candidate(key) for key in keys] == list(range(5000))


def test_ids_are_those_of_the_library():
    rng, theirs = random.Random(1), own()
    encoder = bpe.Encoder(bpe.load(PATH, P.PATTERN))
    alphabet = "ab  \n\t'stré你 \x1c\x85😀1٣.!-" + " é"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(map(chr, rng.choices(range(128), k=40))) for _ in range(5000)]
    texts += [" " * 5000, "x" * 20_000, "ab" * 9000 + "  c", "it's I'll we'd  ok\n\n x"]
    for text in texts:
        assert encoder(text) == theirs.encode_ordinary(text), text[:80]


def test_every_character_splits_as_in_the_library():
    theirs, encoder = own(), bpe.Encoder(bpe.load(PATH, P.PATTERN))
    wrong = []
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        if code > 0x3FFFF and code % 997:
            continue
        text = f"a{chr(code)}1{chr(code)} b"
        if encoder(text) != theirs.encode_ordinary(text):
            wrong.append(code)
    assert not wrong, [hex(code) for code in wrong[:20]]


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 7)
    theirs, encoder, rng = own(), bpe.Encoder(bpe.load(PATH, P.PATTERN)), random.Random(2)
    for _ in range(500):
        text = "".join(rng.choices("ab \n'st1.", k=60))
        assert encoder(text) == theirs.encode_ordinary(text), text


def test_query_and_odd_rows(spark, sf, documents):
    theirs = own()
    rows = [(1, None), (2, ""), (3, "ab  c"), (3, "ab  c"), (4, "z" * 30_000), (None, "q")]
    for where, texts in ((documents(rows), rows), (sf, None)):
        got = queries.QUERIES["op1_byte_bpe"](spark, where).collect()
        if texts is None:
            texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
        expected = []
        for doc_id, text in texts:
            ids = theirs.encode_ordinary(text or "")
            joined = " ".join(map(str, ids)).encode()
            expected.append((doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_empty_table(spark, documents):
    assert queries.QUERIES["op1_byte_bpe"](spark, documents([])).collect() == []


def test_one_pass_gives_what_two_give(spark):
    vocabulary = bpe.load(PATH, P.PATTERN)
    rows = [(None,), ("",), ("it's été 😀 \n\n x",), ("ab" * 5000,), ("it's été 😀 \n\n x",)]
    frame = spark.createDataFrame(rows, "text string")
    ids = bpe.encode(frame["text"], vocabulary)
    two = frame.select(ids.alias("ids"), bpe.decode(ids, vocabulary).alias("decoded")).collect()
    one = frame.select(bpe.encode_and_decode(frame["text"], vocabulary).alias("both")).select("both.*").collect()
    assert one == two and [bytes(r.decoded).decode() for r in one] == [t or "" for (t,) in rows]


def test_decoded_bytes_are_held_once():
    token = {i: bytes([97 + i]) * 8 for i in range(26)}.__getitem__
    ids = pa.array([[i % 26 for i in range(n % 500)] for n in range(2000)] + [[]], pa.list_(pa.int32()))
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    got = bpe._bytes_of(ids, token)
    held = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    expected = [b"".join(map(token, row)) for row in ids.to_pylist()]
    assert got.to_pylist() == expected
    assert held < 1.5 * sum(map(len, expected))
