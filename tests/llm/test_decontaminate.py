from __future__ import annotations

import hashlib
import random
import re

import pytest
from oracle_check import connect, differences

from tagpulse.llm import decontaminate, queries
from tagpulse.llm.words import cut, words

BENCHMARK = "item_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(text, items, window):
    doc, hit, names = plain_words(text), set(), set()
    for name, item in items:
        item = plain_words(item)
        if name is None or not item:
            continue
        k = min(window, len(item))
        wanted = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)}
        for i in range(len(doc) - k + 1):
            if tuple(doc[i : i + k]) in wanted:
                hit |= set(range(i, i + k))
                names.add(str(name))
    return len(doc), hit, sorted(names)


def test_words_are_those_of_the_pattern():
    text = "Ab-c é É_9 你好  x\x7fY\n" + "".join(map(chr, range(300)))
    assert [w.decode() for w in words(text.encode())] == plain_words(text)
    assert cut(b"a, b; c. d", [(0, 0), (2, 2)]) == b"b; d"
    assert cut(b"a b c!", [(1, 2)]) == b"a "


def test_automaton_against_brute_force():
    rng = random.Random(4)
    for case in range(400):
        window = rng.randint(1, 5)
        letters = "abc"[: rng.randint(1, 3)]
        make = lambda n: " ".join(rng.choices(letters, k=rng.randint(0, n)))
        items = [(i, make(12)) for i in range(rng.randint(0, 5))]
        automaton = decontaminate.Automaton(
            [(str(i), words(t.encode())) for i, t in items if words(t.encode())], window
        )
        for _ in range(5):
            text = make(30) + rng.choice(["", " z "]) + make(10)
            spans, names = automaton.find(words(text.encode()))
            n, hit, expected = brute(text, items, window)
            assert {p for a, b in spans for p in range(a, b + 1)} == hit, (case, items, text)
            assert sorted(names) == expected
            assert all(a[1] + 1 < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_query_against_sql(spark):
    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        ours = queries.QUERIES["op2_decontamination"](spark, sf_dir)
        assert differences(ours, connect(sf_dir), queries.ORACLE["op2_decontamination"]) is None


ITEMS = [(1, "one two three"), (1, "four five"), (2, " ".join(f"w{i}" for i in range(30))), (3, None),
         (4, ""), (5, "..."), (None, "six"), (6, "one two three"), (10, "two")]
TEXTS = [(1, None), (2, ""), (3, "One, two! THREE four"), (3, "One, two! THREE four"), (4, "six"),
         (5, "x " * 50_000 + " ".join(f"w{i}" for i in range(5, 20)) + " y" * 9), (6, "w1 w2 w3"), (None, "four five")]


def test_odd_rows_and_shards(spark, documents, monkeypatch):
    where = documents(TEXTS, benchmark=(ITEMS, BENCHMARK))
    expected = []
    for doc_id, text in TEXTS:
        n, hit, names = brute(text, ITEMS, 10)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        expected.append((doc_id, n, len(hit), len(names), digest, bool(hit)))
    run = lambda: sorted(map(str, map(tuple, queries.QUERIES["op2_decontamination"](spark, where).collect())))
    assert run() == sorted(map(str, expected))
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 12)
    docs, items = spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/benchmark.parquet")
    one = decontaminate.find(docs, items).select("doc_id", "text", "found").collect()
    many = decontaminate.find(docs, items, shard_words=9).select("doc_id", "text", "found").collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_removal_keeps_clean_documents_and_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b one two three c d e f g", 7), (2, "one two three x", 8), (3, "clean text", 9), (4, None, 1)],
        "doc_id bigint, text string, found int",
    )
    items = spark.createDataFrame([(1, "one two three")], BENCHMARK)
    kept = {r["doc_id"]: (r["text"], r["found"]) for r in decontaminate.remove(docs, items).collect()}
    assert kept == {1: ("a b c d e f g", 7), 3: ("clean text", 9), 4: (None, 1)}


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "one two three", "x", "y")], "doc_id bigint, text string, found string, item string")
    items = spark.createDataFrame([(1, "one two three")], BENCHMARK)
    (row,) = decontaminate.find(docs, items, into="hits").collect()
    assert (row["found"], row["item"], row["hits"]["items"]) == ("x", "y", ["1"])
    with pytest.raises(ValueError):
        decontaminate.find(docs, items)


def test_empty_tables(spark, documents):
    run = queries.QUERIES["op2_decontamination"]
    assert run(spark, documents([], benchmark=(ITEMS, BENCHMARK))).collect() == []
    (row,) = run(spark, documents([(1, "a b")], benchmark=([], BENCHMARK))).collect()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)
