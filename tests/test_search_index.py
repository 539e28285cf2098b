from __future__ import annotations

import random
import sys

import pytest
from pyspark.sql import functions as F

from tagpulse.operators import search_index
from tagpulse.operators.search_index import SearchIndex, build
from tagpulse.operators.serving import after_prefix, begins_with, search, suggest, suggest_from, title_index

QUESTIONS = "question_id bigint, title string, body string, score int, tags array<string>"
COLUMNS = ("question_id", "title", "score")


def some_questions(n, seed=5):
    rng = random.Random(seed)
    words = ["spark", "Sparkle", "join", "JOINED", "été", "ÉTÉ", "on", "window", "日本語です", "x" * 80, "a-b\nc"]
    rows = []
    for i in range(n):
        title, body = (" ".join(rng.choice(words) for _ in range(rng.randint(0, k))) for k in (3, 8))
        rows.append((i, rng.choice([title, None]), rng.choice([body, body, None]), rng.choice([None, *range(12)]), rng.sample(["a", "b", "c"], rng.randint(0, 2))))
    return rows


QUERIES = ("spark", "SPARK join", "été", "語で", "日本語", "on", "on spark", "", "zzz", "park sparkz", "x" * 70, "b\nc", "e j")


@pytest.mark.parametrize("block", [7, 1024])
def test_searches_equal_scans(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(search_index, "FIRST_BLOCKS", 1)
    monkeypatch.setattr(search_index, "PER_RESULT", 1)
    questions = spark.createDataFrame(some_questions(300), QUESTIONS).repartition(4)
    index = build(questions, str(tmp_path / "index"), block=block, buckets=4)
    asked = QUERIES if block == 7 else QUERIES[1:4]
    for n, query in enumerate(asked):
        limit, tags, every = ((3, (), False), (10, ("a", "b"), True), (400, ("a", "c"), False))[n % 3]
        theirs = search(questions, query, tags, limit, every, COLUMNS).collect()
        assert index.search(query, tags, limit, every, COLUMNS).collect() == theirs, (query, limit, tags)


def test_an_index_is_opened_again(spark, tmp_path):
    questions = spark.createDataFrame(some_questions(40), QUESTIONS)
    build(questions, str(tmp_path / "index"), block=16, buckets=2)
    index = SearchIndex(spark, str(tmp_path / "index"), block=16, buckets=2)
    assert index.search("spark", columns=COLUMNS).collect() == search(questions, "spark", columns=COLUMNS).collect()


def test_no_questions(spark, tmp_path):
    index = build(spark.createDataFrame([], QUESTIONS), str(tmp_path / "index"))
    assert index.search("spark", columns=COLUMNS).collect() == index.search("", columns=COLUMNS).collect() == []


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_searches_read_their_buckets_and_blocks_only(spark, tmp_path):
    index = build(spark.createDataFrame(some_questions(300), QUESTIONS), str(tmp_path / "index"), block=10, buckets=16)
    text = plan(index.candidates(["spa", "par"], 4, 8))
    buckets = {row[0] for row in spark.sql("SELECT CAST(pmod(xxhash64(g), 16) AS INT) FROM VALUES ('spa'), ('par') AS t(g)").collect()}
    (filters,) = [part.split("]", 1)[0] for part in text.split("PartitionFilters: [")[1:]]
    assert all(f"{b}" in filters for b in buckets) and "bucket" in filters
    for bound in ("GreaterThanOrEqual(block,4)", "LessThan(block,8)", "In(term, [par,spa])"):
        assert bound in text
    # A term that every question has is a row a block.
    assert index.postings.groupBy("term", "block").count().filter("count > 1").isEmpty()
    assert index.postings.agg(F.max(F.size("places"))).first()[0] <= 10


def test_ends_of_prefixes():
    assert after_prefix("ab") == "ac" and after_prefix("a\ud7ff") == "a\ue000"
    assert after_prefix("a" + chr(sys.maxunicode)) == "b" and after_prefix(chr(sys.maxunicode)) is None
    assert after_prefix("") is None


TITLES = ["Spark", "spark", "Sparkle", "SPARK joins", "été", "ÉTÉ en", "日本語", "日本", "a\ud7ffb", "a\ue000", "😀x", "😀", "", "a", None, "Spark"]
TITLES += [f"t{i:04}" for i in range(500)]


def test_prefix_ranges_equal_scans(spark, tmp_path):
    questions = spark.createDataFrame([(i, t) for i, t in enumerate(TITLES)], "question_id bigint, title string").repartition(3)
    title_index(questions).write.parquet(str(tmp_path / "titles"))
    titles = spark.read.parquet(str(tmp_path / "titles"))
    asked = {t[:n] for t in TITLES[:15] if t for n in range(1, len(t) + 1)} | {"SP", "t0", "T01", "zz", "", "日", "éT", chr(sys.maxunicode) * 2}
    for prefix in sorted(asked):
        assert suggest_from(titles, prefix).collect() == suggest(questions, prefix).collect(), prefix
    text = plan(suggest_from(titles, "T01"))
    assert "GreaterThanOrEqual(lowered,t01)" in text and "LessThan(lowered,t02)" in text


def test_ranges_of_random_texts(spark):
    rng = random.Random(2)
    alphabet = ["a", "b", "\ud7ff", "\ue000", "\uffff", chr(0x10000), chr(sys.maxunicode), "é"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 4))) for _ in range(300)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for prefix in {t[:2] for t in texts}:
        assert frame.filter(begins_with("text", prefix)).count() == sum(t.startswith(prefix) for t in texts)


def test_single_grams_are_not_shuffled(spark, tmp_path, monkeypatch):
    plans, into = {}, spark.range(1).write.__class__.parquet

    def parquet(self, path, **options):
        plans[path.rsplit("/", 1)[1]] = plan(self._df)
        return into(self, path, **options)

    monkeypatch.setattr(type(spark.range(1).write), "parquet", parquet)
    index = build(spark.createDataFrame(some_questions(300), QUESTIONS), str(tmp_path / "index"), block=10, buckets=4)
    text = plans["postings"]
    # texts by block below the grams, postings by bucket above them, and nothing in ranges, which computes them twice
    assert text.count("Exchange ") == 2 and "rangepartitioning" not in text
    assert "Exchange " in text[text.index("Generate explode") :] and "Exchange " in text[: text.index("Generate explode")]
    expected = sorted((t, b, sorted(p)) for t, b, p in index.postings.select("term", "block", "places").collect())
    assert len(expected) == len({row[:2] for row in expected}) > 0
