from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from oracle_check import connect, differences

from tagpulse.llm import queries, resample

DOCS = "doc_id bigint, text string"


def runs(text, longest):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return len(words), found


def brute(docs, target, longest=1, buckets=10_000, percent=10, min_words=20, seed="2024"):
    at = lambda run: zlib.crc32(run.encode()) % buckets
    own = [(key, *runs(text, longest)) for key, text in docs]
    s = Counter(at(r) for _, _, found in own for r in found)
    t = Counter(at(r) for text in target for r in runs(text, longest)[1])
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))
    )
    rows = []
    for key, n_words, found in own:
        weight = sum(gain(at(r)) for r in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, n_words, len(found), weight, score, None])
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(fit[: len(fit) * percent // 100], 1):
        row[5] = place
    return sorted(map(str, map(tuple, rows)))


def found(spark, docs, target, **options):
    frame = spark.createDataFrame(docs, DOCS).repartition(3)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted(str(tuple(r)) for r in resample.resample(frame, aim, **options).collect())


def texts(seed, n, longest=60):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "été", "ÉTÉ", "x1", "ſ", "K", "日本", "zeta", "nu"]
    gaps = [" ", ", ", "\n", "-", "...", "\x7f", " \x00"]
    return ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    ours = queries.QUERIES["op13_resampling"](spark, sf_dir)
    assert differences(ours, connect(sf_dir), queries.ORACLE["op13_resampling"]) is None


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 97}, {"longest": 2, "buckets": 70_000, "percent": 55, "min_words": 5, "seed": "s"}])
def test_against_brute_force(spark, monkeypatch, options):
    monkeypatch.setattr(resample, "PIECE_CHARS", 40)
    docs = list(enumerate(texts(1, 120)))
    target = texts(2, 10)
    assert found(spark, docs, target, **options) == brute(docs, target, **options)


def test_nulls_repeats_and_empty_texts(spark):
    docs = [(None, "a b"), (1, None), (2, ""), (3, "..."), (4, "a " * 30), (4, "a " * 30), (4, "b " * 30), (None, "c " * 25)]
    for options in ({"percent": 60}, {"min_words": 0, "percent": 100}):
        expected = brute(docs, ["a a b"], **{**options, "min_words": max(options.get("min_words", 20), 1)})
        assert found(spark, docs, ["a a b", None], **options) == expected


def test_empty_tables(spark):
    assert found(spark, [], ["a"]) == []
    docs = list(enumerate(texts(3, 12)))
    assert found(spark, docs, []) == brute(docs, [])


def test_equal_scores_are_ranked_whole(spark):
    docs = [(7, "a " * 25)] * 40 + [(8, "b " * 25)] * 5
    ranks = [r["rank"] for r in resample.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], DOCS), percent=100).collect()]
    assert sorted(ranks) == list(range(1, 46))


def test_one_long_word_and_one_long_text(spark):
    docs = [(1, "w" * 50_000), (2, "lorem ipsum " * 40_000), (3, "é" * 9_000 + " x")]
    assert found(spark, docs, ["lorem"]) == brute(docs, ["lorem"])


def test_other_columns_do_not_matter(spark):
    frame = spark.createDataFrame([(1, "a b c", "x")], f"{DOCS}, key string")
    for name in ("n_words", "buckets", "weight", "score", "rank", "row", "fit", "part", "at"):
        frame = frame.withColumn(name, frame["key"])
    result = resample.resample(frame, frame)
    assert result.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"] and result.count() == 1
    with pytest.raises(ValueError):
        resample.resample(frame, frame, key="weight")


def test_bad_shapes(spark):
    frame = spark.createDataFrame([], DOCS)
    for options in ({"longest": 0}, {"buckets": 0}):
        with pytest.raises(ValueError):
            resample.resample(frame, frame, **options)
