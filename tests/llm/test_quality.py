from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tagpulse.llm import quality, queries

LABELS = "doc_id bigint, quality int, toxic int"


def area(scores, truth):
    """Share of (good, bad) pairs in the right order, ties half."""
    good = [s for s, t in zip(scores, truth, strict=True) if t == 1]
    bad = [s for s, t in zip(scores, truth, strict=True) if t == 0]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    net = quality.Network.fresh(rng)
    for p in net.parameters():
        p[...] += 0.05 * rng.standard_normal(p.shape)
    vars(net).update({k: v.astype(np.float64) for k, v in vars(net).items()})
    batch = [quality.features(bytes(rng.integers(97, 123, n).astype(np.uint8))) for n in (20, 70, 5)]
    labels, weights = np.array([1.0, 0.0, 1.0]), np.array([2.0, 1.0, 1.0])

    def loss():
        total = 0.0
        for (codes, repeats), y, w in zip(batch, labels, weights, strict=True):
            answer = net.responses(codes, repeats)
            score = net.combine(np.concatenate((answer.max(axis=0), answer.mean(axis=0)))[None])[0]
            total -= w * np.log(score if y else 1 - score)
        return total / weights.sum()

    gradients = quality._gradients(net, batch, labels, weights)
    for p, g in zip(net.parameters(), gradients, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, step = p[at], 1e-5
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=1e-6)


def test_pieces_cover_the_whole_text(monkeypatch):
    net = quality.Network.fresh(np.random.default_rng(2))
    text = bytes(random.Random(1).choices(range(32, 127), k=5003))
    whole = net.pooled(text)
    monkeypatch.setattr(quality, "LAGS", range(0))
    plain = net.pooled(text)
    monkeypatch.setattr(quality, "PIECE", 256)
    assert np.allclose(net.pooled(text), plain, atol=1e-4)
    assert whole.shape == plain.shape
    rows = [plain_row for plain_row in net.responses(*quality.features(text))]
    assert np.allclose(np.max(rows, axis=0), plain[: quality.FILTERS], atol=1e-4)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = queries.QUERIES["op7_quality"](spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert area([r["score"] for r in held], [r["quality"] for r in held]) > 0.98
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_odd_rows(spark, documents, tables):
    rows = [(1, None), (2, ""), (3, "good text here"), (3, "good text here"), (None, "x"), (4, "ab " * 100_000), (6, "é")]
    some = [(1, 1, 0), (2, 0, 0), (3, 1, 0), (3, 1, 0), (None, 1, 1), (4, 0, None), (6, None, 0), (99, 1, 0)]
    for labels in (some, [(3, 1, 0)], [(3, 0, 0)], []):
        got = queries.QUERIES["op7_quality"](spark, documents(rows, labels=(labels, LABELS))).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
        same = [r["score"] for r in got if r["doc_id"] == 3]
        assert same[0] == same[1]
    assert queries.QUERIES["op7_quality"](spark, documents([], labels=(some, LABELS))).collect() == []


def test_gradients_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(4)
    net = quality.Network.fresh(np.random.default_rng(3))
    batch = [quality.features(bytes(rng.choices(range(32, 60), k=n))) for n in (1, 900, 40, 2500, 16)]
    labels, weights = np.array([0, 1, 0, 1, 1], np.float32), np.array([1, 2, 1, 1, 3], np.float32)
    whole = quality._gradients(net, batch, labels, weights)
    for rows in (1, 7, 64):
        monkeypatch.setattr(quality, "GROUP_ROWS", rows)
        assert len(list(quality._cut(batch))) > 1
        for a, b in zip(whole, quality._gradients(net, batch, labels, weights), strict=True):
            assert np.allclose(a, b, rtol=1e-3, atol=1e-5)


def test_what_stands_at_the_start_of_long_texts_is_learned():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(500)]

    def text(good):
        junk = "" if good else "".join(rng.choices("#$%&*@!~", k=400))
        return f"{junk} {' '.join(rng.choices(words, k=2700))}".encode()

    labels = np.array([i % 2 for i in range(240)], np.float32)
    texts = [text(label) for label in labels]
    net = quality.train(texts[:160], labels[:160], np.ones(160, np.float32), steps=120)
    right = [(net.score(t) >= 0.5) == bool(label) for t, label in zip(texts[160:], labels[160:], strict=True)]
    assert sum(right) / len(right) > 0.95
