from __future__ import annotations

import numpy as np

from tagpulse.llm import queries, vamana

EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k=20):
    """Every query's nearest by a full scan: {query: [(score, vec_id)]}."""
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in fine:
        if q % 20 == 0:
            found = [(float((u * v).sum()), i) for i, us in fine.items() if i != q for u in us for v in fine[q] if len(u) == len(v)]
            out[q] = sorted(found, key=lambda p: (-p[0], p[1]))[:k]
    return out


def results(spark, where):
    frame = queries.QUERIES["op4_vector_search"](spark, where)
    assert frame.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, expected):
    assert set(got) == {q for q in expected if expected[q]}
    shares = []
    for q, true in expected.items():
        assert len(got.get(q, [])) == len(true)
        assert got.get(q, []) == sorted(got.get(q, []), key=lambda p: (-p[0], p[1]))
        shares += [len({i for _, i in true} & {i for _, i in got[q]}) / len(true)] if true else []
    return float(np.mean(shares)), min(shares)


def test_pruning_against_the_rule():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((80, 3)).astype(np.float32)
    candidates = np.array([rng.permutation(80)[:50] for _ in range(10)])
    owners = np.arange(10)
    got = vamana._prune(points, owners, candidates)
    for owner in owners:
        left = [c for c in candidates[owner] if c != owner]
        left.sort(key=lambda c: ((points[c] - points[owner]) ** 2).sum())
        kept = []
        while left and len(kept) < vamana.DEGREE:
            best = left.pop(0)
            kept.append(best)
            left = [
                c for c in left
                if vamana.ALPHA**2 * ((points[c] - points[best]) ** 2).sum() > ((points[c] - points[owner]) ** 2).sum()
            ]
        assert [i for i in got[owner] if i >= 0] == kept


def test_all_points_are_reached():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.standard_normal((60, 8)) * 0.01 + 10 * rng.standard_normal(8) for _ in range(12)])
    graph = vamana.build(points)
    found, _ = graph.search(points.astype(np.float32), 96, (points**2).sum(axis=1).astype(np.float32))
    assert (found[:, 0] == np.arange(len(points))).mean() > 0.95


def test_recall_on_generated_vectors(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected, got = plain(rows), results(spark, sf_dir)
    mean, _ = recall(got, expected)
    assert mean > 0.95
    for q, found in got.items():
        true = dict((i, s) for s, i in expected[q])
        assert all(abs(true[i] - s) < 1e-12 for s, i in found if i in true)


def test_several_shards_and_blocks(spark, tables, monkeypatch):
    monkeypatch.setattr(vamana, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(16) * rng.uniform(0.5, 2)).astype(np.float32).tolist()) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = vamana.search(frame, frame.where("vec_id % 20 = 0"), shard_rows=200).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    mean, _ = recall(got, plain(rows))
    assert mean > 0.97


def test_odd_rows(spark, tables):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(1, 100)]
    same = [1.0, 2.0, 3.0, 4.0]
    rows += [(i, same) for i in range(200, 300)]
    rows += [(0, same), (20, same), (20, same), (None, same), (400, None), (420, []), (440, [0.0] * 4), (460, [1.0, None, 0.0, 0.0]),
             (480, [float("nan"), 1.0, 0.0, 0.0]), (500, [float("inf"), 1.0, 0.0, 0.0]), (520, [1.0, 1.0]), (541, [2.0, 1.0]), (560, [5.0])]
    where = tables(embeddings=([(i, v, 0) for i, v in rows], EMBEDDINGS))
    got, expected = results(spark, where), plain(dict((str(r), r) for r in rows).values())
    mean, least = recall(got, expected)
    assert mean > 0.95
    assert [i for _, i in got[0]] == [i for _, i in expected[0]]
    assert [i for _, i in got[200]] == [i for _, i in expected[200]]
    assert [i for _, i in got[520]] == [541] and 560 not in got and 400 not in got
    assert results(spark, tables(embeddings=([], EMBEDDINGS))) == {}
    assert results(spark, tables(embeddings=([(20, same, 0)], EMBEDDINGS))) == {}
