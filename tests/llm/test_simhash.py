from __future__ import annotations

import itertools
import random
import re

import xxhash

from tagpulse.llm import queries, simhash
from tagpulse.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(pairs, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def plain_result(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    distinct = sorted({f for i, f in prints if i is not None})
    near = [(a, b) for a, b in itertools.combinations(distinct, 2) if (a ^ b).bit_count() <= 2]
    roots = plain_roots(near, distinct)
    first = {}
    for i, f in prints:
        if i is not None:
            first[roots[f]] = min(i, first.get(roots[f], i))
    return sorted(str((i, f"{f:016x}", None if i is None else first[roots[f]])) for i, f in prints)


def run(spark, where):
    return sorted(str(tuple(r)) for r in queries.QUERIES["op9_simhash"](spark, where).collect())


def test_masks_cover_the_radius():
    masks = simhash.masks()
    assert len(masks) == 7
    for a, b in itertools.combinations(range(64), 2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_links_connect_all_within_two_bits(spark):
    rng = random.Random(3)
    values = set()
    for _ in range(6):  # crowded buckets, and a few lone values
        base = rng.getrandbits(64)
        for _ in range(60):
            value = base
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randint(0, 63)
            values.add(value)
    values |= {rng.getrandbits(64) for _ in range(50)} | {0, 3, 12}
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "f bigint")
    found = [(a % 2**64, b % 2**64) for a, b in simhash.links(frame).collect()]
    assert all((a ^ b).bit_count() <= 2 and a != b for a, b in found)
    near = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 2]
    assert plain_roots(found, values) == plain_roots(near, values)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)]
    pairs += [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    rng.shuffle(pairs)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    nodes = {n for p in pairs for n in p}
    expected = plain_roots(pairs, nodes)
    assert {n: got.get(n, n) for n in nodes} == expected


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, sf_dir) == plain_result(rows)


def test_odd_rows(spark, documents):
    rows = [(5, None), (3, ""), (9, " \n\t"), (4, "A b"), (4, "a B"), (None, "a b"), (None, "only here"), (7, "a  b c d"),
            (8, "x y " * 40_000), (10, "x y " * 40_001), (11, "É b"), (12, "é b")]
    assert run(spark, documents(rows)) == plain_result(rows)
    assert run(spark, documents([])) == []
