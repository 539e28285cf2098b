from __future__ import annotations

import random
import time
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tagpulse.llm import passages, queries
from tagpulse.llm.shared import shared_folder
from tagpulse.llm.words import words


def plain_windows(values, width):
    """Positions that are the first minimum of some stretch of ``width`` values."""
    return {i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)}


def test_every_stretch_has_its_minimum():
    rng = np.random.default_rng(1)
    for n, high in ((0, 9), (5, 9), (60, 1000), (300, 10**9), (300, 12), (200, 1), (80, 3)):
        values = rng.integers(0, high, n).astype(np.uint64)
        got = passages.compact_windows(values, 10)
        assert len(got) == len(set(got))
        assert plain_windows(values, 10) <= set(got)
        if high > n:
            # A node of the tree has a subtree of ten or more: its stretch between smaller values.
            for c in got:
                a, b = c, c
                while a > 0 and values[a - 1] > values[c]:
                    a -= 1
                while b < n - 1 and values[b + 1] > values[c]:
                    b += 1
                assert b - a + 1 >= 10


def test_sliding_minimum():
    values = np.random.default_rng(2).integers(0, 99, 50).astype(np.uint64)
    for width in (1, 2, 3, 8, 23):
        assert passages._sliding_min(values, width).tolist() == [min(values[i : i + width]) for i in range(51 - width)]


def test_rolling_hash_depends_on_its_stretch_only():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 80).astype(np.uint64)
    b = np.concatenate((rng.integers(0, 2**63, 7).astype(np.uint64), a[20:60]))
    for width in (1, 2, 5, 23):
        x, y = passages._rolling(a, width), passages._rolling(b, width)
        assert len(x) == 81 - width
        assert (x[20 : 61 - width] == y[7:]).all()
        assert len(set(x.tolist())) == len(x)
    assert len(passages._rolling(a[:5], 23)) == 0


def brute(rows):
    """Words of each document in an exact run of WORDS words that a smaller id has, where no
    still smaller id has over half of the run."""
    texts = defaultdict(list)
    for doc, text in sorted((i, t) for i, t in rows if i is not None and t is not None):
        texts[doc].append(words(text.encode()))
    part = passages.HALF + passages.SHINGLE - 1
    first = {}
    for doc, versions in texts.items():
        for found in versions:
            for n in (part, passages.WORDS):
                for i in range(len(found) - n + 1):
                    first.setdefault(tuple(found[i : i + n]), doc)
    hit = defaultdict(set)
    for doc, versions in texts.items():
        for found in versions:
            for i in range(len(found) - passages.WORDS + 1):
                run = found[i : i + passages.WORDS]
                owner = first[tuple(run)]
                if owner != doc and all(first[tuple(run[k : k + part])] == owner for k in range(len(run) - part + 1)):
                    hit[doc] |= set(range(i, i + passages.WORDS))
    return hit


def covered(got):
    hit = defaultdict(set)
    for r in got:
        hit[r["doc_id"]] |= set(range(r["first_word"], r["last_word"] + 1))
    return hit


def check(rows, got):
    """All exact repeats are found, and all that is found is as similar as it says."""
    expected, found = brute(rows), covered(got)
    for doc, where in expected.items():
        assert where <= found[doc], (doc, sorted(where - found[doc])[:5])
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(words((t or "").encode()))
    parts = lambda found, a, b: {tuple(found[i : i + 5]) for i in range(a, b - 3)}
    for r in got:
        assert r["source_doc_id"] < r["doc_id"]
        assert r["last_word"] - r["first_word"] + 1 >= passages.WORDS
        best = 0
        for mine in texts[r["doc_id"]]:
            for theirs in texts[r["source_doc_id"]]:
                a = parts(mine, r["first_word"], r["last_word"])
                b = parts(theirs, r["source_first_word"], r["source_last_word"])
                best = max(best, len(a & b) / max(1, len(a | b)))
        assert best >= passages.SIMILARITY


def made(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    shared = [text(n) for n in (50, 52, 80, 300)]
    line = text(20)
    rows = [(i, text(rng.randint(0, 200))) for i in range(60)]
    for i in range(60, 140):
        parts = [text(rng.randint(0, 60)), rng.choice(shared), text(rng.randint(0, 40)), line, text(30)]
        rows.append((i, " ".join(parts)))
    for i in range(140, 160):  # a changed word every 60
        found = rows[i - 40][1].split() + text(200).split()
        rows.append((i, " ".join(found)))
        found = [w if k % 60 != 59 else "x" for k, w in enumerate(found)]
        rows.append((1000 + i, " ".join(found)))
    return rows


def test_query_against_brute_force(spark, documents):
    rows = made(1) + [(2001, "spam " * 30_000), (2002, "spam " * 200), (2003, "a b c " * 60), (2004, "a b c " * 50)]
    rows += [(None, rows[0][1]), (7, None), (8, ""), (2005, rows[90][1]), (2005, rows[90][1]), (2006, rows[91][1]), (2006, rows[95][1])]
    got = queries.QUERIES["op3_substring_dedup"](spark, documents(rows)).collect()
    check(rows, got)
    pairs = {(r["doc_id"], r["source_doc_id"]) for r in got}
    assert (2002, 2001) in pairs and (2004, 2003) in pairs
    # Nearly all of the changed copies is found, across the changes.
    where = covered(got)
    for i in range(140, 160):
        text = next(t for d, t in rows if d == 1000 + i).split()
        assert len(where[1000 + i]) > 0.9 * len(text) - 40
    clean = {i for i, _ in rows if i is not None and i < 60}
    assert not clean & set(where)


def test_generated_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, queries.QUERIES["op3_substring_dedup"](spark, sf_dir).collect())


def test_removal(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, f"One. {passage}", 5), (2, f"Two, {passage}! End.", 6), (3, passage.upper(), 7), (4, None, 8), (5, "", 9), (None, passage, 1)],
        "doc_id bigint, text string, copied int",
    )
    kept = {r["doc_id"]: (r["text"], r["copied"]) for r in passages.remove(docs).collect()}
    assert kept == {1: (f"One. {passage}", 5), 2: ("Two, End.", 6), 4: (None, 8), 5: ("", 9), None: (passage, 1)}


def test_names_that_clash(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage, i, "b", "w", "s") for i in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, doc bigint, blocks string, words string, src string")
    found = {r["doc_id"]: [s["source"] for s in r["copied"]] for r in passages.find(docs).collect()}
    assert found == {1: [], 2: [1]}
    with pytest.raises(ValueError):
        passages.find(docs, into="words")


def every_repeat(rows):
    """Words of each document in an exact run of WORDS words that a smaller id has."""
    first, hit = {}, defaultdict(set)
    for doc, text in sorted(rows):
        found = words(text.encode())
        for i in range(len(found) - passages.WORDS + 1):
            if first.setdefault(tuple(found[i : i + passages.WORDS]), doc) != doc:
                hit[doc] |= set(range(i, i + passages.WORDS))
    return hit


def test_partial_holders_hide_no_repeat(spark, tmp_path):
    rng = random.Random(4)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, last = [], []
    for family in range(40):
        passage = text(rng.choice((50, 56, 70)))
        part = passage[: rng.randint(30, 45)] if family % 2 else passage[-rng.randint(30, 45) :]
        # The smallest id, or one between, has a part only; one document has the part before the whole.
        parts = [part, passage, passage] if family % 4 < 2 else [passage, part, part + text(9) + passage]
        rows += [(family * 5 + i, " ".join(text(40) + p + text(40))) for i, p in enumerate(parts)]
        last.append(family * 5 + 2)
    schema = "doc_id bigint, text string"
    by_file = tmp_path / "by_file"
    by_file.mkdir()
    for i, r in enumerate(rows):  # one document per input file
        pq.write_table(pa.table({"doc_id": [r[0]], "text": [r[1]]}), by_file / f"{i}.parquet")
    one = spark.createDataFrame(rows, schema).coalesce(1)
    results = []
    for docs in (one, spark.read.schema(schema).parquet(str(by_file)).repartition(len(rows), "doc_id")):
        got = defaultdict(set)
        results.append(sorted((r["doc_id"], s) for r in passages.find(docs).collect() for s in r["copied"]))
        for doc, s in results[-1]:
            got[doc] |= set(range(s["first"], s["last"] + 1))
        expected = every_repeat(rows)
        assert set(last) == set(expected)
        for doc, where in expected.items():
            assert where <= got[doc], doc
    assert results[0] == results[1]


def test_recall_of_short_changed_passages():
    rng = random.Random(5)
    text = lambda n: [b"%d" % rng.randrange(10**9) for _ in range(n)]
    of = lambda found: set(passages.signatures(passages.shingles(found, passages._Hashes().__getitem__))[0].tolist())
    for n, changed in ((50, 25), (50, 20), (60, 30)):
        linked = 0
        for _ in range(400):
            passage = text(n)
            copy = [b"x" if i == changed else w for i, w in enumerate(passage)]
            linked += bool(of(text(100) + passage + text(100)) & of(text(100) + copy + text(100)))
        print(n, changed, linked / 400)
        assert linked >= 0.98 * 400, (n, changed, linked)


def test_changed_word_near_an_end(spark):
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    for around in (0, 40):
        rows, lengths = [], {}
        for w in range(5):
            for n in (50, 50 + w, 120):
                for k in (w, n - 1 - w):
                    passage, doc = text(n), 2 * len(lengths) + 1
                    copy = ["x" if i == k else v for i, v in enumerate(passage)]
                    rows += [(doc, " ".join(text(around) + passage + text(around)))]
                    rows += [(doc + 1, " ".join(text(around) + copy + text(around)))]
                    lengths[doc + 1] = (n, k)
        found = passages.find(spark.createDataFrame(rows, "doc_id bigint, text string"))
        got = {r["doc_id"]: r["copied"] for r in found.where("size(copied) > 0").collect()}
        assert set(got) == set(lengths)
        for doc, (n, k) in lengths.items():
            where = {i for s in got[doc] for i in range(s["first"], s["last"] + 1)}
            assert len(where) >= passages.WORDS
            assert where >= set(range(around + (k == 0), around + n - (k == n - 1))), (doc, n, k)
            assert all(s["source"] == doc - 1 and s["similarity"] >= passages.SIMILARITY for s in got[doc])


def test_empty(spark, documents):
    assert queries.QUERIES["op3_substring_dedup"](spark, documents([])).collect() == []


@pytest.mark.parametrize("gap", [0, 5, 20])
def test_a_source_that_holds_a_passage_twice(spark, documents, gap):
    rng = random.Random(gap)
    text = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    x, y, z = text(60), text(60), text(30)
    rows = [(1, " ".join([x, z, x, y])), (2, " ".join([y, text(gap), x])), (3, " ".join([text(80), x]))]
    got = queries.QUERIES["op3_substring_dedup"](spark, documents(rows)).collect()
    assert covered(got) == {2: set(range(60)) | set(range(60 + gap, 120 + gap)), 3: set(range(80, 140))}


def test_exact_runs_wherever_shingles_repeat():
    rng = random.Random(8)
    for _ in range(60):
        vocabulary = [f"w{i}" for i in range(rng.choice([3, 40, 4000]))]
        said = [[rng.choice(vocabulary) for _ in range(rng.choice([50, 70]))] for _ in range(3)]
        theirs = [w for _ in range(4) for w in (*rng.choice(said), *rng.choices(vocabulary, k=rng.randint(0, 8)))]
        mine = [w for _ in range(3) for w in (*rng.choice(said), *rng.choices(vocabulary, k=rng.randint(0, 8)))]
        held = {tuple(theirs[i : i + 50]) for i in range(len(theirs) - 49)}
        blocks = [
            {"source": 1, "block": b, "words": " ".join(theirs[b * passages.BLOCK : (b + 1) * passages.BLOCK])}
            for b in range(-(-len(theirs) // passages.BLOCK))
        ]
        found = passages.copied_in(" ".join(mine).encode(), blocks, passages._Hashes().__getitem__)
        hit = {k for s in found for k in range(s["first"], s["last"] + 1)}
        for i in range(len(mine) - 49):
            if tuple(mine[i : i + 50]) in held:
                assert set(range(i, i + 50)) <= hit


def test_columns_of_any_name_stay(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    names = ["__blocks", "__src", "__wanted", "__doc", "__cut", "__copied", "src", "block", "doc"]
    frame = spark.createDataFrame([(1, shared), (2, f"{shared} more of it")], "doc_id bigint, text string")
    for name in names:
        frame = frame.withColumn(name, frame["doc_id"])
    left = passages.remove(frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"], r["text"], r["__cut"]) for r in left.collect()) == [(1, shared, 1), (2, "more of it", 2)]


def test_texts_are_hashed_together(monkeypatch):
    """As each by itself, whatever its length, with few passes over arrays."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice((0, 3, 49, 50, 51, 90, 200)))) for _ in range(400)]
    hash_of = passages._Hashes().__getitem__
    alone = {}
    for doc, text in enumerate(texts):
        sig, at, times = passages.signatures(passages.shingles(words(text.encode()), hash_of))
        alone |= {(s, doc): (a, n) for s, a, n in zip(sig.view("int64").tolist(), at.tolist(), times.tolist(), strict=True)}
    calls = []
    sliding_min = passages._sliding_min
    monkeypatch.setattr(passages, "_sliding_min", lambda *given: calls.append(1) or sliding_min(*given))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc", "text"])
    got = [r for out in passages._windows(iter([batch])) for r in out.to_pylist()]
    assert len(calls) < len(texts) / 4
    assert {(r["sig"], r["doc"]): r["at"] for r in got} == {
        key: at for key, (at, _) in alone.items() if key in {(r["sig"], r["doc"]) for r in got}
    }
    for sig in {s for s, _ in alone}:
        docs = sorted(d for s, d in alone if s == sig)
        rows = sorted((r["doc"], r["n"]) for r in got if r["sig"] == sig)
        assert rows == [(d, sum(alone[sig, e][1] for e in docs) if d == docs[0] else None) for d in docs]


def test_blocks_shorter_than_a_passage():
    hash_of = passages._Hashes().__getitem__
    for n in range(1, 60):
        block = [{"source": 1, "block": 0, "words": " ".join(f"w{i}" for i in range(n))}]
        got = passages.copied_in(" ".join(f"w{i}" for i in range(60)).encode(), block, hash_of)
        assert len(got) == (n >= passages.WORDS)


def test_tables_and_shuffle_files_go_when_they_are_used_up(spark):
    """All that is left of finding the links is which blocks to fetch."""
    shared = " ".join(f"s{i}" for i in range(70))
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(80)) + " " + shared) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    held = Path(shared_folder(spark))
    before, conf = set(held.iterdir()), spark.conf.getAll
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles().size()
    found = passages.find(docs)
    deadline = time.monotonic() + 20  # they are removed in the background
    while blocks.getAllFiles().size() > files and time.monotonic() < deadline:
        time.sleep(0.1)
    assert blocks.getAllFiles().size() <= files
    left = {p.parent.name for new in set(held.iterdir()) - before for p in new.rglob("*.parquet")}
    assert left == {"wants"} and spark.conf.getAll == conf
    spans = {r["doc_id"]: r["copied"] for r in found.collect()}
    assert spans[0] == [] and all(spans[i][0]["source"] == 0 and spans[i][0]["last"] == 149 for i in range(1, 30))
