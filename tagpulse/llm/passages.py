"""Passages of at least ``WORDS`` words that repeat, exactly or nearly, across documents.

A document is its sequence of word shingles, each a 64-bit hash. Under a hash function the
Cartesian tree of the sequence names, for every stretch of shingles at once, the position of
its smallest value: a node and its subtree are a compact window, all stretches inside which
hold the node have that value as their min-hash. Only windows as wide as a passage are kept,
about ``2 n / width`` of n. Each is one or two rows: the value together with the min-hash,
under a second function, of ``SIDE`` shingles to its right, and to its left; one side at least
of any passage that holds the position lies in the passage. Passages that repeat share such
rows, under one of ``HASHES`` functions at least.

Rows of equal signature are linked to the one of the smallest document of all, through one
row of each task, so no group is gathered and no pairs of a group are made. That document may
lack a part of what others share. So in groups of more than two, the members' passage-wide
stretches around the position are keyed as well, by a hash of the whole stretch and by pairs
of min-hashes, and equal keys are linked to the smallest document that has them. The blocks of words around linked positions are then fetched and joined by interval
into longer stretches, and what they share is verified: a passage of a document counts as
copied if it and its counterpart have ``WORDS`` words and a Jaccard similarity of their
shingles of at least ``SIMILARITY``; up to ``SHINGLE`` words at either end count with it where
equal words follow changed ones, or where it is shorter without. An exact repeat of ``WORDS`` words is found for certain,
whatever other documents hold of it. A repeat with changes is found where a
position and the min-hash of a side are unchanged for some hash function: 0.997 of passages
of 50 words, one in the middle changed, shared a signature in 1,000 trials; and surely at
each exact run of ``WORDS`` words inside it.

The document with the smaller id is the source. Null texts, and texts of fewer words, have
no passages. Rows without an id take no part. Rows that share an id are versions of one
document, not compared with each other; each is judged by its own text. Ids are integers.
Other columns, whatever their names, stay; very long texts cost in proportion to their length, also
where they repeat one word; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tagpulse.llm.shared import free_names, new_folder, remove_folder, settle
from tagpulse.llm.words import SPANS, without_spans, words

SHINGLE = 5
WORDS = 50
SIMILARITY = 0.8
#: Shingles in the shortest passage, in half of it, and beside a position in a signature.
WIDTH = WORDS - SHINGLE + 1
HALF = WIDTH // 2
SIDE = (HALF + 1) // 2
#: Hash functions for windows, at most four.
HASHES = 3
#: Words fetched at a time around a linked position.
BLOCK = 64
#: Shingles without a counterpart that a passage may span: two changed words.
GAP = 2 * SHINGLE
#: Windows a task holds before it groups them, and bytes of texts it hashes together.
HELD = 1_000_000
TOGETHER = 1 << 17

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FUNCTION = np.uint64(3)


class _Hashes:
    """Hashes of words; faster than looking up those of words seen before."""

    __getitem__ = staticmethod(xxhash.xxh3_64_intdigest)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _runs(single: np.ndarray) -> np.ndarray:
    """A hash for each run of SHINGLE hashes, SHINGLE at least."""
    n = len(single) - SHINGLE + 1
    total = single[:n].copy()
    for i in range(1, SHINGLE):
        total *= _ODD
        total += single[i : i + n]
    return _mix(total)


def shingles(found: list[bytes], hash_of: Callable[[bytes], int]) -> np.ndarray:
    """A hash for each run of SHINGLE words."""
    if len(found) < SHINGLE:
        return np.zeros(0, np.uint64)
    return _runs(np.fromiter(map(hash_of, found), np.uint64, len(found)))


class Sequences:
    """The shingles of some texts one after another."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes = values, sizes
        ends = np.cumsum(sizes)
        self.first = ends - sizes
        #: Of each shingle its text, its place there, and how many there are from it on.
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.place = np.arange(len(values)) - self.first[self.text]
        self.left = sizes[self.text] - self.place

    @classmethod
    def of(cls, texts: list[bytes], hash_of: Callable[[bytes], int]) -> Sequences:
        found = [words(text) for text in texts]
        n = np.array([len(f) for f in found], np.int64)
        sizes = np.maximum(n - SHINGLE + 1, 0)
        if not sizes.any():
            return cls(np.zeros(0, np.uint64), sizes)
        single = np.fromiter(map(hash_of, chain.from_iterable(found)), np.uint64, n.sum())
        inside = np.arange(len(single)) + SHINGLE <= np.repeat(np.cumsum(n), n)
        return cls(_runs(single)[inside[: len(single) - SHINGLE + 1]], sizes)

    def least(self, values: np.ndarray) -> np.ndarray:
        """The minimum of WIDTH values from each shingle on, 0 where its text has fewer."""
        least = np.zeros(len(values), np.uint64)
        if len(values) >= WIDTH:
            whole = self.left[: len(values) - WIDTH + 1] >= WIDTH
            least[: len(whole)] = np.where(whole, _sliding_min(values, WIDTH), np.uint64(0))
        return least


def _together(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about TOGETHER bytes."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= TOGETHER or i + 1 == len(texts):
            yield first, i + 1
            first, size = i + 1, 0


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of ``width`` values from each position on, where there are so many."""
    now, done = values, 1
    while done * 2 <= width:
        now = np.minimum(now[:-done], now[done:])
        done *= 2
    rest = width - done
    return np.minimum(now[: len(now) - rest], now[rest:]) if rest else now


def compact_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Positions of the nodes of the Cartesian tree whose subtrees are ``width`` wide or more:
    those with the minimum of a stretch of that width. Equal minima count all."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    edge = np.zeros(width - 1, np.uint64)
    least = np.concatenate((edge, _sliding_min(values, width), edge))
    return np.flatnonzero(~_sliding_min(~least, width) == values)


def _rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of ``width`` values from each position on, where there are so many."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    parts, now, done, factor = [], values, 1, int(_ODD)
    while done <= width:
        if width & done:
            parts.append((done, now))
        now = now[:-done] + now[done:] * np.uint64(factor) if len(now) > done else now[:0]
        done, factor = done * 2, factor * factor % (1 << 64)
    n, at = len(values) - width + 1, 0
    total = np.zeros(n, np.uint64)
    for size, part in reversed(parts):
        total = _mix(total + part[at : at + n])
        at += size
    return total


def _hashed(sequence: np.ndarray, f: int) -> np.ndarray:
    return _mix(sequence ^ np.uint64(0xD6E8FEB86659FD93 * (f + 1) % (1 << 64)))


def signatures_of(some: Sequences) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts, their signatures (each once; the lowest bits name the hash function), the first
    positions of these, and how often they occur."""
    found, where = [], []
    edge = np.zeros(WIDTH - 1, np.uint64)
    for f in range(HASHES if (some.sizes >= WIDTH).any() else 0):
        values = _hashed(some.values, f)
        side = _sliding_min(_mix(values + _ODD), SIDE)
        # As compact_windows, for all texts at once.
        at = np.flatnonzero(~_sliding_min(~np.concatenate((edge, some.least(values))), WIDTH) == values)
        at = at[some.sizes[some.text[at]] >= WIDTH]
        right = at[some.left[at] >= SIDE]
        left = at[some.place[at] >= SIDE - 1]
        for sig in (
            _mix(values[right] + _mix(side[right])),
            _mix(values[left] + _mix(side[left - SIDE + 1]) + _ODD),
        ):
            found.append(sig & ~_FUNCTION | np.uint64(f))
        where += [right, left]
    if not found:
        empty = np.zeros(0, np.int32)
        return empty, np.zeros(0, np.uint64), empty, empty
    found, where = np.concatenate(found), np.concatenate(where)
    text = some.text[where]
    order = np.lexsort((where, found, text))
    text, found, where = text[order], found[order], where[order]
    new = np.flatnonzero((np.diff(text, prepend=-1) != 0) | np.concatenate(([True], found[1:] != found[:-1])))
    times = np.diff(new, append=len(found)).astype(np.int32)
    return text[new], found[new], some.place[where[new]].astype(np.int32), times


def signatures(sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of one text."""
    return signatures_of(Sequences(sequence, np.array([len(sequence)])))[1:]


def stretches(some: Sequences, text: np.ndarray, at: np.ndarray, f_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, keys of their passage-wide stretches whose least shingle under a function stands at
    a wanted position of the text, and a position in each: a hash of the whole stretch, for the
    first hash function, and for each its least value with that of another function."""
    values = [_hashed(some.values, f) for f in range(HASHES)]
    least = [some.least(v) for v in values]
    rolled = _rolling(some.values, WIDTH)
    inside = at < some.sizes[text]
    text, at, f_of = text[inside], at[inside], f_of[inside]
    keys, where = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    apart = some.text.astype(np.uint64) * _ODD
    whole = some.left >= WIDTH
    for f in range(HASHES):
        place = some.first[text[f_of == f]] + at[f_of == f]
        starts = np.flatnonzero(whole & np.isin(least[f] + apart, values[f][place] + apart[place]))
        if f == 0:
            keys.append(rolled[starts])
            where.append(starts)
        for g in range(HASHES):
            if g != f:
                keys.append(_mix(least[f][starts] + _mix(least[g][starts] + np.uint64(f * HASHES + g))))
                where.append(starts)
    keys, where = np.concatenate(keys), np.concatenate(where)
    text = some.text[where]
    order = np.lexsort((keys, text))  # of equal ones the first stays first
    text, keys, where = text[order], keys[order], where[order]
    new = np.concatenate((text[:1] >= 0, (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])))
    return text[new], keys[new], (some.place[where[new]] + HALF).astype(np.int32)


_WINDOWS = T.StructType(
    [
        T.StructField("sig", T.LongType()),
        T.StructField("doc", T.LongType()),
        T.StructField("at", T.IntegerType()),
        T.StructField("n", T.IntegerType()),
    ]
)
_ARROW = pa.schema([("sig", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])


def _grouped(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """The first row of each signature with the number of its occurrences, and the rows of
    other documents."""
    sig = np.concatenate([h[0] for h in held])
    doc = np.concatenate([h[1] for h in held])
    at = np.concatenate([h[2] for h in held])
    times = np.concatenate([h[3] for h in held])
    order = np.lexsort((at, doc, sig))
    sig, doc, at, times = sig[order], doc[order], at[order], times[order]
    new = np.concatenate(([True], sig[1:] != sig[:-1]))
    first = np.flatnonzero(new)
    head = first[np.cumsum(new) - 1]
    keep = new | (doc != doc[head])
    n = np.zeros(len(sig), np.int64)
    n[first] = np.add.reduceat(times.astype(np.int64), first)
    n = np.minimum(n, np.iinfo(np.int32).max).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(sig[keep].view(np.int64)),
            pa.array(doc[keep]),
            pa.array(at[keep]),
            pa.array(n[keep], mask=~new[keep]),
        ],
        schema=_ARROW,
    )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hash_of = _Hashes().__getitem__
    held, size = [], 0
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(), batch.column(1).cast(pa.binary()).to_pylist()
        for first, end in _together(texts):
            text, sig, at, times = signatures_of(Sequences.of(texts[first:end], hash_of))
            if len(sig):
                held.append((sig, ids[first + text], at, times))
                size += len(sig)
            if size > HELD:
                yield _grouped(held)
                held, size = [], 0
    if held:
        yield _grouped(held)


_KEYS = "array<struct<key:bigint,at:int>>"


def _stretches(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    hash_of = _Hashes().__getitem__
    kind = pa.struct([("key", pa.int64()), ("at", pa.int32())])
    for column, wanted in batches:
        texts = column.fill_null("").cast(pa.binary()).to_pylist()
        starts, found = wanted.offsets.to_numpy(), wanted.values
        at, f_of = (found.field(name).to_numpy().astype(np.int64) for name in ("at", "f"))
        sizes, keys, where = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for first, end in _together(texts):
            inside = slice(starts[first], starts[end])
            text = np.repeat(np.arange(end - first), np.diff(starts[first : end + 1]))
            text, key, place = stretches(Sequences.of(texts[first:end], hash_of), text, at[inside], f_of[inside])
            sizes.append(np.bincount(text, minlength=end - first))
            keys.append(key)
            where.append(place)
        columns = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(where))]
        flat = pa.StructArray.from_arrays(columns, fields=list(kind))
        yield pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)), pa.int32()), flat)


def links(docs: DataFrame, folder: str) -> DataFrame:
    """(doc, src, src_at) for documents (doc, text): positions of shared signatures and stretches.
    Its tables are in ``folder``, which may go when the result is settled."""
    found = settle(docs.where("text IS NOT NULL").mapInArrow(_windows, _WINDOWS), "windows", inside=folder)
    # One row for a signature and task at most is grouped here, however often it occurs.
    group = Window.partitionBy("sig").orderBy("doc", "at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = (
        found.where("n IS NOT NULL")
        .select("sig", "doc", "at", F.first(F.struct("doc", "at")).over(group).alias("head"), F.sum("n").over(group).alias("n"))
        .where("n > 1")
    )
    firsts = settle(firsts, "groups", inside=folder)
    others = settle(found.where("n IS NULL").select("sig", "doc", "at"), "others", inside=folder)
    # Most signatures are in one document: what repeats is settled, the rest of no more use.
    remove_folder(docs.sparkSession, f"{folder}/windows")
    heads = firsts.where("doc = head.doc AND at = head.at").select("sig", "head", "n").distinct()
    others = others.join(heads, "sig").select("sig", "doc", "at", "head", "n")
    members = firsts.select("sig", "doc", "at", "head", "n").union(others)
    by_signature = members.where("doc <> head.doc").select("doc", F.col("head.doc").alias("src"), F.col("head.at").alias("src_at"))
    # The head of a larger group may lack what two others share: they meet by their stretches.
    wanted = (
        members.where("n > 2")
        .groupBy(F.col("doc").alias("__doc"))
        .agg(F.collect_set(F.struct("at", F.expr("cast(sig & 3 AS int)").alias("f"))).alias("wanted"))
    )
    keyed = docs.join(wanted, docs["doc"] == wanted["__doc"])
    keyed = keyed.select("doc", F.explode(F.arrow_udf(_stretches, _KEYS)("text", "wanted")).alias("k"))
    keyed = settle(keyed.select("k.key", "doc", "k.at"), "stretches", inside=folder)
    first = keyed.groupBy("key").agg(F.min(F.struct("doc", "at")).alias("head"), F.max("doc").alias("last"))
    by_stretch = keyed.join(first.where("last > head.doc").select("key", "head"), "key").where("doc <> head.doc")
    return by_signature.union(by_stretch.select("doc", F.col("head.doc").alias("src"), F.col("head.at").alias("src_at")))


BLOCKS = "array<struct<block:int,words:string>>"


def _blocks(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The words of the wanted blocks of a text, joined by blanks."""
    kind = pa.list_(pa.struct([("block", pa.int32()), ("words", pa.string())]))
    for texts, wanted in batches:
        out = []
        for text, blocks in zip(texts.cast(pa.binary()), wanted.to_pylist(), strict=True):
            found = words(text.as_py() or b"")
            parts = ((b, b" ".join(found[b * BLOCK : (b + 1) * BLOCK])) for b in sorted(blocks))
            out.append([{"block": b, "words": part.decode()} for b, part in parts if part])
        yield pa.array(out, kind)


def _clusters(x: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in ``x`` that ``other`` shares, and theirs there, in runs along a diagonal."""
    values, first, counts = np.unique(other, return_index=True, return_counts=True)
    place = np.minimum(np.searchsorted(values, x), len(values) - 1)
    p = np.flatnonzero(values[place] == x)
    if not len(p):
        return
    diagonal, single = first[place[p]] - p, counts[place[p]] == 1
    if single.any():  # a shingle that repeats in the source follows its neighbours, if it stands there
        known = np.maximum.accumulate(np.where(single, np.arange(len(p)), -1))
        near = diagonal[np.where(known < 0, np.argmax(single), known)]
        there = (p + near >= 0) & (p + near < len(other))
        there[there] = other[(p + near)[there]] == x[p[there]]
        diagonal = np.where(there, near, diagonal)
    y = np.clip(p + diagonal, 0, len(other) - 1)
    breaks = np.flatnonzero((np.diff(p) > GAP + 1) | (np.abs(np.diff(diagonal)) > GAP)) + 1
    yield from zip(np.split(p, breaks), np.split(y, breaks), strict=True)


def _may_hide(shared: list[np.ndarray], passages: list[tuple]) -> bool:
    """Whether WIDTH shared positions in a row lie in no passage."""
    p = np.concatenate(shared or [np.zeros(0, np.int64)])
    if len(p) < WIDTH:
        return False
    breaks = np.flatnonzero(np.diff(p) > 1)
    firsts, lasts = p[np.concatenate(([0], breaks + 1))], p[np.concatenate((breaks, [len(p) - 1]))]
    wide = lasts - firsts + 1 >= WIDTH
    return any(
        not any(s[0] <= a and b <= s[1] for s in passages)
        for a, b in zip(firsts[wide].tolist(), lasts[wide].tolist(), strict=True)
    )


def _exact_runs(x: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in ``x`` and ``other`` of every stretch of WIDTH shingles or more that stands in
    both; of a stretch that ``other`` has more than once, its first place there."""
    windows, first = np.unique(_rolling(other, WIDTH), return_index=True)
    mine = _rolling(x, WIDTH)
    if not len(windows) or not len(mine):
        return
    place = np.minimum(np.searchsorted(windows, mine), len(windows) - 1)
    starts = np.flatnonzero(windows[place] == mine)
    if not len(starts):
        return
    diagonal = first[place[starts]] - starts
    breaks = np.flatnonzero((np.diff(starts) > 1) | (np.diff(diagonal) != 0)) + 1
    for group in np.split(np.arange(len(starts)), breaks):
        p = np.arange(starts[group[0]], starts[group[-1]] + WIDTH)
        yield p, p + diagonal[group[0]]


def _similarity(x: np.ndarray, other: np.ndarray) -> float:
    mine, theirs = np.unique(x), np.unique(other)
    shared = len(np.intersect1d(mine, theirs, assume_unique=True))
    return shared / (len(mine) + len(theirs) - shared)


def _agreeing(mine: list[bytes], theirs: list[bytes], i: int, j: int, step: int, room: int) -> int:
    """How many words from ``i`` and ``j`` on, ``room`` at most, end with an equal word."""
    return max((e + 1 for e in range(room) if mine[i + e * step] == theirs[j + e * step]), default=0)


def _extended(
    mine: list[bytes], theirs: list[bytes], a: int, b: int, c: int, d: int
) -> tuple[int, int, int, int]:
    """The stretches a to b and c to d of shingles, with up to SHINGLE words more at either end
    as far as equal words stand there behind changed ones, and as a passage needs."""
    left = min(SHINGLE, a, c)
    right = min(SHINGLE, len(mine) - SHINGLE - b, len(theirs) - SHINGLE - d)
    before = _agreeing(mine, theirs, a - 1, c - 1, -1, left)
    after = _agreeing(mine, theirs, b + SHINGLE, d + SHINGLE, 1, right)
    lacking = WIDTH - min(b - a, d - c) - 1 - before - after
    if lacking > 0:
        more = min(lacking, left - before)
        before, after = before + more, after + min(lacking - more, right - after)
    return a - before, b + after, c - before, d + after


def _verified(
    x: np.ndarray, other: np.ndarray, p: np.ndarray, y: np.ndarray, mine: list[bytes], theirs: list[bytes]
) -> Iterator[tuple[int, int, int, int, float]]:
    open_ = [(p, y)]
    while open_:
        p, y = open_.pop()
        inner = (int(p[0]), int(p[-1]), int(y.min()), int(y.max()))
        if inner[1] - inner[0] + 1 + 2 * SHINGLE < WIDTH:
            continue
        for a, b, c, d in dict.fromkeys((_extended(mine, theirs, *inner), inner)):
            if b - a + 1 < WIDTH:
                continue
            similarity = _similarity(x[a : b + 1], other[c : d + 1])
            if similarity >= SIMILARITY:
                yield a, b, c, d, similarity
                break
        else:
            if len(p) > 1:
                steps = np.maximum(np.diff(p), np.abs(np.diff(y)))
                cut = int(steps.argmax()) + 1
                if steps[cut - 1] > 1:
                    open_ += [(p[:cut], y[:cut]), (p[cut:], y[cut:])]


COPIED = (
    "array<struct<first:int,last:int,source:bigint,source_first:int,source_last:int,similarity:double>>"
)
_COPIED = pa.list_(
    pa.struct(
        [
            ("first", pa.int32()), ("last", pa.int32()), ("source", pa.int64()),
            ("source_first", pa.int32()), ("source_last", pa.int32()), ("similarity", pa.float64()),
        ]
    )
)


def copied_in(text: bytes, blocks: list[dict], hash_of: Callable[[bytes], int]) -> list[dict]:
    """What of ``text`` the blocks {source, block, words} of other documents have."""
    mine = words(text)
    x = shingles(mine, hash_of)
    out, at = [], 0
    blocks = sorted(blocks, key=lambda b: (b["source"], b["block"]))
    while at < len(blocks):
        end = at + 1
        while end < len(blocks) and (blocks[end]["source"], blocks[end]["block"]) in (
            (blocks[at]["source"], blocks[end - 1]["block"]),
            (blocks[at]["source"], blocks[end - 1]["block"] + 1),
        ):
            end += 1
        run = {b["block"]: b["words"] for b in blocks[at:end]}
        theirs = " ".join(run.values()).encode().split()
        other = shingles(theirs, hash_of)
        start = blocks[at]["block"] * BLOCK
        if len(other):
            clusters = list(_clusters(x, other))
            passages = [s for p, y in clusters for s in _verified(x, other, p, y, mine, theirs)]
            # Longer passages may hide a repeat whose shingles the source has elsewhere as well.
            for p, y in _exact_runs(x, other) if _may_hide([p for p, _ in clusters], passages) else ():
                if not any(s[0] <= p[0] and p[-1] <= s[1] for s in passages):
                    passages += _verified(x, other, p, y, mine, theirs)
            for a, b, c, d, similarity in passages:
                out.append(
                    {
                        "first": a, "last": b + SHINGLE - 1, "source": blocks[at]["source"],
                        "source_first": start + c, "source_last": start + d + SHINGLE - 1,
                        "similarity": similarity,
                    }
                )
        at = end
    return sorted(out, key=lambda s: (s["first"], s["last"], s["source"], s["source_first"]))


def _copied(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    hash_of = _Hashes().__getitem__
    for texts, wanted in batches:
        out = []
        for text, blocks in zip(texts.cast(pa.binary()), wanted, strict=True):
            blocks = blocks.as_py()
            out.append(copied_in(text.as_py(), blocks, hash_of) if blocks and text.is_valid else [])
        yield pa.array(out, _COPIED)


def find(docs: DataFrame, *, key: str = "doc_id", text: str = "text", into: str = "copied") -> DataFrame:
    """``docs`` with an array ``into``: each copied passage (first and last word), its source
    document and the passage there, and their similarity."""
    if into in docs.columns:
        raise ValueError(f"docs already has {into}; name another column")
    block_words = F.arrow_udf(_blocks, BLOCKS)
    # Evaluated once, wherever the result is used.
    copied = F.arrow_udf(_copied, COPIED).asNondeterministic()
    known = docs.where(F.col(key).isNotNull())
    narrow = known.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    reach = F.sequence(
        F.floor(F.greatest(F.col("src_at") - WORDS, F.lit(0)) / BLOCK).cast("int"),
        F.floor((F.col("src_at") + WORDS + SHINGLE) / BLOCK).cast("int"),
    )
    spark = docs.sparkSession
    folder, linked = new_folder(spark, "copied"), new_folder(spark, "links")
    wanted_blocks = links(narrow, linked).select("doc", "src", F.explode(reach).alias("block")).distinct()
    wants = settle(wanted_blocks, "wants", inside=folder)
    remove_folder(spark, linked)
    src, wanted, doc, held = free_names([*docs.columns, into], "__src", "__wanted", "__doc", "__blocks")
    sources = wants.groupBy(F.col("src").alias(src)).agg(F.collect_set("block").alias(wanted))
    # Joined as below, so that one shuffle of the texts serves both where all columns are wanted.
    blocks = (
        known.join(sources, known[key].cast("bigint") == sources[src])
        .select(F.col(src).alias("src"), F.explode(block_words(F.col(text), F.col(wanted))).alias("b"))
        .select("src", "b.block", "b.words")
    )
    fetched = (
        wants.join(blocks, ["src", "block"])
        .groupBy(F.col("doc").alias(doc))
        .agg(F.collect_list(F.struct(F.col("src").alias("source"), "block", "words")).alias(held))
    )
    joined = known.join(fetched, known[key].cast("bigint") == fetched[doc], "left")
    some = F.col(held).isNotNull()
    found = F.when(some, copied(F.when(some, F.col(text)), F.col(held)))
    none = F.array().cast(COPIED)
    judged = joined.withColumn(into, F.coalesce(found, none)).drop(doc, held)
    return judged.unionByName(docs.where(F.col(key).isNull()).withColumn(into, none))


#: Sorted passages, joined where they touch or overlap.
_MERGED = f"""
aggregate(`copied`, cast(array() AS {SPANS}), (done, s) ->
  IF(size(done) > 0 AND element_at(done, -1).last >= s.first - 1,
     concat(slice(done, 1, size(done) - 1), array(named_struct(
       'first', element_at(done, -1).first, 'last', greatest(element_at(done, -1).last, s.last)))),
     concat(done, array(named_struct('first', s.first, 'last', s.last)))))
"""


def spans(copied: str) -> Column:
    """The copied words of a document as spans that do not overlap."""
    return F.expr(_MERGED.replace("`copied`", f"`{copied}`"))


def remove(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without copied passages; documents that had nothing else go."""
    copied, cut = free_names(docs.columns, "__copied", "__cut")
    found = find(docs, key=key, text=text, into=copied)
    left = found.withColumn(cut, spans(copied)).withColumn(text, without_spans(F.col(text), F.col(cut)))
    some = (F.size(cut) == 0) | F.col(text).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    return left.where(some).drop(copied, cut)
