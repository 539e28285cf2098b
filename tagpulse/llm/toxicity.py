"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Vectors hold every word that an example has, weighted by ``(1 + ln tf) idf``; idf comes from
the number of documents of the whole table that hold the word. Terms that tell of label 1
weigh ``STRESS`` times as much: words, and beginnings of words of ``PREFIXES`` characters, that
stand in toxic examples ``LIFT`` times as often as in others, and more often than chance allows
for so many terms (likelihood ratio; of likely copies, whose smallest word shingle hash is the
same, one counts in that test, as chance means independent texts). Nothing else is left out:
every sampled row is an example, and an exact copy of one has it at cosine 1.

The inverted index takes texts in batches. The terms of the longest lists are columns of a
matrix of all examples: one product in single precision gives what they add to the cosines of
a batch. The lists of the other terms add the rest. Only examples that rounding leaves among
the ``NEAREST`` are looked at again, and their cosines taken in double precision over all
terms; so the neighbours are exact.

Neighbours vote with weights that fall with the square of distance and that give the classes
the shares they have among all labelled rows, so that scores are probabilities; the neighbours
are the evidence. Words that no example has add nothing to a text's vector; a text without any
other (null and empty ones too) gets the share of label 1 among examples without words.

Fitting takes at most ``ROWS_PER_CLASS`` labelled rows of each class, those whose keys have
the smallest hashes, with their whole texts; the words of those rows and their counts go
through the driver. Document counts and scoring read whole texts of all documents. Null labels
and keys are left out, repeated rows count as rows. With one class only, or none, the score is
the share of label 1 (0.5 without labels). Examples equally near are taken in index order.
Extra columns stay untouched.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.labelled import sampled, shares
from tagpulse.llm.passages import shingles
from tagpulse.llm.shared import settle
from tagpulse.llm.words import words

PREFIXES = (4, 5, 6)
SHORTEST = min(PREFIXES)
ROWS_PER_CLASS = 3000
NEAREST = 15
#: Terms whose lists are columns, texts bounded together, and twice what single precision can be
#: wrong by, relatively, in a sum of so many.
COLUMNS = 768
TOGETHER = 128
ROUNDING = 4 * (COLUMNS + 8) * 2.0**-24
#: What a telling term weighs against another of the same idf.
STRESS = 20
#: Added to a neighbour's distance before its vote is 1 / distance squared.
CLOSE = 0.02
#: Weight of the overall share of label 1 against one neighbour at distance one.
SMOOTHING = 0.1
#: Least number of examples of label 1 that a term must stand in.
SUPPORT = 3
LIFT = 4
#: Terms a task counts before it passes them on, and bytes of texts whose terms it counts together.
HELD = 500_000
HELD_BYTES = 1 << 17


def terms_of(word: bytes) -> list[str]:
    text = word.decode()
    return [text, *(f"{text[:n]}*" for n in PREFIXES if len(text) >= n)]


class _Terms(dict):
    """The vocabulary by number. Any word gets the number of its own term, else of its longest
    beginning that is a term, else ``none``; all its terms are a range of ``numbers``, as with a
    term go the beginnings of it that are terms."""

    def __init__(self, vocabulary: Iterable[tuple[bytes, int]]):
        super().__init__(vocabulary)
        self.none = len(self)
        self.starts = {term[:SHORTEST] for term in self if term.endswith(b"*")}
        more = {number: self._beginnings(term.rstrip(b"*")) for term, number in self.items() if term[:SHORTEST] in self.starts}
        sizes = np.ones(self.none + 1, np.int32)
        sizes[-1] = 0
        for number, found in more.items():
            more[number] = [number, *(n for n in found if n != number)]
            sizes[number] = len(more[number])
        self.first = np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)])
        self.numbers = np.repeat(np.arange(self.none + 1, dtype=np.int32), sizes)
        for number, found in more.items():
            self.numbers[self.first[number] : self.first[number + 1]] = found

    def __missing__(self, word: bytes) -> int:
        # Characters are a byte at least.
        if word[:SHORTEST] not in self.starts:
            return self.none
        return max(self._beginnings(word), key=lambda n: self.first[n + 1] - self.first[n], default=self.none)

    def _beginnings(self, word: bytes) -> list[int]:
        return [self[t] for t in map(str.encode, terms_of(word)[1:]) if t in self]


def count_all(texts: list[bytes], terms: _Terms) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the numbers of its terms, rising, and how often each occurs."""
    found = [words(text) for text in texts]
    n = np.array([len(f) for f in found], np.int64)
    of = np.fromiter(map(terms.__getitem__, chain.from_iterable(found)), np.int64, n.sum())
    at, sizes = _ranges(terms.first[of], terms.first[of + 1])
    # One sort for all texts.
    text = np.repeat(np.repeat(np.arange(len(texts)), n), sizes)
    both, tf = np.unique(text * (terms.none + 1) + terms.numbers[at], return_counts=True)
    text, numbers = np.divmod(both, terms.none + 1)
    ends = np.searchsorted(text, np.arange(1, len(texts)))
    return list(zip(np.split(numbers, ends), np.split(tf.astype(np.float64), ends), strict=True))


def counted(texts: pa.Array, terms: _Terms) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for a column, about ``HELD_BYTES`` of texts at a time."""
    held, size = [], 0
    for text in texts.cast(pa.binary()):
        held.append(text.as_py())
        size += len(held[-1])
        if size >= HELD_BYTES:
            yield from count_all(held, terms)
            held, size = [], 0
    if held:
        yield from count_all(held, terms)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges one after another, and the length of each range."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes), sizes


@dataclass
class Example:
    key: int
    label: int
    terms: np.ndarray
    weights: np.ndarray


class Index:
    """Inverted lists of the examples. The terms of the longest lists are columns of a matrix in
    single precision, so that one product bounds a whole batch of texts; weights are positive,
    so its rounding is relative. The examples themselves lie one after another, each a block."""

    def __init__(self, examples: list[Example], terms: int):
        # Examples whose heaviest terms are the same lie side by side.
        self.examples = sorted(
            examples, key=lambda e: (e.terms[np.lexsort((e.terms, -e.weights))[:8]].tolist(), e.key, e.label)
        )
        self.terms = terms
        self.blocks = len(examples)
        sizes = [len(e.terms) for e in self.examples]
        self.term = np.concatenate([e.terms for e in self.examples] or [np.zeros(0, np.int64)]).astype(np.int32)
        self.weight = np.concatenate([e.weights for e in self.examples] or [np.zeros(0)])
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.start = np.searchsorted(self.row, np.arange(self.blocks + 1))
        long = np.argsort(-np.bincount(self.term, minlength=terms), kind="stable")[:COLUMNS]
        #: Of each term its column, or -1.
        self.column = np.full(terms, -1, np.int32)
        self.column[long] = np.arange(len(long))
        short = np.flatnonzero(self.column[self.term] < 0)
        short = short[np.argsort(self.term[short], kind="stable")]
        self.in_row, self.in_weight = self.row[short], self.weight[short].astype(np.float32)
        self.lists = np.searchsorted(self.term[short], np.arange(terms + 1))
        self._made: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        for example in self.examples:  # held above
            example.terms = example.weights = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_made": None}

    def _scratch(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The matrix, zeros for the weights of a text, and marks of its terms; made where they are used."""
        if self._made is None:
            matrix = np.zeros((min(COLUMNS, self.terms), len(self.examples)), np.float32)
            at = np.flatnonzero(self.column[self.term] >= 0)
            matrix[self.column[self.term[at]], self.row[at]] = self.weight[at]
            self._made = matrix, np.zeros(self.terms), np.zeros(self.terms, bool)
        return self._made

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` largest cosines over zero and the examples that have them."""
        return self.nearest_of([(terms, weights)], k)[0]

    def nearest_of(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """The same for many texts."""
        out = []
        matrix, query, held = self._scratch()
        for first in range(0, len(texts), TOGETHER):
            some = texts[first : first + TOGETHER]
            left = np.zeros((len(some), len(matrix)), np.float32)
            columns = [self.column[terms] for terms, _ in some]
            for line, column, (_, weights) in zip(left, columns, some, strict=True):
                line[column[column >= 0]] = weights[column >= 0]
            for bound, column, (terms, weights) in zip(left @ matrix, columns, some, strict=True):
                query[terms], held[terms] = weights, True
                out.append(self._among(bound, terms[column < 0], query, k))
                query[terms], held[terms] = 0, False
        return out

    def _among(self, bound: np.ndarray, short: np.ndarray, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The nearest of one text, given what its columns add to each cosine and its other terms."""
        at, sizes = _ranges(self.lists[short], self.lists[short + 1])
        bound = bound + np.bincount(
            self.in_row[at], weights=self.in_weight[at] * np.repeat(query[short], sizes), minlength=len(bound)
        )
        least = np.partition(bound, -k)[-k] * (1 - ROUNDING) if len(bound) > k else 0.0
        blocks = np.flatnonzero((bound >= least) & (bound > 0))
        cosines, rows = self._cosines(blocks, query)
        best = np.lexsort((rows, -cosines))[:k]
        return list(zip(cosines[best].tolist(), rows[best].tolist(), strict=True))

    def _cosines(self, blocks: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cosines over zero of the examples of some blocks."""
        starts, ends = self.start[blocks], self.start[blocks + 1]
        spans = [self.term[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        # Marks are small enough for a cache; few terms of an example stand in the text.
        shared = np.flatnonzero(self._scratch()[2][np.concatenate([self.term[:0], *spans])])
        local = np.repeat(np.arange(len(blocks)), ends - starts)[shared]
        at = shared + (starts - np.cumsum(ends - starts) + ends - starts)[local]
        cosines = np.bincount(local, weights=query[self.term[at]] * self.weight[at], minlength=len(blocks))
        found = np.flatnonzero(cosines)
        return cosines[found], blocks[found]


class Model:
    def __init__(
        self,
        vocabulary: dict[str, int] | _Terms,
        weights: np.ndarray,
        examples: list[tuple[int, int, np.ndarray, np.ndarray]],
        counts: dict[int, int],
    ):
        self.terms = vocabulary if isinstance(vocabulary, _Terms) else _Terms((t.encode(), n) for t, n in vocabulary.items())
        self.weights = weights
        held = Counter(label for _, label, *_ in examples)
        #: What one example of a class stands for.
        self.stands_for = {c: counts[c] / sum(counts.values()) / held[c] * len(examples) for c in held}
        self.share = counts[1] / sum(counts.values())
        self.index = Index(
            [Example(key, label, found, self.vector(found, tf)) for key, label, found, tf in examples if len(found)],
            len(weights),
        )
        empty = [label for _, label, found, _ in examples if not len(found)]
        self.without_terms = self._voted([(1.0, label) for label in empty])

    def vector(self, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
        raw = (1 + np.log(tf)) * self.weights[terms]
        return raw / math.sqrt(float((raw * raw).sum()))

    def _voted(self, votes: list[tuple[float, int]]) -> float:
        total, ones = SMOOTHING, SMOOTHING * self.share
        for weight, label in votes:
            weight *= self.stands_for[label]
            total += weight
            ones += weight * label
        return ones / total

    def judge(self, terms: np.ndarray, tf: np.ndarray) -> tuple[float, list[tuple[Example, float]]]:
        """The score, and the nearest examples with their cosines."""
        return self.judge_all([(terms, tf)])[0]

    def judge_all(
        self, texts: list[tuple[np.ndarray, np.ndarray]]
    ) -> list[tuple[float, list[tuple[Example, float]]]]:
        """The same for many texts."""
        vectors = [(terms, self.vector(terms, tf) if len(terms) else tf) for terms, tf in texts]
        return [self._judged(near) for near in self.index.nearest_of(vectors, NEAREST)]

    def _judged(self, near: list[tuple[float, int]]) -> tuple[float, list[tuple[Example, float]]]:
        if not near:
            return self.without_terms, []
        found = [(self.index.examples[at], min(cosine, 1.0)) for cosine, at in near]
        return self._voted([(1 / (1 + CLOSE - cosine) ** 2, e.label) for e, cosine in found]), found


def _sketches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The smallest shingle hash of a text; that of its words, where it has no shingle."""
    for batch in batches:
        out = []
        for text in batch.cast(pa.binary()):
            found = words(text.as_py())
            hashes = shingles(found, xxhash.xxh3_64_intdigest)
            least = int(hashes.min()) if len(hashes) else xxhash.xxh3_64_intdigest(b" ".join(found))
            out.append(least - (1 << 63))
        yield pa.array(out, pa.int64())


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each label a term stands, summed over as many texts as fit."""
    counts: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        columns = [pa.array(list(counts)), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))]
        return pa.RecordBatch.from_arrays(columns, names=["term", "n0", "n1"])

    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("content").cast(pa.binary()), strict=True):
            for term in {t for word in set(words(text.as_py())) for t in terms_of(word)}:
                counts.setdefault(term, [0, 0])[label] += 1
            if len(counts) > HELD:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def _documents_with(terms: _Terms):
    """In how many texts each term of the vocabulary stands, by number, summed over a task."""

    def standing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(terms.none, np.int64)
        for batch in batches:
            for numbers, _ in counted(batch.column(0), terms):
                counts[numbers] += 1
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["number", "n"])

    return standing


def _likelihood_ratio(a: Column, n1: float, b: Column, n0: float) -> Column:
    """2 * sum(observed * ln(observed / expected)) of a term's presence in two classes."""

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    share = (a + b) / (n1 + n0)
    cells = ((a, n1 * share), (F.lit(n1) - a, n1 * (1 - share)), (b, n0 * share), (F.lit(n0) - b, n0 * (1 - share)))
    return 2 * sum((part(o.cast("double"), e) for o, e in cells), F.lit(0.0))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str) -> Model | float:
    """A model from ``docs`` and the column ``label`` (0 or 1) of ``labels``; the share of
    label 1 where there are not two classes."""
    rows, counts = shares(labels, label, key)
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    zero, one = (sampled(docs, rows, v, ROWS_PER_CLASS, key=key, content=F.col(text)) for v in (0, 1))
    sketch = F.arrow_udf(_sketches, "bigint")
    copies = Window.partitionBy("label", "sketch").orderBy("key", "hash")
    sample = settle(zero.union(one).withColumn("sketch", sketch("content")), "examples")
    sample = sample.withColumn("hash", F.xxhash64("content"))
    single = sample.select("label", "sketch", "key", "hash").withColumn("copy", F.row_number().over(copies))
    single = single.where("copy = 1").select("label", "key", "hash").distinct()
    held = {r["label"]: r["n"] for r in single.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(held) < 2:
        return counts[1] / sum(counts.values())
    n0, n1 = held[0], held[1]
    once = sample.join(single, ["label", "key", "hash"], "left_semi").select("label", "content")
    present = once.mapInArrow(_presence, "term string, n0 bigint, n1 bigint")
    present = present.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    present = settle(present, "terms")
    tested = present.count()
    ratio = _likelihood_ratio(F.col("n1"), n1, F.col("n0"), n0)
    # Below this ratio some of so many terms would stand out by chance.
    often = (F.col("n1") >= SUPPORT) & (F.col("n1") * n0 > LIFT * F.col("n0") * n1)
    telling = often & (ratio > 2 * math.log(max(tested, 2)))
    # Bounded by the sampled rows: their words, and of the beginnings those that tell.
    marked = present.select("term", telling.alias("telling"), (F.col("n0") + F.col("n1")).alias("n")).where("telling OR term NOT LIKE '%*'")
    terms = marked.orderBy("term").toArrow()
    # Frequent ones first, so that they lie together in memory.
    order = np.argsort(-terms.column("n").to_numpy(), kind="stable")
    known = _Terms(zip(terms.column("term").cast(pa.binary()).take(order).to_pylist(), order.tolist(), strict=True))
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("content"))
    standing = texts.mapInArrow(_documents_with(known), "number bigint, n bigint")
    standing = standing.groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    total = docs.count()
    n = np.zeros(known.none)
    n[standing.column("number").to_numpy()] = standing.column("n").to_numpy()
    stress = np.where(terms.column("telling").to_numpy(zero_copy_only=False).astype(bool), STRESS, 1)
    weights = np.log((total + 1) / (n + 0.5)) * stress

    @F.arrow_udf("struct<terms:array<bigint>,tf:array<double>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("terms", pa.list_(pa.int64())), ("tf", pa.list_(pa.float64()))])
        for batch in batches:
            yield pa.array([{"terms": a, "tf": b} for a, b in counted(batch, known)], kind)

    # A bounded number of rows, each the terms of a text.
    rows = sample.select("key", "label", found("content").alias("found")).toArrow().to_batches()
    examples = [
        (key, label, one["terms"].values.to_numpy(), one["tf"].values.to_numpy())
        for batch in rows
        for key, label, one in zip(
            batch.column("key").to_pylist(), batch.column("label").to_pylist(), batch.column("found"), strict=True
        )
    ]
    return Model(known, weights, examples, counts)


JUDGED = "struct<score:double,evidence:array<struct<key:bigint,label:int,cosine:double>>>"


def judge(text: Column, model: Model | float) -> Column:
    """A struct of ``score``, the probability of label 1, and ``evidence``: the nearest
    examples with their labels and cosines, nearest first."""
    if not isinstance(model, Model):
        return F.struct(F.lit(float(model)).alias("score"), F.array().cast(JUDGED.split(",", 1)[1][9:-1]).alias("evidence"))
    evidence = pa.list_(pa.struct([("key", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
    kind = pa.struct([("score", pa.float64()), ("evidence", evidence)])

    @F.arrow_udf(JUDGED)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            texts = counted(batch, model.terms)
            while some := list(islice(texts, TOGETHER)):
                for score, found in model.judge_all(some):
                    near = [{"key": e.key, "label": e.label, "cosine": c} for e, c in found]
                    out.append({"score": score, "evidence": near})
            yield pa.array(out, kind)

    return judged.asNondeterministic()(F.coalesce(text, F.lit("")))
