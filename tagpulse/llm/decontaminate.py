"""Passages of benchmark items in training documents, and their removal.

A generalised suffix automaton holds every run of words of the items. Each document streams
its words through it; at each word the automaton knows the longest run ending there that is
part of an item. Where that reaches a window (``window`` words, or a whole shorter item),
those words are hit, and the state of the window names the items that hold it.

Null texts and items without words hit nothing; an item without an id is ignored; items that
share an id count as one. Repeated documents are judged alike, an empty table gives an empty
result, and other columns of any name stay.

Items are taken in shards of about ``shard_words`` words, so an automaton has a fixed size
whatever the item table has; a long item is cut into pieces that overlap by ``window - 1``
words, which keeps every window whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.words import SPANS, without_spans, words, words_column

WINDOW = 10
SHARD_WORDS = 200_000
PIECE_WORDS = 50_000
#: A document with a larger share of hit words is dropped; from any other the spans are cut.
COVERAGE = 0.5

FOUND = f"struct<n_words:bigint,spans:{SPANS},items:array<string>>"


class Automaton:
    """States are numbered, 0 is the root. ``steps`` holds the transitions of each."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        items = list(items)
        self.window = window
        self.steps: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = []
        for _, item in items:
            state = 0
            for word in item:
                state = self._extend(state, word)
            ends.append(state)
        states = sorted(range(len(self.link)), key=self.length.__getitem__)
        #: For states of runs of a window or more: the state of their last ``window`` words.
        self.tail = [0] * len(states)
        #: Shorter items that end wherever the state's longest run ends: (words, item).
        self.short: list[tuple[tuple[int, str], ...]] = [()] * len(states)
        for (name, item), end in zip(items, ends, strict=True):
            if 0 < len(item) < window:
                self.short[end] += ((len(item), name),)
        for state in states[1:]:
            up = self.link[state]
            self.short[state] += self.short[up]
            if self.length[state] >= window:
                self.tail[state] = self.tail[up] if self.length[up] >= window else state
        self.notable = [bool(a or b) for a, b in zip(self.tail, self.short, strict=True)]
        self.items: dict[int, set[str]] = {}
        for name, item in items:
            if len(item) >= window:
                for _, state, run in self._runs(item):
                    if run >= window:
                        self.items.setdefault(self.tail[state], set()).add(name)

    def _add(self, length: int, link: int, steps: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.steps.append(steps)
        return len(self.link) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for the runs that end in ``state`` and ``word``."""
        copy = self._add(self.length[state] + 1, self.link[target], dict(self.steps[target]))
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def _extend(self, state: int, word: bytes) -> int:
        target = self.steps[state].get(word)
        if target is not None:  # an earlier item had this run
            if self.length[target] == self.length[state] + 1:
                return target
            return self._split(state, word, target)
        new = self._add(self.length[state] + 1, 0, {})
        while state >= 0 and word not in self.steps[state]:
            self.steps[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.steps[state][word]
            if self.length[target] != self.length[state] + 1:
                target = self._split(state, word, target)
            self.link[new] = target
        return new

    def _runs(self, text: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Position, state and length of the longest run, where an item may be found."""
        steps, link, length, notable = self.steps, self.link, self.length, self.notable
        state = run = 0
        for at, word in enumerate(text):
            target = steps[state].get(word)
            if target is None:
                while state and target is None:
                    state = link[state]
                    run = length[state]
                    target = steps[state].get(word)
                if target is None:
                    run = 0
                    continue
            state = target
            run += 1
            if notable[state]:
                yield at, state, run

    def find(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans (first, last) of hit words, and the items found."""
        spans: list[tuple[int, int]] = []
        tails, names = set(), set()
        for at, state, run in self._runs(text):
            size = 0
            if run >= self.window:
                size = self.window
                tails.add(self.tail[state])
            for n, name in self.short[state]:
                if n <= run:
                    names.add(name)
                    size = max(size, n)
            if size:
                first = at - size + 1
                while spans and spans[-1][1] >= first - 1:
                    first = min(first, spans.pop()[0])
                spans.append((first, at))
        for tail in tails:
            names |= self.items[tail]
        return spans, names


def _pieces(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Items as words, long ones in overlapping pieces."""
    step = PIECE_WORDS - (window - 1)
    whole = items.select(F.col(item_id).cast("string").alias("item"), words_column(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(step))
    return (
        whole.where("item IS NOT NULL AND size(w) > 0")
        .select("item", "w", F.explode(starts).alias("start"))
        .select("item", F.slice("w", F.col("start") + 1, PIECE_WORDS).alias("w"))
    )


def _found_by(text: Column, automaton: Automaton) -> Column:
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
            ("items", pa.list_(pa.string())),
        ]
    )

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = automaton.find  # goes along with the function, which Spark broadcasts if large
        for batch in batches:
            rows = []
            for value in batch.cast(pa.binary()):
                text = words(value.as_py())
                spans, names = find(text)
                rows.append(
                    {
                        "n_words": len(text),
                        "spans": [{"first": a, "last": b} for a, b in spans],
                        "items": sorted(names),
                    }
                )
            yield pa.array(rows, kind)

    # Evaluated once, wherever its parts are used.
    return found.asNondeterministic()(F.coalesce(text, F.lit("")))


#: Sorted spans of several shards, joined where they touch or overlap.
_MERGED = """
aggregate(array_sort(flatten(transform(parts, p -> p.spans))), cast(array() AS {spans}), (done, s) ->
  IF(size(done) > 0 AND element_at(done, -1).last >= s.first - 1,
     concat(slice(done, 1, size(done) - 1), array(named_struct(
       'first', element_at(done, -1).first, 'last', greatest(element_at(done, -1).last, s.last)))),
     concat(done, array(s))))
"""


def find(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    into: str = "found",
) -> DataFrame:
    """``docs`` with a struct ``into``: words, hit spans and the ids (as text) of the items."""
    if into in docs.columns:
        raise ValueError(f"docs already has {into}; name another column")
    pieces = _pieces(items, item_id, item_text, window)
    total = pieces.agg(F.coalesce(F.sum(F.size("w")), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_words))
    columns = []
    for shard in range(shards):
        mine = F.pmod(F.xxhash64("item", "w"), F.lit(shards)) == shard
        rows = pieces.where(mine).distinct().collect()
        automaton = Automaton([(r["item"], [w.encode() for w in r["w"]]) for r in rows], window)
        columns.append(_found_by(F.col(text), automaton))
    if shards == 1:
        return docs.withColumn(into, columns[0])
    parts = docs.withColumn(into, F.array(*columns))
    merged = _MERGED.format(spans=SPANS).replace("parts", f"`{into}`")
    return parts.withColumn(
        into,
        F.struct(
            F.col(into)[0]["n_words"].alias("n_words"),
            F.expr(merged).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.col(into)["items"]))).alias("items"),
        ),
    )


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"] + 1))


def remove(
    docs: DataFrame, items: DataFrame, *, text: str = "text", coverage: float = COVERAGE, **options
) -> DataFrame:
    """``docs`` without the hit spans, and without documents hit in more than ``coverage``."""
    into = "__found"
    found = find(docs, items, text=text, into=into, **options)
    spans = F.col(into)["spans"]
    return (
        found.where(hit_words(spans) <= F.col(into)["n_words"] * F.lit(coverage))
        .withColumn(text, without_spans(F.col(text), spans))
        .drop(into)
    )
