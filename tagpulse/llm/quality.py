"""A byte-level convolutional network in numpy that scores how good a text is.

Bytes become small learned vectors. Filters of ``2 * HALF`` bytes move by ``HALF`` bytes, so
overlapping chunks cover the whole text, however long; beside the bytes a chunk sees how many
of its bytes repeat the one ``lag`` bytes before, for the best of ``LAGS`` lags. The largest
response of every filter over all chunks, and its mean, go through one hidden layer into one
probability.

Fitting takes at most ``ROWS_PER_CLASS`` labelled rows of each class (those of the smallest
hash), whatever the label table holds, and their whole texts, which the driver keeps;
weights give the classes the shares they have among all labelled rows. Fitting and scoring read
texts piece by piece; only chunks with a filter's largest response, and means, have gradients.

Null and empty texts get the score of a text of blanks. Unlabelled rows, null labels and
repeated rows are allowed in the labels; with one class only, or none, the score is the
share of label 1 (0.5 without labels). Extra columns stay untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.labelled import sampled, shares

HALF = 8
WIDTH = 6
FILTERS = 24
HIDDEN = 12
LAGS = range(2, 21)
#: A chunk that repeats itself counts as much as several bytes.
REPEATS_SCALE = 4.0
ROWS_PER_CLASS = 1000
STEPS = 400
BATCH = 64
BATCH_BYTES = 1 << 19
#: Rows of HALF bytes that training looks at together.
GROUP_ROWS = 1 << 15
#: Bytes scored at a time; pieces overlap by half a chunk, the maximum joins them.
PIECE = 1 << 16


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in rows of HALF (blanks fill up), and for each row how self-repeating it is."""
    size = max(2, -(-len(text) // HALF)) * HALF
    codes = np.full(size, 32, np.uint8)
    codes[: len(text)] = np.frombuffer(text, np.uint8)
    repeats = np.zeros(size // HALF, np.float32)
    for lag in LAGS:
        if lag < size:
            same = np.zeros(size, np.uint8)
            np.equal(codes[lag:], codes[:-lag], out=same[lag:].view(bool))
            # Eight flags in one word: their sum is the population count.
            counts = np.bitwise_count(same.view(np.uint64)).astype(np.float32)
            np.maximum(repeats, counts, out=repeats)
    return codes.reshape(-1, HALF), repeats * np.float32(REPEATS_SCALE / HALF)


@dataclass
class Network:
    embed: np.ndarray  # 256 x WIDTH
    first: np.ndarray  # HALF * WIDTH + 1 x FILTERS, for the first half of a chunk
    second: np.ndarray  # and for its second half
    bias: np.ndarray
    hidden: np.ndarray  # 2 * FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        def draw(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        rows = HALF * WIDTH + 1
        return cls(
            rng.standard_normal((256, WIDTH)).astype(np.float32), draw(rows, FILTERS), draw(rows, FILTERS),
            np.zeros(FILTERS, np.float32), draw(2 * FILTERS, HIDDEN), np.zeros(HIDDEN, np.float32),
            draw(HIDDEN), np.zeros(1, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return list(vars(self).values())

    def halves(self, codes: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        vectors = self.embed[codes].reshape(len(codes), -1)
        return np.concatenate((vectors, repeats[:, None]), axis=1)

    def responses(self, codes: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        rows = self.halves(codes, repeats)
        return np.maximum(rows[:-1] @ self.first + rows[1:] @ self.second + self.bias, 0)

    def pooled(self, text: bytes) -> np.ndarray:
        top, total, count = np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float64), 0
        at = 0
        while True:
            # HALF bytes of overlap: every chunk of the text lies in exactly one piece.
            answer = self.responses(*features(text[at : at + PIECE + HALF]))
            np.maximum(top, answer.max(axis=0), out=top)
            total += answer.sum(axis=0)
            count += len(answer)
            at += PIECE
            if at + HALF >= len(text):
                return np.concatenate((top, (total / count).astype(np.float32)))

    def combine(self, pooled: np.ndarray) -> np.ndarray:
        inner = np.maximum(pooled @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-(inner @ self.out + self.out_bias)))

    def score(self, text: bytes) -> float:
        return float(self.combine(self.pooled(text)[None])[0])


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, *, steps: int = STEPS, seed: int = 7) -> Network:
    """Fit by Adam on the weighted log loss."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    seen = [features(text) for text in texts]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    classes = [np.flatnonzero(labels == c) for c in (0, 1)]
    sizes = np.array([len(text) for text in texts])
    for step in range(1, steps + 1):
        picked, times = _picked(rng, classes, sizes)
        gradients = _gradients(net, [seen[i] for i in picked], labels[picked], weights[picked] * times)
        rate = 0.004 * (1 - step / (steps + 1))
        for p, g, (m, v) in zip(net.parameters(), gradients, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def _picked(rng: np.random.Generator, classes: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of one step and how often each counts: BATCH of them, both classes in turn, or
    fewer where they are long, so that a step's work has a bound but for its last two texts."""
    drawn = np.stack([rng.choice(c, BATCH // 2) for c in classes], axis=1)
    before = np.cumsum(sizes[drawn].sum(axis=1)) - sizes[drawn].sum(axis=1)
    picked, times = np.unique(drawn[before < BATCH_BYTES], return_counts=True)
    return picked, times.astype(np.float32)


def _cut(batch: list[tuple]) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """The texts of a batch as (text, codes, repeats) in pieces that share a row with the next,
    in groups of about GROUP_ROWS rows, so that long texts need no more memory than short ones."""
    group, size = [], 0
    for text, (codes, repeats) in enumerate(batch):
        for at in range(0, len(codes) - 1, GROUP_ROWS):
            part = slice(at, at + GROUP_ROWS + 1)
            group.append((text, codes[part], repeats[part]))
            size += len(group[-1][1])
            if size >= GROUP_ROWS:
                yield group
                group, size = [], 0
    if group:
        yield group


class _Forward:
    """The filters' answers to a group of pieces."""

    def __init__(self, net: Network, group: list[tuple[int, np.ndarray, np.ndarray]]):
        sizes = np.array([len(codes) for _, codes, _ in group])
        self.texts = np.array([text for text, _, _ in group])
        self.codes = np.concatenate([codes for _, codes, _ in group])
        self.rows = net.halves(self.codes, np.concatenate([repeats for _, _, repeats in group]))
        # Chunks that would join two pieces get no part.
        self.starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        real = np.ones(len(self.codes) - 1, bool)
        real[self.starts[1:] - 1] = False
        answer = self.rows[:-1] @ net.first + self.rows[1:] @ net.second + net.bias
        self.active = (answer > 0) & real[:, None]
        self.answer = np.where(self.active, answer, 0)
        self.piece = np.repeat(np.arange(len(group)), sizes)[:-1]


def _gradients(net: Network, batch: list[tuple], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    counts = np.array([len(codes) - 1 for codes, _ in batch], np.float32)[:, None]
    shape, kind = (len(batch), FILTERS), net.first.dtype
    top, total = np.full(shape, -1, kind), np.zeros(shape, kind)
    winner = np.zeros((len(batch), FILTERS), np.int64)
    groups, number, kept = list(_cut(batch)), 0, None
    for group in groups:
        kept = _Forward(net, group)
        tops = np.maximum.reduceat(kept.answer, kept.starts, axis=0)
        np.add.at(total, kept.texts, np.add.reduceat(kept.answer, kept.starts, axis=0))
        for text, best in zip(kept.texts, tops, strict=True):  # the first piece that has the maximum
            better = best > top[text]
            top[text, better], winner[text, better] = best[better], number
            number += 1
    pooled = np.concatenate((top, total / counts), axis=1)
    inner = np.maximum(pooled @ net.hidden + net.hidden_bias, 0)
    score = 1 / (1 + np.exp(-(inner @ net.out + net.out_bias)))
    d_logit = ((score - labels) * weights / weights.sum()).astype(np.float32)
    d_inner = np.outer(d_logit, net.out) * (inner > 0)
    d_pooled = d_inner @ net.hidden.T
    sums, number = None, 0
    for group in groups:
        seen = kept if len(groups) == 1 else _Forward(net, group)
        owner = seen.texts[seen.piece]
        d_answer = np.where(seen.active, (d_pooled[:, FILTERS:] / counts)[owner], 0)
        # The first chunk that has the maximum takes its gradient.
        is_top = (seen.answer == top[owner]) & seen.active & (winner[owner] == (number + seen.piece)[:, None])
        at, column = np.nonzero(is_top)
        _, first = np.unique(owner[at] * FILTERS + column, return_index=True)
        d_answer[at[first], column[first]] += d_pooled[owner[at[first]], column[first]]
        parts = _of_filters(net, seen, d_answer)
        sums = parts if sums is None else [a + b for a, b in zip(sums, parts, strict=True)]
        number += len(group)
    return [
        *sums, pooled.T @ d_inner, d_inner.sum(axis=0), inner.T @ d_logit, d_logit.sum(keepdims=True),
    ]


def _of_filters(net: Network, seen: _Forward, d_answer: np.ndarray) -> list[np.ndarray]:
    d_rows = np.zeros_like(seen.rows)
    d_rows[:-1] += d_answer @ net.first.T
    d_rows[1:] += d_answer @ net.second.T
    by_byte = d_rows[:, :-1].reshape(-1, WIDTH)
    flat = seen.codes.reshape(-1)
    d_embed = np.stack([np.bincount(flat, by_byte[:, i], 256) for i in range(WIDTH)], axis=1)
    return [d_embed.astype(np.float32), seen.rows[:-1].T @ d_answer, seen.rows[1:].T @ d_answer, d_answer.sum(axis=0)]


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str) -> Network | float:
    """A network from ``docs`` and the column ``label`` (0 or 1) of ``labels``; the share of
    label 1 where there are not two classes."""
    rows, counts = shares(labels, label, key)
    if len(counts) < 2:
        return float(next(iter(counts), 0.5))
    texts, classes = [], []
    for value in (0, 1):
        found = sampled(docs, rows, value, ROWS_PER_CLASS, key=key, content=F.col(text).cast("binary")).collect()
        texts += [bytes(r["content"]) for r in found]
        classes += [value] * len(found)
    if len(set(classes)) < 2:
        return counts[1] / sum(counts.values())
    classes = np.array(classes, np.float32)
    weights = np.where(classes == 1, counts[1], counts[0]).astype(np.float32)
    return train(texts, classes, weights)


def score(text: Column, model: Network | float) -> Column:
    """The probability of label 1."""
    if not isinstance(model, Network):
        return F.lit(float(model))

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            pooled = [model.pooled(value.as_py()) for value in batch.cast(pa.binary())]
            yield pa.array(model.combine(np.stack(pooled)).astype(np.float64) if pooled else [], pa.float64())

    return scores(F.coalesce(text, F.lit("")))
