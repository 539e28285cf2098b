"""Importance resampling of documents toward the words of a target, over hashed word runs.

A text, with A-Z lower-cased, is split by an untrained ``tokenizers`` pre-tokeniser into words
with offsets. A feature is a run of 1 to ``longest`` consecutive words, joined by one blank:
the stretch between an offset pair of the words laid out with single blanks. The CRC-32 of its
UTF-8 bytes modulo ``buckets`` is its bucket. Histograms of all documents and of all targets
give each bucket a gain (the logarithm of the ratio of the two smoothed shares, in
thousandths, floored); a document's weight is the floored mean gain of its features. Weights
with Gumbel noise drawn from the keys' digests give scores, and the highest are drawn, which
is sampling without replacement in proportion to the exponential of the weights.

Texts are tokenised once: each document's buckets are written as one binary value, of two or
four bytes a feature, which the histogram and the weights read. Only the two histograms, of
at most ``buckets`` rows each, come to the driver. Ranks come from a sort in ranges over all
tasks and from the number of rows before each range.

Null and empty texts, and texts without words, have no features, weight 0, and are never
drawn (``min_words`` is at least 1). Long texts are split in pieces between words. Bytes that
are not UTF-8 count as U+FFFD. A null key hashes as the empty string and comes after others in
a tie. Repeated rows are documents of their own. Other columns are left out, whatever their
names. An empty table of documents gives an empty result, an empty target gains below zero
for common words.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Regex, pre_tokenizers

from tagpulse.llm.shared import settle
from tagpulse.llm.words import WORD

#: Characters a call of the pre-tokeniser gets; it slows down on longer texts.
PIECE_CHARS = 4000
#: Runs whose buckets a task remembers.
MEMO_ENTRIES = 1 << 20
LONGEST, BUCKETS = 1, 10_000
MIN_WORDS, PERCENT, SEED = 20, 10, "2024"

_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: monotonically_increasing_id: the partition stands above this many bits.
_ROW_BITS = 33


def lowered(text: str) -> str:
    """With A-Z, and nothing else, in lower case."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


class Splitter:
    """Words of a text with their offsets, piece by piece."""

    def __init__(self) -> None:
        self._split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True).pre_tokenize_str

    def __call__(self, text: str) -> Iterator[list[tuple[str, tuple[int, int]]]]:
        start = 0
        while start < len(text):
            gap = _GAP.search(text, start + PIECE_CHARS)
            end = gap.start() if gap else len(text)
            yield self._split(text[start:end])
            start = end


class Bucketing(dict):
    """The bucket of a run; common runs are remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, run: str) -> int:
        bucket = zlib.crc32(run.encode()) % self.buckets
        if len(self) < MEMO_ENTRIES:
            self[run] = bucket
        return bucket


def _windows(words: list[str], fresh: int, longest: int) -> Iterator[str]:
    """The runs of up to ``longest`` words that end in one of the last ``fresh`` words."""
    laid_out = " ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [end - len(word) for end, word in zip(ends, words, strict=True)]
    for last in range(len(words) - fresh, len(words)):
        for first in range(max(0, last - longest + 1), last + 1):
            yield laid_out[starts[first] : ends[last]]


class Features:
    """The number of words and the buckets of a text's features."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.code = longest, _code(buckets)
        self.split, self.bucket = Splitter(), Bucketing(buckets).__getitem__

    def __call__(self, text: str) -> tuple[int, array]:
        n_words, found, before = 0, array(self.code), []
        for piece in self.split(lowered(text)):
            words = [word for word, _ in piece]
            n_words += len(words)
            if self.longest == 1:
                found.extend(map(self.bucket, words))
                continue
            runs = _windows(before + words, len(words), self.longest)
            found.extend(map(self.bucket, runs))
            before = (before + words)[1 - self.longest :]
        return n_words, found


def _code(buckets: int) -> str:
    if not 1 <= buckets <= 1 << 32:
        raise ValueError("buckets must be between 1 and 2**32")
    return "H" if buckets <= 1 << 16 else "I"


def features(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS
) -> DataFrame:
    """A written table of ``key``, ``n_words`` and ``buckets``: each feature's bucket, repeats
    included."""
    _code(buckets)
    if longest < 1:
        raise ValueError("longest must be at least 1")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(longest, buckets)
        for batch in batches:
            n_words, values = [], []
            for value in batch.column(1).cast(pa.binary()):
                n, own = make(value.as_py().decode(errors="replace"))
                n_words.append(n)
                values.append(own.tobytes())
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "buckets"])

    kind = rows.schema["key"].dataType.simpleString()
    return settle(rows.mapInArrow(found, f"key {kind}, n_words bigint, buckets binary"), "features")


def histogram(found: DataFrame, buckets: int = BUCKETS) -> dict[int, int]:
    """How many features fall in each bucket that has any; at most ``buckets`` entries."""
    code = _code(buckets)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            together = np.frombuffer(b"".join(batch.column(0).to_pylist()), code)
            sums += np.bincount(together, minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["bucket", "n"])

    parts = found.select("buckets").mapInArrow(counted, "bucket bigint, n bigint")
    return {r["bucket"]: r["n"] for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(raw: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """1000 ln of the target's share of a bucket over the documents' share, each with one
    feature more in every bucket, floored."""
    all_raw, all_target = float(sum(raw.values()) + buckets), float(sum(target.values()) + buckets)
    out = np.empty(buckets, np.int64)
    for bucket in range(buckets):
        s, t = float(raw.get(bucket, 0) + 1), float(target.get(bucket, 0) + 1)
        out[bucket] = math.floor(1000 * math.log((t * all_raw) / (s * all_target)))
    return out


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight`` of each row of ``found``."""
    code = _code(len(gain))
    size = array(code).itemsize

    @F.arrow_udf("bigint")
    def weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for value in batch:
                own = np.frombuffer(value.as_py(), code)
                out.append(int(gain[own].sum()) // len(own) if len(own) else 0)
            yield pa.array(out, pa.int64())

    n_features = F.expr(f"octet_length(buckets) DIV {size}")
    return found.select("key", "n_words", n_features.alias("n_features"), weight("buckets").alias("weight"))


def draw(
    weighed: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED
) -> DataFrame:
    """``weighed`` with ``score`` and ``rank``: 1, 2, 3... for the ``percent`` hundredths of
    the rows of at least ``min_words`` words that have the highest scores, ties to the
    smaller key; null for all others."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = settle(
        weighed.withColumns(
            {
                "score": F.col("weight") + noise,
                "fit": F.col("n_words") >= max(min_words, 1),
                "row": F.monotonically_increasing_id(),
            }
        ),
        "scored",
    )
    drawn = scored.where("fit").count() * percent // 100

    order = [F.desc("fit"), F.desc("score"), F.asc_nulls_last("key"), F.asc("row")]
    ranges = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = settle(ranges.withColumn("at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("at", _ROW_BITS)
    # A row for each range: few, however many rows there are.
    sizes = ranges.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.expr(f"at & {(1 << _ROW_BITS) - 1}L") + 1
    return (
        ranges.withColumn("part", part)
        .join(before, "part")
        .withColumn("rank", F.when(F.col("fit") & (place <= drawn), place))
        .select(*weighed.columns, "score", "rank")
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """A row for each of ``docs``: ``key`` under its own name, ``n_words``, ``n_features``,
    ``weight``, ``score``, and ``rank`` for those drawn. ``target`` needs the text only."""
    if key in ("n_words", "n_features", "weight", "score", "rank"):
        raise ValueError(f"the key needs another name than {key}")
    shape = {"longest": longest, "buckets": buckets}
    found = features(docs, key=key, text=text, **shape)
    aimed_at = features(target, key=text, text=text, **shape)
    gain = gains(histogram(found, buckets), histogram(aimed_at, buckets), buckets)
    drawn = draw(weigh(found, gain), percent=percent, min_words=min_words, seed=seed)
    return drawn.withColumnRenamed("key", key)
