"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's words are runs without blanks, A-Z lower-cased; each shingle of ``SHINGLE`` words,
repeats included, is hashed, and a bit of the fingerprint is set where over half of the
hashes have it. A text with fewer words is one shingle; one without words, or null, has the
fingerprint zero. Texts link at ``RADIUS`` or fewer differing bits.

Every bit position gets a vector of ``RADIUS + 1`` bits, and every non-zero vector v a mask:
the positions whose vector has an odd product with v. Any ``RADIUS`` positions leave some v
orthogonal to all their vectors, so any two fingerprints within the radius agree under that
mask: no pair is lost. Inside a bucket of equal masked values:

* of few fingerprints, every pair is compared;
* of more, each fingerprint is sent to all values at one bit's distance outside the mask.
  Two that differ in two bits or fewer meet at one of them, and all that meet there are
  within two bits, so linking them to the smallest is exact and linear in the bucket.

Only distinct fingerprints are compared. Repeated rows, documents without an id and extra
columns do no harm: a null id takes part in no component and gets itself (null); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.components import components
from tagpulse.llm.shared import settle

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
#: Buckets up to this size compare pairs: fewer rows than 1 + the bits outside a mask.
PAIRS_UP_TO = 8
_BATCH_HASHES = 1 << 16


def _fingerprint(text: bytes, width: int) -> int:
    found = text.lower().split()  # of bytes: A-Z, and the blanks 0x20 and 0x09 to 0x0D
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(word) for word in found]) + np.arange(len(found))
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) > width:
        starts, ends = starts[: 1 - width], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest  # highest byte first
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _BATCH_HASHES):
        part = slice(at, at + _BATCH_HASHES)
        pairs = zip(starts[part].tolist(), ends[part].tolist(), strict=True)
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in pairs])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, BITS // 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


def fingerprint(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint as a bigint (its bits; the highest is the sign)."""

    @F.arrow_udf("bigint")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.cast(pa.binary())
            yield pa.array([_fingerprint(value.as_py(), width) for value in texts], pa.int64())

    return fingerprints(F.coalesce(text, F.lit("")))


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask for each non-zero vector of ``radius + 1`` bits, as unsigned integers."""
    vectors = (1 << radius + 1) - 1
    return [
        sum(1 << i for i in range(bits) if ((1 + i % vectors) & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> BITS - 1 else value


def links(fingerprints: DataFrame) -> DataFrame:
    """All pairs needed to connect fingerprints ``f`` (distinct bigints) within two bits, as
    (a, b). Pairs of small buckets are all there; of large buckets, a star for each meeting."""
    if RADIUS != 2:
        raise ValueError("large buckets are linked through values one bit away, which means radius 2")
    tables = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(_signed(m)).alias("m")) for n, m in enumerate(masks())])
    rows = fingerprints.select("f", F.explode(tables).alias("t")).select(
        "f", F.col("t.n").alias("n"), F.col("f").bitwiseAND(F.col("t.m")).alias("k")
    )
    sizes = rows.groupBy("n", "k").agg(F.count("*").alias("size")).where("size > 1")
    crowded = settle(rows.join(sizes, ["n", "k"]), "buckets")
    small = (
        crowded.where(F.col("size") <= PAIRS_UP_TO)
        .groupBy("n", "k")
        .agg(F.array_sort(F.collect_list("f")).alias("fs"))
        .select(F.posexplode("fs").alias("i", "a"), "fs")
        .select("a", F.explode(F.slice("fs", F.col("i") + 2, F.greatest(F.size("fs") - F.col("i") - 1, F.lit(0)))).alias("b"))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
        .distinct()
    )
    flips = {n: [0, *(_signed(1 << i) for i in range(BITS) if not m >> i & 1)] for n, m in enumerate(masks())}
    by_table = F.create_map(*[F.lit(x) if isinstance(x, int) else F.array(*map(F.lit, x)) for n in flips for x in (n, flips[n])])
    meetings = crowded.where(F.col("size") > PAIRS_UP_TO).select(
        "f", F.explode(by_table[F.col("n")]).alias("flip")
    ).select("f", F.col("f").bitwiseXOR(F.col("flip")).alias("at")).distinct()
    heads = meetings.groupBy("at").agg(F.min("f").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = meetings.join(heads, "at").select("a", F.col("f").alias("b")).where("a <> b").distinct()
    return small.union(stars)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's key, ``fingerprint`` (bigint) and ``component_id``, the smallest key that
    its links reach."""
    prints = settle(docs.select(F.col(key), fingerprint(F.col(text)).alias("fingerprint")), "prints")
    heads = prints.where(F.col(key).isNotNull()).groupBy(F.col("fingerprint").alias("f")).agg(F.min(key).alias("first"))
    heads = settle(heads, "heads")
    found = settle(links(heads.select("f")), "pairs")
    # Links between fingerprints become links between their smallest documents.
    as_docs = (
        found.join(heads.select(F.col("f").alias("a"), F.col("first").alias("da")), "a")
        .join(heads.select(F.col("f").alias("b"), F.col("first").alias("db")), "b")
        .select(F.col("da").alias("a"), F.col("db").alias("b"))
    )
    roots = components(as_docs)
    classes = heads.join(roots, heads["first"] == roots["node"], "left").select(
        F.col("f").alias("fingerprint"), F.coalesce("root", "first").alias("component_id")
    )
    return prints.join(classes, "fingerprint", "left").select(
        key, "fingerprint", F.when(F.col(key).isNotNull(), F.col("component_id")).alias("component_id")
    )


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
