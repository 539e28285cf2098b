"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shares(labels: DataFrame, label: str, key: str) -> tuple[DataFrame, dict[int, int]]:
    """Rows (key, label) with a key and a label 0 or 1, and how many there are of each."""
    rows = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(
        "key IS NOT NULL AND label IN (0, 1)"
    )
    return rows, {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}


def sampled(docs: DataFrame, rows: DataFrame, value: int, bound: int, *, key: str, content: Column) -> DataFrame:
    """(key, label, content) of at most ``bound`` documents labelled ``value``: those whose
    keys have the smallest hashes. At most ``bound`` keys go to the scan of the documents."""
    order = [F.xxhash64("key"), F.col("key")]
    picked = rows.where(F.col("label") == value).select("key").distinct().orderBy(*order).limit(bound)
    texts = docs.select(F.col(key).alias("key"), content.alias("content")).where("content IS NOT NULL")
    found = texts.join(F.broadcast(picked), "key").orderBy(*order, "content").limit(bound)
    return found.select("key", F.lit(value).alias("label"), "content")
