"""Message bytes to typed records, and records to message text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagpulse.schemas import QUESTION, TREND


def _parsed(text: Column, schema: T.StructType) -> Column:
    # inline() parses once. As a plain projection, a filter on a parsed field would be
    # pushed below it and parse every message a second time.
    return F.inline(F.array(F.from_json(text, schema)))


def decode(messages: DataFrame, schema: T.StructType, *carry: str) -> DataFrame:
    """Parse ``value`` as JSON with a declared schema and flatten it.

    Text that is no JSON gives a row of nulls, a field of the wrong type a null, and
    fields outside the schema are dropped. ``carry`` names message columns to keep.
    """
    return messages.select(*carry, _parsed(F.col("value").cast("string"), schema))


def decode_questions(messages: DataFrame, *carry: str, schema: T.StructType = QUESTION) -> DataFrame:
    """Question records that have an id; the others are :func:`rejected_questions`."""
    return decode(messages, schema, *carry).filter("question_id IS NOT NULL")


def _rejected(messages: DataFrame, needed: T.StructField, *carry: str) -> DataFrame:
    texts = messages.select(*carry, F.col("value").cast("string").alias("message"))
    parsed = texts.select(*carry, "message", _parsed(F.col("message"), T.StructType([needed])))
    return parsed.filter(F.col(needed.name).isNull()).drop(needed.name)


def rejected_questions(messages: DataFrame, *carry: str) -> DataFrame:
    """Messages that give no question id, as text, for a reject table."""
    return _rejected(messages, QUESTION["question_id"], *carry)


def rejected_trends(messages: DataFrame, *carry: str) -> DataFrame:
    """Messages that give no tag, as text, for a reject table."""
    return _rejected(messages, TREND["tag"], *carry)


def stamped(messages: DataFrame) -> DataFrame:
    """Messages with processing time as event time: one value per micro-batch, kept by a
    replay when stamped inside the stream."""
    return messages.withColumn("event_time", F.current_timestamp())


def decode_trends(messages: DataFrame, *carry: str) -> DataFrame:
    """Trend records that have a tag, from stamped messages; the others are
    :func:`rejected_trends`."""
    return decode(messages, TREND, *carry, "event_time").filter("tag IS NOT NULL")


def to_messages(records: DataFrame, key: str | None = "question_id", carry: Sequence[str] = ()) -> DataFrame:
    """Records as JSON messages, keyed so that one question stays in one topic partition.

    ``carry`` names columns that stay beside the message instead of going into it.
    """
    fields = [name for name in records.columns if name not in carry]
    value = F.to_json(F.struct(*fields)).alias("value")
    keys = [] if key is None else [F.col(key).cast("string").alias("key")]
    return records.select(*keys, value, *carry)
