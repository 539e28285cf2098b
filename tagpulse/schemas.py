"""Declared record schemas. Nothing is inferred from data; every field is nullable."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the fields of a record.
ANSWER = T.StructType(
    [
        T.StructField("answer_id", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("is_accepted", T.BooleanType()),
        T.StructField("owner_reputation", T.IntegerType()),
    ]
)

QUESTION = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("creation_date", T.LongType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("owner_reputation", T.IntegerType()),
        T.StructField("answers", T.ArrayType(ANSWER)),
    ]
)

# What the metrics query reads of a question. ``from_json`` parses every field of
# its schema whether used or not, so a narrow schema is how that query skips the texts.
METRIC_QUESTION = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("creation_date", T.LongType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField(
            "answers",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("score", T.IntegerType()),
                        T.StructField("is_accepted", T.BooleanType()),
                    ]
                )
            ),
        ),
    ]
)

TREND = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("count", T.IntegerType()),
    ]
)

# Items as the public API returns them, before shaping.
_OWNER = T.StructType([T.StructField("reputation", T.IntegerType())])

RAW_QUESTION = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("creation_date", T.LongType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("owner", _OWNER),
        T.StructField("is_answered", T.BooleanType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

RAW_ANSWER = T.StructType(
    [
        T.StructField("question_id", T.LongType()),
        T.StructField("answer_id", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("is_accepted", T.BooleanType()),
        T.StructField("creation_date", T.LongType()),
        T.StructField("owner", _OWNER),
    ]
)


# The order of messages: when they were sent, and within a moment the place in their topic.
VERSION = T.StructField(
    "version",
    T.StructType(
        [
            T.StructField("sent", T.TimestampType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
        ]
    ),
)
# When a micro-batch was planned; a replay keeps it.
WRITTEN = T.StructField("written", T.TimestampType())


# Stored tables.
QNA = T.StructType(
    [
        *QUESTION.fields,
        T.StructField("creation_date_readable", T.StringType()),
        T.StructField("has_accepted_answer", T.BooleanType()),
        T.StructField("is_unanswered", T.BooleanType()),
        T.StructField("avg_answer_score", T.DoubleType()),
        T.StructField("answer_count", T.IntegerType()),
        T.StructField("answer_score_sum", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("top_answers", T.ArrayType(ANSWER)),
        VERSION,
    ]
)

TAG_INDEX = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("creation_date", T.LongType()),
        T.StructField("question_id", T.LongType()),
        VERSION,
    ]
)

METRICS = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("period_start", T.TimestampType()),
        T.StructField("total_questions", T.LongType()),
        T.StructField("unanswered_percent", T.DoubleType()),
        T.StructField("accepted_percent", T.DoubleType()),
        T.StructField("avg_question_score", T.DoubleType()),
        T.StructField("avg_answer_score", T.DoubleType()),
        WRITTEN,
    ]
)

# The additive parts of metrics, and which of them a run made anew.
METRIC_PARTS = T.StructType(
    [
        *METRICS.fields[:4],
        T.StructField("unanswered", T.LongType()),
        T.StructField("accepted", T.LongType()),
        T.StructField("score_sum", T.LongType()),
        T.StructField("score_count", T.LongType()),
        T.StructField("answer_mean_sum", T.DoubleType()),
        T.StructField("answer_count", T.LongType()),
        T.StructField("answer_score_sum", T.LongType()),
    ]
)

# Parts that batches of changes are added to, with what they were before the last one.
HOURLY_PARTS = T.StructType([*METRIC_PARTS.fields, T.StructField("before", T.StructType(METRIC_PARTS.fields[3:]))])

CHANGED_PERIODS = T.StructType([METRICS["tag"], METRICS["period_start"]])

# The last batch of questions that a run of the calendar refresh has seen.
CALENDAR_RUNS = T.StructType([T.StructField("upto", T.LongType())])

TREND_COUNTS = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("stamp", T.StringType()),
        T.StructField("raw_count", T.IntegerType()),
        T.StructField("timestamp_readable", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        VERSION,
    ]
)

CELLS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("table", "row_key", "family", "qualifier", "value")]
)

CELL_LOG = T.StructType([*CELLS.fields, VERSION, WRITTEN])

REJECTS = T.StructType([T.StructField("topic", T.StringType()), T.StructField("message", T.StringType()), VERSION])

FAILED_PUTS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("row_key", T.StringType()),
        T.StructField(
            "cells",
            T.ArrayType(
                T.StructType([T.StructField(name, T.StringType()) for name in ("family", "qualifier", "value")])
            ),
        ),
        T.StructField("error", T.StringType()),
    ]
)
