"""The given tables read as question-and-answer records.

``orders`` and ``lineitem`` are raw questions and raw answers, ``events`` question and
trend messages, ``documents`` questions whose lines are answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def _int(expression: str) -> str:
    # A value too large for the field is an error, not another value.
    return f"CAST({expression} AS INT)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS question_id",
        "concat('Order ', o_orderkey, ' ', o_orderpriority) AS title",
        "concat('<p>', o_orderpriority, ' &amp; ', o_orderstatus, '</p>') AS body",
        "unix_seconds(CAST(o_orderdate AS TIMESTAMP)) AS creation_date",
        f"{_int('floor(o_totalprice / 10000)')} AS score",
        f"named_struct('reputation', {_int('o_custkey')}) AS owner",
        "o_orderstatus = 'F' AS is_answered",
        "array(o_orderpriority, o_orderstatus) AS tags",
    )


def raw_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS question_id",
        # Line numbers repeat within an order; with part, supplier and quantity they do not.
        "shiftleft(l_partkey, 36) + shiftleft(l_suppkey, 12) + l_linenumber * 256 + CAST(l_quantity AS INT) AS answer_id",
        "concat('<i>', l_returnflag, '</i> &lt;', l_linestatus, '&gt; ', l_linenumber) AS body",
        f"{_int('l_quantity')} AS score",
        "l_returnflag = 'A' AS is_accepted",
        "unix_seconds(CAST(l_shipdate AS TIMESTAMP)) AS creation_date",
        f"named_struct('reputation', {_int('l_partkey')}) AS owner",
    )


def event_questions(events: DataFrame) -> DataFrame:
    """Events as question records with none to three answers each."""
    k = "from_json(props, 'k INT').k"
    return events.selectExpr("*", f"{k} AS k").selectExpr(
        "event_id AS question_id",
        "concat(event_type, ' #', event_id) AS title",
        "concat('<p>', event_type, ' &amp; <code>', k, '</code></p>') AS body",
        "unix_seconds(CAST(ts AS TIMESTAMP)) AS creation_date",
        "CAST(floor(value) AS INT) AS score",
        "array(event_type, concat('user-', user_id)) AS tags",
        f"{_int('user_id')} AS owner_reputation",
        "transform(slice(array(1, 2, 3), 1, least(k DIV 25, 3)), j -> named_struct("
        "'answer_id', event_id * 10 + j, 'body', concat('<b>', j, '</b> of ', k), 'score', k - 20 * j, "
        f"'is_accepted', k - 10 * j >= 60, 'owner_reputation', {_int('user_id * 40 * j')})) AS answers",
    )


def question_messages(events: DataFrame, *more: Column) -> DataFrame:
    """Events as question messages: JSON bytes and a version.

    An 'error' event is a message broken off in the middle. ``more`` are columns made of the
    record.
    """
    record = F.to_json(F.struct("*"))
    text = F.when(F.col("tags")[0] == "error", F.concat(F.lit('{"question_id": "'), "question_id")).otherwise(record)
    return event_questions(events).select(
        text.cast("binary").alias("value"), version("question_id").alias("version"), *more
    )


def version(number: str, sent: str = "TIMESTAMP'2024-01-01 00:00:00'"):
    """The order of messages sent at one moment over one topic partition."""
    return F.expr(f"named_struct('sent', {sent}, 'partition', 0, 'offset', CAST({number} AS BIGINT))")


def trend_messages(events: DataFrame) -> DataFrame:
    """Events as trend messages: the count is the event's ``k``."""
    return events.selectExpr(
        "CAST(to_json(named_struct('tag', event_type, 'count', from_json(props, 'k INT').k)) AS BINARY) AS value",
        "named_struct('sent', CAST(ts AS TIMESTAMP), 'partition', 0, 'offset', event_id) AS version",
        "CAST(ts AS TIMESTAMP) AS event_time",
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # as a glob, since a stream takes no path that is a single file
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as questions without their answers."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS question_id",
        "concat(source, ' ', lang, ' ', doc_id) AS title",
        "text AS body",
        "doc_id * 60 + 1704067200 AS creation_date",
        f"{_int('n_chars')} AS score",
        "array(lang, source) AS tags",
        f"{_int('n_chars')} AS owner_reputation",
    )


def line_answers(questions: DataFrame) -> DataFrame:
    """Every line of the whole body as an answer."""
    return questions.withColumn(
        "answers",
        F.expr(
            # Unique while a text has fewer than 2^31 lines.
            "transform(split(body, '\\n', -1), (line, i) -> named_struct("
            "'answer_id', shiftleft(question_id, 31) + i + 1, "
            "'body', line, 'score', length(line) DIV 50, 'is_accepted', contains(lower(line), 'ou'), "
            f"'owner_reputation', {_int('greatest(2000 - 300 * i, 0)')}))"
        ),
    )


def document_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as questions; every line of the whole text is an answer."""
    return line_answers(documents(spark, sf_dir))
