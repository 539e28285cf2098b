"""Five metrics per tag and period, kept as additive parts until the last step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.functions.times import PERIODS
from tagpulse.operators.questions import by_tag

INPUTS = (
    "event_time",
    "is_unanswered",
    "has_accepted_answer",
    "score",
    "avg_answer_score",
    "answer_count",
    "answer_score_sum",
)

WINDOW = "1 hour"
WATERMARK = "10 minutes"


def _parts() -> list:
    return [
        F.count("*").alias("total_questions"),
        F.sum(F.col("is_unanswered").cast("int")).alias("unanswered"),
        F.sum(F.col("has_accepted_answer").cast("int")).alias("accepted"),
        F.sum("score").alias("score_sum"),
        F.count("score").alias("score_count"),
        F.sum("avg_answer_score").alias("answer_mean_sum"),
        F.sum("answer_count").alias("answer_count"),
        F.sum("answer_score_sum").alias("answer_score_sum"),
    ]


PARTS = (
    "total_questions",
    "unanswered",
    "accepted",
    "score_sum",
    "score_count",
    "answer_mean_sum",
    "answer_count",
    "answer_score_sum",
)


def hourly_parts(questions: DataFrame) -> DataFrame:
    """Parts per (tag, hour), by event-time window. Serves batch and stream.

    Partial aggregation sends one row per tag, hour and map task, so a tag carried by a
    third of all questions is no heavier than another.
    """
    return (
        by_tag(questions, *INPUTS)
        .groupBy("tag", F.window("event_time", WINDOW))
        .agg(*_parts())
        .select("tag", F.lit("hourly").alias("period"), F.col("window.start").alias("period_start"), *PARTS)
    )


def calendar_parts(questions: DataFrame, period: str, only: DataFrame | None = None) -> DataFrame:
    """Parts per (tag, calendar day or month) of the session zone, in batch.

    Not an event-time window: windows are anchored in UTC, and a month is none. ``only``
    names the (tag, period_start) that are wanted; each gives a row, one without questions
    parts of zero.
    """
    start = F.date_trunc(PERIODS[period][0], "event_time")
    rows = by_tag(questions, *INPUTS).filter("event_time IS NOT NULL").withColumn("period_start", start)
    if only is not None:
        rows = rows.join(only, _same_period(rows, only), "left_semi")
    parts = (
        rows.groupBy("tag", "period_start").agg(*_parts()).select("tag", F.lit(period).alias("period"), "period_start", *PARTS)
    )
    return parts if only is None else _each_of(parts, only, period)


def _same_period(rows: DataFrame, only: DataFrame) -> Column:
    return rows["tag"].eqNullSafe(only["tag"]) & (rows["period_start"] == only["period_start"])


def _each_of(parts: DataFrame, only: DataFrame, period: str) -> DataFrame:
    """A row for each (tag, period_start) of ``only``."""
    found = only.join(parts, _same_period(only, parts), "left")
    return found.select(
        only["tag"], F.lit(period).alias("period"), only["period_start"],
        *[F.coalesce(parts[part], F.lit(0)).alias(part) for part in PARTS],
    )


def roll_up(parts: DataFrame, period: str, only: DataFrame | None = None) -> DataFrame:
    """Parts of a shorter period summed into a longer one; averages are never averaged.

    Needs a session zone whose offset is whole hours, as hours are cut in UTC. ``only`` is
    that of :func:`calendar_parts`.
    """
    start = F.date_trunc(PERIODS[period][0], "period_start")
    if only is not None:
        parts = parts.withColumn("start", start)
        wanted = parts["tag"].eqNullSafe(only["tag"]) & (parts["start"] == only["period_start"])
        return _each_of(roll_up(parts.join(only, wanted, "left_semi").drop("start"), period), only, period)
    return (
        parts.groupBy("tag", start.alias("start"))
        .agg(*[F.sum(part).alias(part) for part in PARTS])
        .select("tag", F.lit(period).alias("period"), F.col("start").alias("period_start"), *PARTS)
    )


def finish(parts: DataFrame, answer_mean: str = "per_question") -> DataFrame:
    """Parts to percentages and averages.

    ``per_question`` averages each question's mean, an unanswered question counting as
    0.0; ``per_answer`` averages over all answers alike. Without questions there is no mean.
    """
    total = F.nullif(F.col("total_questions"), F.lit(0))
    mean = {
        "per_question": F.col("answer_mean_sum") / total,
        "per_answer": F.when(F.col("answer_count") > 0, F.col("answer_score_sum") / F.col("answer_count")).otherwise(0.0),
    }[answer_mean]
    return parts.select(
        "tag",
        "period",
        "period_start",
        "total_questions",
        (F.col("unanswered") / total * 100).alias("unanswered_percent"),
        (F.col("accepted") / total * 100).alias("accepted_percent"),
        F.when(F.col("score_count") > 0, F.col("score_sum") / F.col("score_count")).alias("avg_question_score"),
        mean.alias("avg_answer_score"),
    )


def deduplicated(questions: DataFrame, window: str = WINDOW, delay: str = WATERMARK, salts: int = 1) -> DataFrame:
    """A stream of questions without repeats, for the hourly metrics.

    Deduplication drops every row older than the watermark, which alone would lose late
    rows whose window is still open; so the delay grows by the window's length. State is one
    row per question. Only where a few questions are sent so often that a batch's copies of
    one overload a task, ``salts`` lets them meet in that many tasks first; its price is up
    to that many more rows of state per question. The salt is drawn row by row from a fixed
    seed, so that a task run again salts alike.
    """
    rows = questions.withWatermark("event_time", delay_of(window, delay))
    if salts > 1:
        salted = rows.withColumn("__salt", F.floor(F.rand(seed=1) * salts))
        rows = salted.dropDuplicatesWithinWatermark(["question_id", "__salt"]).drop("__salt")
    return rows.dropDuplicatesWithinWatermark(["question_id"])


def delay_of(window: str, delay: str) -> str:
    """The watermark that admits rows of every window that is still open."""
    return f"{_seconds(window) + _seconds(delay)} seconds"


def _seconds(interval: str) -> int:
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
