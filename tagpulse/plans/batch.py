"""Batch jobs beside the streams: calendar metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.functions import times
from tagpulse.operators.metrics import calendar_parts, finish, roll_up
from tagpulse.streaming.store import Store


def calendar_metrics(questions: DataFrame, period: str, answer_mean: str = "per_question") -> DataFrame:
    """Metrics per (tag, calendar day or month) of questions that carry their flags."""
    return finish(calendar_parts(questions, period), answer_mean)


def refresh_calendar_metrics(store: Store, run_id: int, answer_mean: str = "per_question") -> None:
    """Recompute all day and month metrics from the newest version of every question."""
    questions = store.questions.latest()
    for period in ("daily", "monthly"):
        metrics = calendar_metrics(questions, period, answer_mean).withColumn("written", F.current_timestamp())
        store.write_metrics(metrics, run_id, f"{period}_metrics")


def refresh_changed_periods(store: Store, answer_mean: str = "per_question") -> int | None:
    """Bring day and month metrics up to date with the questions that changed since the last
    run; returns the run's number, or None where nothing changed.

    Run on a schedule. A changed question touches the days of all tags it has or had, as the
    tag index keeps them. Those (tag, day) are made anew from the questions, and their months by
    adding up the stored days; both are stored as additive parts in partitions by month, of
    which only the touched ones are written. Periods that lost their last question stay as parts
    of zero. A run that fails is made again whole: its questions count as seen at its end.
    """
    last = store.calendar_runs.rows().agg(F.max("batch_id").alias("run_id"), F.max("upto").alias("upto")).first()
    run_id = 0 if last.run_id is None else last.run_id + 1
    changed = store.questions.rows().filter(F.col("batch_id") > (-1 if last.upto is None else last.upto))
    upto = changed.agg(F.max("batch_id")).first()[0]
    if upto is None:
        return None

    created = F.expr(times.event_time("creation_date"))
    touched = (
        store.tag_index.latest()
        .join(changed.select("question_id"), "question_id", "left_semi")
        .select("tag", F.date_trunc("day", created).alias("period_start"))
        .filter("period_start IS NOT NULL")
        .distinct()
    )
    store.calendar_changes.append(touched, "calendar", run_id)
    days = store.calendar_changes.rows().filter(F.col("batch_id") == run_id).select("tag", "period_start")
    daily = calendar_parts(store.questions.latest(), "daily", only=days)
    _store_parts(store, daily, run_id, answer_mean, "daily")

    months = days.select("tag", F.date_trunc("month", "period_start").alias("period_start")).distinct()
    # One number a month, for the scan to leave other partitions alone.
    places = [row[0] for row in months.select(F.date_format("period_start", "yyyyMM").cast("int")).distinct().collect()]
    stored = store.calendar_parts.latest_where((F.col("period") == "daily") & F.col("bucket").isin(places))
    _store_parts(store, roll_up(stored, "monthly", only=months), run_id, answer_mean, "monthly")

    store.calendar_runs.append(days.sparkSession.range(1).select(F.lit(upto).alias("upto")), "calendar", run_id)
    return run_id


def _store_parts(store: Store, parts: DataFrame, run_id: int, answer_mean: str, period: str) -> None:
    written = store.calendar_parts.merge(parts, period, run_id)
    metrics = finish(written, answer_mean).withColumn("written", F.current_timestamp())
    store.write_metrics(metrics, run_id, f"{period}_metrics")
