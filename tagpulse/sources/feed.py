"""Raw API items to question records: shaping, time slices, backfill and live feeds."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.operators.answer_rows import preselect_rows

SLICE_SECONDS = 60
BACKFILL_DAYS = 3
LIVE_PAUSE = 1.5


def flat_answers(raw_answers: DataFrame) -> DataFrame:
    """Raw answer items with the defaults of missing values, one row per answer."""
    return raw_answers.select(
        "question_id",
        "answer_id",
        "body",
        "score",
        F.coalesce("is_accepted", F.lit(False)).alias("is_accepted"),
        "creation_date",
        F.coalesce("owner.reputation", F.lit(0)).alias("owner_reputation"),
    )


def shape_questions(
    raw_questions: DataFrame,
    raw_answers: DataFrame,
    order: tuple[str, ...] = ("creation_date", "answer_id"),
    keep: int = 3,
) -> DataFrame:
    """Question records with their pre-selected answers attached.

    Answers are cut to ``keep`` per question before they are gathered, on the map side
    first, so neither a task nor a row ever holds all answers of a popular question.
    Uncut answers stay rows: see :mod:`tagpulse.operators.answer_rows`.
    """
    answer = F.struct(
        "answer_id", "body", "score", "is_accepted", "creation_date", "owner_reputation"
    )
    chosen = (
        preselect_rows(flat_answers(raw_answers), order, keep)
        .groupBy("question_id")
        .agg(F.sort_array(F.collect_list(F.struct("rank", answer.alias("answer")))).alias("ranked"))
        .select("question_id", F.col("ranked.answer").alias("answers"))
    )
    no_answers = F.array().cast(chosen.schema["answers"].dataType)
    return raw_questions.join(chosen, "question_id", "left").select(
        "question_id",
        "title",
        "body",
        "creation_date",
        "score",
        F.coalesce("owner.reputation", F.lit(0)).alias("owner_reputation"),
        F.coalesce("is_answered", F.lit(False)).alias("is_answered"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.coalesce("answers", no_answers).alias("answers"),
    )


def slices(questions: DataFrame, start: int, end: int, mode: str, width: int = SLICE_SECONDS) -> DataFrame:
    """Records created in [start, end], once per slice that fetches them.

    Slices have both ends inclusive, so a question created on a shared end is fetched by
    both; ``slice_start`` tells the fetches apart. Slices begin at ``start`` and every
    ``width`` seconds until ``end`` is reached.
    """
    offset = F.col("creation_date") - F.lit(start)
    own = F.lit(start) + F.floor(offset / width) * width
    on_shared_end = (offset % width == 0) & (offset > 0)
    fetched_by = F.array(own, F.when(on_shared_end, own - width))
    return (
        questions.filter(F.col("creation_date").between(start, end))
        .withColumn("slice_start", F.explode(F.array_compact(fetched_by)))
        .filter(F.col("slice_start") < end)
        .withColumn("mode", F.lit(mode))
    )


def live_repeats(questions: DataFrame, start: int, end: int, pause: float = LIVE_PAUSE, width: int = SLICE_SECONDS) -> DataFrame:
    """What a live producer sends that fetches the last ``width`` seconds again and again,
    with ``pause`` seconds between: each record about ``width / pause`` times.

    Fetch ``fetch`` is made at ``start + pause * fetch``, while that is before ``end``, and
    takes what was created in the ``width`` seconds up to then, both ends included.
    """
    created = F.col("creation_date") - F.lit(start)
    first = F.greatest(F.ceil(created / pause), F.lit(0))
    last = F.least(F.floor((created + width) / pause), F.lit(math.ceil((end - start) / pause) - 1))
    fetched = questions.filter(created >= -width).withColumn("fetch", F.explode(F.when(first <= last, F.sequence(first, last))))
    return fetched.withColumn("mode", F.lit("live"))


def backfill_and_live(questions: DataFrame, now: int, until: int, days: int = BACKFILL_DAYS) -> DataFrame:
    """The feed of a producer started at ``now`` and stopped at ``until``.

    History goes out slice by slice labelled 'backfill', then what is created later,
    labelled 'live'.
    """
    history = slices(questions, now - days * 86400, now, "backfill")
    return history.unionByName(slices(questions, now, until, "live"))
