"""Answers held as rows: totals and best answers per question, however many there are.

These are the batch twins of :mod:`tagpulse.functions.answers`. Every step aggregates or
cuts on the map side first, and no row or task gathers all answers of a question.
``answer_id`` must be unique within a question; see :func:`latest_version` for copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagpulse.functions.answers import HIGH_REPUTATION
from tagpulse.operators.latest import first_rows

_ACCEPTED = "coalesce(is_accepted, false)"
_FALLING_SCORE = "-CAST(coalesce(score, 0) AS BIGINT)"


def answer_totals(answers: DataFrame) -> DataFrame:
    """Per question: number of answers, sum of scores, whether one is accepted."""
    return answers.groupBy("question_id").agg(
        F.count("*").alias("answer_count"),
        F.sum(F.coalesce("score", F.lit(0))).alias("answer_score_sum"),
        F.max(F.expr(_ACCEPTED)).alias("has_accepted_answer"),
    )


def with_answer_flags(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Questions with the flags and averages of their answers."""
    count = F.coalesce("answer_count", F.lit(0))
    total = F.coalesce("answer_score_sum", F.lit(0))
    return (
        questions.join(answer_totals(answers), "question_id", "left")
        .withColumn("answer_count", count)
        .withColumn("answer_score_sum", total)
        .withColumn("has_accepted_answer", F.coalesce("has_accepted_answer", F.lit(False)))
        .withColumn("is_unanswered", F.col("answer_count") == 0)
        .withColumn(
            "avg_answer_score",
            F.when(F.col("answer_count") > 0, F.col("answer_score_sum") / F.col("answer_count")).otherwise(0.0),
        )
    )


def _ranked(
    answers: DataFrame, ordinary: Column, merit: Sequence[str], order: Sequence[str], keep: int, carry: Sequence[str] | None
) -> DataFrame:
    """First accepted answer, then the ``ordinary`` ones by ``merit`` and ``order``, cut to ``keep``.

    Ids and what they are ranked by are read once, without texts. Each answer stands for
    the set of accepted ones, of which the first by ``order`` alone counts, for the set of
    ordinary ones, of which ``keep + 1`` by merit do (one more, as the accepted one may be
    among them), or for both. The chosen ids then fetch their answers, unless ``carry``
    names all that is wanted beside them: a few narrow columns, which come along.
    """
    carried = [F.col(name).alias(f"__carry{i}") for i, name in enumerate(carry or ())]
    merits = [F.expr(text).alias(f"__merit{i}") for i, text in enumerate(merit)]
    places = [F.col(name).alias(f"__place{i}") for i, name in enumerate(order)]
    by_merit = [f"__merit{i}" for i in range(len(merits))]
    by_place = [f"__place{i}" for i in range(len(places))]
    sets = F.array_compact(F.array(F.when(F.expr(_ACCEPTED), F.lit(True)), F.when(ordinary, F.lit(False))))
    narrow = answers.select("question_id", "answer_id", *merits, *places, *carried, F.explode(sets).alias("__first"))
    # Among the accepted ones merit says nothing.
    own_merit = [F.when(~F.col("__first"), F.col(name)) for name in by_merit]
    candidates = first_rows(narrow, ["question_id", "__first"], [*own_merit, *by_place], keep + 1, "__candidate")
    candidates = candidates.filter("NOT __first OR __candidate = 1")
    accepted_id = F.max(F.when(F.col("__first"), F.col("answer_id"))).over(Window.partitionBy("question_id"))
    finalists = candidates.withColumn("__accepted_id", accepted_id).filter(
        F.col("__first") | ~F.col("answer_id").eqNullSafe(F.col("__accepted_id"))
    )
    final = [F.col("__first").desc(), *by_merit, *by_place]
    chosen = first_rows(finalists, ["question_id"], final, keep, "rank")
    if carry is not None:
        names = [F.col(f"__carry{i}").alias(name) for i, name in enumerate(carry)]
        return chosen.select("question_id", "answer_id", *names, "rank")
    return answers.join(chosen.select("question_id", "answer_id", "rank"), ["question_id", "answer_id"])


def top_answer_rows(
    answers: DataFrame, order: Sequence[str], keep: int = 3, carry: Sequence[str] | None = None
) -> DataFrame:
    """The best answers of each question, numbered in ``rank``; with ``carry`` only ids and
    those columns.

    First the accepted answer that comes first by ``order``, then those of reputable
    owners by score, then the rest by score; ties by ``order``.
    """
    reputable_first = f"CASE WHEN coalesce(owner_reputation, 0) > {HIGH_REPUTATION} THEN 1 ELSE 2 END"
    return _ranked(answers, F.lit(True), [reputable_first, _FALLING_SCORE], order, keep, carry)


def preselect_rows(
    answers: DataFrame, order: Sequence[str], keep: int = 3, carry: Sequence[str] | None = None
) -> DataFrame:
    """The producer's cut: first accepted answer, then not accepted ones by score."""
    return _ranked(answers, ~F.expr(_ACCEPTED), [_FALLING_SCORE], order, keep, carry)
