"""Question records: cleaning, derived columns, tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.functions import answers as A
from tagpulse.functions import text, times


def with_answer_columns(questions: DataFrame) -> DataFrame:
    """Flags and averages over the answers array, and the event time."""
    return questions.withColumns(
        {
            "has_accepted_answer": F.expr(A.has_accepted("answers")),
            "is_unanswered": F.expr(A.is_unanswered("answers")),
            "avg_answer_score": F.expr(A.avg_score("answers")),
            "answer_count": F.expr(A.answer_count("answers")),
            "answer_score_sum": F.expr(A.answer_score_sum("answers")),
            "event_time": F.expr(times.event_time("creation_date")),
        }
    )


def clean(questions: DataFrame, restrip: bool = True) -> DataFrame:
    """Bodies as plain text, the readable date, derived columns and the best answers."""
    # The flags come from the array as it was, so where only they are asked for, no body is cleaned.
    cleaned = with_answer_columns(questions).withColumns(
        {
            "body": F.expr(text.strip_html("body", restrip)),
            "creation_date_readable": F.expr(times.readable("creation_date")),
            "answers": F.expr(A.clean_bodies("answers", restrip)),
        }
    )
    return cleaned.withColumn("top_answers", F.expr(A.top_answers("answers")))


def by_tag(questions: DataFrame, *columns: str) -> DataFrame:
    """One row per tag. No tags, no row; a tag given twice counts twice."""
    return questions.select(F.explode("tags").alias("tag"), *columns)


def tag_index(questions: DataFrame, *carry: str) -> DataFrame:
    """Which questions carry a tag, with their creation time.

    A question whose tags change stays under the old ones, as keyed puts leave it; who reads
    the index looks at the question's own tags as well.
    """
    return by_tag(questions, "creation_date", "question_id", *carry)


def tag_index_latest(index: DataFrame, version: str = "question_id") -> DataFrame:
    """The index as keyed puts leave it: of one tag's questions created in the same
    second only the one written last stays."""
    return index.groupBy("tag", "creation_date").agg(F.max_by("question_id", version).alias("question_id"))
