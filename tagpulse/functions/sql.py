"""SQL functions of the same meaning, for queries written as SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tagpulse.functions import answers, text, times
from tagpulse.schemas import ANSWER

_ANSWERS = f"ARRAY<{ANSWER.simpleString()}>"


def register_functions(spark: SparkSession) -> None:
    """Create the temporary functions. The analyzer inlines them; none runs Python."""
    functions = {
        "strip_html_completely(html STRING) RETURNS STRING": text.strip_html("html"),
        "format_timestamp(seconds STRING) RETURNS STRING": times.readable_text("seconds"),
        f"has_accepted_answer(answers {_ANSWERS}) RETURNS BOOLEAN": answers.has_accepted("answers"),
        f"is_unanswered(answers {_ANSWERS}) RETURNS BOOLEAN": answers.is_unanswered("answers"),
        f"avg_answer_score(answers {_ANSWERS}) RETURNS DOUBLE": answers.avg_score("answers"),
        f"select_top_answers(answers {_ANSWERS}) RETURNS {_ANSWERS}": answers.top_answers("answers"),
    }
    for signature, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
