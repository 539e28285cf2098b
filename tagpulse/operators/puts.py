"""Records as puts on wide-column rows, and puts merged into current cells.

A put is one row: table, row key, and an array of cells built from that row alone, so no
shuffle is needed to form it. Values are text as a Python writer would print them:
``None`` for null, ``True``/``False`` for booleans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.functions.numbers import python_text
from tagpulse.functions.times import PERIODS, READABLE

# Table names, column families and qualifiers of the stored rows.
QNA_TABLE = "stackoverflow_qna"
TAG_INDEX_TABLE = "stackoverflow_tag_index"
TRENDS_TABLE = "stackoverflow_trends"

QUESTION_QUALIFIERS = {
    "title": "title",
    "body": "body",
    "creation_date": "creation_date_readable",
    "raw_creation_date": "creation_date",
    "score": "score",
    "owner_reputation": "owner_reputation",
    "has_accepted": "has_accepted_answer",
    "is_unanswered": "is_unanswered",
}
METRIC_QUALIFIERS = (
    "total_questions",
    "unanswered_percent",
    "accepted_percent",
    "avg_question_score",
    "avg_answer_score",
)

CELL_KEY = ("table", "row_key", "family", "qualifier")


def as_text(value: Column, boolean: bool = False) -> Column:
    text = F.initcap(value.cast("string")) if boolean else value.cast("string")
    return F.coalesce(text, F.lit("None"))


def _cell(family: str, qualifier: Column, value: Column) -> Column:
    return F.struct(F.lit(family).alias("family"), qualifier.alias("qualifier"), value.alias("value"))


def _cells(family: str, values: dict[str, Column]) -> Column:
    return F.array(*[_cell(family, F.lit(name), value) for name, value in values.items()])


def _answer_cells(family: str, answers: str, prefix: str) -> Column:
    """Cells ``{prefix}{j}_id`` and so on of the j-th answer, j from 1."""

    def cells(answer: Column, position: Column) -> Column:
        def named(suffix: str) -> Column:
            return F.concat(F.lit(prefix), (position + 1).cast("string"), F.lit(f"_{suffix}"))

        return F.array(
            _cell(family, named("id"), as_text(answer["answer_id"])),
            _cell(family, named("body"), as_text(answer["body"])),
            _cell(family, named("score"), as_text(answer["score"])),
            _cell(family, named("is_accepted"), as_text(F.coalesce(answer["is_accepted"], F.lit(False)), True)),
            _cell(family, named("owner_reputation"), as_text(F.coalesce(answer["owner_reputation"], F.lit(0)))),
        )

    return F.flatten(F.transform(F.coalesce(answers, F.array()), cells))


def _ascii(json: Column) -> Column:
    """JSON with each character beyond ASCII as its UTF-16 units, backslash, ``u``, four digits."""

    def written(char: Column) -> Column:
        units = F.regexp_replace(F.lower(F.hex(F.encode(char, "UTF-16BE"))), "(.{4})", "\\\\u$1")
        return F.when(char >= "\x7f", units).otherwise(char)

    return F.when(json.rlike(r"[^\x00-\x7E]"), F.array_join(F.transform(F.split(json, ""), written), "")).otherwise(json)


def question_cells() -> Column:
    """The ``question`` family."""
    values = {
        qualifier: as_text(F.col(column), column in ("has_accepted_answer", "is_unanswered"))
        for qualifier, column in QUESTION_QUALIFIERS.items()
    }
    # JSON with a space after each comma and without characters beyond ASCII, as the stored rows have it
    quoted = F.transform("tags", lambda tag: _ascii(F.regexp_extract(F.to_json(F.array(tag)), r"(?s)^\[(.*)\]$", 1)))
    values["tags"] = F.when(F.col("tags").isNull(), "null").otherwise(
        F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    )
    return _cells("question", values)


def answer_cells() -> Column:
    return _answer_cells("answers", "answers", "answer")


def top_answer_cells() -> Column:
    return _answer_cells("top_answers", "top_answers", "top")


FAMILIES = {"question": question_cells, "answers": answer_cells, "top_answers": top_answer_cells}


def question_puts(questions: DataFrame, *carry: str, families: Sequence[str] = tuple(FAMILIES)) -> DataFrame:
    """One put per cleaned question: its columns, all answers, the best answers."""
    return questions.select(
        F.lit(QNA_TABLE).alias("table"),
        F.col("question_id").cast("string").alias("row_key"),
        F.concat(*[FAMILIES[family]() for family in families]).alias("cells"),
        *carry,
    )


def tag_index_puts(questions: DataFrame, *carry: str) -> DataFrame:
    """One put per tag of a question: column ``question_ids:<creation time>``."""
    return index_puts(questions.select(F.explode("tags").alias("tag"), "creation_date", "question_id", *carry), *carry)


def index_puts(index: DataFrame, *carry: str) -> DataFrame:
    """The same from rows of the tag index."""
    return index.select(
        F.lit(TAG_INDEX_TABLE).alias("table"),
        as_text(F.col("tag")).alias("row_key"),
        F.array(
            _cell("question_ids", as_text(F.col("creation_date")), F.col("question_id").cast("string"))
        ).alias("cells"),
        *carry,
    )


def metric_puts(metrics: DataFrame, *carry: str) -> DataFrame:
    """One put per metrics row, keyed ``tag#period#stamp``."""
    start = F.col("period_start")
    stamps = [F.when(F.col("period") == name, F.date_format(start, style)) for name, (_, style) in PERIODS.items()]
    values = {"total_questions": as_text(F.col("total_questions"))}
    for name in METRIC_QUALIFIERS[1:]:
        values[name] = F.coalesce(F.expr(python_text(name)), F.lit("None"))
    values["timestamp_readable"] = F.date_format(start, READABLE)
    return metrics.select(
        F.lit(TRENDS_TABLE).alias("table"),
        F.concat_ws("#", as_text(F.col("tag")), "period", F.coalesce(*stamps)).alias("row_key"),
        _cells("trend", values).alias("cells"),
        *carry,
    )


def trend_puts(counts: DataFrame, *carry: str) -> DataFrame:
    """One put per fanned-out raw count, on the same rows as the metrics."""
    values = {
        "raw_count": as_text(F.col("raw_count")),
        "timestamp_readable": as_text(F.col("timestamp_readable")),
    }
    return counts.select(
        F.lit(TRENDS_TABLE).alias("table"),
        F.concat_ws("#", as_text(F.col("tag")), "period", "stamp").alias("row_key"),
        _cells("trend", values).alias("cells"),
        *carry,
    )


def cells(puts: DataFrame, *carry: str) -> DataFrame:
    """Puts as one row per cell."""
    # Outer, then without the empty ones: for an inner generator Spark infers a filter on
    # the array's size and pushes it to the scan, building every array a second time.
    return puts.select("table", "row_key", *carry, F.inline_outer("cells")).filter("qualifier IS NOT NULL")


def merge_cells(log: DataFrame, *versions: str) -> DataFrame:
    """Current cells: per column the value put last; columns not put again stay.

    A stored null is never meant, as values are text, so the order of versions decides.
    """
    order = F.struct(*versions) if len(versions) > 1 else F.col(versions[0])
    return log.groupBy(*CELL_KEY).agg(F.max_by("value", order).alias("value"))
