"""Queries behind a search page and a trends page."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from tagpulse.streaming.tables import KeyedTable

SEARCH_LIMIT = 10
SUGGESTIONS = 5
SHORTEST_PREFIX = 2
GRAM = 3
PIECE = 64

RESULT_COLUMNS = ("question_id", "title", "score", "tags", "top_answers")


def matches(query: str) -> Column:
    """Every word of ``query`` occurs in title or body, whatever its case."""
    words = dict.fromkeys(query.lower().split())
    if not words:
        return F.lit(True)
    # The lowered text is an element of an array, so that it is made once for all words.
    text = F.array(F.lower(F.concat_ws(" ", "title", "body")))
    return F.exists(text, lambda t: reduce(and_, [F.contains(t, F.lit(word)) for word in words]))


def tagged(tags: Sequence[str], every: bool = False) -> Column:
    """Carries any of ``tags``, or with ``every`` all of them."""
    wanted = [F.array_contains("tags", tag) for tag in dict.fromkeys(tags)]
    result = wanted[0]
    for condition in wanted[1:]:
        result = (result & condition) if every else (result | condition)
    return result


def search(
    questions: DataFrame,
    query: str,
    tags: Sequence[str] = (),
    limit: int = SEARCH_LIMIT,
    every_tag: bool = False,
    columns: Sequence[str] = RESULT_COLUMNS,
) -> DataFrame:
    """The best-scored matching questions with their top answers.

    Each task keeps its own best ``limit`` rows, so what travels is small.
    """
    found = questions.filter(matches(query))
    if tags:
        found = found.filter(tagged(tags, every_tag))
    return found.select(*columns).orderBy(F.col("score").desc(), "question_id").limit(limit)


def search_by_index(
    questions: DataFrame,
    index: DataFrame,
    query: str,
    tags: Sequence[str],
    limit: int = SEARCH_LIMIT,
    columns: Sequence[str] = RESULT_COLUMNS,
) -> DataFrame:
    """The same, found through the tag index; the questions' own tags have the last word, as
    an index entry outlives a change of tags.

    Texts are compared where they are read, and only ids and results meet in the join. It
    is left to Catalyst, which broadcasts the ids only below its size limit: a tag may be
    on a third of all questions.
    """
    ids = index.filter(F.col("tag").isin(*tags)).select("question_id")
    return search(questions.join(ids, "question_id", "left_semi"), query, tags, limit, columns=columns)


def gram_index(questions: DataFrame, *carry: str) -> DataFrame:
    """(gram, question_id): the runs of ``GRAM`` characters without blanks that a question's
    lowered title and body hold, each once. A table to keep beside the questions, sorted by
    gram. ``carry`` names columns to keep."""
    words = F.array_distinct(F.split(F.lower(F.concat_ws(" ", "title", "body")), " "))

    def runs(text: Column, step: int, width: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - GRAM + 1, F.lit(1)), F.lit(step))
        return F.transform(starts, lambda i: F.substr(text, i, F.lit(width)))

    # Long words in overlapping pieces, as finding a place in a text takes as long as its distance.
    pieces = F.flatten(F.transform(words, lambda w: runs(w, PIECE - GRAM + 1, PIECE)))
    grams = F.flatten(F.transform(F.array_distinct(pieces), lambda p: runs(p, 1, GRAM)))
    distinct = F.filter(F.array_distinct(grams), lambda g: F.char_length(g) == GRAM)
    return questions.select("question_id", *carry, F.explode(distinct).alias("gram")).select("gram", "question_id", *carry)


def search_by_grams(
    questions: DataFrame,
    index: DataFrame,
    query: str,
    limit: int = SEARCH_LIMIT,
    columns: Sequence[str] = RESULT_COLUMNS,
) -> DataFrame:
    """The same as :func:`search` without tags, looking only into questions that hold all
    grams of the query; words shorter than a gram prune nothing."""
    grams = sorted({w[i : i + GRAM] for w in query.lower().split() for i in range(len(w) - GRAM + 1)})
    if not grams:
        return search(questions, query, (), limit, columns=columns)
    held = index.filter(F.col("gram").isin(*grams)).groupBy("question_id").agg(F.count("*").alias("held"))
    ids = held.filter(F.col("held") == len(grams)).select("question_id")
    return search(questions.join(ids, "question_id", "left_semi"), query, (), limit, columns=columns)


def after_prefix(prefix: str) -> str | None:
    """The smallest text that is greater than all texts that begin with ``prefix``, in the order
    of their bytes in UTF-8; None where there is none."""
    for i in range(len(prefix) - 1, -1, -1):
        code = ord(prefix[i])
        if code < 0x10FFFF:
            # no code points between these two: they are halves of UTF-16 pairs
            return prefix[:i] + chr(0xE000 if code == 0xD7FF else code + 1)
    return None


def begins_with(column: str, prefix: str) -> Column:
    """``column`` begins with ``prefix``, as a range, which the statistics of sorted files
    answer."""
    end = after_prefix(prefix)
    at_least = F.col(column) >= prefix
    return at_least if end is None else at_least & (F.col(column) < end)


def row_cells(cells: KeyedTable, table: str, row_key: str) -> DataFrame:
    """The current cells of one row, from the one bucket that can hold it."""
    return cells.at(table, row_key).select("table", "row_key", "family", "qualifier", "value")


def cells_by_prefix(cells: KeyedTable, table: str, prefix: str) -> DataFrame:
    """The current cells of all rows whose keys begin with ``prefix``."""
    held = cells.latest_where(F.col("table") == table).filter(begins_with("row_key", prefix))
    return held.select("table", "row_key", "family", "qualifier", "value")


def trend_series(metrics: DataFrame, tag: str, period: str) -> DataFrame:
    """One tag's metrics over time; ``period`` is 'hour', 'day' or 'month'."""
    name = {"hour": "hourly", "day": "daily", "month": "monthly"}[period]
    return metrics.filter((F.col("tag") == tag) & (F.col("period") == name)).orderBy("period_start")


def suggest(questions: DataFrame, prefix: str, limit: int = SUGGESTIONS) -> DataFrame:
    """Up to ``limit`` distinct titles that begin with ``prefix``, whatever its case.

    Shorter prefixes than two characters suggest nothing. Titles are made distinct by
    partial aggregation, so copies of one title meet as one row per task.
    """
    asked = prefix.lower() if len(prefix) >= SHORTEST_PREFIX else None
    starts = F.lit(False) if asked is None else F.lower("title").startswith(asked)
    return (
        questions.filter(starts)
        .groupBy("title")
        .agg(F.min("question_id").alias("question_id"))
        .orderBy("title", "question_id")
        .limit(limit)
    )


def title_index(questions: DataFrame) -> DataFrame:
    """(lowered, title, question_id): distinct titles, each with its smallest question, sorted by
    the lowered title over ranges. A table to keep beside the questions."""
    titles = questions.filter("title IS NOT NULL").groupBy("title").agg(F.min("question_id").alias("question_id"))
    keyed = titles.select(F.lower("title").alias("lowered"), "title", "question_id")
    return keyed.repartitionByRange("lowered", "title").sortWithinPartitions("lowered", "title")


def suggest_from(titles: DataFrame, prefix: str, limit: int = SUGGESTIONS) -> DataFrame:
    """The same as :func:`suggest` from a stored title index: the prefix is a range of lowered
    titles, so only the row groups that hold it are read."""
    starts = begins_with("lowered", prefix.lower()) if len(prefix) >= SHORTEST_PREFIX else F.lit(False)
    return titles.filter(starts).select("title", "question_id").orderBy("title", "question_id").limit(limit)
