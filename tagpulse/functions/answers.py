"""Expressions over the ``answers`` array of one question.

They serve records whose answers came inside one message, so the array is as bounded
as a message is. Answers held as rows of a table, which no row may have to hold all
of, go through :mod:`tagpulse.operators.answer_rows` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from tagpulse.functions.text import strip_html
from tagpulse.schemas import ANSWER

HIGH_REPUTATION = 1000


def has_accepted(answers: str) -> str:
    return f"coalesce(exists({answers}, a -> coalesce(a.is_accepted, false)), false)"


def is_unanswered(answers: str) -> str:
    return f"({answers} IS NULL OR size({answers}) = 0)"


def answer_count(answers: str) -> str:
    return f"CASE WHEN {answers} IS NULL THEN 0 ELSE size({answers}) END"


def answer_score_sum(answers: str) -> str:
    return (
        f"coalesce(aggregate({answers}, 0L, (total, a) -> total + coalesce(a.score, 0)), 0L)"
    )


def avg_score(answers: str) -> str:
    """Mean answer score, a missing score counting as 0; no answers give 0.0."""
    return (
        f"CASE WHEN {is_unanswered(answers)} THEN 0.0D "
        f"ELSE {answer_score_sum(answers)} / size({answers}) END"
    )


def clean_bodies(answers: str, restrip: bool = True, fields: Sequence[str] = tuple(ANSWER.names)) -> str:
    """Each answer with its body as plain text; ``fields`` are those of an answer."""
    values = {field: f"a.{field}" for field in fields} | {"body": strip_html("a.body", restrip)}
    return f"transform({answers}, a -> named_struct({', '.join(f"'{name}', {value}" for name, value in values.items())}))"


def _accepted_first(answers: str, others: str, order: str, keep: int) -> str:
    """First accepted answer, then ``others`` by ``order`` and array position, cut to ``keep``.

    The one-element array binds ``s`` so that the accepted answer is found once per
    question rather than once per element.
    """
    ranked = (
        f"transform(array_sort(transform(filter(s.every, a -> {others}), "
        f"(a, i) -> struct({order}, i AS pos, a AS answer))), r -> r.answer)"
    )
    # filter(array(x), present) is [] or [x], with the answer's own type either way
    chosen = f"slice(concat(filter(array(s.accepted), a -> a IS NOT NULL), {ranked}), 1, {keep})"
    bound = (
        f"named_struct('every', {answers}, "
        f"'accepted', get(filter({answers}, a -> coalesce(a.is_accepted, false)), 0))"
    )
    return (
        f"CASE WHEN {answers} IS NULL THEN filter(array({answers}[0]), a -> false) "
        f"ELSE transform(array({bound}), s -> {chosen})[0] END"
    )


def top_answers(answers: str, keep: int = 3) -> str:
    """The best answers: first accepted, then reputable ones by score, then the rest by score.

    Ties keep array order. Copies equal to the accepted answer go; other copies stay.
    """
    return _accepted_first(
        answers,
        others="NOT (a <=> s.accepted)",
        order=(
            f"CASE WHEN coalesce(a.owner_reputation, 0) > {HIGH_REPUTATION} THEN 1 ELSE 2 END AS tier, "
            "-CAST(coalesce(a.score, 0) AS BIGINT) AS falling"
        ),
        keep=keep,
    )


def preselect(answers: str, keep: int = 3) -> str:
    """The producer's cut: first accepted, then not accepted ones by score."""
    return _accepted_first(
        answers,
        others="NOT coalesce(a.is_accepted, false)",
        order="-CAST(coalesce(a.score, 0) AS BIGINT) AS falling",
        keep=keep,
    )
