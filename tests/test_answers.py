from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tagpulse.functions import answers as A
from tagpulse.operators.answer_rows import preselect_rows, top_answer_rows, with_answer_flags
from tagpulse.schemas import ANSWER

RECORD = f"question_id long, answers array<{ANSWER.simpleString()}>"


def answer(i, score, accepted, reputation, body="b"):
    return (i, body, score, accepted, reputation)


def best(answers, keep=3):
    """Brute force: accepted, then reputable by score, then the rest by score."""
    if not answers:
        return []
    accepted = next((a for a in answers if a[3]), None)
    others = [a for a in answers if accepted is None or a != accepted]
    reputable = [a for a in others if (a[4] or 0) > 1000]
    rest = [a for a in others if (a[4] or 0) <= 1000]
    for group in (reputable, rest):
        group.sort(key=lambda a: a[2] or 0, reverse=True)
    return (([accepted] if accepted else []) + reputable + rest)[:keep]


def cut(answers, keep=3):
    if not answers:
        return []
    accepted = [a for a in answers if a[3]][:1]
    others = sorted((a for a in answers if not a[3]), key=lambda a: a[2] or 0, reverse=True)
    return (accepted + others)[:keep]


def pick(spark, expression, records):
    rows = spark.createDataFrame(list(enumerate(records)), RECORD)
    result = rows.select("question_id", F.expr(expression).alias("picked")).collect()
    return [[tuple(a) for a in row.picked] for row in sorted(result, key=lambda row: row.question_id)]


GOLDENS = [
    (None, []),
    ([], []),
    ([(9, False, 10), (1, True, 5), (5, False, 2000), (7, False, 1001)], [2, 4, 3]),
    ([(9, False, 1000), (1, False, 1001)], [2, 1]),
    ([(3, False, 0), (3, False, 0), (4, True, 0), (8, True, 0)], [3, 4, 1]),
    ([(2, True, 1), (None, False, 1), (4, False, 1)], [1, 3, 2]),
]


def test_top_answers_goldens(spark):
    records = [
        None if given is None else [answer(i, *values) for i, values in enumerate(given, 1)] for given, _ in GOLDENS
    ]
    picked = pick(spark, A.top_answers("answers"), records)
    assert [[a[0] for a in row] for row in picked] == [expected for _, expected in GOLDENS]


def random_records(seed, count, unique):
    source = random.Random(seed)
    records = []
    for _ in range(count):
        size = source.randrange(0, 9)
        records.append(
            [
                answer(
                    i if unique else source.randrange(2),
                    source.choice([None, 0, 1, 2, 3]),
                    source.choice([None, False, False, True]),
                    source.choice([None, 5, 1000, 1001, 5000]),
                    "b" if not unique else f"b{i}",
                )
                for i in range(size)
            ]
        )
    return records


@pytest.mark.parametrize("unique", [True, False])
def test_array_choices_equal_brute_force(spark, unique):
    records = random_records(7, 2000, unique)
    assert pick(spark, A.top_answers("answers"), records) == [best(r) for r in records]
    assert pick(spark, A.preselect("answers"), records) == [cut(r) for r in records]


def test_ordinary_copies_stay_and_copies_of_the_accepted_go(spark):
    accepted, other = answer(1, 5, True, 1), answer(2, 4, False, 1)
    assert pick(spark, A.top_answers("answers"), [[accepted, accepted, other, other]]) == [[accepted, other, other]]


def flat(spark, records):
    rows = [(q, i, *a) for q, record in enumerate(records) for i, a in enumerate(record)]
    schema = "question_id long, pos int, answer_id long, body string, score int, is_accepted boolean, owner_reputation int"
    return spark.createDataFrame(rows, schema)


def ranked(frame):
    found = {}
    for row in sorted(frame.collect(), key=lambda row: (row.question_id, row["rank"])):
        found.setdefault(row.question_id, []).append(row.answer_id)
        assert row["rank"] == len(found[row.question_id])
    return found


@pytest.mark.parametrize("keep", [1, 3, 5])
def test_row_choices_equal_brute_force(spark, keep):
    records = random_records(11, 1500, unique=True)
    rows = flat(spark, records).repartition(5)
    for choose, expected in ((top_answer_rows, best), (preselect_rows, cut)):
        want = {q: [a[0] for a in expected(r, keep)] for q, r in enumerate(records)}
        assert ranked(choose(rows, ["pos"], keep)) == {q: ids for q, ids in want.items() if ids}


def test_a_question_with_a_third_of_all_answers(spark, without_broadcast):
    many = [answer(i, i % 977, i in (500, 20000), 900 + i % 202) for i in range(30000)]
    records = [many] + random_records(5, 12000, unique=True)
    rows = flat(spark, records).repartition(8)
    chosen = top_answer_rows(rows, ["pos"])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert ranked(chosen)[0] == [a[0] for a in best(many)]
    # both sets are cut before their one shuffle, and no body is sorted up to there
    assert plan.count("Partial") == 1
    below = plan[plan.index("Partial") :].split("\n")
    up_to_scan = below[: next(i for i, line in enumerate(below) if "Scan" in line)]
    assert any("Sort" in line for line in up_to_scan) and not any("body" in line for line in up_to_scan)


def test_flags(spark):
    records = [None, [], [answer(1, 2, True, 1), answer(2, None, None, 1), answer(3, 4, False, 1)]]
    rows = spark.createDataFrame(list(enumerate(records)), RECORD).select(
        "question_id",
        F.expr(A.has_accepted("answers")),
        F.expr(A.is_unanswered("answers")),
        F.expr(A.avg_score("answers")),
        F.expr(A.answer_count("answers")),
        F.expr(A.answer_score_sum("answers")),
    )
    assert [tuple(row) for row in sorted(rows.collect())] == [
        (0, False, True, 0.0, 0, 0),
        (1, False, True, 0.0, 0, 0),
        (2, True, False, 2.0, 3, 6),
    ]


def test_flags_of_rows_equal_flags_of_arrays(spark):
    records = random_records(3, 500, unique=True)
    nested = spark.createDataFrame(list(enumerate(records)), RECORD).select(
        "question_id",
        F.expr(A.has_accepted("answers")),
        F.expr(A.is_unanswered("answers")),
        F.expr(A.avg_score("answers")),
    )
    questions = spark.range(len(records)).withColumnRenamed("id", "question_id")
    from_rows = with_answer_flags(questions, flat(spark, records)).select(
        "question_id", "has_accepted_answer", "is_unanswered", "avg_answer_score"
    )
    assert sorted(map(tuple, nested.collect())) == sorted(map(tuple, from_rows.collect()))


def test_bodies_are_cleaned_inside_the_array(spark):
    rows = spark.createDataFrame([(1, [answer(1, 1, True, 1, "<p>a &amp; b</p>"), answer(2, 1, None, 1, None)]), (2, None)], RECORD)
    cleaned = [row[0] for row in rows.select(F.expr(A.clean_bodies("answers"))).collect()]
    assert [a.body for a in cleaned[0]] == ["a & b", ""] and cleaned[1] is None
