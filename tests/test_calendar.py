from __future__ import annotations

import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from tagpulse.operators.metrics import finish, roll_up
from tagpulse.plans.batch import calendar_metrics, refresh_changed_periods
from tagpulse.schemas import VERSION
from tagpulse.streaming.store import Store

DAY = 86400


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "tables"), cell_view=False, buckets=4)


def send(spark, store, batch_id, *records, version=None):
    rows = [(json.dumps(record).encode(), batch_id if version is None else version) for record in records]
    messages = spark.createDataFrame(rows, "value binary, n bigint").select(
        "value", F.struct(F.lit(None), F.lit(0), "n").cast(VERSION.dataType).alias("version")
    )
    store.write_questions(messages, batch_id)


def question(i, day, tags=("a",), scores=(), **more):
    answers = [{"answer_id": n, "score": s, "is_accepted": s > 5} for n, s in enumerate(scores)]
    return {"question_id": i, "creation_date": None if day is None else day * DAY + i % 1000, "score": i, "tags": list(tags), "answers": answers, **more}


def rounded(metrics):
    columns = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in metrics.dtypes]
    return sorted((str(tuple(row)) for row in metrics.select(*columns).collect()))


def assert_current(store, answer_mean="per_question"):
    whole = [calendar_metrics(store.questions.latest(), period, answer_mean) for period in ("daily", "monthly")]
    assert rounded(store.current_metrics().drop("written")) == rounded(whole[0].unionByName(whole[1]))


def partitions(store):
    found = {}
    for path in pathlib.Path(store.calendar_parts.path, "rows").rglob("*.parquet"):
        found.setdefault((path.parts[-3], path.parts[-2]), set()).add(path.name)
    return found


def test_changes_equal_a_full_recomputation(spark, store):
    rng = random.Random(3)
    for batch_id in range(4):
        # Questions come late, change tags, dates, scores and answers, and some go without.
        records = [
            question(
                rng.randrange(40), rng.choice([None, *range(0, 75, 7)]), rng.sample(["a", "b", "c", "d", None], rng.randint(0, 3)),
                [rng.randrange(9) for _ in range(rng.randint(0, 3))],
            )
            for _ in range(25)
        ]
        send(spark, store, batch_id, *records)
        if batch_id != 1:  # two batches to one run
            assert refresh_changed_periods(store) == {0: 0, 2: 1, 3: 2}[batch_id]
            assert_current(store)


def test_only_touched_months_are_written(spark, store):
    send(spark, store, 0, question(1, 3), question(2, 40), question(3, 400, ["b"]))
    refresh_changed_periods(store)
    before = partitions(store)
    assert sorted(place[1] for place in before if place[0] == "period=daily") == ["bucket=197001", "bucket=197002", "bucket=197102"]
    send(spark, store, 1, question(4, 41, ["z"]))
    refresh_changed_periods(store)
    after = partitions(store)
    assert {place for place in after if before.get(place) != after[place]} == {("period=daily", "bucket=197002"), ("period=monthly", "bucket=197002")}
    changes = store.calendar_changes.rows().filter("batch_id = 1").collect()
    assert [(row.tag, str(row.period_start)[:10]) for row in changes] == [("z", "1970-02-11")]
    assert_current(store)


def test_without_changes_nothing_is_done(spark, store):
    assert refresh_changed_periods(store) is None
    send(spark, store, 0, question(1, 3))
    assert refresh_changed_periods(store) == 0
    assert refresh_changed_periods(store) is None
    send(spark, store, 1, question(1, 3, ["old"]), version=-1)  # an older message changes no question
    assert refresh_changed_periods(store) is None
    assert_current(store)


def test_a_period_can_lose_its_last_question(spark, store):
    send(spark, store, 0, question(1, 3, ["a"], [7]), question(2, 3, ["b"]))
    refresh_changed_periods(store, "per_answer")
    send(spark, store, 1, question(1, 70, ["c"], [4, 5]))
    refresh_changed_periods(store, "per_answer")
    assert_current(store, "per_answer")
    gone = store.metrics.latest().filter("tag = 'a'").collect()
    assert [(row.total_questions, row.unanswered_percent, row.avg_question_score) for row in gone] == [(0, None, None)] * 2
    assert {row.tag for row in store.current_metrics().collect()} == {"b", "c"}


def test_a_run_that_failed_is_made_again(spark, store, monkeypatch):
    send(spark, store, 0, question(1, 3), question(2, 33))
    refresh_changed_periods(store)
    send(spark, store, 1, question(1, 3, ["b"], [3]))
    monkeypatch.setattr(store, "write_metrics", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        refresh_changed_periods(store)
    monkeypatch.undo()
    assert refresh_changed_periods(store) == 1
    assert_current(store)


def test_months_come_from_stored_days(spark, store):
    send(spark, store, 0, *[question(i, i * 3, ["a", f"t{i % 2}"], [i]) for i in range(30)])
    refresh_changed_periods(store)
    days = store.calendar_parts.latest().filter("period = 'daily'")
    months = store.current_metrics().filter("period = 'monthly'").drop("written")
    assert rounded(months) == rounded(finish(roll_up(days, "monthly")))
