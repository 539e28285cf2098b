from __future__ import annotations

import datetime
import pathlib
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagpulse.operators.puts import CELL_KEY, cells, merge_cells
from tagpulse.operators.serving import cells_by_prefix, row_cells
from tagpulse.schemas import CELLS, WRITTEN
from tagpulse.session import run_folder, shared_dir, shuffles_once
from tagpulse.streaming import tables
from tagpulse.streaming.delivery import deliver
from tagpulse.streaming.store import Store
from tagpulse.streaming.tables import BatchTable, KeyedTable

STORED = T.StructType([*CELLS.fields, T.StructField("version", T.IntegerType()), WRITTEN])


def rows(spark, *values, version=0, written=0):
    at = datetime.datetime.fromtimestamp(1_700_000_000 + written)
    return spark.createDataFrame([("t", key, "f", column, value, version, at) for key, column, value in values], STORED)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(
        spark, str(tmp_path / "cells"), STORED, CELL_KEY, between="written", partition_by=["table"],
        bucket_by=["table", "row_key"], buckets=64, bloom=["row_key"],
    )


def current(table):
    return {(row.row_key, row.qualifier): row.value for row in table.latest().collect()}


def files(table):
    """Every stored file by its bucket."""
    found = {}
    for path in pathlib.Path(table.path, "rows").rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add(path)
    return found


def test_empty(table):
    assert current(table) == {} and table.at("t", "k").collect() == []


def test_later_puts_win_per_column(spark, table):
    table.merge(rows(spark, ("k", "a", "1"), ("k", "b", "1")), "w", 0)
    back = table.merge(rows(spark, ("k", "a", "2"), ("l", "a", "2")), "w", 1)
    assert current(table) == {("k", "a"): "2", ("k", "b"): "1", ("l", "a"): "2"}
    assert sorted(row.row_key for row in back.collect()) == ["k", "l"] and back.schema == STORED
    assert table.rows().count() == 3


def test_the_newest_message_wins_whenever_it_lands(spark, table):
    table.merge(rows(spark, ("k", "a", "new"), version=200), "w", 0)
    table.merge(rows(spark, ("k", "a", "old"), version=100), "w", 1)
    assert current(table) == {("k", "a"): "new"}


def test_no_clock_decides_within_a_writer(spark, table):
    table.merge(rows(spark, ("k", "a", "0"), written=60), "w", 0)
    table.merge(rows(spark, ("k", "a", "1"), written=0), "w", 1)  # restarted where the clock is behind
    assert current(table) == {("k", "a"): "1"}


def test_a_replay_changes_nothing(spark, table):
    first, second = rows(spark, ("k", "a", "1"), ("l", "a", "1")), rows(spark, ("k", "a", "2"))
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        table.merge(batch, "w", batch_id)
    before = sorted(map(tuple, table.rows().collect()))
    table.merge(second, "w", 1)
    table.merge(first, "w", 0)  # not even one that is not the last
    table.merge(second.limit(0), "w", 2)
    assert sorted(map(tuple, table.rows().collect())) == before
    assert current(table) == {("k", "a"): "2", ("l", "a"): "1"}


def test_writers_share_rows_and_the_later_wins(spark, table):
    table.merge(rows(spark, ("k", "shared", "x"), ("k", "x", "x"), written=1), "x", 5)
    table.merge(rows(spark, ("k", "shared", "y"), ("k", "y", "y"), written=2), "y", 0)
    expected = {("k", "shared"): "y", ("k", "x"): "x", ("k", "y"): "y"}
    assert current(table) == expected
    assert {(row.row_key, row.qualifier): row.value for row in table.at("t", "k").collect()} == expected


def test_merging_equals_a_maximum_over_all_puts(spark, table):
    source, every = random.Random(1), None
    for batch in range(5):
        values = [(str(source.randrange(30)), str(source.randrange(3)), f"{batch} {n}") for n in range(40)]
        for version in (source.randrange(9), source.randrange(9)):
            part = rows(spark, *dict(((k, c), (k, c, v)) for k, c, v in values).values(), version=version * 10 + batch)
            table.merge(part, "w", batch)
            every = part if every is None else every.unionByName(part)
    expected = {(r.row_key, r.qualifier): r.value for r in merge_cells(every, "version").collect()}
    assert current(table) == expected


def test_a_batch_reads_and_writes_the_buckets_it_touches(spark, table):
    table.merge(rows(spark, *[(f"k{i}", "a", "1") for i in range(500)]), "w", 0)
    before = files(table)
    assert len(before) == 64
    (bucket,) = {f"bucket={row.bucket}" for row in table.rows().filter("row_key = 'k7'").collect()}
    # Whatever else is read would fail.
    kept = {path: path.read_bytes() for name, paths in before.items() if name != bucket for path in paths}
    for path in kept:
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
        path.write_bytes(b"no parquet")
    table.merge(rows(spark, ("k7", "a", "2")), "w", 1)
    after = files(table)
    assert {name for name in before if before[name] != after[name]} == {bucket}
    assert [row.value for row in table.at("t", "k7").collect()] == ["2"]
    for path, content in kept.items():
        path.write_bytes(content)
    assert len(current(table)) == 500


def test_a_driver_that_dies_while_buckets_are_replaced(spark, table, monkeypatch):
    table.merge(rows(spark, *[(f"k{i}", "a", "1") for i in range(200)]), "w", 0)
    update = rows(spark, *[(f"k{i}", "a", "2") for i in range(0, 200, 2)])
    even = table.rows().filter("CAST(substr(row_key, 2) AS INT) % 2 = 0").select("bucket").distinct().collect()
    touched = sorted(f"bucket={row.bucket}" for row in even)
    put_in_place = KeyedTable._put_in_place

    def die(self, merged, writer):
        if pathlib.Path(merged).exists():
            # Some partitions are gone and their successors have not been moved there yet.
            for path in (path for name in touched[:9] for path in files(self)[name]):
                path.unlink()
            raise RuntimeError("lost")
        put_in_place(self, merged, writer)

    monkeypatch.setattr(KeyedTable, "_put_in_place", die)
    with pytest.raises(RuntimeError, match="lost"):
        table.merge(update, "w", 1)
    monkeypatch.undo()
    assert len(current(table)) < 200
    table.merge(update, "w", 1)
    assert current(table) == {(f"k{i}", "a"): "1" if i % 2 else "2" for i in range(200)}


def test_null_keys_are_keys(spark, table):
    table.merge(rows(spark, (None, "a", "1"), (None, "b", "1"), ("k", "a", "1")), "w", 0)
    table.merge(rows(spark, (None, "a", "2")), "w", 1)
    expected = {(None, "a"): "2", (None, "b"): "1", ("k", "a"): "1"}
    assert current(table) == expected
    assert {row.qualifier: row.value for row in table.at("t", None).collect()} == {"a": "2", "b": "1"}


def test_keys_that_come_together_can_be_stored_together(spark, tmp_path):
    schema = T.StructType([T.StructField("day", T.IntegerType()), T.StructField("n", T.IntegerType())])
    table = KeyedTable(spark, str(tmp_path / "days"), schema, ["day"], order=(), bucket=F.expr("day DIV 30"))
    for batch_id, days in enumerate((range(90), range(80, 95))):
        table.merge(spark.createDataFrame([(day, batch_id) for day in days], schema), "w", batch_id)
    assert sorted(files(table)) == ["bucket=0", "bucket=1", "bucket=2", "bucket=3"]
    assert sorted(map(tuple, table.latest().collect())) == [(day, int(day >= 80)) for day in range(95)]
    assert [tuple(row) for row in table.at(81).collect()] == [(81, 1)]


def test_a_large_place_is_shared_by_tasks(spark, tmp_path):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("text", T.StringType())])
    table = KeyedTable(spark, str(tmp_path / "months"), schema, ["n"], order=(), bucket=F.lit(202401), parts=8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for batch_id in range(2):
            table.merge(spark.range(1000 + 500 * batch_id).selectExpr("id AS n", f"'{batch_id}' AS text"), "w", batch_id)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (place,) = files(table).values()
    assert len(place) == 4  # all shuffle partitions of the tests
    assert sorted(map(tuple, table.latest().collect())) == [(n, "1") for n in range(1500)]


def test_merged_rows_are_written_and_shuffled_once(spark, table, monkeypatch):
    written, into = [], spark.createDataFrame([], "a int").write.__class__.parquet

    def parquet(self, path, **options):
        plan = self._df._jdf.queryExecution().optimizedPlan().toString()
        written.append((path.removeprefix(table.path).split("/")[1], plan.count("RepartitionByExpression")))
        return into(self, path, **options)

    monkeypatch.setattr(type(spark.range(1).write), "parquet", parquet)
    table.merge(rows(spark, ("k", "a", "1")), "w", 0)
    table.merge(rows(spark, ("k", "a", "2")), "w", 1)
    assert written == [("incoming", 0), ("merged", 1)] * 2
    written.clear()
    puts = rows(spark, ("k", "a", "3"), ("l", "a", "3"))
    table.merge_into(puts, puts.select("table", "row_key"), "w", 2)
    assert written == [("merged", 1)] and current(table) == {("k", "a"): "3", ("l", "a"): "3"}


def shuffle_files(spark):
    """Names of the shuffle files that are there, when none is being removed any more."""
    disk, names, before = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), None, ()
    while names != before:
        time.sleep(0.5)
        before, files = names, disk.getAllFiles()
        names = {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}
    return names


def test_a_merge_leaves_no_shuffle_files(spark, table):
    before = shuffle_files(spark)
    for value in ("1", "2"):
        table.merge(rows(spark, *[(f"k{i}", "a", value) for i in range(300)]).repartition(3), "w", int(value))
    puts = rows(spark, ("k7", "a", "3"))
    table.merge_into(puts, puts, "w", 3)
    assert shuffle_files(spark) <= before
    assert current(table) == {(f"k{i}", "a"): "3" if i == 7 else "2" for i in range(300)}


def test_shuffle_files_stay_as_set_outside_merges(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with shuffles_once(spark), shuffles_once(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before
    spark.conf.set(name, "false")
    try:
        with shuffles_once(spark):
            with shuffles_once(spark):
                pass
            assert spark.conf.get(name) == "true"
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.unset(name)


@pytest.fixture
def small_rounds(monkeypatch):
    """Rounds of as few partitions as there can be, once something is stored."""
    monkeypatch.setattr(tables, "TASK_BYTES", 1)
    monkeypatch.setattr(tables, "TASKS_PER_CORE", 0)


def test_a_large_batch_is_merged_in_rounds(spark, tmp_path, small_rounds, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "cells"), STORED, CELL_KEY, partition_by=["table"], bucket_by=["table", "row_key"], buckets=6)
    table.merge(rows(spark, *[(f"k{i}", "a", "1") for i in range(100)]), "w", 0)
    merged, put_in_place = [], KeyedTable._put_in_place

    def counting(self, folder, writer):
        found = [path.name for path in pathlib.Path(folder).glob("*/bucket=*")]
        merged.extend([found] if found else [])
        if len(merged) == 3:
            raise RuntimeError("lost")
        put_in_place(self, folder, writer)

    monkeypatch.setattr(KeyedTable, "_put_in_place", counting)
    update = rows(spark, *[(f"k{i}", "a", "2") for i in range(0, 100, 2)], ("new", "a", "2"), version=1)
    with pytest.raises(RuntimeError, match="lost"):
        table.merge(update, "w", 1)
    expected = {("new", "a"): "2"} | {(f"k{i}", "a"): "1" if i % 2 else "2" for i in range(100)}
    assert current(table) != expected
    table.merge(update, "w", 1)  # the replay
    # what was merged before the driver died is put in place, then all partitions are merged
    assert current(table) == expected and [len(found) for found in merged] == [1] * (3 + 1 + 6)
    table.merge_into(update, update.select("table", "row_key"), "w", 1)
    assert current(table) == expected and [len(found) for found in merged] == [1] * (3 + 1 + 6 + 6)


def test_tasks_share_what_has_grown_large(spark, tmp_path, small_rounds):
    table = KeyedTable(spark, str(tmp_path / "cells"), STORED, CELL_KEY, partition_by=["table"], bucket_by=["table", "row_key"], buckets=2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for batch_id in range(2):
            values = [(f"k{i}", name, str(batch_id)) for i in range(200 + 100 * batch_id) for name in "abc"]
            table.merge(rows(spark, *values), "w", batch_id)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [len(paths) for paths in files(table).values()] == [4, 4]  # all shuffle partitions of the tests
    assert current(table) == {(f"k{i}", name): "1" for i in range(300) for name in "abc"}
    # what is read together is stored together
    assert table.rows().groupBy("row_key").agg(F.countDistinct("_metadata.file_path").alias("n")).filter("n > 1").count() == 0


def test_partitions_of_null_and_of_odd_names_go_in_rounds(spark, tmp_path, small_rounds):
    schema = T.StructType([T.StructField("place", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("at", T.IntegerType())])
    table = KeyedTable(spark, str(tmp_path / "odd"), schema, ["place", "n"], order=(), partition_by=["place"], buckets=2)
    names = [None, "-", "a/b", "a=b", "100%", "é ü", "x#y"]
    for batch_id in range(2):
        batch = [(name, n, batch_id) for name in names for n in range(6 + 2 * batch_id)]
        table.merge(spark.createDataFrame(batch, schema), "w", batch_id)
    found = sorted(map(tuple, table.latest().collect()), key=str)
    assert found == sorted(((name, n, 1) for name in names for n in range(8)), key=str)


def test_a_round_makes_the_puts_of_its_own_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "tables"))
    puts = Store._question_puts(spark.createDataFrame([], store.questions.schema)).withColumn("written", F.lit(None).cast("timestamp"))
    tagged = store.cells._tagged(cells(puts, "version", "written"), 0)

    def plan(*places):
        return tagged.filter(store.cells._within(places))._jdf.queryExecution().optimizedPlan().toString()

    assert "Window" in plan(("stackoverflow_qna", 1), ("stackoverflow_tag_index", 1))
    assert "Window" not in plan(("stackoverflow_qna", 1), ("stackoverflow_qna", 2))
    index = plan(("stackoverflow_tag_index", 1))
    # only the tags of the round reach the shuffle of the index
    assert "Union" not in index and "xxhash64(stackoverflow_tag_index" in index.partition("Window ")[2]


def scanned(found):
    """What the scans of a result read, in its first run: files and rows."""
    found.collect()
    plan, leaves = found._jdf.queryExecution().executedPlan(), []
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    stack = [plan]
    while stack:
        node = stack.pop()
        if "QueryStage" in node.getClass().getSimpleName():
            node = node.plan()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            leaves.append({name: node.metrics().apply(name).value() for name in ("numFiles", "numOutputRows")})
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return {name: sum(leaf[name] for leaf in leaves) for name in ("numFiles", "numOutputRows")}


def test_reads_by_key_reach_few_files_and_row_groups(spark, tmp_path):
    table = KeyedTable(
        spark, str(tmp_path / "cells"), STORED, CELL_KEY, partition_by=["table"], bucket_by=["table", "row_key"],
        buckets=2, bloom=["row_key"],
    )
    at = datetime.datetime(2024, 1, 1)
    keys = [f"{tag}#{period}#{n:05}" for tag in ("a", "b", "é") for period in ("daily", "hourly") for n in range(20_000)]
    many = spark.createDataFrame([(k,) for k in keys], "row_key string").selectExpr(
        "'t' AS table", "row_key", "'f' AS family", "'q' AS qualifier", "repeat(row_key, 20) AS value", "1 AS version",
    ).withColumn("written", F.lit(at))
    spark.conf.set("parquet.block.size", str(1 << 16))
    try:
        table.merge(many, "w", 0)
    finally:
        spark.conf.unset("parquet.block.size")
    total = len(keys)
    one = row_cells(table, "t", "b#daily#00017")
    read = scanned(one)
    assert [row.row_key for row in one.collect()] == ["b#daily#00017"]
    assert 1 <= read["numFiles"] < table.rows().select("_metadata.file_path").distinct().count()
    assert read["numOutputRows"] < total / 4
    for prefix in ("b#daily#", "é#hourly#0001", "", "zz"):
        found = cells_by_prefix(table, "t", prefix)
        assert found.count() == sum(key.startswith(prefix) for key in keys)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual(row_key,{prefix})" in plan
        if prefix.startswith("é"):
            assert scanned(found)["numOutputRows"] < total / 4


def test_rows_of_batches_are_replaced_by_replays(spark, tmp_path):
    schema = T.StructType([T.StructField("message", T.StringType())])
    table = BatchTable(spark, str(tmp_path / "rejects"), schema)
    assert table.rows().count() == 0
    broken = spark.createDataFrame([("x",), ("x",)], schema)
    table.append(broken, "w", 0)
    table.append(broken.limit(1), "w", 1)
    assert sorted((r.message, r.writer, r.batch_id) for r in table.rows().collect()) == [("x", "w", 0), ("x", "w", 0), ("x", "w", 1)]
    table.append(broken.limit(0), "w", 0)
    assert table.rows().count() == 1


def test_merge_of_puts_in_one_log(spark):
    log = spark.createDataFrame(
        [("t", "k", "f", "a", "1", 1), ("t", "k", "f", "a", "3", 3), ("t", "k", "f", "a", "2", 2), ("t", "k", "f", "b", "1", 1)],
        f"{', '.join(f'`{c}` string' for c in CELLS.names)}, version long",
    )
    assert sorted((r.qualifier, r.value) for r in merge_cells(log, "version").collect()) == [("a", "3"), ("b", "1")]


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured.rstrip("/")
    assert run_folder(spark, "x").startswith(f"{configured.rstrip('/')}/tagpulse-x-")


PUTS = "table string, row_key string, cells array<struct<family:string,qualifier:string,value:string>>"


def puts(spark, count):
    return spark.createDataFrame([("t", f"k{i}", [("f", "a", f"v{i}")]) for i in range(count)], PUTS).repartition(3)


def recorder(folder, flaky=False, bad=("k1",), down=False):
    """Write each put to a file; a send with a row of ``bad`` fails, with ``flaky`` every
    first send of a connection does, with ``down`` no connection is made."""

    class Client:
        def __init__(self):
            self.sends = 0
            (folder / f"{uuid.uuid4().hex}.opened").touch()

        def send(self, table, puts):
            self.sends += 1
            if flaky and not (folder / "flaked").exists():
                (folder / "flaked").touch()
                raise ConnectionError("first attempt")
            if any(key.decode() in bad for key, _ in puts):
                raise ConnectionError("refused")
            for key, columns in puts:
                (folder / f"{key.decode()}.put").write_text(repr((table, sorted(columns.items()))))

        def close(self):
            (folder / f"{uuid.uuid4().hex}.closed").touch()

    def connect():
        if down:
            (folder / f"{uuid.uuid4().hex}.tried").touch()
            raise ConnectionError("down")
        return Client()

    return connect


def test_delivery_returns_what_failed(spark, tmp_path):
    failed = deliver(puts(spark, 20), recorder(tmp_path, flaky=True), delay=0.0).collect()
    assert [(row.row_key, row.cells[0].value, row.error) for row in failed] == [
        ("k1", "v1", "ConnectionError('refused')")
    ]
    assert len(list(tmp_path.glob("*.put"))) == 19
    assert (tmp_path / "k3.put").read_text() == repr(("t", [(b"f:a", b"v3")]))
    assert len(list(tmp_path.glob("*.opened"))) == len(list(tmp_path.glob("*.closed")))


def test_a_dead_store_is_given_up(spark, tmp_path):
    rows = puts(spark, 3000).coalesce(1)
    failed = deliver(rows, recorder(tmp_path, down=True), attempts=2, delay=0.0).collect()
    assert len(failed) == 3000 and {row.error for row in failed} == {"ConnectionError('down')"}
    # three chunks are tried, each twice and then put by put; the others are not
    assert len(list(tmp_path.glob("*.tried"))) == 3 * (2 + 100)


def test_a_store_delivers_and_keeps_what_failed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "tables"), cell_view=False, connect=recorder(tmp_path))
    store._put(puts(spark, 5), "w", 0)
    assert [row.row_key for row in store.failed_puts.rows().collect()] == ["k1"]
    assert len(list(tmp_path.glob("*.put"))) == 4
    # a replay that delivers everything leaves no failures behind
    store.connect = recorder(tmp_path, bad=())
    store._put(puts(spark, 5), "w", 0)
    assert store.failed_puts.rows().count() == 0


def test_delivery_can_fail_the_batch(spark, tmp_path):
    with pytest.raises(Exception, match="refused"):
        deliver(puts(spark, 3), recorder(tmp_path), attempts=2, delay=0.0, fail=True).collect()
