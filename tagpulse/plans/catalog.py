"""Registered queries: each operator over the given tables, whole.

Averages are rounded to six decimals here, and only here, so that results can be compared
across engines that add doubles in different orders. Timestamps leave as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagpulse.functions import answers as A
from tagpulse.functions import text, times
from tagpulse.functions.sql import register_functions
from tagpulse.operators import metrics as M
from tagpulse.operators import puts as P
from tagpulse.operators import questions as Q
from tagpulse.operators import serving as S
from tagpulse.operators import trends as T
from tagpulse.operators.answer_rows import preselect_rows, top_answer_rows, with_answer_flags
from tagpulse.operators.latest import latest_version
from tagpulse.operators.search_index import SearchIndex, build
from tagpulse.plans import tables
from tagpulse.plans.batch import calendar_metrics, refresh_calendar_metrics, refresh_changed_periods
from tagpulse.schemas import CELL_LOG, METRIC_QUESTION, METRICS
from tagpulse.session import remove_folder, run_folder, shuffles_once
from tagpulse.sources.decode import decode_questions, decode_trends, rejected_questions, rejected_trends, to_messages
from tagpulse.sources.feed import backfill_and_live, flat_answers, live_repeats, shape_questions
from tagpulse.sources.messages import versioned
from tagpulse.streaming import jobs
from tagpulse.streaming.store import Store
from tagpulse.streaming.tables import BatchTable, KeyedTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ANSWER_ORDER = ("creation_date", "answer_id")
NOW, UNTIL = 1704931200, 1705017600  # 2024-01-11 and a day later


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _readable(column: str):
    return F.date_format(column, times.READABLE).alias(column)


def _rounded(metrics: DataFrame) -> DataFrame:
    averages = [c for c in metrics.columns if c.endswith(("_percent", "_score"))]
    plain = [c for c in metrics.columns if c not in (*averages, "period_start")]
    return metrics.select(*plain, _readable("period_start"), *[F.round(c, 6).alias(c) for c in averages])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "events")


def _event_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.with_answer_columns(tables.event_questions(_events(spark, sf_dir)))


def _sent_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through the wire format: encoded as messages, decoded for the metrics."""
    encoded = to_messages(tables.event_questions(_events(spark, sf_dir)))
    return Q.with_answer_columns(decode_questions(encoded, schema=METRIC_QUESTION))


def _order_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the flags of all their lines."""
    questions = tables.raw_questions(spark, sf_dir).withColumn("event_time", F.expr(times.event_time("creation_date")))
    return with_answer_flags(questions, flat_answers(tables.raw_answers(spark, sf_dir)))


def _shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_questions(tables.raw_questions(spark, sf_dir), tables.raw_answers(spark, sf_dir), ANSWER_ORDER)


# Sources and decoding


@_query
def decoded_questions(spark, sf_dir):
    messages = tables.question_messages(_events(spark, sf_dir))
    return decode_questions(messages).select(
        "question_id", "title", "body", "creation_date", "score", "owner_reputation",
        F.array_join("tags", "|").alias("tags"), F.size("answers").alias("answer_count"),
    )


@_query
def reject_split(spark, sf_dir):
    rejected = rejected_questions(tables.question_messages(_events(spark, sf_dir)), "version")
    return rejected.select(F.col("version.offset").alias("version"), "message")


@_query
def parse_trend_messages(spark, sf_dir):
    parsed = decode_trends(tables.trend_messages(_events(spark, sf_dir)), "version")
    return parsed.select(F.col("version.offset").alias("version"), "tag", "count")


@_query
def trend_rejects(spark, sf_dir):
    """Trend messages of which every 'error' is cut off and every 'view' has no tag."""
    cut = F.expr(
        "CASE tag WHEN 'error' THEN substr(text, 1, 9) WHEN 'view' THEN '{\"count\":1}' ELSE text END"
    )
    messages = tables.trend_messages(_events(spark, sf_dir)).select("version", F.col("value").cast("string").alias("text"))
    tagged = messages.withColumn("tag", F.get_json_object("text", "$.tag"))
    rejected = rejected_trends(tagged.select("version", cut.alias("value")), "version")
    return rejected.select(F.col("version.offset").alias("version"), "message")


@_query
def message_order(spark, sf_dir):
    """Each user's newest message of a topic of three partitions, whose offsets pass a
    million while many messages share a time."""
    topic = _events(spark, sf_dir).selectExpr(
        "CAST(event_id AS STRING) AS value", "CAST(date_trunc('DAY', ts) AS TIMESTAMP) AS timestamp",
        "CAST(event_id % 3 AS INT) AS partition", "999500 + event_id DIV 3 AS offset",
    )
    users = _events(spark, sf_dir).select(F.col("event_id").cast("string").alias("value"), "user_id")
    newest = latest_version(versioned(topic).join(users, "value"), ["user_id"], ["version"])
    return newest.select("user_id", F.col("value").cast("bigint").alias("event_id"))


@_query
def live_feed_repeats(spark, sf_dir):
    """How often a live producer sends each question of a day, fetching the last minute
    every second and a half, and what one copy of each leaves."""
    sent = live_repeats(tables.event_questions(_events(spark, sf_dir)), NOW, UNTIL)
    copies = sent.groupBy("question_id").agg(F.count("*").alias("copies"), F.max("fetch").alias("newest_fetch"))
    kept = latest_version(sent, ["question_id"], ["fetch"]).select("question_id", F.col("fetch").alias("kept_fetch"))
    return copies.join(kept, "question_id")


@_query
def shaped_questions(spark, sf_dir):
    return _shaped(spark, sf_dir).select(
        "question_id", "title", "body", "creation_date", "score", "owner_reputation", "is_answered",
        F.array_join("tags", "|").alias("tags"), F.size("answers").alias("answer_count"),
    )


@_query
def shaped_answers(spark, sf_dir):
    exploded = _shaped(spark, sf_dir).select("question_id", F.posexplode("answers").alias("position", "answer"))
    return exploded.select("question_id", "position", "answer.*")


@_query
def backfill_live_union(spark, sf_dir):
    questions = tables.event_questions(_events(spark, sf_dir))
    return backfill_and_live(questions, NOW, UNTIL, days=10).select(
        "question_id", "creation_date", "slice_start", "mode"
    )


@_query
def latest_versions(spark, sf_dir):
    versions = tables.table(spark, sf_dir, "orders")
    newest = latest_version(versions, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")


@_query
def outbound_json(spark, sf_dir):
    return to_messages(_shaped(spark, sf_dir).withColumn("mode", F.lit("backfill")))


# Text, dates and answer arrays


@_query
def strip_html_pages(spark, sf_dir):
    return tables.table(spark, sf_dir, "pages").selectExpr("page_id", f"{text.strip_html('html')} AS body")


@_query
def strip_html_keep_code(spark, sf_dir):
    return tables.table(spark, sf_dir, "pages").selectExpr("page_id", f"{text.strip_html('html', False)} AS body")


@_query
def strip_html_hard(spark, sf_dir):
    """Pages' numbers inside tags of many attributes, padded references, nested templates."""
    hard = tables.table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        """concat('<div ', array_join(transform(sequence(1, 65 + CAST(page_id % 30 AS INT)),
             i -> concat('a', i, '="', i, '>"')), ' '), ' title="p>q">n', page_id, '</div>&#',
           lpad('65', 13 + CAST(page_id % 20 AS INT), '0'), ';<template id="x>"><p>a</p><template>b', page_id,
           '</template><!-- </template> -->c</template>d', page_id, '<a href=''unclosed>e</a>') AS html""",
    )
    return hard.selectExpr("page_id", f"{text.strip_html('html')} AS body")


@_query
def strip_html_answers(spark, sf_dir):
    paragraphs = tables.table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "transform(split(html, '</p>', -1), (part, i) -> named_struct('answer_id', CAST(i AS BIGINT), 'body', part, "
        "'score', 0, 'is_accepted', false, 'owner_reputation', 0)) AS answers",
    )
    cleaned = paragraphs.select("page_id", F.inline_outer(F.expr(A.clean_bodies("answers"))))
    return cleaned.filter("answer_id IS NOT NULL").select("page_id", "answer_id", "body")


@_query
def readable_dates(spark, sf_dir):
    return tables.raw_questions(spark, sf_dir).selectExpr(
        "question_id",
        f"{times.readable('creation_date')} AS from_number",
        f"{times.readable_text('CAST(creation_date AS STRING)')} AS from_text",
        f"{times.readable_text('tags[0]')} AS from_other_text",
    )


@_query
def event_times(spark, sf_dir):
    questions = tables.event_questions(_events(spark, sf_dir))
    return questions.select(
        "question_id", F.expr(times.event_time("creation_date")).alias("event_time")
    ).select("question_id", _readable("event_time"))


@_query
def answer_flags(spark, sf_dir):
    return Q.with_answer_columns(tables.document_questions(spark, sf_dir)).select(
        "question_id", "has_accepted_answer", "is_unanswered", "answer_count", "answer_score_sum",
        F.round("avg_answer_score", 6).alias("avg_answer_score"),
    )


@_query
def answer_flags_rows(spark, sf_dir):
    return _order_questions(spark, sf_dir).select(
        "question_id", "has_accepted_answer", "is_unanswered", "answer_count", "answer_score_sum",
        F.round("avg_answer_score", 6).alias("avg_answer_score"),
    )


def _picked(spark, sf_dir, expression: str) -> DataFrame:
    picked = tables.document_questions(spark, sf_dir).select(
        "question_id", F.posexplode_outer(F.expr(expression)).alias("position", "answer")
    )
    return picked.filter("position IS NOT NULL").select("question_id", "position", "answer.*")


@_query
def top3_answers(spark, sf_dir):
    return _picked(spark, sf_dir, A.top_answers("answers"))


@_query
def preselect_answers(spark, sf_dir):
    return _picked(spark, sf_dir, A.preselect("answers"))


@_query
def top3_answer_rows(spark, sf_dir):
    answers = flat_answers(tables.raw_answers(spark, sf_dir))
    return top_answer_rows(answers, ANSWER_ORDER, carry=["score", "is_accepted"])


@_query
def preselect_answer_rows(spark, sf_dir):
    answers = flat_answers(tables.raw_answers(spark, sf_dir))
    return preselect_rows(answers, ANSWER_ORDER, carry=["score", "is_accepted"])


@_query
def sql_functions(spark, sf_dir):
    register_functions(spark)
    tables.document_questions(spark, sf_dir).createOrReplaceTempView("tagpulse_questions")
    return spark.sql(
        "SELECT question_id, strip_html_completely(body) AS body, format_timestamp(creation_date) AS created, "
        "has_accepted_answer(answers) AS has_accepted_answer, is_unanswered(answers) AS is_unanswered, "
        "round(avg_answer_score(answers), 6) AS avg_answer_score, "
        "array_join(transform(select_top_answers(answers), a -> CAST(a.answer_id AS STRING)), '|') AS top_answers "
        "FROM tagpulse_questions"
    )


# Metrics


@_query
def hourly_tag_metrics(spark, sf_dir):
    return _rounded(M.finish(M.hourly_parts(_sent_questions(spark, sf_dir))))


@_query
def hourly_tag_metrics_per_answer(spark, sf_dir):
    return _rounded(M.finish(M.hourly_parts(_event_questions(spark, sf_dir)), "per_answer"))


@_query
def daily_tag_metrics(spark, sf_dir):
    return _rounded(calendar_metrics(_order_questions(spark, sf_dir), "daily"))


@_query
def monthly_tag_metrics(spark, sf_dir):
    return _rounded(calendar_metrics(_order_questions(spark, sf_dir), "monthly"))


@_query
def metrics_rollup_day(spark, sf_dir):
    return _rounded(M.finish(M.roll_up(M.hourly_parts(_event_questions(spark, sf_dir)), "daily")))


@_query
def metrics_rollup_month(spark, sf_dir):
    days = M.roll_up(M.hourly_parts(_event_questions(spark, sf_dir)), "daily")
    return _rounded(M.finish(M.roll_up(days, "monthly")))


@_query
def trend_series(spark, sf_dir):
    metrics = M.finish(M.roll_up(M.hourly_parts(_event_questions(spark, sf_dir)), "daily"))
    return _rounded(S.trend_series(metrics, "purchase", "day"))


# Tags and raw counts


@_query
def tag_rows(spark, sf_dir):
    return Q.by_tag(tables.raw_questions(spark, sf_dir), "question_id", "score")


@_query
def tag_index(spark, sf_dir):
    return Q.tag_index(tables.raw_questions(spark, sf_dir))


@_query
def tag_index_latest(spark, sf_dir):
    return Q.tag_index_latest(Q.tag_index(tables.raw_questions(spark, sf_dir)))


def _trends(spark, sf_dir) -> DataFrame:
    # the batch replay takes the time from the record instead of the clock
    return decode_trends(tables.trend_messages(_events(spark, sf_dir)), "version")


@_query
def trend_fanout(spark, sf_dir):
    return T.fan_out(_trends(spark, sf_dir), "version").drop("event_time").withColumn("version", F.col("version.offset"))


@_query
def trend_latest(spark, sf_dir):
    return T.latest_counts(_trends(spark, sf_dir)).drop("event_time")


@_query
def trend_monthly(spark, sf_dir):
    return T.monthly_counts(_trends(spark, sf_dir))


# Puts and cells


def _cleaned(spark, sf_dir) -> DataFrame:
    return Q.clean(tables.document_questions(spark, sf_dir))


@_query
def question_cells(spark, sf_dir):
    return P.cells(P.question_puts(_cleaned(spark, sf_dir), families=["question"]))


@_query
def answer_cells(spark, sf_dir):
    return P.cells(P.question_puts(_cleaned(spark, sf_dir), families=["answers"]))


@_query
def top_answer_cells(spark, sf_dir):
    return P.cells(P.question_puts(_cleaned(spark, sf_dir), families=["top_answers"]))


@_query
def tag_index_cells(spark, sf_dir):
    return P.cells(P.tag_index_puts(tables.event_questions(_events(spark, sf_dir))))


def _numbers_apart(cells: DataFrame) -> DataFrame:
    """The one mean that depends on the order of addition as a rounded number, all else as
    the text it is."""
    is_mean = F.col("qualifier") == "avg_answer_score"
    return cells.select(
        "table", "row_key", "family", "qualifier",
        F.when(~is_mean, F.col("value")).alias("text_value"),
        F.when(is_mean, F.expr("round(try_cast(value AS DOUBLE), 6)")).alias("number_value"),
    )


@_query
def hourly_trend_cells(spark, sf_dir):
    metrics = M.finish(M.hourly_parts(_event_questions(spark, sf_dir)))
    return _numbers_apart(P.cells(P.metric_puts(metrics)))


@_query
def trend_cells(spark, sf_dir):
    cells = P.cells(P.trend_puts(T.fan_out(_trends(spark, sf_dir), "version"), "version"), "version")
    return cells.withColumn("version", F.col("version.offset"))


@_query
def cell_merge(spark, sf_dir):
    """Metrics and raw counts written to the same rows, the raw counts later."""
    metrics = M.finish(M.hourly_parts(_event_questions(spark, sf_dir)))
    first = P.cells(P.metric_puts(metrics)).withColumn("version", tables.version("-1", "TIMESTAMP'1970-01-01'"))
    counts = P.trend_puts(T.fan_out(_trends(spark, sf_dir), "version"), "version")
    return _numbers_apart(P.merge_cells(first.unionByName(P.cells(counts, "version")), "version"))


def _trend_cells_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(
        spark, f"{root}/cells", CELL_LOG, P.CELL_KEY, between="written", partition_by=["table"],
        bucket_by=["table", "row_key"], buckets=16, bloom=["row_key"],
    )


@_query
def keyed_table_latest(spark, sf_dir):
    """Raw counts merged in batches that do not come in order: the newest messages first,
    older ones after them, and one merged twice, as a replay does."""
    table = _trend_cells_table(spark, run_folder(spark, "keyed"))
    trends = _trends(spark, sf_dir)

    def put(condition: str, batch_id: int) -> None:
        counts = T.fan_out(trends.filter(condition), "version")
        newest = latest_version(counts, T.KEY, ["event_time", "version"])
        cells = P.cells(P.trend_puts(newest, "version", F.col("event_time").alias("written")), "version", "written")
        table.merge(cells, "trends", batch_id)

    put("event_time >= TIMESTAMP'2024-01-15 12:00:00'", 1)
    put("event_time < TIMESTAMP'2024-01-10 06:30:00'", 2)
    for _ in range(2):
        put("event_time BETWEEN TIMESTAMP'2024-01-09 00:00:00' AND TIMESTAMP'2024-01-16 00:00:00'", 0)
    return table.latest().select("table", "row_key", "family", "qualifier", "value")


def _stored_trends(spark, sf_dir, name: str) -> KeyedTable:
    """The cells of all raw counts and of the metrics, by two writers."""
    table = _trend_cells_table(spark, run_folder(spark, name))
    counts = P.trend_puts(T.fan_out(_trends(spark, sf_dir), "version"), "version", F.col("event_time").alias("written"))
    table.merge(P.cells(counts, "version", "written"), "trends", 0)
    metrics = P.metric_puts(M.finish(M.hourly_parts(_event_questions(spark, sf_dir))))
    before = tables.version("-1", "TIMESTAMP'1970-01-01'"), F.expr("TIMESTAMP'1970-01-01'")
    cells = P.cells(metrics).withColumn("version", before[0]).withColumn("written", before[1])
    table.merge(cells, "metrics", 0)
    return table


@_query
def stored_row(spark, sf_dir):
    """All current cells of one row, as a get by row key reads them."""
    table = _stored_trends(spark, sf_dir, "get")
    return _numbers_apart(S.row_cells(table, P.TRENDS_TABLE, "purchase#hourly#2024011006"))


@_query
def stored_rows_by_prefix(spark, sf_dir):
    """All current cells of one tag's days, as a scan by row prefix reads them."""
    table = _stored_trends(spark, sf_dir, "scan")
    return _numbers_apart(S.cells_by_prefix(table, P.TRENDS_TABLE, "click#daily#"))


# Serving queries


@_query
def search(spark, sf_dir):
    found = S.search(tables.documents(spark, sf_dir), "the ON", columns=("question_id", "title", "score", "body"))
    # The best answers of the few questions found.
    answered = tables.line_answers(found).withColumn("top_answers", F.expr(A.top_answers("answers")))
    ids = F.transform("top_answers", lambda a: a["answer_id"].cast("string"))
    return answered.select("question_id", "title", "score", F.array_join(ids, "|").alias("top_answers"))


@_query
def search_by_grams(spark, sf_dir):
    questions = tables.documents(spark, sf_dir)
    index = S.gram_index(questions)
    return S.search_by_grams(questions, index, "Reatha tion", columns=("question_id", "title", "score"))


@_query
def search_all_tags(spark, sf_dir):
    questions = tables.documents(spark, sf_dir)
    return S.search(questions, "th", ["en", "src1"], every_tag=True, columns=("question_id", "title", "score"))


@_query
def search_by_tag(spark, sf_dir):
    questions = tables.documents(spark, sf_dir)
    return S.search_by_index(
        questions, Q.tag_index(questions), "que", ["fr", "src3"], columns=("question_id", "title", "score")
    )


@_query
def suggest_titles(spark, sf_dir):
    titles = tables.table(spark, sf_dir, "part").selectExpr("p_partkey AS question_id", "p_name AS title")
    return S.suggest(titles, "SM")


#: Indexes that this process has written and opened, by kind, tables and session.
_WRITTEN: dict[tuple[str, str, str], object] = {}


def _written(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]):
    """An index that is written once for all queries on it."""
    key = name, sf_dir, spark.sparkContext.applicationId
    if key not in _WRITTEN:
        _WRITTEN[key] = write(run_folder(spark, name))
    return _WRITTEN[key]


def _search_index(spark: SparkSession, sf_dir: str) -> SearchIndex:
    questions = tables.documents(spark, sf_dir).select("question_id", "title", "body", "score", "tags")
    return _written(spark, sf_dir, "search", lambda folder: build(questions, folder))


@_query
def search_index_terms(spark, sf_dir):
    """How many questions and blocks of the ranking hold each gram."""
    return _search_index(spark, sf_dir).terms.select("term", "questions", "blocks", "first_block")


@_query
def search_stored(spark, sf_dir):
    return _search_index(spark, sf_dir).search("the ON", columns=("question_id", "title", "score"))


@_query
def search_stored_rare(spark, sf_dir):
    return _search_index(spark, sf_dir).search("Reatha tion", columns=("question_id", "title", "score"))


@_query
def search_stored_tags(spark, sf_dir):
    index = _search_index(spark, sf_dir)
    return index.search("th", ["en", "src1"], every_tag=True, columns=("question_id", "title", "score"))


@_query
def suggest_stored(spark, sf_dir):
    titles = tables.table(spark, sf_dir, "part").selectExpr("p_partkey AS question_id", "p_name AS title")

    def write(folder: str) -> DataFrame:
        S.title_index(titles).write.parquet(folder)
        return spark.read.parquet(folder)

    return S.suggest_from(_written(spark, sf_dir, "titles", write), "SM")


# Streaming

ONCE = {"availableNow": True}
#: Files of one slice of messages, all taken by one trigger, at least.
FILES = 2
SLICES = 4


def _files(spark: SparkSession, sf_dir: str) -> int:
    """Files of a slice: as many as tasks that read the events, so that each trigger has work for all."""
    return max(FILES, _events(spark, sf_dir).rdd.getNumPartitions())


def _sliced(messages: DataFrame, folder: str, slices: range, files: int) -> None:
    """Write messages to a stream's folder slice by slice, by their column ``slice``."""
    for number in slices:
        part = messages.filter(F.col("slice") == number).drop("slice").repartition(files)
        with shuffles_once(part.sparkSession):
            part.write.mode("append").parquet(folder)


def _stream(spark: SparkSession, folder: str, like: DataFrame, files: int) -> DataFrame:
    """The folder as a stream, a slice to a micro-batch."""
    schema = like.drop("slice").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


#: Eight days to a slice of January.
_OWN_SLICE = "CAST((day(timestamp_seconds(creation_date)) - 1) DIV 8 AS INT)"


def _halves(messages: DataFrame, folder: str, files: int, run: Callable[[], None]) -> None:
    """Feed a job half of the slices, let it end, and start it again for the rest. Messages that
    the job has taken are removed."""
    for half in (range(SLICES // 2), range(SLICES // 2, SLICES)):
        _sliced(messages, folder, half, files)
        run()
        remove_folder(messages.sparkSession, folder)


@_query
def stream_hourly_metrics(spark, sf_dir):
    """The hourly metrics job over the events as a stream, stopped and started again
    half-way, read back from its table."""
    root = run_folder(spark, "hourly")
    questions = tables.event_questions(_events(spark, sf_dir)).withColumn("slice", F.expr(_OWN_SLICE))
    keyed = to_messages(questions, carry=["slice"])
    store = Store(spark, f"{root}/tables", cell_view=False)
    files = _files(spark, sf_dir)

    def run():
        stream = _stream(spark, f"{root}/in", keyed, files)
        jobs.start_hourly_metrics(stream, store, f"{root}/checkpoints", ONCE).awaitTermination()

    _halves(keyed, f"{root}/in", files, run)
    return _rounded(store.metrics.latest().drop("written"))


@_query
def stream_late_rows(spark, sf_dir):
    """What each micro-batch of the hourly metrics emits when some messages come one slice
    late, in time for what is still open, and some three slices late."""
    root = run_folder(spark, "late")
    late = "CASE WHEN question_id % 11 = 0 THEN 1 WHEN question_id % 13 = 0 THEN 3 ELSE 0 END"
    questions = tables.event_questions(_events(spark, sf_dir))
    keyed = to_messages(
        questions.withColumn("slice", F.expr(f"least({_OWN_SLICE} + {late}, {SLICES - 1})")), carry=["slice"]
    )
    kept = BatchTable(spark, f"{root}/emitted", METRICS)
    store = Store(spark, f"{root}/tables", cell_view=False)
    store.write_metrics = lambda metrics, batch_id: kept.append(metrics, "hourly_metrics", batch_id)
    files = _files(spark, sf_dir)

    def run():
        stream = _stream(spark, f"{root}/in", keyed, files)
        jobs.start_hourly_metrics(stream, store, f"{root}/checkpoints", ONCE).awaitTermination()

    _halves(keyed, f"{root}/in", files, run)
    emitted = kept.rows()
    # Micro-batches without data emit nothing and are not numbered.
    batches = emitted.select("batch_id").distinct().withColumn("batch", F.row_number().over(Window.orderBy("batch_id")) - 1)
    return emitted.join(batches, "batch_id").select("batch", "tag", _readable("period_start"), "total_questions")


@_query
def stream_deduplicated_metrics(spark, sf_dir):
    """Every message sent twice at once and once more a slice later, counted once."""
    root = run_folder(spark, "dedup")
    questions = tables.event_questions(_events(spark, sf_dir)).withColumn("slice", F.expr(_OWN_SLICE))
    sent = F.expr(f"explode(array(slice, slice, least(slice + 1, {SLICES - 1})))")
    copies = to_messages(questions, carry=["slice"]).select("key", "value", sent.alias("slice"))
    store = Store(spark, f"{root}/tables", cell_view=False)
    files = _files(spark, sf_dir)
    _sliced(copies, f"{root}/in", range(SLICES), files)
    stream = _stream(spark, f"{root}/in", copies, files)
    jobs.start_hourly_metrics(stream, store, f"{root}/checkpoints", ONCE, dedup=True).awaitTermination()
    return _rounded(store.metrics.latest().drop("written"))


def _question_job(spark, sf_dir, name: str, cell_view: bool = False) -> Store:
    """The question job over messages of which every even one is followed, two slices
    later, by an older version of itself, and which all break in the same way if broken."""
    root = run_folder(spark, name)
    broken = F.when(F.col("value").cast("string").endswith("}"), F.col("value")).otherwise(F.lit("broken").cast("binary"))
    own = F.expr(f"least({_OWN_SLICE}, {SLICES - 3})").alias("slice")
    newest = tables.question_messages(_events(spark, sf_dir), own).withColumn("value", broken)
    title = F.regexp_replace(F.col("value").cast("string"), '"title":"[^"]*"', '"title":"old"').cast("binary")
    older = newest.filter("version.offset % 2 = 0").select(
        title.alias("value"), tables.version("version.offset", "TIMESTAMP'2023-01-01'").alias("version"),
        (F.col("slice") + 2).alias("slice"),
    )
    sent = newest.unionByName(older)
    store = Store(spark, f"{root}/tables", cell_view)
    files = _files(spark, sf_dir)

    def run():
        jobs.start_questions(_stream(spark, f"{root}/in", sent, files), store, f"{root}/checkpoints", ONCE).awaitTermination()

    _halves(sent, f"{root}/in", files, run)
    return store


@_query
def stream_questions(spark, sf_dir):
    """The question table after older versions came last."""
    return _question_job(spark, sf_dir, "questions").questions.latest().select(
        "question_id", "title", "body", "creation_date_readable", "score", "has_accepted_answer", "is_unanswered",
        F.array_join(F.transform("top_answers", lambda a: a["answer_id"].cast("string")), "|").alias("top_answers"),
    )


@_query
def stream_question_cells(spark, sf_dir):
    """The cells of the same job: titles, and what the tag index holds."""
    cells = _question_job(spark, sf_dir, "cells", cell_view=True).cells.latest()
    wanted = cells.filter("(family = 'question' AND qualifier = 'title') OR family = 'question_ids'")
    return wanted.select("table", "row_key", "family", "qualifier", "value")


@_query
def reject_counts(spark, sf_dir):
    """Rejects of the same job: equal broken messages are all counted."""
    rejects = _question_job(spark, sf_dir, "rejects").rejects.rows()
    return rejects.groupBy("topic", "message").agg(F.count("*").alias("messages"))


@_query
def stream_trends(spark, sf_dir):
    """The trends job; its stamps are the clock's, so only counts are returned."""
    root = run_folder(spark, "trends")
    messages = tables.trend_messages(tables.event_stream(spark, sf_dir)).select("value", "version")
    store = Store(spark, f"{root}/tables", cell_view=False)
    jobs.start_trends(messages, store, f"{root}/checkpoints", ONCE).awaitTermination()
    return store.trend_counts.latest().select("tag", "period", "raw_count")


@_query
def calendar_refresh(spark, sf_dir):
    """Day and month metrics of the stored questions, as the scheduled batch writes them."""
    store = _question_job(spark, sf_dir, "refresh")
    refresh_calendar_metrics(store, run_id=0)
    return _rounded(store.metrics.latest().drop("written"))


@_query
def calendar_refresh_changes(spark, sf_dir):
    """Day and month metrics kept up with changes: the first batch has an older version of
    every third question, with another date, tag and score, and lacks every seventh, which
    comes late; a refresh after each batch makes the touched days and their months anew."""
    store = Store(spark, f"{run_folder(spark, 'changes')}/tables", cell_view=False)
    questions = tables.event_questions(_events(spark, sf_dir)).filter("tags[0] <> 'error'")
    older = questions.withColumns(
        {
            "creation_date": F.col("creation_date") - 86400 * 20,
            "tags": F.array(F.lit("old"), F.col("tags")[1]),
            "score": F.col("score") + 1000,
            "answers": F.slice("answers", 1, 0),
        }
    )
    batches = (
        older.filter("question_id % 3 = 0").unionByName(questions.filter("question_id % 3 > 0")).filter("question_id % 7 > 0"),
        questions.filter("question_id % 3 = 0 OR question_id % 7 = 0"),
    )
    for batch_id, records in enumerate(batches):
        sent = tables.version(str(batch_id)).alias("version")
        messages = to_messages(records).select(F.col("value").cast("binary").alias("value"), sent)
        store.write_questions(messages, batch_id)
        refresh_changed_periods(store)
    return _rounded(store.current_metrics().drop("written"))


@_query
def stream_newest_metrics(spark, sf_dir):
    """Hourly metrics of a job that is stopped and started half-way, where every third question
    is sent with another tag, another score and no answers as well, as an older version."""
    root = run_folder(spark, "newest")
    questions = tables.event_questions(_events(spark, sf_dir))
    first = questions.filter("question_id % 3 = 0").withColumns(
        {"tags": F.array(F.lit("old"), F.col("tags")[1]), "answers": F.slice("answers", 1, 0), "score": F.col("score") + 100}
    )
    slices = F.expr(_OWN_SLICE)
    sent = [
        to_messages(part.withColumn("slice", slices), carry=["slice"]).select(
            F.col("value").cast("binary").alias("value"), tables.version(number).alias("version"), "slice"
        )
        for number, part in (("0", first), ("1", questions))
    ]
    messages = sent[0].unionByName(sent[1])
    store = Store(spark, f"{root}/tables", cell_view=False)
    files = _files(spark, sf_dir)

    def run():
        stream = _stream(spark, f"{root}/in", messages, files)
        jobs.start_newest_metrics(stream, store, f"{root}/checkpoints", ONCE).awaitTermination()

    _halves(messages, f"{root}/in", files, run)
    return _rounded(store.current_metrics().drop("written"))
