"""The registered queries as SQL for an independent engine, over the same tables."""

from __future__ import annotations

# Tags and what is no text inside them, in this engine's own terms; the given pages have no
# templates.
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)|<script(?:[\s/][^>]*)?>.*?(?:</script[^>]*>|\z)|<style(?:[\s/][^>]*)?>.*?(?:</style[^>]*>|\z)"
    r"|</?[a-z!?](?:[^>=]*=\s*(?:\x22[^\x22]*\x22|\x27[^\x27]*\x27))*[^>]*>"
)
LEFTOVER_TAG = "<[^>]+>"
# Unicode white space written out, for an engine without a class for it
BLANKS = (
    r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _html(column: str, restrip: bool = True) -> str:
    """HTML to text with the entities that occur in the given tables; a name may lack its
    semicolon where no letter or digit follows."""
    out = f"regexp_replace({column}, '{MARKUP}', ' ', 'g')"
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        out = f"regexp_replace({out}, '&{name}(;|\\b)', '{char}', 'g')"
    if restrip:
        out = f"regexp_replace({out}, '{LEFTOVER_TAG}', '', 'g')"
    return f"trim(regexp_replace({out}, '{BLANKS}', ' ', 'g'))"


# Events as questions, with the totals of their answers
_EVENTS = """
k AS (
  SELECT event_id, event_type, user_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS created,
         CAST(floor(value) AS INT) AS score, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k
  FROM events),
place AS (SELECT unnest([1, 2, 3]) AS j),
ea AS (
  SELECT event_id, j, k - 20 * j AS score, k - 10 * j >= 60 AS accepted
  FROM k, place WHERE j <= least(k // 25, 3)),
et AS (
  SELECT event_id, count(*) AS n, sum(score) AS total, bool_or(accepted) AS accepted FROM ea GROUP BY event_id),
q AS (
  SELECT k.event_id AS question_id, unnest([event_type, 'user-' || user_id]) AS tag, event_type, ts, k.score,
         coalesce(n, 0) AS n, coalesce(total, 0) AS total, coalesce(et.accepted, false) AS accepted
  FROM k LEFT JOIN et ON k.event_id = et.event_id)
"""

# Orders as questions, with the totals of their lines
_ORDERS = """
la AS (
  SELECT l_orderkey AS question_id, l_partkey * 68719476736 + l_suppkey * 4096 + l_linenumber * 256 + CAST(l_quantity AS INT) AS answer_id,
         '<i>' || l_returnflag || '</i> &lt;' || l_linestatus || '&gt; ' || l_linenumber AS body,
         l_returnflag || ' ' || l_linenumber AS clean_body,
         CAST(l_quantity AS INT) AS score, l_returnflag = 'A' AS is_accepted,
         CAST(epoch(l_shipdate) AS BIGINT) AS creation_date, CAST(l_partkey AS INT) AS owner_reputation
  FROM lineitem),
lt AS (
  SELECT question_id, count(*) AS n, sum(score) AS total, bool_or(is_accepted) AS accepted FROM la GROUP BY question_id),
o AS (
  SELECT o_orderkey AS question_id, 'Order ' || o_orderkey || ' ' || o_orderpriority AS title,
         '<p>' || o_orderpriority || ' &amp; ' || o_orderstatus || '</p>' AS body,
         o_orderpriority || ' & ' || o_orderstatus AS clean_body,
         o_orderdate, CAST(epoch(o_orderdate) AS BIGINT) AS creation_date,
         CAST(floor(o_totalprice / 10000) AS INT) AS score, CAST(o_custkey AS INT) AS owner_reputation,
         o_orderstatus = 'F' AS is_answered, o_orderpriority, o_orderstatus
  FROM orders),
of AS (
  SELECT o.*, coalesce(n, 0) AS n, coalesce(total, 0) AS total, coalesce(accepted, false) AS accepted
  FROM o LEFT JOIN lt ON o.question_id = lt.question_id),
q AS (
  SELECT question_id, unnest([o_orderpriority, o_orderstatus]) AS tag, o_orderdate AS ts, score, n, total, accepted
  FROM of)
"""

# The lines of orders: the first accepted, and the two ways of choosing three
_CHOSEN = (
    _ORDERS
    + """,
first AS (
  SELECT question_id, answer_id FROM la WHERE is_accepted
  QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY creation_date, answer_id) = 1),
marked AS (
  SELECT la.*, first.answer_id IS NOT NULL AS is_first
  FROM la LEFT JOIN first ON la.question_id = first.question_id AND la.answer_id = first.answer_id),
top AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY is_first DESC, owner_reputation > 1000 DESC,
                               score DESC, creation_date, answer_id) AS rank
  FROM marked QUALIFY rank <= 3),
pre AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY is_first DESC,
                               score DESC, creation_date, answer_id) AS rank
  FROM marked WHERE is_first OR NOT is_accepted QUALIFY rank <= 3)
"""
)

# The lines of documents as answers, by position
_LINES = """
cut AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS body, unnest(range(len(lines))) AS i FROM cut),
da AS (
  SELECT doc_id AS question_id, i, doc_id * 2147483648 + i + 1 AS answer_id, body,
         CAST(length(body) // 50 AS INT) AS score, contains(lower(body), 'ou') AS is_accepted,
         CAST(greatest(2000 - 300 * i, 0) AS INT) AS owner_reputation
  FROM line),
first AS (SELECT question_id, min(i) AS i FROM da WHERE is_accepted GROUP BY question_id),
marked AS (
  SELECT da.*, first.i IS NOT NULL AS is_first
  FROM da LEFT JOIN first ON da.question_id = first.question_id AND da.i = first.i),
top AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY is_first DESC, owner_reputation > 1000 DESC,
                               score DESC, i) - 1 AS position
  FROM marked QUALIFY position < 3),
pre AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY is_first DESC, score DESC, i) - 1 AS position
  FROM marked WHERE is_first OR NOT is_accepted QUALIFY position < 3)
"""


def _metrics(
    source: str, start: str, period: str, answer_mean: str | None = None, tail: str = "", rounded: bool = True
) -> str:
    mean = answer_mean or "avg(CASE WHEN n = 0 THEN 0.0 ELSE total / n END)"
    digits = "round({}, 6)" if rounded else "{}"
    return f"""
WITH {source}
SELECT tag, '{period}' AS period, {_TIME.format(start)} AS period_start, count(*) AS total_questions,
       {digits.format("sum(CASE WHEN n = 0 THEN 1 ELSE 0 END)::DOUBLE / count(*) * 100")} AS unanswered_percent,
       {digits.format("sum(CASE WHEN accepted THEN 1 ELSE 0 END)::DOUBLE / count(*) * 100")} AS accepted_percent,
       {digits.format("sum(score)::DOUBLE / count(score)")} AS avg_question_score,
       {digits.format(mean)} AS avg_answer_score
FROM q {tail} GROUP BY tag, {start}"""


_HOUR, _DAY, _MONTH = (f"date_trunc('{unit}', ts)" for unit in ("hour", "day", "month"))
_HOURLY = _metrics(_EVENTS, _HOUR, "hourly")
_HOURLY_EXACT = _metrics(_EVENTS, _HOUR, "hourly", rounded=False)
_GOOD = "WHERE event_type <> 'error'"

_DOCUMENT_FIELDS = "doc_id AS question_id, source || ' ' || lang || ' ' || doc_id AS title, CAST(n_chars AS INT) AS score"

_TREND_PLACES = """
t AS (
  SELECT event_id AS version, event_type AS tag, ts, CAST(regexp_extract(props, '[0-9]+') AS INT) AS raw_count
  FROM events),
f AS (
  SELECT tag, version, ts, raw_count, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp_readable,
         unnest(['hourly', 'daily', 'monthly']) AS period,
         unnest([strftime(ts, '%Y%m%d%H'), strftime(ts, '%Y%m%d'), strftime(ts, '%Y%m')]) AS stamp
  FROM t),
last AS (
  SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY tag, period, stamp ORDER BY ts DESC, version DESC) = 1),
written_last AS (
  SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY tag, period, stamp ORDER BY ts DESC, version DESC) = 1)
"""


def _cells(table: str, family: str, key: str, cells: dict[str, str], source: str, extra: str = "") -> str:
    names = ", ".join(name if name.startswith("(") else f"'{name}'" for name in cells)
    values = ", ".join(cells.values())
    return (
        f"SELECT '{table}' AS \"table\", {key} AS row_key, '{family}' AS family, "
        f"unnest([{names}]) AS qualifier, unnest([{values}]) AS value{extra} FROM {source}"
    )


def _boolean(column: str) -> str:
    return f"CASE WHEN {column} THEN 'True' ELSE 'False' END"


def _answer_cells(family: str, prefix: str, place: str, body: str, source: str) -> str:
    def name(suffix: str) -> str:
        return f"('{prefix}' || {place} || '_{suffix}')"

    return _cells(
        "stackoverflow_qna",
        family,
        "CAST(question_id AS VARCHAR)",
        {
            name("id"): "CAST(answer_id AS VARCHAR)",
            name("body"): body,
            name("score"): "CAST(score AS VARCHAR)",
            name("is_accepted"): _boolean("is_accepted"),
            name("owner_reputation"): "CAST(owner_reputation AS VARCHAR)",
        },
        source,
    )


_TREND_VALUES = {"raw_count": "CAST(raw_count AS VARCHAR)", "timestamp_readable": "timestamp_readable"}
_TREND_KEY = "tag || '#' || period || '#' || stamp"

_METRIC_NAMES = (
    "total_questions", "unanswered_percent", "accepted_percent", "avg_question_score", "avg_answer_score",
)


def _metric_cells(source: str) -> str:
    names = ", ".join(f"'{name}'" for name in _METRIC_NAMES)
    texts = ", ".join(f"CAST({name} AS VARCHAR)" for name in _METRIC_NAMES[:-1])
    return f"""
SELECT 'stackoverflow_trends' AS "table",
       tag || '#hourly#' || strftime(CAST(period_start AS TIMESTAMP), '%Y%m%d%H') AS row_key, 'trend' AS family,
       unnest([{names}, 'timestamp_readable']) AS qualifier,
       unnest([{texts}, NULL, period_start]) AS text_value,
       unnest([NULL, NULL, NULL, NULL, round(avg_answer_score, 6), NULL]) AS number_value
FROM ({source})"""


#: Cells of metrics with those of raw counts put over them.
_MERGED = f"""
WITH {_TREND_PLACES},
m AS ({_metric_cells(_HOURLY_EXACT)}),
r AS (
  SELECT 'stackoverflow_trends' AS "table", {_TREND_KEY} AS row_key, 'trend' AS family,
         unnest(['raw_count', 'timestamp_readable']) AS qualifier,
         unnest([CAST(raw_count AS VARCHAR), timestamp_readable]) AS text_value, CAST(NULL AS DOUBLE) AS number_value
  FROM written_last)
SELECT * FROM r
UNION ALL
SELECT m.* FROM m ANTI JOIN r ON m.row_key = r.row_key AND m.qualifier = r.qualifier"""


ORACLE: dict[str, str] = {
    "decoded_questions": """
SELECT event_id AS question_id, event_type || ' #' || event_id AS title,
       '<p>' || event_type || ' &amp; <code>' || k || '</code></p>' AS body,
       created AS creation_date, score, CAST(user_id AS INT) AS owner_reputation,
       event_type || '|user-' || user_id AS tags, CAST(least(k // 25, 3) AS INT) AS answer_count
FROM k WHERE event_type <> 'error'""",
    "reject_split": """
SELECT event_id AS version, '{"question_id": "' || event_id AS message FROM events WHERE event_type = 'error'""",
    "parse_trend_messages": """
SELECT event_id AS version, event_type AS tag, CAST(regexp_extract(props, '[0-9]+') AS INT) AS count FROM events""",
    "shaped_questions": f"""
WITH {_ORDERS}
SELECT question_id, title, body, creation_date, score, owner_reputation, is_answered,
       o_orderpriority || '|' || o_orderstatus AS tags, CAST(coalesce(c, 0) AS INT) AS answer_count
FROM o LEFT JOIN (
  SELECT question_id AS id, least(sum(CASE WHEN is_accepted THEN 0 ELSE 1 END) + max(CAST(is_accepted AS INT)), 3) AS c
  FROM la GROUP BY 1) ON question_id = id""",
    "shaped_answers": f"""
WITH {_CHOSEN}
SELECT question_id, CAST(rank - 1 AS INT) AS position, answer_id, body, score, is_accepted, creation_date, owner_reputation
FROM pre""",
    "backfill_live_union": """
WITH e AS (SELECT event_id AS question_id, CAST(floor(epoch(ts)) AS BIGINT) AS creation_date FROM events),
s AS (
  SELECT unnest(range(1704931200 - 864000, 1705017600, 60)) AS slice_start),
m AS (SELECT slice_start, CASE WHEN slice_start < 1704931200 THEN 'backfill' ELSE 'live' END AS mode FROM s)
SELECT question_id, creation_date, slice_start, mode
FROM e JOIN m ON creation_date BETWEEN slice_start AND slice_start + 60""",
    "latest_versions": """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "trend_rejects": """
SELECT event_id AS version, CASE event_type WHEN 'error' THEN '{"tag":"e' ELSE '{"count":1}' END AS message
FROM events WHERE event_type IN ('error', 'view')""",
    "message_order": """
SELECT user_id, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, event_id % 3 DESC, event_id // 3 DESC) = 1""",
    "live_feed_repeats": """
WITH e AS (SELECT event_id AS question_id, CAST(floor(epoch(ts)) AS BIGINT) - 1704931200 AS created FROM events),
fetches AS (SELECT unnest(range(57600)) AS place)
SELECT question_id, count(*) AS copies, max(place) AS newest_fetch, max(place) AS kept_fetch
FROM e JOIN fetches ON place * 1.5 BETWEEN created AND created + 60 GROUP BY question_id""",
    "outbound_json": f"""
WITH {_CHOSEN},
a AS (
  SELECT question_id, string_agg('{{"answer_id":' || answer_id || ',"body":"' || body || '","score":' || score ||
         ',"is_accepted":' || CAST(is_accepted AS VARCHAR) || ',"creation_date":' || creation_date ||
         ',"owner_reputation":' || owner_reputation || '}}', ',' ORDER BY rank) AS answers
  FROM pre GROUP BY question_id)
SELECT CAST(o.question_id AS VARCHAR) AS key,
       '{{"question_id":' || o.question_id || ',"title":"' || title || '","body":"' || body ||
       '","creation_date":' || creation_date || ',"score":' || score || ',"owner_reputation":' || owner_reputation ||
       ',"is_answered":' || CAST(is_answered AS VARCHAR) || ',"tags":["' || o_orderpriority || '","' ||
       o_orderstatus || '"],"answers":[' || coalesce(answers, '') || '],"mode":"backfill"}}' AS value
FROM o LEFT JOIN a ON o.question_id = a.question_id""",
    "strip_html_hard": """
SELECT page_id, 'n' || page_id || ' A d' || page_id || ' e' AS body FROM pages""",
    "strip_html_pages": f"SELECT page_id, {_html('html')} AS body FROM pages",
    "strip_html_keep_code": f"SELECT page_id, {_html('html', False)} AS body FROM pages",
    "strip_html_answers": f"""
WITH p AS (SELECT page_id, string_split(html, '</p>') AS parts FROM pages),
u AS (SELECT page_id, unnest(parts) AS part, CAST(unnest(range(len(parts))) AS BIGINT) AS answer_id FROM p)
SELECT page_id, answer_id, {_html('part')} AS body FROM u""",
    "readable_dates": f"""
SELECT o_orderkey AS question_id, {_TIME.format('o_orderdate')} AS from_number,
       {_TIME.format('o_orderdate')} AS from_text, o_orderpriority AS from_other_text
FROM orders""",
    "event_times": f"""
SELECT event_id AS question_id, {_TIME.format("date_trunc('second', ts)")} AS event_time FROM events""",
    "answer_flags": f"""
WITH {_LINES}
SELECT question_id, bool_or(is_accepted) AS has_accepted_answer, false AS is_unanswered,
       CAST(count(*) AS INT) AS answer_count, CAST(sum(score) AS BIGINT) AS answer_score_sum,
       round(sum(score) / count(*), 6) AS avg_answer_score
FROM da GROUP BY question_id""",
    "answer_flags_rows": f"""
WITH {_ORDERS}
SELECT question_id, accepted AS has_accepted_answer, n = 0 AS is_unanswered, n AS answer_count,
       CAST(total AS BIGINT) AS answer_score_sum,
       round(CASE WHEN n = 0 THEN 0.0 ELSE total / n END, 6) AS avg_answer_score
FROM of""",
    "top3_answers": f"""
WITH {_LINES}
SELECT question_id, CAST(position AS INT) AS position, answer_id, body, score, is_accepted, owner_reputation FROM top""",
    "preselect_answers": f"""
WITH {_LINES}
SELECT question_id, CAST(position AS INT) AS position, answer_id, body, score, is_accepted, owner_reputation FROM pre""",
    "top3_answer_rows": f"""
WITH {_CHOSEN}
SELECT question_id, CAST(rank AS INT) AS rank, answer_id, score, is_accepted FROM top""",
    "preselect_answer_rows": f"""
WITH {_CHOSEN}
SELECT question_id, CAST(rank AS INT) AS rank, answer_id, score, is_accepted FROM pre""",
    "sql_functions": f"""
WITH {_LINES},
c AS (SELECT question_id, count(*) AS n, sum(score) AS total, bool_or(is_accepted) AS accepted FROM da GROUP BY question_id),
ids AS (
  SELECT question_id, string_agg(CAST(answer_id AS VARCHAR), '|' ORDER BY position) AS top_answers FROM top GROUP BY 1)
SELECT c.question_id, {_html('text')} AS body, {_TIME.format('make_timestamp((doc_id * 60 + 1704067200) * 1000000)')} AS created,
       accepted AS has_accepted_answer, false AS is_unanswered, round(total / n, 6) AS avg_answer_score, top_answers
FROM c JOIN documents ON c.question_id = doc_id JOIN ids ON c.question_id = ids.question_id""",
    "hourly_tag_metrics": _HOURLY,
    "hourly_tag_metrics_per_answer": _metrics(
        _EVENTS, _HOUR, "hourly", "CASE WHEN sum(n) = 0 THEN 0.0 ELSE sum(total) / sum(n) END"
    ),
    "daily_tag_metrics": _metrics(_ORDERS, _DAY, "daily"),
    "monthly_tag_metrics": _metrics(_ORDERS, _MONTH, "monthly"),
    "metrics_rollup_day": _metrics(_EVENTS, _DAY, "daily"),
    "metrics_rollup_month": _metrics(_EVENTS, _MONTH, "monthly"),
    "trend_series": _metrics(_EVENTS, _DAY, "daily", tail="WHERE tag = 'purchase'"),
    "tag_rows": f"WITH {_ORDERS} SELECT tag, question_id, score FROM q",
    "tag_index": f"""
WITH {_ORDERS}
SELECT tag, CAST(epoch(ts) AS BIGINT) AS creation_date, question_id FROM q""",
    "tag_index_latest": f"""
WITH {_ORDERS}
SELECT tag, CAST(epoch(ts) AS BIGINT) AS creation_date, max(question_id) AS question_id FROM q GROUP BY tag, ts""",
    "trend_fanout": f"""
WITH {_TREND_PLACES}
SELECT tag, period, stamp, raw_count, timestamp_readable, version FROM f""",
    "trend_latest": f"""
WITH {_TREND_PLACES}
SELECT tag, period, stamp, raw_count, timestamp_readable FROM last""",
    "trend_monthly": f"""
WITH {_TREND_PLACES}
SELECT tag || '#' || stamp AS row_key, raw_count AS count FROM last WHERE period = 'monthly'""",
    "question_cells": f"WITH {_LINES}, of AS (SELECT question_id, bool_or(is_accepted) AS accepted FROM da GROUP BY 1), "
    "dq AS (SELECT documents.*, accepted, doc_id * 60 + 1704067200 AS created FROM documents JOIN of ON doc_id = question_id) "
    + _cells(
        "stackoverflow_qna",
        "question",
        "CAST(doc_id AS VARCHAR)",
        {
            "title": "source || ' ' || lang || ' ' || doc_id",
            "body": _html("text"),
            "creation_date": _TIME.format("make_timestamp(created * 1000000)"),
            "raw_creation_date": "CAST(created AS VARCHAR)",
            "score": "CAST(n_chars AS VARCHAR)",
            "owner_reputation": "CAST(n_chars AS VARCHAR)",
            "has_accepted": _boolean("accepted"),
            "is_unanswered": "'False'",
            "tags": "'[\"' || lang || '\", \"' || source || '\"]'",
        },
        "dq",
    ),
    "answer_cells": f"WITH {_LINES} " + _answer_cells("answers", "answer", "(i + 1)", _html("body"), "da"),
    "top_answer_cells": f"WITH {_LINES} "
    + _answer_cells("top_answers", "top", "(position + 1)", _html("body"), "top"),
    "tag_index_cells": """
SELECT 'stackoverflow_tag_index' AS "table", unnest([event_type, 'user-' || user_id]) AS row_key,
       'question_ids' AS family, CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS qualifier,
       CAST(event_id AS VARCHAR) AS value
FROM events""",
    "hourly_trend_cells": _metric_cells(_HOURLY_EXACT),
    "trend_cells": f"WITH {_TREND_PLACES} "
    + _cells("stackoverflow_trends", "trend", _TREND_KEY, _TREND_VALUES, "f", ", version"),
    "cell_merge": _MERGED,
    "stored_row": f"SELECT * FROM ({_MERGED}) WHERE row_key = 'purchase#hourly#2024011006'",
    "stored_rows_by_prefix": f"SELECT * FROM ({_MERGED}) WHERE starts_with(row_key, 'click#daily#')",
    "keyed_table_latest": f"WITH {_TREND_PLACES} "
    + _cells("stackoverflow_trends", "trend", _TREND_KEY, _TREND_VALUES, "last"),
    "search_by_grams": f"""
SELECT {_DOCUMENT_FIELDS} FROM documents
WHERE contains(lower(source || ' ' || lang || ' ' || doc_id || ' ' || text), 'reatha')
  AND contains(lower(source || ' ' || lang || ' ' || doc_id || ' ' || text), 'tion')
ORDER BY n_chars DESC, doc_id LIMIT 10""",
    "search": f"""
WITH {_LINES},
found AS (
  SELECT {_DOCUMENT_FIELDS} FROM documents
  WHERE contains(lower(source || ' ' || lang || ' ' || doc_id || ' ' || text), 'the')
    AND contains(lower(source || ' ' || lang || ' ' || doc_id || ' ' || text), 'on')
  ORDER BY n_chars DESC, doc_id LIMIT 10),
ids AS (
  SELECT question_id, string_agg(CAST(answer_id AS VARCHAR), '|' ORDER BY position) AS top_answers FROM top GROUP BY 1)
SELECT found.question_id, title, score, top_answers FROM found JOIN ids ON found.question_id = ids.question_id""",
    "search_all_tags": f"""
SELECT {_DOCUMENT_FIELDS} FROM documents
WHERE contains(lower(source || ' ' || lang || ' ' || doc_id || ' ' || text), 'th') AND lang = 'en' AND source = 'src1'
ORDER BY n_chars DESC, doc_id LIMIT 10""",
    "search_by_tag": f"""
SELECT {_DOCUMENT_FIELDS} FROM documents
WHERE contains(lower(source || ' ' || lang || ' ' || doc_id || ' ' || text), 'que') AND (lang = 'fr' OR source = 'src3')
ORDER BY n_chars DESC, doc_id LIMIT 10""",
    "search_index_terms": """
WITH r AS (
  SELECT doc_id, lower(source || ' ' || lang || ' ' || doc_id || ' ' || text) AS t,
         (row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) // 1024 AS block FROM documents),
w AS (SELECT DISTINCT doc_id, block, unnest(string_split(t, ' ')) AS w FROM r),
g AS (
  SELECT DISTINCT doc_id, block, substr(w, i, 3) AS term
  FROM (SELECT doc_id, block, w, unnest(range(1, length(w) - 1)) AS i FROM w WHERE length(w) >= 3))
SELECT term, count(*) AS questions, count(DISTINCT block) AS blocks, min(block) AS first_block FROM g GROUP BY term""",
    "search_stored": f"""
SELECT {_DOCUMENT_FIELDS} FROM documents
WHERE contains(lower(source || ' ' || lang || ' ' || doc_id || ' ' || text), 'the')
  AND contains(lower(source || ' ' || lang || ' ' || doc_id || ' ' || text), 'on')
ORDER BY n_chars DESC, doc_id LIMIT 10""",
    "suggest_titles": """
SELECT p_name AS title, min(p_partkey) AS question_id FROM part
WHERE starts_with(lower(p_name), 'sm') GROUP BY p_name ORDER BY title LIMIT 5""",
    "stream_hourly_metrics": _HOURLY,
    "stream_deduplicated_metrics": _HOURLY,
    "stream_newest_metrics": _HOURLY,
    "stream_late_rows": f"""
WITH e AS (
  SELECT unnest([event_type, 'user-' || user_id]) AS tag, date_trunc('hour', ts) AS hour, date_trunc('second', ts) AS moment,
         least((day(ts) - 1) // 8 + CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_id % 13 = 0 THEN 3 ELSE 0 END, 3) AS batch
  FROM events),
tops AS (SELECT batch, max(moment) AS top_moment FROM e GROUP BY batch),
-- A batch drops by the watermark of the batch before; the stop after the second adds one without data.
seen AS (
  SELECT e.batch, max(top_moment) - INTERVAL 10 MINUTE AS watermark
  FROM (SELECT DISTINCT batch FROM e) e JOIN tops ON tops.batch <= CASE WHEN e.batch = 2 THEN 1 ELSE e.batch - 2 END
  GROUP BY e.batch),
kept AS (
  SELECT e.* FROM e LEFT JOIN seen ON e.batch = seen.batch
  WHERE watermark IS NULL OR hour + INTERVAL 1 HOUR > watermark),
new AS (SELECT batch, tag, hour, count(*) AS n FROM kept GROUP BY ALL)
SELECT CAST(batch AS INT) AS batch, tag, {_TIME.format('hour')} AS period_start,
       CAST(sum(n) OVER (PARTITION BY tag, hour ORDER BY batch) AS BIGINT) AS total_questions
FROM new""",
    "stream_questions": f"""
WITH {_EVENTS},
best AS (
  SELECT event_id, string_agg(CAST(event_id * 10 + j AS VARCHAR), '|' ORDER BY first DESC, reputable DESC, score DESC, j) AS ids
  FROM (
    SELECT ea.*, user_id * 40 * j > 1000 AS reputable,
           ea.accepted AND j = min(CASE WHEN ea.accepted THEN j END) OVER (PARTITION BY ea.event_id) AS first
    FROM ea JOIN k ON ea.event_id = k.event_id)
  GROUP BY event_id)
SELECT k.event_id AS question_id, event_type || ' #' || k.event_id AS title, event_type || ' & ' || k AS body,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS creation_date_readable, k.score,
       coalesce(et.accepted, false) AS has_accepted_answer, n IS NULL AS is_unanswered, coalesce(ids, '') AS top_answers
FROM k LEFT JOIN et ON k.event_id = et.event_id LEFT JOIN best ON k.event_id = best.event_id
WHERE event_type <> 'error'""",
    "stream_question_cells": """
WITH e AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS created FROM events WHERE event_type <> 'error'),
t AS (SELECT unnest([event_type, 'user-' || user_id]) AS tag, created, event_id FROM e)
SELECT 'stackoverflow_qna' AS "table", CAST(event_id AS VARCHAR) AS row_key, 'question' AS family, 'title' AS qualifier,
       event_type || ' #' || event_id AS value FROM e
UNION ALL
SELECT 'stackoverflow_tag_index', tag, 'question_ids', CAST(created AS VARCHAR), CAST(max(event_id) AS VARCHAR)
FROM t GROUP BY tag, created""",
    "reject_counts": """
SELECT 'stackoverflow-questions' AS topic, 'broken' AS message,
       sum(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END)::BIGINT AS messages
FROM events WHERE event_type = 'error' HAVING count(*) > 0""",
    "calendar_refresh": f"""
SELECT * FROM ({_metrics(_EVENTS, _DAY, "daily", tail=_GOOD)})
UNION ALL
SELECT * FROM ({_metrics(_EVENTS, _MONTH, "monthly", tail=_GOOD)})""",
    "calendar_refresh_changes": f"""
SELECT * FROM ({_metrics(_EVENTS, _DAY, "daily", tail=_GOOD)})
UNION ALL
SELECT * FROM ({_metrics(_EVENTS, _MONTH, "monthly", tail=_GOOD)})""",
    "stream_trends": f"""
WITH {_TREND_PLACES},
newest AS (SELECT tag, raw_count FROM t QUALIFY row_number() OVER (PARTITION BY tag ORDER BY ts DESC, version DESC) = 1)
SELECT tag, unnest(['hourly', 'daily', 'monthly']) AS period, raw_count FROM newest""",
}
ORACLE["decoded_questions"] = f"WITH {_EVENTS}" + ORACLE["decoded_questions"]
for _stored, _scanned in (
    ("search_stored_rare", "search_by_grams"),
    ("search_stored_tags", "search_all_tags"),
    ("suggest_stored", "suggest_titles"),
):
    ORACLE[_stored] = ORACLE[_scanned]
