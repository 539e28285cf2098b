"""The registered queries of this package, and their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from tagpulse.llm import (
    bpe,
    chat,
    decontaminate,
    licenses,
    passages,
    quality,
    resample,
    simhash,
    toxicity,
    trie,
    urls,
    vamana,
    warc,
)
from tagpulse.llm.shared import new_folder, settle, small, table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    vocabulary = bpe.load(path, public_tokenizers.PATTERN)
    both = bpe.encode_and_decode(F.col("text"), vocabulary).alias("both")
    return table(spark, sf_dir, "documents").select("doc_id", both).select("doc_id", "both.*").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    n_hit = decontaminate.hit_words(F.col("found.spans"))
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each passage that a document shares with one of a smaller id."""
    found = passages.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    copy = found.select("doc_id", F.explode("copied").alias("c"))
    return copy.select(
        "doc_id",
        F.col("c.source").alias("source_doc_id"),
        F.col("c.first").alias("first_word"),
        F.col("c.last").alias("last_word"),
        F.col("c.source_first").alias("source_first_word"),
        F.col("c.source_last").alias("source_last_word"),
        F.col("c.similarity").alias("similarity"),
    )


def op4_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vamana.search(rows, rows.where("vec_id % 20 = 0"), k=20)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = chat.Template()
    said = "</s>[INST] ok [/INST]"
    more = small(spark, [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id turn role text")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    chats = chat.format_chats(turns, template)
    loss = chat.lost_text(F.col("segments"), template)
    # The turns as a reader of the formatted text finds them.
    read = F.transform(template.parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size(read).cast("long").alias("n_turns"),
        F.sha2(F.array_join(read, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


#: Fixed values of the query: host, path, verdict.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = small(spark, list(URL_RULES), "host path verdict")
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), licenses.known(spark))
    return scanned.select(
        "doc_id",
        "canonical_sha256",
        F.array_join("license_ids", ",").alias("license_ids"),
        F.array_join("notice_ids", ",").alias("notice_ids"),
    )


def _remainder() -> Column:
    """Rows with remainder 0 are held out from learning."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))


def learnable(labels: DataFrame) -> DataFrame:
    return labels.where(_remainder() != 0)


def _judged(docs: DataFrame, score: Column, threshold: float) -> DataFrame:
    scored = docs.select("doc_id", (_remainder() == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels")), label="toxic")
    judged = docs.withColumn("judged", toxicity.judge(F.col("text"), model))
    scored = judged.select("doc_id", "judged", (_remainder() == 0).alias("held_out"))
    return scored.select(
        "doc_id",
        "held_out",
        F.col("judged.score").alias("score"),
        (F.col("judged.score") >= 0.5).cast("int").alias("predicted"),
        F.col("judged.evidence.key").alias("evidence_doc_ids"),
    )


QUALITY_THRESHOLD = 0.3


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, learnable(table(spark, sf_dir, "labels")), label="quality")
    return _judged(docs, quality.score(F.col("text"), model), QUALITY_THRESHOLD)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations whose first turns are those of conversation c - c % 100."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    numbered = trie.digested(turns).withColumn("place", F.row_number().over(order))
    numbered = settle(numbered.select("conv_id", "place", "digest", "chars"), "turns")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6))
    own = numbered.where(F.col("place") > h).select("conv_id", F.col("place").alias("turn"), "digest", "chars")
    ids = numbered.select("conv_id").distinct()
    heads = numbered.where("place < 6 AND conv_id % 100 = 0").withColumnRenamed("conv_id", "head")
    started = (
        ids.withColumns({"h": h, "head": F.expr("conv_id - conv_id % 100")})
        .join(heads, "head")
        .where("place <= h")
        .select("conv_id", F.col("place").alias("turn"), "digest", "chars")
    )
    return own.unionByName(started), ids


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, ids = _rebuilt(table(spark, sf_dir, "conversations"))
    return trie.nodes(trie.sequences(turns, ids))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return warc.records(warc.read(manifest, data=False)).select(
        F.col("key").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
        "url",
    )


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
window_starts AS (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
  FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM window_starts),
sizes AS (SELECT DISTINCT k FROM windows),
runs AS (
  SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k),
occurrences AS (
  SELECT r.doc_id, r.p, r.k, x.item_id
  FROM runs r JOIN windows x ON x.k = r.k AND x.g = array_to_string(r.w[r.p:r.p + r.k - 1], ' ')),
hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM occurrences) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occurrences) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "tool": ("[TOOL]", "[/TOOL]")}
_AROUND = " ".join(f"WHEN '{role}' THEN {len(a) + len(b) + 3}" for role, (a, b) in _MARKS.items())

OP5_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
m AS (
  SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    len(regexp_extract_all(text, '(?:<\\\\*(?:<SYS>>|</SYS>>|s>|/s>|role>|/role>|end>)|\\[\\\\*(?:/?INST|/?TOOL)\\])')) AS escapes
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(text) + escapes + CASE role {_AROUND} ELSE length(role) + 22 END) AS BIGINT) AS formatted_chars,
  bool_and((before || '>' || role) IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user',
    'assistant>tool', 'tool>assistant')) AS valid
FROM m GROUP BY conv_id
"""

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

OP8_SQL = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
after AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS a FROM pages),
parts AS (
  SELECT page_id, regexp_extract(a, '^[^/?#]*') AS raw, a FROM after),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(a, length(raw) + 1), '^[^?#]*') AS path FROM parts),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM p, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN fits ON fits.page_id = p.page_id AND place = 1
"""


def _folded_sql(text: str) -> str:
    out = f"regexp_replace({text}, '(?m)^[ \\t]*(?:(?:[Cc]opyright|COPYRIGHT)[ \\t]*(?:\\([Cc]\\)|©|[0-9<\\[])|\\([Cc]\\)[ \\t]|©)[^\\n]*$', ' ', 'g')"
    return f"regexp_replace(lower({out}), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"


def _canonical_sql(folded: str) -> str:
    out = f"trim(regexp_replace({folded}, '[ \\n]+', ' ', 'g'))"
    for one, other in licenses.SPELLINGS:
        out = f"replace({out}, '{one}', '{other}')"
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN_ROWS = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in licenses.KNOWN)

OP10_SQL = f"""
WITH known(id, text) AS (VALUES {_KNOWN_ROWS}),
names AS (SELECT DISTINCT id, {_canonical_sql(_folded_sql('text'))} AS form FROM known),
folded AS (SELECT doc_id, {_folded_sql('text')} AS f FROM documents),
entire AS (SELECT doc_id, nullif({_canonical_sql('f')}, '') AS form FROM folded),
parts AS (
  SELECT doc_id, unnest(string_split(f, chr(10))) AS part FROM folded
  UNION ALL SELECT doc_id, unnest(regexp_split_to_array(f, '\\n *\\n[ \\n]*')) FROM folded),
forms AS (SELECT doc_id, {_canonical_sql('part')} AS form FROM parts),
notices AS (
  SELECT doc_id, string_agg(id, ',' ORDER BY id) AS notice_ids
  FROM (SELECT DISTINCT doc_id, id FROM forms JOIN names USING (form)) GROUP BY doc_id),
whole AS (
  SELECT doc_id, string_agg(id, ',' ORDER BY id) AS license_ids
  FROM (SELECT DISTINCT doc_id, id FROM entire JOIN names USING (form)) GROUP BY doc_id)
SELECT doc_id, sha256(form) AS canonical_sha256, coalesce(license_ids, '') AS license_ids,
  coalesce(notice_ids, '') AS notice_ids
FROM entire LEFT JOIN whole USING (doc_id) LEFT JOIN notices USING (doc_id)
"""

#: CRC-32 by table, in SQL; ``crc.t`` is the table.
_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, i::UBIGINT)) AS t)"""


def _crc_sql(text: str) -> str:
    octets = f"list_transform(range(octet_length(encode({text}))), lambda k: ('0x' || substr(hex(encode({text})), 2*k+1, 2))::UBIGINT)"
    step = "xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)::BIGINT"


OP11_SQL = f"""
WITH {_CRC_TABLE},
o AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
    length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, {_crc_sql('CAST(conv_id AS VARCHAR)')} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM o), crc),
r AS (
  SELECT o.conv_id, place, m, chars FROM o JOIN ids USING (conv_id) WHERE place > h
  UNION ALL SELECT ids.conv_id, place, m, chars FROM ids JOIN o ON o.conv_id = ids.head WHERE place <= h),
turns AS (SELECT conv_id, m, chars, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth FROM r),
paths AS (
  SELECT ids.conv_id, coalesce(string_agg(m, '' ORDER BY depth), '') AS path
  FROM ids LEFT JOIN turns USING (conv_id) GROUP BY ids.conv_id),
members AS (
  SELECT conv_id, 0 AS depth, '' AS node, 0 AS chars FROM ids
  UNION ALL SELECT conv_id, depth, substr(path, 1, 32 * depth), chars FROM turns JOIN paths USING (conv_id)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars
  FROM members GROUP BY node, depth),
below AS (
  SELECT substr(node, 1, length(node) - 32) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN below USING (node)),
sums AS (
  SELECT m.node, sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved
  FROM full_nodes x JOIN members m ON m.conv_id = x.conv_id AND m.depth <= x.depth GROUP BY m.node),
ends AS (SELECT path AS node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM paths GROUP BY path)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs, x.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes x JOIN sums USING (node) LEFT JOIN ends USING (node)
LEFT JOIN nodes up ON x.depth > 0 AND up.node = substr(x.node, 1, length(x.node) - 32)
"""

OP12_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
g AS (
  SELECT page_id, url, body, octet_length(encode(body)) AS n,
    max(page_id) OVER (PARTITION BY body) AS head FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM head THEN head END AS refers_to, url
FROM g
"""

OP13_SQL = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents),
b AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
buckets AS (
  SELECT w, {_crc_sql('w')} % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM (SELECT w FROM d UNION ALL SELECT w FROM b)), crc),
s AS (SELECT bucket, count(*) AS s FROM d JOIN buckets USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN buckets USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    (CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM d) + 10000))
    / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM b) + 10000)))) AS BIGINT) AS gain
  FROM range(10000) r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total
  FROM d JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features,
    CASE WHEN n_features IS NULL THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
    CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM documents LEFT JOIN weights USING (doc_id)),
noisy AS (
  SELECT doc_id, n_features, weight,
    weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
places AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n FROM noisy)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank
FROM places
"""


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_decontamination": op2_decontamination,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_vector_search": op4_vector_search,
    "op5_chat_format": op5_chat_format,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_url_filter": op8_url_filter,
    "op9_simhash": op9_simhash,
    "op10_license_scan": op10_license_scan,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_warc": op12_warc,
    "op13_resampling": op13_resampling,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op5_chat_format": OP5_SQL,
    "op8_url_filter": OP8_SQL,
    "op10_license_scan": OP10_SQL,
    "op11_conversation_trie": OP11_SQL,
    "op12_warc": OP12_SQL,
    "op13_resampling": OP13_SQL,
}
