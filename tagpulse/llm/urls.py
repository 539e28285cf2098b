"""URL verdicts by a sort-merge range join of reversed-host keys, in DataFrame operations only.

A rule (host, path) fits its host and all subdomains where the URL's path starts with the
rule's. For every suffix of a URL's host that is some rule's host there is a key: that host
with its labels reversed, then the path. A rule covers the interval of keys that start with
its own, and rules' intervals either nest or lie apart. So keys and rules are sorted together
once; each rule carries the stack of the rules it is nested in, and a key takes the stack of
the last rule before it: the innermost entry that is still open there (a prefix of the key)
is the longest rule that fits. Of a URL's suffixes the longest rule (host and path together)
wins; of rules for one host and path, "block".

Only distinct hosts and paths are sorted, in ranges over all tasks, so a hot URL is one key;
the last rule of each range is handed on to the next ranges as one row.

A null URL, or one without "://", has empty host and path. URLs that no rule fits get
``DEFAULT``. Rules with a null host, path or verdict fit nothing; an empty rule path fits
every path, and an empty rule host only the empty host. Repeated rows are judged alike,
extra columns stay, empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.shared import settle
from tagpulse.llm.words import LOWER, UPPER

DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased. Path: from
    there up to "?", "#" or the end. Both as they stand in the URL otherwise."""
    at = F.locate("://", url)
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.char_length(host) + 1), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _key(host: Column, path: Column) -> Column:
    # The lowest character ends the host, so no other host's keys stand between its own.
    return F.concat(_reversed(host), F.lit("\x00"), path)


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with the rules it is nested in and itself, shortest path first."""
    lengths = rules.groupBy("host").agg(F.collect_set(F.char_length("path")).alias("lengths"))
    entry = F.struct(_key(F.col("host"), F.col("path")).alias("key"), "host", "path", "verdict")
    outer = rules.select("host", F.col("path").alias("prefix"), entry.alias("entry"))
    prefixes = rules.join(lengths, "host").select(
        "host", "path", F.explode(F.filter("lengths", lambda n: n <= F.char_length("path"))).alias("n")
    )
    return (
        prefixes.withColumn("prefix", F.substring("path", F.lit(1), F.col("n")))
        .join(outer, ["host", "prefix"])
        .groupBy("host", "path")
        .agg(F.array_sort(F.collect_list("entry")).alias("stack"))
    )


def judge(
    pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = DEFAULT, prefix: str = ""
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that won, or
    null) and ``verdict``; ``rules`` has host, path, verdict. ``prefix`` goes before the four
    names where they would clash with columns of ``pages``."""
    names = [prefix + n for n in ("host", "path", "rule", "verdict")]
    if set(names) & set(pages.columns):
        raise ValueError(f"pages already has one of {names}; name a prefix")
    rules = (
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        .where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block over allow
    )
    stacks = settle(_stacks(rules), "stacks")
    hosts = stacks.select(F.col("host").alias("anchor")).distinct()
    deepest = hosts.agg(F.max(F.size(F.split("anchor", r"\.")))).first()[0] or 0

    host, path = host_and_path(F.col(url))
    pages = pages.withColumns({names[0]: host, names[1]: path})
    targets = pages.select(F.col(names[0]).alias("host"), F.col(names[1]).alias("path")).distinct()
    labels = F.split("host", r"\.")
    # Suffixes of no more labels than any rule's host has.
    counts = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1))))
    suffix = F.transform(counts, lambda n: F.array_join(F.slice(labels, -n, n), "."))
    keys = (
        targets.select("host", "path", F.explode(suffix).alias("anchor"))
        .join(hosts, "anchor")
        .select("host", "path", "anchor", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
    )
    starts = stacks.select(
        F.lit(None).cast("string").alias("host"), "path", F.col("host").alias("anchor"), "stack"
    )
    ranges = (
        keys.unionByName(starts)
        .withColumn("key", _key(F.col("anchor"), F.col("path")))
        .withColumn("is_key", F.col("stack").isNull())
        .repartitionByRange("key", "is_key", "host")
        .withColumn("range", F.spark_partition_id())
    )
    ranges = settle(ranges, "ranges")
    ends = ranges.where("NOT is_key").groupBy("range").agg(F.max_by("stack", "key").alias("end"))
    everywhere = ranges.select("range").distinct().join(ends, "range", "left")
    handed_on = everywhere.select(
        "range",
        # One row for a range: few, however many keys there are.
        F.last("end", ignorenulls=True)
        .over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
        .alias("before"),
    )
    sweep = Window.partitionBy("range").orderBy("key", "is_key").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranges.withColumn("top", F.last("stack", ignorenulls=True).over(sweep)).where("is_key")
    stack = F.coalesce("top", "before")
    open_ = F.filter(stack, lambda r: F.col("key").startswith(r["key"]))
    rule = F.col("inner.host"), F.col("inner.path")
    best = (
        swept.join(handed_on, "range")
        .withColumn("inner", F.element_at(F.when(F.size(open_) > 0, open_), -1))
        .where("inner IS NOT NULL")
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.char_length(F.concat(*rule)).alias("length"),
                    F.char_length(rule[0]).alias("host_length"),
                    F.concat(*rule).alias("rule"),
                    F.col("inner.verdict").alias("verdict"),
                )
            ).alias("best")
        )
        .select(
            F.col("host").alias(names[0]),
            F.col("path").alias(names[1]),
            F.col("best.rule").alias(names[2]),
            F.col("best.verdict").alias("__verdict"),
        )
    )
    judged = pages.join(best, names[:2], "left")
    return judged.withColumn(names[3], F.coalesce("__verdict", F.lit(default))).select(*pages.columns, *names[2:])
