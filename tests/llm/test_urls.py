from __future__ import annotations

import random

import pytest
from oracle_check import connect, differences

from tagpulse.llm import queries, urls

RULES = "host string, path string, verdict string"
PAGES = "page_id bigint, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    cut = min([after.find(c) for c in "/?#" if c in after], default=len(after))
    host, rest = after[:cut], after[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def plain(url, rules):
    host, path = split(url)
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for h, p, v in rules
        if h is not None and p is not None and v is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, "allow"
    return host, path, *max(fits)[2:]


def check(spark, rows, rules):
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    judged = urls.judge(pages, spark.createDataFrame(rules, RULES))
    expected = sorted(str((i, *plain(u, rules))) for i, u in rows)
    found = sorted(str((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])) for r in judged.collect())
    assert found == expected


def test_query_against_sql(spark):
    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        ours = queries.QUERIES["op8_url_filter"](spark, sf_dir)
        assert differences(ours, connect(sf_dir), queries.ORACLE["op8_url_filter"]) is None


def test_nested_rules_against_brute_force(spark):
    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "x.org", "org", "co", "acom", "a.b.a.com"]
    path = lambda n: "/" + "".join(rng.choices("ab/", k=rng.randint(0, n)))
    rules = [(rng.choice(hosts), rng.choice([path(4), ""]), rng.choice(["allow", "block"])) for _ in range(150)]
    rules += [(None, "/", "block"), ("com", None, "block"), ("com", "/", None), ("", "/a", "block")]
    rows = []
    for i in range(1500):
        host = rng.choice(hosts + ["www.", "q.", "B.A.COM", ""]) if rng.random() < 0.6 else f"s{i % 7}.{rng.choice(hosts)}"
        rows.append((i, f"http://{host}{path(7)}{rng.choice(['', '?a=/b', '#x', '?q#f'])}"))
    rows += [(1, None), (2, ""), (2, ""), (3, "a.com/b"), (4, "http://"), (5, "x://a.com"), (None, "http://a.com/a"),
             (6, "http://a.com?/a"), (7, "http://" + "a." * 20_000 + "com/" + "a" * 50_000), (8, "http://é.com/ü"),
             (9, "a://b://c/d"), (10, "http://a.com/a\nb")]
    check(spark, rows, rules)
    check(spark, rows, [("com", "/", "block")])


def test_empty_tables_and_names(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    none = spark.createDataFrame([], RULES)
    (row,) = urls.judge(pages, none, default="block").collect()
    assert (row["rule"], row["verdict"]) == (None, "block")
    some = spark.createDataFrame([("com", "/", "block")], RULES)
    assert urls.judge(pages.limit(0), some).collect() == []
    clash = spark.createDataFrame([(1, "http://a.com/", "h", "r")], "page_id bigint, url string, host string, rule string")
    with pytest.raises(ValueError):
        urls.judge(clash, some)
    (row,) = urls.judge(clash, some, prefix="url_").collect()
    assert (row["host"], row["rule"], row["url_rule"], row["url_verdict"]) == ("h", "r", "com/", "block")
