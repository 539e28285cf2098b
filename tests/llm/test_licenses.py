from __future__ import annotations

import pytest
from oracle_check import connect, differences

from tagpulse.llm import licenses, queries


def test_query_against_sql(spark):
    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        ours = queries.QUERIES["op10_license_scan"](spark, sf_dir)
        assert differences(ours, connect(sf_dir), queries.ORACLE["op10_license_scan"]) is None


def ids(spark, rows, known=licenses.KNOWN):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, digest int")
    names = spark.createDataFrame(list(known), "license_id string, text string")
    return sorted(
        ((r["doc_id"], ",".join(r["license_ids"]), ",".join(r["notice_ids"])) for r in licenses.scan(docs, names).collect()),
        key=str,
    )


def test_equivalent_texts(spark):
    mit = dict(licenses.KNOWN)["ISC"]
    varied = "Copyright (c) 2020, Some Body\n(C) 2021 Other\n\n" + mit.upper().replace(",", " ;").replace(" ", "\n ")
    rows = [
        (1, mit, "a", 1), (2, varied, "b", 2), (3, mit + " And more.", "c", 3), (4, None, "d", 4), (5, "", "e", 5),
        (6, "Copyright 1999 Me\n!!!", "f", 6), (7, "Some prose.\nreleased under the mit licence\nmore", "g", 7),
        (7, "x", "g", 7), (None, "Licensed under CC BY 4.0", "h", 8), (8, "word " * 100_000, "i", 9),
        (9, f"Intro.\n \n{mit}\n\nEnd.", "j", 1), (10, "Licensed under CC BY 4.0", "k", 1), (10, "Licensed under CC BY 4.0", "k", 1),
    ]
    assert ids(spark, rows) == sorted(
        [
            (1, "ISC", "ISC"), (2, "ISC", ""), (3, "", ""), (4, "", ""), (5, "", ""), (6, "", ""), (7, "", "MIT"),
            (7, "", "MIT"), (None, "CC-BY-4.0", "CC-BY-4.0"), (8, "", ""), (9, "", "ISC"),
            (10, "CC-BY-4.0", "CC-BY-4.0"), (10, "CC-BY-4.0", "CC-BY-4.0"),
        ],
        key=str,
    )


def test_odd_known_texts_and_empty_tables(spark, documents):
    known = [("A", "one two"), ("B", "One, two!"), ("A", "one two"), (None, "three"), ("C", None), ("D", "Copyright 2")]
    rows = [(1, "one-two", "", 0), (2, "three", "", 0), (3, "", "", 0), (4, "Copyright 2", "", 0)]
    assert ids(spark, rows, known) == [(1, "A,B", "A,B"), (2, "", ""), (3, "", ""), (4, "", "")]
    assert ids(spark, rows, []) == [(i, "", "") for i in (1, 2, 3, 4)]
    assert queries.QUERIES["op10_license_scan"](spark, documents([])).collect() == []


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "Licensed under CC BY 4.0.", ["own"], "id")], "doc_id int, text string, notice_ids array<string>, ids string")
    with pytest.raises(ValueError):
        licenses.scan(docs, licenses.known(spark))
    (row,) = licenses.scan(docs, licenses.known(spark), prefix="found_").collect()
    assert (row["notice_ids"], row["ids"], row["found_notice_ids"]) == (["own"], "id", ["CC-BY-4.0"])
