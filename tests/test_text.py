from __future__ import annotations

import os
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tagpulse.functions import times
from tagpulse.functions.sql import register_functions
from tagpulse.functions.text import strip_html

PAGES = "/root/testdata/sf0.01/pages.parquet"


def stripped(spark, values, restrip=True):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, html string")
    result = rows.select("i", F.expr(strip_html("html", restrip)).alias("text")).collect()
    return [row.text for row in sorted(result)]


GOLDENS = {
    None: "",
    "": "",
    "<p>a</p><p>b</p>": "a b",
    "<b>foo</b>bar": "foo bar",
    "<pre>List&lt;String&gt; x</pre>": "List x",
    '<script>var t="</p>";</script>x': "x",
    "a < b <i>x</i>": "a < b x",
    # a quoted attribute value may hold the tag's end
    '<a title="a>b" href=x>q</a>z': "q z",
    "<a title='x > y'>q</a>": "q",
    # what a comment, script, style or template holds is no text, closed or not
    "x<!-- <p> -->y<!-- open": "x y",
    "<STYLE type='a'>p{}</STYLE >t<template><b>no</b></template>u": "t u",
    "a<script>b": "a",
    "<scripted>x</scripted>": "x",
    "<!DOCTYPE html><?php echo ?>x": "x",
    # any number of quoted attributes; a quote or a tag that is never closed
    "<a " + " ".join(f'a{i}="{i}"' for i in range(70)) + ' t="p>q">z</a>': "z",
    "<a " + "b='>' " * 3000 + ">z": "z",
    "<a t='x>y": "y",
    "<a x='1' t=\"x>y <b>z</b>": "y z",
    # templates nest, and hold scripts and comments
    "<template>a<template>b</template>c</template>d": "d",
    "<template x='>'>a<!-- </template> -->b<script></template></script></template>c": "c",
    "a</template>b<template>c": "a b",
    "<TEMPLATE>a</Template >b<templates>c</templates>": "b c",
    # leading zeros do not make a number larger
    "&#0000000000065; &#x00000000000000041; &#00000000000000; &#99999999999; &#xFFFFFFFFFFFF;": "A A � � �",
    # references are decoded once
    "&amp;lt;b&amp;gt;": "&lt;b&gt;",
    "&copy; &copy=2 &hellip; &NotEqualTilde;": "© ©=2 … ≂̸",
    "&#8364; &#x20AC; &#150; &#0; &#1114112; &#x110000;": "€ € – � � �",
    "&foo; &bar &amp": "&foo &bar &",
    "a && b & c": "a && b & c",
    "&apos;&quot;&bsol;": "'\"\\",
    # blanks of all kinds
    "a&nbsp;  \tb\r\n c　": "a b c",
}


def test_goldens(spark):
    assert stripped(spark, list(GOLDENS)) == list(GOLDENS.values())


def test_blanks_are_those_of_unicode(spark):
    blanks = [chr(code) for code in range(0x10000) if re.match(r"\s", chr(code))]
    others = [chr(code) for code in (0x0B7, 0x180E, 0x200B, 0x2060, 0xFEFF)]
    assert stripped(spark, [f"a{blank}{blank}b" for blank in blanks]) == ["a b"] * len(blanks)
    assert stripped(spark, [f"a{other}b" for other in others]) == [f"a{other}b" for other in others]


def test_keeping_quoted_code(spark):
    assert stripped(spark, ["<pre>List&lt;String&gt; x</pre>"], restrip=False) == ["List<String> x"]


class InnerText(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "template")

    def handle_endtag(self, tag):
        self.hidden -= self.hidden > 0 and tag in ("script", "style", "template")

    def handle_data(self, data):
        if not self.hidden:
            self.pieces.append(data.strip())


def inner_text(html):
    parser = InnerText()
    parser.feed(html)
    parser.close()
    text = re.sub(r"<[^>]+>", "", " ".join(piece for piece in parser.pieces if piece))
    return re.sub(r"\s+", " ", text).strip()


@pytest.mark.skipif(not os.path.exists(PAGES), reason="tables not present")
def test_agrees_with_a_parser_on_whole_pages(spark):
    rows = spark.read.parquet(PAGES).select("html", F.expr(strip_html("html")).alias("text")).collect()
    assert len(rows) == 250
    assert [row.text for row in rows] == [inner_text(row.html) for row in rows]


def test_long_and_hostile_texts_end(spark):
    many_attributes = "<p " + " ".join(f'a{i}="x>y"' for i in range(60)) + ">in</p>"
    unclosed = "<a " * 3000 + "x"
    quotes = "<p title=\"" + "word " * 20000
    ands = "&" * 20000
    result = stripped(spark, [many_attributes, unclosed, quotes, ands, "<b>" * 30000 + "x"])
    assert result[0] == "in" and result[3] == ands and result[4] == "x"


def test_event_time_survives_the_hour_that_comes_twice(spark, zone):
    zone("America/New_York")
    row = spark.range(1).select(F.unix_seconds(F.expr(times.event_time("1730615400L"))).alias("s")).first()
    assert row.s == 1730615400


def test_event_time_out_of_range_is_null(spark):
    rows = spark.createDataFrame([(None,), (0,), (2**62,), (-(2**62),)], "s long")
    result = [row.t for row in rows.select(F.expr(times.event_time("s")).alias("t")).collect()]
    assert [value is None for value in result] == [True, False, True, True]


def test_readable(spark):
    numbers = spark.createDataFrame([(0,), (None,), (1730615400,), (2**60,)], "s long")
    assert [row.t for row in numbers.select(F.expr(times.readable("s")).alias("t")).collect()] == [
        "1970-01-01 00:00:00", "", "2024-11-03 06:30:00", str(2**60),
    ]
    texts = spark.createDataFrame([("0",), (None,), ("soon",), ("1730615400",)], "s string")
    assert [row.t for row in texts.select(F.expr(times.readable_text("s")).alias("t")).collect()] == [
        "1970-01-01 00:00:00", "", "soon", "2024-11-03 06:30:00",
    ]


def test_sql_functions_run_no_python(spark):
    register_functions(spark)
    frame = spark.sql(
        "SELECT strip_html_completely('<p>a &amp; b</p>') AS body, format_timestamp(0L) AS created, "
        "format_timestamp('x') AS other, is_unanswered(NULL) AS unanswered, has_accepted_answer(NULL) AS accepted, "
        "avg_answer_score(array(named_struct('answer_id', id, 'body', 'b', 'score', 3, 'is_accepted', true, "
        "'owner_reputation', 1))) AS mean FROM range(1)"
    )
    assert tuple(frame.first()) == ("a & b", "1970-01-01 00:00:00", "x", True, False, 3.0)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
