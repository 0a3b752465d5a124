"""Scalar functions against stated results and the standard library."""

import base64
import html
import quopri
import random
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from mailweir.functions import encoding, text
from mailweir.functions.dates import with_mail_date
from mailweir.functions.html import html_text, html_unescape, is_html, tidy_chunks


def apply(spark, values, function, kind="string"):
    """``function`` over a column of values, in order, as one job."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    done = rows.select("i", function(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(done, key=lambda r: r["i"])]


DATES = [
    ("Thu, 14 Nov 2024 10:00:00 -0500", "2024-11-14 15:00:00", -300, "2024-11-14T10:00:00-05:00"),
    ("Mon, 4 Nov 2024 10:00:00 +0000 (UTC)", "2024-11-04 10:00:00", 0, "2024-11-04T10:00:00+00:00"),
    ("Mon, 04 Nov 2024 10:00:00 GMT", "2024-11-04 10:00:00", 0, "2024-11-04T10:00:00+00:00"),
    ("Mon, 04 Nov 2024 10:00:00 EDT", "2024-11-04 14:00:00", -240, "2024-11-04T10:00:00-04:00"),
    ("Mon, 04 Nov 2024 10:00:00 XYZ (PST)", "2024-11-04 18:00:00", -480, "2024-11-04T10:00:00-08:00"),
    ("Mon, 04 Nov 2024 10:00:00 0530", "2024-11-04 04:30:00", 330, "2024-11-04T10:00:00+05:30"),
    ("mon, 4 nov 2024 1:2:3 +05:30", "2024-11-03 19:32:03", 330, "2024-11-04T01:02:03+05:30"),
    ("Mon, 4 Nov 2024 10:00:00 +1900", "2024-11-03 15:00:00", 1140, "2024-11-04T10:00:00+19:00"),
    ("Mon, 4 Nov 2024 10:00:00 Z", "2024-11-04 10:00:00", 0, "2024-11-04T10:00:00+00:00"),
    # The weekday has to be one, but need not be the right one.
    ("Sun, 4 Nov 2024 10:00:00 GMT", "2024-11-04 10:00:00", 0, "2024-11-04T10:00:00+00:00"),
    # Minutes above 59 are only read by the loose form; what follows it is ignored.
    ("Mon, 4 Nov 2024 10:00:00 +0575", "2024-11-04 03:45:00", 375, "2024-11-04T10:00:00+06:15"),
    ("Mon, 4 Nov 2024 10:00:00 +0530abc", "2024-11-04 04:30:00", 330, "2024-11-04T10:00:00+05:30"),
    ("Mon, 4 Nov 2024 10:00:00 +053010", "2024-11-04 04:29:50", 330, "2024-11-04T10:00:00+05:30:10"),
    ("Mon, 4 Nov 2024 10:00:00 -0000 ", "2024-11-04 10:00:00", 0, "2024-11-04T10:00:00+00:00"),
    ("Mon, 4 Nov 2024 10:00:00 +2500 (PST)", "2024-11-04 18:00:00", -480, "2024-11-04T10:00:00-08:00"),
    ("Mon, 4 Nov 2024 10:00:00 +0200 (PST)", "2024-11-04 08:00:00", 120, "2024-11-04T10:00:00+02:00"),
    ("Mon, 4 Nov 2024 23:30:00 -0500", "2024-11-05 04:30:00", -300, "2024-11-04T23:30:00-05:00"),
    ("Mon,  4 Nov 2024\r\n 10:00:00 GMT", "2024-11-04 10:00:00", 0, "2024-11-04T10:00:00+00:00"),
    ("Thu, 29 Feb 2024 00:00:00 GMT", "2024-02-29 00:00:00", 0, "2024-02-29T00:00:00+00:00"),
    *[
        (unreadable, None, None, None)
        for unreadable in (
            None, "", "(PST)", "Mon, 04 Nov 2024 10:00:00 MST", "Mon, 04 Nov 2024 10:00:00",
            "04 Nov 2024 10:00:00 GMT", "Xyz, 04 Nov 2024 10:00:00 GMT",
            "Sat, 31 Feb 2024 10:00:00 GMT", "Mon, 4 Nov 2024 10:00:60 GMT",
            "Mon, 4 Nov 2024 10:00:00 gmt", "Mon, 4 Nov 2024 10:00:00 +2500",
            "Mon, 4 Nov 0000 10:00:00 GMT", "Mon, 4 Nov 24 10:00:00 GMT",
            "Mon, 4 Nov 2024 24:00:00 GMT", " Mon, 4 Nov 2024 10:00:00 GMT", "Mon, 32 Jan 2024 1:1:1 GMT",
        )
    ],
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_mail_dates(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(i, d[0]) for i, d in enumerate(DATES)], "i int, date string")
        shown = with_mail_date(rows).select(
            "i", F.unix_seconds("parsed_ts").alias("s"), "tz_offset_min", "parsed_iso"
        )
        got = {r["i"]: r for r in shown.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    import calendar
    import time

    for i, (header, ts, offset, iso) in enumerate(DATES):
        seconds = calendar.timegm(time.strptime(ts, "%Y-%m-%d %H:%M:%S")) if ts else None
        assert (got[i]["s"], got[i]["tz_offset_min"], got[i]["parsed_iso"]) == (seconds, offset, iso), header


def test_a_filter_on_the_date_does_not_repeat_the_parsing(spark):
    rows = spark.createDataFrame([(d[0],) for d in DATES], "date string")
    late = with_mail_date(rows).filter("parsed_ts IS NULL OR parsed_ts >= '2024-11-05'")
    assert late.count() == 2 + sum(d[1] is None for d in DATES)
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Thu|Fri") <= 2


def test_unescape_equals_standard_library(spark):
    rng = random.Random(7)
    names = sorted(html5)
    codes = [0, 9, 10, 11, 13, 31, 65, 127, 128, 129, 150, 0x9F, 0xA0, 8364, 0xD800, 0xFDD0,
             0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10**12, 10**30]
    odd = ["&", "&&", "&;", "&#;", "&#x;", "&amp;lt;", "&ampx;", "&notit;", "&notin;", "&#X41;",
           "&#0065;", "&" + "a" * 40 + ";", "&€uro;", "x;", "é😀", "\n", "&amp", "&amp;amp;"]

    def token():
        kind = rng.random()
        if kind < 0.3:
            return "&" + rng.choice(names)
        if kind < 0.45:
            return "&" + rng.choice(names).rstrip(";") + rng.choice(["x", "1", " ", "", "=", ";"])
        if kind < 0.6:
            return f"&#{rng.choice(codes)};"
        if kind < 0.75:
            return f"&#x{rng.choice(codes):x}" + rng.choice([";", "", " ", "g"])
        return rng.choice(odd)

    cases = ["".join(token() for _ in range(rng.randint(1, 8))) for _ in range(1500)]
    cases += ["&" + n for n in names]
    assert apply(spark, cases, html_unescape) == [html.unescape(c) for c in cases]


def test_base64(spark):
    raw = ["", "a", "ab", "abc", "é😀", "x" * 100, "??>>~~"]
    encoded = [base64.urlsafe_b64encode(r.encode()).decode() for r in raw]
    decode = lambda c: encoding.utf8_replace(encoding.b64_decode(c))
    assert apply(spark, encoded, decode) == raw
    assert apply(spark, [e.rstrip("=") for e in encoded], decode) == raw
    cases = {
        "QUJD\r\nREVG": "ABCDEF", "QUJDR": "", "Q": "", "QQ==QUJD": "A", "QUI=QUJD": "AB",
        "QUJD====": "ABC", "=QUJD": "ABC", "QU!JD": "ABC", "é": "", "/w==": "�", None: "",
        "QcNC": "A�B",
    }
    assert apply(spark, list(cases), decode) == list(cases.values())


def test_quoted_printable_equals_standard_library(spark):
    cases = ["a=3Db", "a=\r\nb", "a=\nb", "x=", "=C3=A9", "100% + 1", "=3D3D", "a  \nb", "a =\nb",
             "=zz=4", "é=E9", "a= \nb", "=3d", "end  ", "a==41", "===41", "=\rxx\nb", "%41+%2B"]
    want = [quopri.decodestring(c.encode()).decode("utf-8", "replace") for c in cases]
    assert apply(spark, cases, encoding.quoted_printable) == want


def test_transfer_encodings(spark):
    rows = spark.createDataFrame(
        [("QUJD", "base64"), ("a=3D", "quoted-printable"), ("a=3D", "7bit"), ("a=3D", None),
         ("a=3D", "x-unknown"), ("", "base64"), (None, None)], "d string, e string",
    )
    got = rows.select(encoding.transfer_decode(F.col("d"), F.col("e")).alias("r")).collect()
    assert [r["r"] for r in got] == ["ABC", "a=", "a=3D", "a=3D", "a=3D", "", ""]


URLS = [
    ("see https://a.example/x, and (http://b.example/y).", ["https://a.example/x", "http://b.example/y"]),
    ("http://a.example/x#frag http://a.example/~me", ["http://a.example/x", "http://a.example/"]),
    ("HTTP://a.example ftp://a.example", []),
    ("http://a.example http://a.example", ["http://a.example"] * 2),
    ("http://a.example/%20b?q=1&r=2;<b>", ["http://a.example/%20b?q=1&r=2;<b>"]),
    ("http://a.example/é", ["http://a.example/"]),
    ("http://a.example/wow!?...", ["http://a.example/wow"]),
    ('<a href="http://a.example">', ["http://a.example"]),
    ("", []), (None, None),
]


def test_urls(spark):
    got = apply(spark, [u[0] for u in URLS], text.extract_urls)
    assert [None if g is None else list(g) for g in got] == [u[1] for u in URLS]


CLEAN = [
    ("  a \t b\n\nc  ", "a b c"),
    ("see https://a.example/x, ok", "see , ok"),
    # The shorter link is removed inside the longer one first and leaves its tail.
    ("http://a.example http://a.example/more", "/more"),
    ("x&amp;lt;y", "x&lt;y"), ("caf&eacute;", "café"),
    ("a‌b﻿c", "abc"), ("a  b\x1cc", "a b c"),
    ("[link]x[/link] (link)y(/link) [Link]", "x y [Link]"),
    ("rehttped word", "re word"), ("http", ""), ("", ""), (None, ""),
    ("&#104;ttp://late.example gone", "gone"),
]


def test_clean_text(spark):
    assert apply(spark, [c[0] for c in CLEAN], text.clean_text) == [c[1] for c in CLEAN]


def test_body_is_counted_in_code_points(spark):
    body = apply(spark, ["😀 http://a.example é", "", None], text.structure_body)
    assert [tuple(b) for b in body] == [("😀 é", ["http://a.example"], 3), ("", [], 0), ("", [], 0)]


def test_html_text(spark):
    cases = {
        "<p>Hel<b>lo</b></p>": "Hel lo",
        "a<!-- x <script> -->b<script>var t='</p>';</script>c": "a b c",
        "<style>p{}</style>x": "x",
        "<STYLE type='a'>p{}</STYLE >x": "x",
        "<script src='a'/>kept": "kept",
        "<script>never closed": "",
        "<!-- never closed": "",
        "<!DOCTYPE html><p>x": "x",
        "a < b and c > d": "a < b and c > d",
        "<a title='1 > 0' href=x>t</a>": "t",
        "<a title=\"it's\">t</a>": "t",
        "one  two\n three\tfour": "one two three\tfour",
        "&lt;b&gt; &amp;amp; &nbsp;x": "<b> &amp;  x",
        "mail <me@x.example> now": "mail now",
        "<p>\n</p>  <p> </p>": "",
    }
    assert apply(spark, list(cases), html_text) == list(cases.values())


def test_long_inputs_do_not_exhaust_the_stack(spark):
    long_tag = "<a " + " ".join(f'k{i}="{"v" * 50}"' for i in range(4000)) + ">t</a>"
    long_url = "http://a.example/" + "x" * 200_000
    blanks = "a" + "\t" * 200_000 + "b"
    assert apply(spark, [long_tag], html_text) == ["t"]
    assert apply(spark, [long_url], text.extract_urls) == [[long_url]]
    assert apply(spark, [blanks], tidy_chunks) == [blanks]
    assert apply(spark, ["x=" * 100_000], encoding.quoted_printable)[0].startswith("x=x")


def test_is_html(spark):
    assert apply(spark, ["<b>", "a < b > c", "1 < 2", "", "<>", None], is_html) == [
        True, True, False, False, False, None,
    ]


def test_keywords(spark):
    cases = {
        "The Cat and the DOG, by_the way": ["cat", "dog", "by_the", "way"],
        "ab abc": ["abc"], "Été à Köln 2024!": ["été", "köln", "2024"], "日本語 と": ["日本語"],
        "": [], "with of at": [],
    }
    assert [list(r) for r in apply(spark, list(cases), text.keywords)] == list(cases.values())


def test_small_helpers(spark):
    assert apply(spark, [None, [], ["a"]], text.size_or_zero, "array<string>") == [0, 0, 1]
    assert apply(spark, [None, "x"], lambda c: text.nullish_default(c, "No")) == ["No", "x"]
    assert apply(spark, ["é😀", None], text.code_points) == [2, None]
