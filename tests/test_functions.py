import datetime as dt
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions import urls as U

P = "/documentation/product"
B = f"https://docs.example.com{P}"
SPACE = "\t\n\x0b\x0c\r                  　﻿"


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_versions(spark):
    urls = [f"{B}/152/renderer-proxy-logic", f"{B}/133/renderer-proxy-logic", f"{B}/renderer-proxy-logic", f"{B}/152", f"{B}/152/133/x", "x", None]
    assert column(spark, urls, lambda u: U.extract_version(u, P)) == ["152", "133", None, None, "152", None, None]
    plain = f"{B}/renderer-proxy-logic"
    assert column(spark, urls, lambda u: U.canonical_url(u, P)) == [plain, plain, plain, f"{B}/152", f"{B}/133/x", "x", None]


def test_filenames(spark):
    cases = {B: "index", f"{B}/": "index", f"{B}/index": "index", f"{B}/a/b.c/?q=1#h": "a_b_c", f"{B}/a__b/_c_": "a_b_c", f"{B}-foo/x": "-foo_x", f"{B}/caf%C3%A9/": "caf_C3_A9", f"{B}/café/": "caf_C3_A9", f"{B}/152": "152", f"{B}/A b": "A_20b", "https://other.example.com/x.html": "x_html"}
    assert column(spark, list(cases), lambda u: U.url_to_filename(u, P)) == [v + ".json" for v in cases.values()]
    assert column(spark, ["no url", None], lambda u: U.url_to_filename(u, P)) == [None, None]
    assert column(spark, [f"{B}/a"], lambda u: U.redirect_filename(u, P)) == ["a.redirect.json"]


def test_links(spark):
    html = f'<a href="{B}/x?q#h">1</a><A data-href="/no" class=c href=\'{P}/y\'>2</A><abbr href="{P}/z">3</abbr><a href={P}/unquoted>4</a><a href="{P}/y#again">5</a><a href="/other">6</a><a href="http://docs.example.com{P}/h">7</a><a data-x="1" href="{P}-foo">8</a>'
    got = column(spark, [html], lambda h: U.extract_links(h, F.lit(f"{B}/page"), B, P))[0]
    assert got == [f"{B}/x", f"{B}/y", f"{B}/z", f"{B}-foo"]


def test_hrefs(spark):
    base = "https://h.example/a/b?x#y"
    cases = {"c": "https://h.example/a/c", "/c": "https://h.example/c", "//o/c": "https://o/c", "#z": "https://h.example/a/b?x#z", "?q": "https://h.example/a/b?q", "http://o": "http://o", "HTTP://o": "http://o/", "mailto:x": "mailto:x"}
    assert column(spark, list(cases), lambda h: U.resolve_href(h, F.lit(base))) == list(cases.values())
    assert column(spark, ["/c"], lambda h: U.resolve_href(h, F.lit("no base"))) == [None]


def normal(text):
    lines = "\n".join(x.rstrip(SPACE) for x in text.split("\n"))
    while "\n\n\n" in lines:
        lines = lines.replace("\n\n\n", "\n\n")
    return lines.strip(SPACE)


VECTORS = [
    ("Line 1\n\n\nLine 2\n\n\n\n\nLine 3", "Line 1\n\nLine 2\n\nLine 3"),
    ("Line 1   \nLine 2\t\t\nLine 3     ", "Line 1\nLine 2\nLine 3"),
    ("\n\n  Line 1\n  Line 2\n\n", "Line 1\n  Line 2"),
    ("# Heading\n\n  - Indented item\n    - More indented", "# Heading\n\n  - Indented item\n    - More indented"),
    ("\n\nTitle\n\n\nParagraph 1\n\n\n\nParagraph 2\n\n\n\nEnd\n\n", "Title\n\nParagraph 1\n\nParagraph 2\n\nEnd"),
    ("Text\n\n```js\na;\n\n\n\nb;\n```", "Text\n\n```js\na;\n\nb;\n```"),
]


def test_whitespace_vectors(spark):
    assert column(spark, [a for a, _ in VECTORS], T.normalize_whitespace) == [b for _, b in VECTORS]
    assert column(spark, [None, "", "﻿ ​\r\n"], T.normalize_whitespace) == [None, "", "​"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from(list("ab\n\n\n" + SPACE + "​\u0085")), max_size=25), min_size=40, max_size=80))
def test_whitespace_random(spark, texts):
    once = column(spark, texts, T.normalize_whitespace)
    assert once == [normal(t) for t in texts] and column(spark, once, T.normalize_whitespace) == once


def test_frontmatter(spark):
    df = spark.createDataFrame([("T", "H", "u", ["Home", "X"]), ("T", "", "u", []), ("T", None, "u", None)], "t string, h string, u string, b array<string>")
    got = [r[0] for r in df.select(T.content_to_markdown(F.col("t"), F.col("h"), F.col("u"), F.col("b"), F.lit("\n body \n"))).collect()]
    assert got == ["# H\n**URL:** u\n**Breadcrumb:** Home > X\n---\nbody", "# T\n**URL:** u\n---\nbody", "# T\n**URL:** u\n---\nbody"]


@pytest.mark.parametrize("seconds,page,redirect", [(60, [True, False, True, False, False], [True, False, True, False, True]), (0, [False] * 5, [True] * 5), (-5, [False, False, True, False, False], [True] * 5)])
def test_freshness(spark, seconds, page, redirect):
    now = dt.datetime(2024, 1, 1)
    times = [now - dt.timedelta(seconds=60) + dt.timedelta(milliseconds=1), now - dt.timedelta(seconds=60), now + dt.timedelta(days=1), dt.datetime(1970, 1, 1), None]
    df = spark.createDataFrame(list(enumerate(times)), "i int, t timestamp").orderBy("i")
    got = df.select(T.page_is_fresh(F.col("t"), F.lit(now), seconds), T.redirect_is_fresh(F.col("t"), F.lit(now), seconds)).collect()
    assert [r[0] for r in got] == page and [r[1] for r in got] == redirect


def test_sizes(spark):
    assert column(spark, ["a🙂é"], T.utf16_length) == [4] and column(spark, ["a\n\n\nb"], T.preview) == ["a\nb"]
    df = spark.range(1).select(T.iso_time(F.lit(dt.datetime(2024, 1, 2, 3, 4, 5, 6000)).cast("timestamp")))
    assert df.first()[0] == "2024-01-02T03:04:05.006Z"


def test_megabytes_of_a_length(spark):
    units = [0, 300 * 9, 9_830_400, 98_304 * 300, 3_000 * (1 << 20)]
    got = spark.createDataFrame([(n,) for n in units], "n long").select(T.megabytes(F.col("n"))).collect()
    assert [r[0] for r in got] == ["0.00", "0.00", "9.38", "28.12", "3000.00"]


def test_long_runs_of_space_cost_their_length_once(spark):
    long = "a" + " " * 1_000_000 + "b" + "\t" * 1_000_000
    began = time.monotonic()
    got = column(spark, [long, " " * 1_000_000, long + "\n"], T.normalize_whitespace)
    assert got == ["a" + " " * 1_000_000 + "b", "", "a" + " " * 1_000_000 + "b"] and time.monotonic() - began < 20


def test_dot_segments(spark):
    base = "https://h.example/a/b/c?q#f"
    cases = {"../x": "/a/x", "./x": "/a/b/x", "../../../x": "/x", "..": "/a/", ".": "/a/b/", "/p/./q/../r": "/p/r", "/p/..": "/", "x/%2e%2E/y": "/a/b/y", "x.y/..z": "/a/b/x.y/..z", "/a//b/../c": "/a//c", "x?../y": "/a/b/x?../y", "": "/a/b/c?q"}
    assert column(spark, list(cases), lambda h: U.resolve_href(h, F.lit(base))) == ["https://h.example" + v for v in cases.values()]
    assert column(spark, ["x", "../x", "/"], lambda h: U.resolve_href(h, F.lit("https://h.example"))) == ["https://h.example/x", "https://h.example/x", "https://h.example/"]
