import pytest
from pyspark.sql import functions as F

from corpusmill.functions.weburl import hrefs_of, parsed, url_href

#: text, base, and what a browser makes of them, worked out from the URL standard.
CASES = [
    ('e f', 'http://h.example/d/x', 'http://h.example/d/e%20f'),
    ('\\a', 'http://h.example/d/x', 'http://h.example/a'),
    ('a\tb\nc', 'http://h.example/d/x', 'http://h.example/d/abc'),
    ('HTTP://Ex.COM', 'http://h.example/d/x', 'http://ex.com/'),
    ('HTTP:x', 'http://h.example/d/y', 'http://h.example/d/x'),
    ('http:/x', 'http://h.example/d/y', 'http://h.example/x'),
    ('http:x', 'https://h.example/d/y', 'http://x/'),
    ('https:///x//y', 'http://h.example/d/y', 'https://x//y'),
    ('http://a:80/', 'http://b', 'http://a/'),
    ('https://a:443', 'http://b', 'https://a/'),
    ('https://a:0444/', 'http://b', 'https://a:444/'),
    ('http://a:65536/', 'http://b', None),
    ('http://a:/', 'http://b', 'http://a/'),
    ('//x/p?q', 'https://h.example/d', 'https://x/p?q'),
    ('\\\\x\\p', 'https://h.example/d', 'https://x/p'),
    ('', 'https://h/a/b?q#f', 'https://h/a/b?q'),
    ('?', 'https://h/a/b?q#f', 'https://h/a/b?'),
    ("?x y'", 'https://h/a/b?q#f', 'https://h/a/b?x%20y%27'),
    ('#x `', 'https://h/a/b?q#f', 'https://h/a/b?q#x%20%60'),
    ('../../../z', 'https://user@h.example:8080/a/b/c?q#f', 'https://user@h.example:8080/z'),
    ('mailto:x@y z', 'http://h', 'mailto:x@y z'),
    ("javascript:a(' b')", 'http://h', "javascript:a(' b')"),
    ('http://0x7f.1/', 'http://h', 'http://127.0.0.1/'),
    ('http://192.168.257/', 'http://h', 'http://192.168.1.1/'),
    ('http://017700000001', 'http://h', 'http://127.0.0.1/'),
    ('http://4294967296', 'http://h', None),
    ('http://256.1.1.1', 'http://h', None),
    ('http://1.2.3.4.5', 'http://h', None),
    ('http://1.2.3.4.', 'http://h', 'http://1.2.3.4/'),
    ('http://09.1/', 'http://h', None),
    ('http://[::1]/', 'http://h', 'http://[::1]/'),
    ('http://[1:0:0:2:0:0:0:3]:80/x', 'http://h', 'http://[1:0:0:2::3]/x'),
    ('http://[2001:DB8::0:1]', 'http://h', 'http://[2001:db8::1]/'),
    ('http://[::FFFF:1.2.3.4]', 'http://h', 'http://[::ffff:102:304]/'),
    ('http://[1::2::3]', 'http://h', None),
    ('http://[1:2]', 'http://h', None),
    ('http://[::1', 'http://h', None),
    ('http://ex%41mple.com/%41', 'http://h', 'http://example.com/%41'),
    ('http://a b/', 'http://h', None),
    ('http://a%zz/', 'http://h', None),
    ('http://bücher.example/ü?ü#ü', 'http://h', 'http://xn--bcher-kva.example/%C3%BC?%C3%BC#%C3%BC'),
    ('http://EXAMPLE.com/😀', 'http://h', 'http://example.com/%F0%9F%98%80'),
    ('http://u:p:q@a@b/', 'http://h', 'http://u:p%3Aq%40a@b/'),
    ('http://@a/', 'http://h', 'http://a/'),
    ('http://u@/', 'http://h', None),
    ('http://', 'http://h', None),
    ('http:///', 'https://h', None),
    ('  http://x/  ', 'http://h', 'http://x/'),
    ('x:y', 'http://h', 'x:y'),
    ('x:/a/../b', 'http://h', 'x:/b'),
    ('x://H/a b', 'http://h', 'x://H/a%20b'),
    ('x:/..//p', 'http://h', 'x:/.//p'),
    ('x://', 'http://h', 'x://'),
    ('x://a:99/', 'http://h', 'x://a:99/'),
    ('y', 'x:opaque', None),
    ('#y', 'x:opaque', 'x:opaque#y'),
    ('y', 'x://h', 'x://h/y'),
    ('a{b}^|`"<>\'', 'http://h/', "http://h/a%7Bb%7D%5E|%60%22%3C%3E'"),
    ('file:///a/../b', 'http://h', 'file:///b'),
    ('file:x', 'http://h', 'file:///x'),
    ('file://localhost/x', 'http://h', 'file:///x'),
    ('//x/y', 'file:///a', 'file://x/y'),
    ('z', 'file:///a/b', 'file:///a/z'),
    ('a/.', 'http://h/', 'http://h/a/'),
    ('a/%2E%2e/b', 'http://h/', 'http://h/b'),
    ('/a//../b', 'http://h/', 'http://h/a/b'),
    ('/p', 'not a base', None),
    ('http://x.example/p', 'not a base', 'http://x.example/p'),
    (None, 'http://h', None),
    ('x', None, None),
    ('/simple/path.html', 'https://docs.example.com/a?b', 'https://docs.example.com/simple/path.html'),
    ('/a/..b', 'https://docs.example.com', 'https://docs.example.com/a/..b'),
    ('http://a/b?c?d#e#f', 'http://h', 'http://a/b?c?d#e#f'),
    ('1x:y', 'http://h/d/', 'http://h/d/1x:y'),
    ('ws://a:80', 'http://h', 'ws://a/'),
    ('ftp://a:21/x', 'http://h', 'ftp://a/x'),
    ('http://a.0x/', 'http://h', None),
    ('http://0x', 'http://h', 'http://0.0.0.0/'),
    ('http://x.example:80', 'http://h', 'http://x.example/'),
    ('http://a;b/', 'http://h', 'http://a;b/'),
]


def test_against_a_base(spark):
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(CASES)], "k int, t string, b string, w string")
    got = df.select("t", "b", "w", url_href(F.col("t"), F.col("b")).alias("g")).collect()
    assert [(r.t, r.b, r.g) for r in got if r.g != r.w] == []


def test_normal_form_is_stable_and_needs_no_base(spark):
    """What a URL was made is read as itself, alone and against any base."""
    df = spark.createDataFrame([(w,) for *_, w in CASES if w], "w string")
    base = F.lit("http://other.example/q")
    assert df.select("w", url_href(F.col("w")).alias("g")).where("not g <=> w").collect() == []
    assert df.select("w", url_href(F.col("w"), base).alias("g")).where("not g <=> w").collect() == []


def test_many_texts_of_one_base(spark):
    texts = ["x", "/y", None, "http://z.example", "http://a.example/b", "#f"]
    df = spark.createDataFrame([(texts, "https://h.example/d/?q"), (["/only", "/plain/"], "https://h.example"), (["x", "http://z.example/"], "none"), (["x"], None), ([], "https://h"), (None, "https://h")], "t array<string>, b string")
    assert [r[0] for r in df.select(hrefs_of(F.col("t"), F.col("b"))).collect()] == [
        ["https://h.example/d/x", "https://h.example/y", None, "http://z.example/", "http://a.example/b", "https://h.example/d/?q#f"], ["https://h.example/only", "https://h.example/plain/"], [None, "http://z.example/"], [None], [], None,
    ]


@pytest.mark.parametrize("text,want", [("HTTPS://u@H:443/a/./b?c#d", ("https", "u@h", "/a/b", "c", "d", False)), ("x:y?", ("x", None, "y", "", None, True)), ("/a", None), ("", None)])
def test_parts(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(parsed(F.col("t")).alias("p")).first().p
    assert (got and tuple(got)) == want


def test_long_and_odd_texts(spark):
    texts = ["a" * 100_000, "../" * 5000 + "x", "é" * 20_000, "\ud83d\ude00 " * 1000, "?" * 1000, "http://" + "a." * 200 + "com/"]
    df = spark.createDataFrame([(t.encode("utf-16", "surrogatepass").decode("utf-16"),) for t in texts], "t string")
    got = [r[0] for r in df.select(url_href(F.col("t"), F.lit("https://h.example/"))).collect()]
    assert got[0] == "https://h.example/" + "a" * 100_000 and got[1] == "https://h.example/x" and got[2] == "https://h.example/" + "%C3%A9" * 20_000
    assert got[3] == "https://h.example/" + "%20".join(["%F0%9F%98%80"] * 1000) and got[4] == "https://h.example/" + "?" * 1000 and got[5] == texts[5]
