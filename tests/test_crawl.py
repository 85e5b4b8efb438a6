import datetime as dt
import http.server
import random
import re
import threading

from pyspark.sql import functions as F

from corpusmill.config import CrawlOptions, SiteProfile
from corpusmill.operators import crawl
from corpusmill.operators.crawl import Crawl, Site, asked_for, crawl_rounds, reachable, reachable_within
from corpusmill.operators.dedup import dedup_versions
from corpusmill.plans.runs import crawl_snapshot, regenerate, sample
from corpusmill.sources import progress
from corpusmill.sources.corpus import write_corpus
from corpusmill.sources.live import fetch_pages, redirects_of
from corpusmill.streaming.pages import extracted_stream, page_stream, write_stream

SITE = SiteProfile(product="Thing")
P, B = SITE.path_prefix, SITE.base_url
NOW = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_depth_first_decisions():
    links = {B: [f"{B}/152/a", f"{B}/133/a", f"{B}/152/b", f"{B}/133/b", f"{B}/old", f"{B}/bad"], f"{B}/a": [B], f"{B}/new": [f"{B}/old", f"{B}/deep"], f"{B}/152/b": [], f"{B}/deep": []}
    lead = {f"{B}/old": f"{B}/new"}
    site = Site(lambda u: links.get(lead.get(u, u), []), lambda u: lead.get(u, u), lambda u: u != f"{B}/b", lambda u: u == f"{B}/bad")
    crawl = Crawl(P)
    crawl.run(site, [B])
    # the page without a version stands for both; of b, which has none, the first version found
    assert crawl.saved == [B, f"{B}/a", f"{B}/152/b", f"{B}/new", f"{B}/deep"]
    assert crawl.fetched == 6 and f"{B}/bad" in crawl.visited and crawl.redirects == lead
    limited = Crawl(P, 2)
    limited.run(site, [B])
    assert limited.saved == [B, f"{B}/a"]
    cached = Crawl(P, 1)
    cached.take_cached(B)
    cached.run(site, [B, f"{B}/deep", f"{B}/new"])
    assert cached.saved == [f"{B}/deep"]


def test_breadth_first(spark):
    e = spark.createDataFrame([(f"n{i}", f"n{i + 1}", 0) for i in range(25)] + [("n3", "n0", 1), ("q", "n0", 0)], "src string, dst string, pos int")
    seeds = spark.createDataFrame([("n0",)], "url string")
    assert {(r.url, r.depth) for r in reachable(e, seeds, max_depth=19).collect()} == {(f"n{i}", i) for i in range(20)}
    assert {r.url for r in reachable_within(e.where("src in ('n0', 'n1', 'n2', 'n3')"), seeds, 3, spark.createDataFrame([("n1",)], "url string")).collect()} == {"n0", "n2", "n3"}
    assert reachable(e.limit(0), seeds).count() == 1


def test_versions_keep_one(spark):
    rows = [(0, f"{B}/152/a"), (1, f"{B}/a"), (2, f"{B}/133/b"), (3, f"{B}/152/b"), (4, f"{B}/a")]
    got = dedup_versions(spark.createDataFrame(rows, "ord int, url string"), P)
    assert {(r.ord, r.url) for r in got.collect()} == {(1, f"{B}/a"), (2, f"{B}/133/b")}


def pages(spark):
    link = lambda *to: "".join(f'<a href="{P}/{t}">{t}</a>' for t in to)
    rows = [(B, f"<title>Root</title><body><nav>{link('a', '152/b', 'old')}</nav><h1>Root</h1><p>Text.</p>"), (f"{B}/a?x=1", f"<body><h1>A</h1>{link('')}<p>About a."), (f"{B}/152/b", "<body><p>About b."), (f"{B}/133/b", "<body><p>About b, older."), (f"{B}/new", "<body><h1>New</h1>"), (f"{B}/island", "<body>no link leads here")]
    return spark.createDataFrame(rows, "url string, html string")


def test_run_save_resume(spark, tmp_path):
    options = CrawlOptions(output_dir=str(tmp_path), max_pages=None, now=NOW, stale_seconds=60)
    assert progress.lookup_redirect(spark, f"{B}/old", SITE, options) is None and progress.read_pages(spark, options).count() == 0
    assert progress.save_redirect(spark, f"{B}/old", f"{B}/new", SITE, options) == "old.redirect.json"
    assert progress.lookup_redirect(spark, f"{B}/old", SITE, options) == f"{B}/new"
    later = CrawlOptions(output_dir=str(tmp_path), now=NOW + dt.timedelta(seconds=60), stale_seconds=60)
    assert progress.lookup_redirect(spark, f"{B}/old", SITE, later) is None and progress.read_redirects(spark, later).count() == 0
    got = crawl_snapshot(pages(spark), SITE, options, redirects=progress.read_redirects(spark, options))
    assert {r.url for r in got["pages"].collect()} == {B, f"{B}/a", f"{B}/152/b", f"{B}/new"}
    # every attempt counts and is visited: the one that fails, and the one that is led elsewhere, with where it is led
    assert {(r.url, r.final, r.ok, r.saved) for r in got["tried"].collect()} == {(B, B, True, True), (f"{B}/a", f"{B}/a", True, True), (f"{B}/152/b", f"{B}/152/b", True, True), (f"{B}/old", f"{B}/new", True, True), (f"{B}/", f"{B}/", False, False)}
    whole = got["summary"].first()
    assert whole.pages == [B, f"{B}/a", f"{B}/152/b", f"{B}/old", f"{B}/new", f"{B}/"] and whole.totalPages == whole.newlyFetchedPages == 5
    progress.save_pages(got["pages"], SITE, options)
    progress.save_table(got["pages"], SITE, options, f"file://{tmp_path}/records")
    assert spark.read.parquet(f"file://{tmp_path}/records").count() == 4
    (tmp_path / "progress" / "broken.json").write_text("{")
    stored = progress.read_pages(spark, options)
    assert progress.cache_summary(stored).first().asDict() == {"fresh": 4, "stale": 1}
    assert progress.cache_summary(progress.read_pages(spark, later)).first().fresh == 0
    a = stored.where(F.col("url") == f"{B}/a").first()
    assert (a.heading, a.breadcrumb, a.crawledAt) == ("A", [], "2024-01-01T00:00:00.000Z") and a.md.startswith(f"# A\n**URL:** {B}/a\n---\n")
    # the root's links stood in its nav, which the cleaned html has no more
    assert {r.url for r in progress.resume_seeds(stored, SITE).collect()} <= {f"{B}/"}
    again = crawl_snapshot(pages(spark), SITE, options, cached=stored.where("fresh").select("url", "md"))
    assert again["pages"].count() == 0 and again["summary"].first().cachedPages == 4
    made = regenerate(stored, SITE, options)
    assert made["counts"].first().asDict() == {"success": 4, "error": 1}
    write_corpus(made["corpus"], f"file://{tmp_path}/corpus")
    text = "\n".join(r.value for r in spark.read.text(f"file://{tmp_path}/corpus").collect())
    assert text.count("**URL:**") == 4
    lines = [r.value for r in made["corpus"].orderBy("seq").collect()]
    assert lines[0].startswith("# Documentation\n\n**Generated:** 2024-01-01T00:00:00.000Z\n**Total Pages:** 4\n**Regenerated from cache:** true\n\n---\n")
    assert len(lines) == 5 and all(x.startswith("\n\n# ") for x in lines[1:])
    assert crawl_snapshot(pages(spark), SITE, CrawlOptions(max_pages=2, now=NOW))["pages"].count() == 2


def test_sample(spark):
    got = sample(pages(spark), [f"{B}/152/b", B], SITE).orderBy("ord").collect()
    assert [(r.url, r.preview) for r in got] == [(f"{B}/152/b", "About b."), (B, "RootText.")]


def test_live(spark):
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            if self.path == "/old":
                self.send_response(302)
                self.send_header("Location", "/new#top")
                self.end_headers()
                return
            self.send_response(404 if self.path == "/gone" else 200)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.end_headers()
            self.wfile.write(f"<p>é {self.path}".encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    urls = spark.createDataFrame([(f"{at}/new",), (f"{at}/old",), (f"{at}/gone",), ("http://127.0.0.1:1/x",)], "url string")
    got = {r.url.rpartition("/")[2]: r for r in fetch_pages(urls, attempts=2, patience=2.0).collect()}
    server.shutdown()
    assert (got["new"].html, got["new"].ok, got["gone"].ok, got["gone"].status, got["x"].html) == ("<p>é /new", True, False, 404, None) and got["x"].error
    fetched = spark.createDataFrame([got["old"], got["new"]], "url string, final_url string, status int, ok boolean, html string, error string")
    assert [(r.source, r.target) for r in redirects_of(fetched, NOW).collect()] == [(f"{at}/old", f"{at}/new")]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(k, u, h, NOW.replace(tzinfo=None)) for k, (u, h) in enumerate(pages(spark).collect())]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, fetched_at timestamp")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        write_stream(extracted_stream(page_stream(spark, f"{tmp_path}/in"), SITE), f"{tmp_path}/out", f"{tmp_path}/at").awaitTermination(60)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == 5 and {r.canonical for r in got.collect()} == {B, f"{B}/a", f"{B}/b", f"{B}/new", f"{B}/island"}


def test_rounds_against_a_plain_crawl(spark):
    """Random sites with versions, redirects and missing pages: what is tried and visited, in order and under limits."""
    pick = random.Random(8)
    for turn in range(3):
        names = [f"{B}/p{i}" for i in range(14)] + [f"{B}/{v}/p{i}" for i in range(8) for v in (133, 152)]
        there = set(pick.sample(names, 24))
        links = {u: pick.sample(names, pick.randint(0, 4)) for u in there}
        leads = {u: pick.choice(names) for u in pick.sample(names, 5) if "/133/" not in u and "/152/" not in u}
        leads = {a: b for a, b in leads.items() if a != b and b not in leads}
        limit = (None, 9, 4)[turn]

        version = re.compile(re.escape(P) + r"/[0-9]+/")
        plain = lambda u: version.sub(P + "/", u, count=1)
        answers = lambda u: u in there or leads.get(u) in there
        visited, memo, tried, queue = {}, {}, [], [B + "/p0"]
        while queue and (limit is None or len(tried) < limit):
            fresh = [u for u in dict.fromkeys(queue) if u not in visited and memo.get(u) not in visited]
            best = {}
            for u in fresh:
                if plain(u) not in best or plain(best[plain(u)]) != best[plain(u)] and plain(u) == u:
                    best[plain(u)] = u
            fresh = [u for u in best.values() if u == plain(u) or plain(u) not in {plain(v) for v in visited}]
            goes = [(plain(u) if answers(plain(u)) else u, queue.index(u)) for u in fresh]
            goes = [u for u, _ in sorted(goes, key=lambda x: x[1]) if u not in visited and memo.get(u) not in visited]
            goes = goes[: None if limit is None else limit - len(tried)]
            finals = {u: leads.get(u, u) for u in goes}
            saved = {}
            for u in sorted(goes, key=lambda u: (finals[u] != u, goes.index(u))):
                if finals[u] in there and finals[u] not in visited:
                    saved.setdefault(finals[u], u)
            tried += [(u, finals[u], finals[u] in there, saved.get(finals[u]) == u) for u in goes]
            for u in goes:
                visited[u] = None
            for u in goes:
                if finals[u] in there:
                    visited.setdefault(finals[u])
                    if finals[u] != u:
                        memo[u] = finals[u]
            queue = [x for u in goes if saved.get(finals[u]) == u for x in links[finals[u]]]
        edges = spark.createDataFrame([(u, x, k) for u, xs in links.items() for k, x in enumerate(xs)] or [("", "", 0)], "src string, dst string, pos int")
        done = crawl_rounds(edges, spark.createDataFrame([(u,) for u in there], "url string"), spark.createDataFrame([(B + "/p0", 0)], "url string, ord long"), P, spark.createDataFrame(list(leads.items()) or [("", "")], "source string, target string"), spark.createDataFrame([], "source string, target string, cachedAt string"), spark.createDataFrame([], "url string"), limit)
        assert [(r.url, r.final, r.ok, r.saved) for r in done.tried.orderBy("round", "number").collect()] == tried
        assert {r.url for r in done.visited.collect()} == set(visited)


def test_rounds_over_large_tables_give_the_same(spark, monkeypatch):
    """Whether rounds join whole tables or what they ask for."""
    links = [(f"{B}/{i}", f"{B}/{'152/' if j % 3 == 0 else ''}{j}", p) for i in range(30) for p, j in enumerate((2 * i + 1, 2 * i + 2))]
    there = [(f"{B}/{i}",) for i in range(28)] + [(f"{B}/moved",)]
    leads = [(f"{B}/5", f"{B}/moved"), (f"{B}/7", f"{B}/3"), (f"{B}/8", f"{B}/moved")]
    frames = [spark.createDataFrame(links, "src string, dst string, pos int"), spark.createDataFrame(there, "url string"), spark.createDataFrame([(f"{B}/0", 0)], "url string, ord long")]
    lead, none, cached = spark.createDataFrame(leads, "source string, target string"), spark.createDataFrame([], "source string, target string, cachedAt string"), spark.createDataFrame([(f"{B}/9",)], "url string")
    got = []
    for small in (1_000_000, 0):
        monkeypatch.setattr(crawl, "SMALL", small)
        done = crawl_rounds(*frames, P, lead, none, cached, 25)
        got.append((sorted(map(tuple, done.tried.select("url", "final", "ok", "saved", "round").collect())), sorted(map(tuple, done.visited.select("url", "round", "step").collect())), sorted((r.url, r.depth) for r in reachable(frames[0], frames[2].select("url")).collect())))
    assert got[0] == got[1] and len(got[0][0]) > 10


def test_a_round_takes_what_it_asks_for(spark):
    """Of a large table little more than the asked keys' rows go on, and all of those."""
    table = spark.range(200_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))
    asked = spark.createDataFrame([(f"u{k}",) for k in range(0, 1000, 10)] + [("none",), (None,)], "k string")
    got = asked_for(table, F.col("url"), asked, asked.limit(0))
    assert got.join(asked.withColumnRenamed("k", "url"), "url", "left_semi").count() == 100 and got.count() < 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert asked_for(table, F.col("url"), asked.limit(0)).count() == 0
