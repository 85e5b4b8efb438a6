"""The queries of the engine's own operators over whole tables, and the same in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import ANY_SITE, CrawlOptions, SiteProfile
from corpusmill.functions import text as T
from corpusmill.functions import urls as U
from corpusmill.functions import weburl as W
from corpusmill.operators import crawl, dedup
from corpusmill.operators.extract import extract_pages
from corpusmill.operators.links import link_counts, new_links, page_links
from corpusmill.plans import runs
from corpusmill.sources import progress
from corpusmill.sources.corpus import corpus_header, corpus_lines, corpus_text, read_ranges, summary, write_corpus_file
from corpusmill.sources.tables import new_path, table
from corpusmill.streaming.refetch import refetches

HREFS = ("../x", "./a/../b", "/r/../s?q#f", "../../../z", "c/d/..", "/a/./%2E%2e/b/.", "?q=1", "#f", "//other.example.org/p/../q", "mailto:x@y", "http://h.example/a/../b", "e f")
FORMS = ("e f", "\\a\\.\\b", " a\tb\n", "HTTP:x", "HTTPS://EX.com:443", "http://u:p@X.example:80/%7e/../q?'", "http://0x7f.1/", "http://[0:0::1]:8080", "//b.example:443", "", "?", "#x y", "\u00e9/\U0001f642?\u00e9", "http://a:99999", "MAILTO:a b", "HTTP:/r", "http://b\u00fccher.example")
#: A profile of links that have a prefix and stand below a base.
BELOW = SiteProfile(base_url="https://", path_prefix="/th")
PREFIX = "/documentation/product"
BASE = f"https://docs.example.com{PREFIX}"
SITE = SiteProfile()
NOW = dt.datetime(2024, 1, 15)
TTL = 86_400

#: A site drawn from the ids of all pages: page i has two children, a link to its parent, and other forms of its URL.
CHILDREN = (("2 * page_id + 1", 0), ("2 * page_id + 2", 1), ("(page_id - 1) DIV 2", 2))
DEPTH_FIRST_LIMIT, BREADTH_LIMIT = 50, 40


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages")


def _title() -> F.Column:
    return F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1)


def url_clean(spark, d):
    return _pages(spark, d).select("page_id", U.clean_url(F.col("url")).alias("clean_url"))


def url_filename(spark, d):
    return _pages(spark, d).select("page_id", U.url_to_filename(F.col("url"), "").alias("filename"), U.redirect_filename(F.col("url"), "").alias("redirect_filename"), U.swap_extension(U.url_to_filename(F.col("url"), ""), ".md").alias("md_filename"))


def _versioned(spark, d) -> DataFrame:
    """ord, url: for every page a URL without a version, with one of two, or with two after each other; three pages share a name."""
    i = F.col("page_id")
    version = F.when(i % 4 == 0, "").when(i % 4 == 1, "/133").when(i % 4 == 2, "/152").otherwise("/152/133")
    name = F.concat(F.lit("/doc"), F.floor(i / 3).cast("string"))
    return _pages(spark, d).select(i.alias("ord"), F.when(i % 10 == 9, F.concat(F.lit(BASE), version)).when(i % 10 == 8, F.concat(F.lit(f"{BASE}-foo/9"), name)).otherwise(F.concat(F.lit(BASE), version, name)).alias("url"))


def url_version(spark, d):
    return _versioned(spark, d).select("ord", U.extract_version(F.col("url"), PREFIX).alias("version"))


def url_canonical(spark, d):
    return _versioned(spark, d).select("ord", U.canonical_url(F.col("url"), PREFIX).alias("canonical"))


def href_resolve(spark, d):
    """Relative, root-relative, host-relative and other references against every page's URL, with dot segments."""
    forms = F.array(*map(F.lit, HREFS))
    rows = _pages(spark, d).select("page_id", "url", F.posexplode(forms).alias("form", "href"))
    return rows.select("page_id", "form", U.resolve_href(F.col("href"), F.col("url")).alias("full"))


def url_resolve(spark, d):
    """What browsers make of references against every page's URL: encodings, backslashes, schemes, ports, addresses, names."""
    rows = _pages(spark, d).select("page_id", "url", F.posexplode(W.hrefs_of(F.array(*map(F.lit, FORMS)), F.col("url"))).alias("form", "href"))
    return rows.select("page_id", "form", "href")


def links_below(spark, d):
    """Links by the pattern whose hrefs have a prefix, of pages below a base."""
    return page_links(_pages(spark, d), BELOW).select("page_id", F.col("pos").cast("long").alias("pos"), "link")


def page_live_links_below(spark, d):
    """The same from the tree, the hrefs being read against the folder that each page names as its base."""
    pages = _pages(spark, d).withColumn("html", F.replace("html", F.lit("<head>"), F.lit("<head><base href='/b a/se?x'>")))
    return extract_pages(pages, BELOW, fields=()).select("page_id", F.posexplode("links").alias("pos", "link")).withColumn("pos", F.col("pos").cast("long"))


def page_title(spark, d):
    return _pages(spark, d).select("page_id", _title().alias("title"))


def links_of_pages(spark, d):
    return page_links(_pages(spark, d), ANY_SITE).select("page_id", F.col("pos").cast("long").alias("pos"), "link")


def count_links(spark, d):
    return link_counts(page_links(_pages(spark, d), ANY_SITE))


def links_distinct_new(spark, d):
    pages = _pages(spark, d)
    return new_links(page_links(pages, ANY_SITE), pages.select(U.clean_url(F.col("url")).alias("url")))


def filename_collisions(spark, d):
    return dedup.filename_collisions(_pages(spark, d), "")


def filename_last_write(spark, d):
    return dedup.last_write_by_filename(_pages(spark, d).select("page_id", "url"), "", ord_="page_id").select("filename", "page_id", "url")


def version_dedup(spark, d):
    return dedup.dedup_versions(_versioned(spark, d), PREFIX)


def _ages(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _micros(column) -> F.Column:
    return F.unix_micros(column.cast("timestamp"))


def cache_freshness(spark, d):
    at, now = F.col("ts").cast("timestamp"), F.lit(NOW).cast("timestamp")
    return _ages(spark, d).select("event_id", T.page_is_fresh(at, now, TTL).alias("page_fresh"), T.page_is_fresh(at, now, 0).alias("never"), T.redirect_is_fresh(at, now, TTL).alias("redirect_fresh"), T.redirect_is_fresh(at, now, 0).alias("always"))


def cache_summary(spark, d):
    return cache_freshness(spark, d).agg(F.count_if("page_fresh").alias("fresh"), F.count_if(~F.col("page_fresh")).alias("stale"))


def cache_refetches(spark, d):
    """Which of all events, as arrivals of a page for each user, a cache with a lifetime takes."""
    rows = table(spark, d, "events").select(F.concat(F.lit(f"{BASE}/p"), F.col("user_id").cast("string")).alias("url"), F.col("ts").alias("fetched_at"), F.col("event_id").alias("page_id"))
    return refetches(rows, TTL)


def _redirects(spark, d) -> DataFrame:
    """source, target, cachedAt: every eleventh page's URL leads elsewhere, and every third of these has two records."""
    u = _versioned(spark, d).where("ord % 11 = 3")
    first = u.select(F.col("url").alias("source"), F.concat(F.lit(f"{BASE}/doc"), F.floor(F.col("ord") / 5).cast("string")).alias("target"), F.col("ord").alias("cachedAt"))
    again = first.where("cachedAt % 3 = 0").select("source", F.concat("target", F.lit("/new")).alias("target"), (F.col("cachedAt") + 1_000_000_000).alias("cachedAt"))
    return first.union(again)


def redirect_resolve(spark, d):
    return crawl.resolve_redirects(_versioned(spark, d), _redirects(spark, d))


def crawl_frontier(spark, d):
    visited = _pages(spark, d).where("page_id % 5 = 0").select(F.concat(F.lit(f"{BASE}/doc"), F.floor(F.col("page_id") / 9).cast("string")).alias("url"))
    return crawl.frontier(_versioned(spark, d), visited, _redirects(spark, d), PREFIX)


def _node(i) -> F.Column:
    return F.concat(F.lit(f"{BASE}/p"), i.cast("string"))


def _edges(spark, d, children=CHILDREN):
    """Links between pages by number, and the first page: links of the last pages lead to pages that aren't there."""
    pages = _pages(spark, d)
    edges = pages.select(_node(F.col("page_id")).alias("src"), F.explode(F.array(*(F.struct(F.expr(to).alias("to"), F.lit(pos).alias("pos")) for to, pos in children))).alias("l"))
    return edges.where("l.to >= 0").select("src", _node(F.col("l.to")).alias("dst"), "l.pos"), pages.where("page_id = 0").select(_node(F.col("page_id")).alias("url"))


def crawl_reachable(spark, d):
    return crawl.reachable(*_edges(spark, d))


def crawl_limit(spark, d):
    cached = _pages(spark, d).where("page_id % 7 = 1").select(_node(F.col("page_id")).alias("url"))
    return crawl.reachable_within(*_edges(spark, d), BREADTH_LIMIT, cached).select("url", "depth")


def crawl_depth_first(spark, d):
    edges, _ = _edges(spark, d)
    n = _pages(spark, d).count()
    got = crawl.crawl_depth_first(edges, [f"{BASE}/p0"], PREFIX, max_pages=DEPTH_FIRST_LIMIT, failing=lambda u: int(u.rpartition("/p")[2]) >= n)
    return spark.createDataFrame(list(enumerate(got.saved)), "ord int, url string")


def _site(spark, d):
    """links, there, leads of a site with versions, redirects and missing pages, over all pages.

    Every fourth page and the next but one is linked with a version; of every eighth only
    the version is there; every thirteenth of the others is led to another URL.
    """
    pages, i = _pages(spark, d).select("page_id"), F.col("page_id")
    plain, versioned = lambda n: F.concat(F.lit(f"{BASE}/p"), n.cast("string")), lambda n: F.concat(F.lit(f"{BASE}/152/p"), n.cast("string"))
    moved = F.concat(F.lit(f"{BASE}/moved"), i.cast("string"))
    at = F.when(i % 8 == 7, versioned(i)).when(i % 13 == 5, moved).otherwise(plain(i))
    links = pages.select(at.alias("src"), F.posexplode(F.array(2 * i + 1, 2 * i + 2)).alias("pos", "to"))
    links = links.select("src", F.when(F.col("to") % 2 == 1, versioned(F.col("to"))).otherwise(plain(F.col("to"))).alias("dst"), "pos")
    leads = pages.where((i % 8 != 7) & (i % 13 == 5)).select(plain(i).alias("source"), moved.alias("target"))
    return links, pages.select(at.alias("url")), leads


def crawl_attempts(spark, d):
    """Every attempt of a crawl by breadth: where it was led, and whether the page was there."""
    links, there, leads = _site(spark, d)
    none = leads.select("source", "target", F.lit(0).alias("cachedAt")).limit(0)
    done = crawl.crawl_rounds(links, there, spark.createDataFrame([(f"{BASE}/p0", 0)], "url string, ord long"), PREFIX, leads, none, there.limit(0))
    return done.tried.select("url", "final", "ok", "saved")


def crawl_led(spark, d):
    """A crawl in which every thirteenth page is led to the page that links to it, which was visited: nothing is saved, and its links are not followed."""
    pages, i = _pages(spark, d).select("page_id"), F.col("page_id")
    links = pages.select(_node(i).alias("src"), F.posexplode(F.array(2 * i + 1, 2 * i + 2)).alias("pos", "to")).select("src", _node(F.col("to")).alias("dst"), "pos")
    leads = pages.where(i % 13 == 5).select(_node(i).alias("source"), _node(F.expr("(page_id - 1) DIV 2")).alias("target"))
    none = leads.select("source", "target", F.lit(0).alias("cachedAt")).limit(0)
    there = pages.select(_node(i).alias("url"))
    done = crawl.crawl_rounds(links, there, spark.createDataFrame([(f"{BASE}/p0", 0)], "url string, ord long"), PREFIX, leads, none, there.limit(0))
    return done.tried.select("url", "final", "ok", "saved")


def crawl_visited(spark, d):
    """What a crawl counts as visited: attempts, failed ones too, and where they were led."""
    links, there, leads = _site(spark, d)
    none = leads.select("source", "target", F.lit(0).alias("cachedAt")).limit(0)
    cached = spark.createDataFrame([(f"{BASE}/p2",)], "url string")
    done = crawl.crawl_rounds(links, there, spark.createDataFrame([(f"{BASE}/p0", 0), (f"{BASE}/p5", 1), (f"{BASE}/p6", 2)], "url string, ord long"), PREFIX, leads, none, cached)
    return done.visited.select("url")


def _records(spark, d) -> DataFrame:
    """Page records of all ages: some without a time, with no time at all, or without their Markdown."""
    i = F.col("page_id")
    hours = F.timestamp_micros(F.lit(int(NOW.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000) - (i % 50) * F.lit(3_600_000_000) + F.lit(3_600_000_000))
    crawled = F.when(i % 17 == 3, F.lit(None).cast("string")).when(i % 19 == 4, "no time").otherwise(T.iso_time(hours))
    md = F.when(i % 7 != 2, F.concat(F.lit("# "), _title()))
    return _pages(spark, d).select("page_id", U.url_to_filename(F.col("url"), "").alias("filename"), "url", _title().alias("title"), F.lit("").alias("heading"), F.array().cast("array<string>").alias("breadcrumb"), crawled.alias("crawledAt"), F.when(i % 23 != 5, F.col("html")).alias("html"), md.alias("md"))


def _options(**more) -> CrawlOptions:
    return CrawlOptions(now=NOW.replace(tzinfo=dt.timezone.utc), stale_seconds=TTL, **more)


def cache_pages(spark, d):
    return progress.judged(_records(spark, d), _options()).select("page_id", "filename", "complete", "fresh")


def cache_folder(spark, d):
    """The records as a folder of files, written by the executors and read again: of each name the last write."""
    path = new_path(spark, "cache")
    progress.save_records(dedup.last_write(_records(spark, d).withColumn("text", F.lit("")), F.col("filename"), "page_id"), f"{path}/progress")
    found = progress.read_pages(spark, _options(output_dir=path))
    return found.select("filename", "url", "title", "crawledAt", F.md5("html").alias("html_md5"), "md", "complete", "fresh")


def cache_redirect_folder(spark, d):
    """Redirects as a folder of files, one a name, and those that are valid when it is read."""
    path = new_path(spark, "redirects")
    leads = _pages(spark, d).where("page_id % 3 = 1").select(F.col("url").alias("source"), F.concat("url", F.lit('/"to"')).alias("target"))
    progress.save_redirects(leads, ANY_SITE, _options(output_dir=path))
    return progress.read_redirects(spark, _options(output_dir=path)).select("source", "target")


def cache_counts(spark, d):
    return progress.cache_summary(progress.judged(_records(spark, d), _options()))


def cache_resume(spark, d):
    return progress.resume_seeds(progress.judged(_records(spark, d), _options()), ANY_SITE)


def cache_redirects(spark, d):
    rows = _records(spark, d).select(F.col("url").alias("source"), F.when(F.col("page_id") % 29 != 7, F.concat("url", F.lit("/to"))).alias("target"), F.col("crawledAt").alias("cachedAt"))
    return progress.valid_redirects(rows, _options()).select("source", "target", T.iso_time(F.col("cachedAt")).alias("cached_at"))


def regenerate_counts(spark, d):
    return runs.regenerate(_records(spark, d), SITE, _options())["counts"]


def regenerate_order(spark, d):
    """Of every regenerated page how many come before it, by file name with its extension."""
    made = runs.regenerate(dedup.last_write(_records(spark, d), F.col("filename"), "page_id"), SITE, _options())["pages"]
    return runs.places(made).select("url", "place")


def run_summary(spark, d):
    out = summary(_pages(spark, d).select("url", F.col("page_id").alias("ord")), 3, 4, SITE, NOW)
    return out.select("totalPages", "cachedPages", "newlyFetchedPages", T.iso_time(F.col("crawledAt").cast("timestamp")).alias("crawledAt"), "baseUrl", F.size("pages").cast("long").alias("n_pages"), F.md5(F.array_join("pages", " ")).alias("pages_md5"))


def corpus_whole(spark, d):
    """The one value of the concatenated corpus, by its digest and size."""
    header = corpus_header("Documentation", F.lit(NOW).cast("timestamp"), F.lit(3))
    pages = _pages(spark, d).select(F.col("page_id").alias("ord"), _title().alias("md"))
    return corpus_text(pages, header).select(F.md5("corpus").alias("md5"), F.length("corpus").cast("long").alias("n_points"))


def corpus_file(spark, d):
    """Where each page stands in the corpus as one file, and what is read there again."""
    path = f"{new_path(spark, 'corpus')}/llms-full.txt"
    header = spark.range(1).select(corpus_header("Documentation", F.lit(NOW).cast("timestamp"), F.lit(3))).first()[0]
    front = T.frontmatter(_title(), F.lit(""), F.col("url"), F.array().cast("array<string>"))
    ranges = write_corpus_file(corpus_lines(_pages(spark, d).select(F.col("page_id").alias("ord"), F.concat(front, F.lit("\n"), F.col("html")).alias("md")), header), path)
    return ranges.join(read_ranges(ranges, path), "seq").where("seq >= 0").select("seq", "begin", "n_bytes", F.md5("data").alias("md5"))


def corpus_headers(spark, d):
    """The lines above a corpus: of a crawl, a regeneration and a sample."""
    n, now = F.col("n"), F.lit(NOW).cast("timestamp")
    counted = _pages(spark, d).agg(F.count("*").alias("n"))
    return counted.select(corpus_header("Documentation", now, n, n - 1, F.lit(1)).alias("crawl"), corpus_header("Documentation", now, n, regenerated=True).alias("regenerated"), corpus_header("Documentation", now, n).alias("sample"))


def utf16_sizes(spark, d):
    """Sizes in the web's units, of texts with characters that take two, and of 300 copies of each."""
    sizes = table(spark, d, "documents").select("doc_id", T.utf16_length(F.concat("text", F.lit("🙂x🙂"))).alias("n_units"))
    return sizes.withColumn("megabytes", T.megabytes(300 * F.col("n_units")))


def content_markdown(spark, d):
    """Front matter, and a body whose white space is put in order."""
    body = F.concat(F.lit("\n\n"), _title(), F.lit("  \n\n\n\ntext\t\n"))
    return _pages(spark, d).select("page_id", T.content_to_markdown(_title(), F.lit(""), F.col("url"), F.array(F.lit("Home"), F.lit("Here")), body).alias("md"))


def sample_pages(spark, d):
    """Five pages by URL, in the order asked for."""
    pages = _pages(spark, d)
    urls = [r.url for r in pages.where("page_id < 5").orderBy(F.desc("page_id")).select("url").collect()]
    return runs.sample(pages.dropDuplicates(["url"]), urls, SITE).select("ord", "url", "title", "heading", "text_length", "preview")


def page_breadcrumb(spark, d):
    """The trail of pages whose navigation is marked as one, from the markup as it came."""
    pages = _pages(spark, d).withColumn("html", F.replace("html", F.lit("<nav>"), F.lit("<nav aria-label='the breadcrumb'><a href='/'> Home </a><a href='/e'> </a>")))
    return extract_pages(pages, SITE, fields=()).select("page_id", F.array_join("breadcrumb", " > ").alias("trail"))


def page_live_links(spark, d):
    """The links of the whole document, navigation and all, from the tree."""
    return extract_pages(_pages(spark, d), ANY_SITE, fields=()).select("page_id", F.posexplode("links").alias("pos", "link")).withColumn("pos", F.col("pos").cast("long"))


#: Pieces that the cleaning passes take out, each before the article, and what they leave.
PIECES = (
    '<div class="my-promo">P1</div>', '<p id="kendonav">P2</p>', '<span data-role="treeview">P3</span>', "<iframe>P4</iframe>", "<noscript>P5</noscript>",
    '<section><h3>Want to learn more? Now</h3><div>P6</div><p>P7</p><h4>P8</h4><h3>L1</h3><p>L2</p></section>', "<div>P9 <b>We use cookies to personalize content</b></div>",
    '<ul><li>This free lesson P10 <a href="/services/education/x">P11</a></li><li>L3 <a href="/services/education/y">L4</a></li></ul>',
    '<img src="/i/course_book.png">', "<span> Thank you for your feedback! </span>", '<a onclick="x.__doPostBack(1)">P12</a>', '<a href="javascript:void 0">P13</a>', '<i class="is-nextish">P14</i>', "<!-- P15 --><em>L5</em>",
)


def page_cleaned(spark, d):
    """The text of pages with a piece for each cleaning pass put before the article."""
    pages = _pages(spark, d).withColumn("html", F.replace("html", F.lit("<article>"), F.lit("".join(PIECES) + "<article>")))
    return extract_pages(pages, SITE, fields=("text",)).select("page_id", "text")


def page_cleaned_html(spark, d):
    """The markup that is left of pages without unclosed elements: comments stay, removed elements don't."""
    pages = _pages(spark, d).withColumn("html", F.concat(F.lit("<body><nav>n</nav><p id=a>"), _title(), F.lit("</p><!-- c --><div class='feedback'>f</div><br><img src='x.png'></body>")))
    return extract_pages(pages, SITE, fields=("html",)).select("page_id", "html")


def _unmarked(html: F.Column) -> F.Column:
    """The article of a page of the plain template without its tags, a line separator where a paragraph begins."""
    article = F.regexp_extract(html, r"(?s)<article>(.*?)(?:</article>|\z)", 1)
    return F.regexp_replace(F.replace(article, F.lit("<p>"), F.lit("\u2028")), r"<[a-z/!][^>]*(?:>|\z)", "")


def page_tree(spark, d):
    """The tree, as markup, of every page's article as rows of a table without sections and ends, with its heading loose in the table and in misnested elements behind it."""
    article = _unmarked(F.col("html"))
    heading = F.substring_index(article, "\u2028", 1)
    behind = F.concat(F.lit("</table><b>a<div>"), heading, F.lit("</b>c</div><p>1<b>2<i>"), heading, F.lit("</b>4</i>5</p><a href=x>d<div><a href=y>"), heading, F.lit("</a></div><select><option>e<option>f<p>g</select><dl><dt>h<dd>i<dt>j"))
    pages = _pages(spark, d).withColumn("html", F.concat(F.lit("<!doctype html><title>t</title><p>k<table>"), F.replace(article, F.lit("\u2028"), F.lit("<tr><td>")), behind))
    return extract_pages(pages, SITE, selectors=(), fields=("html",)).select("page_id", "html")


def page_structure(spark, d):
    """Markdown of headings, lists, code, links and emphasis around every page's title."""
    body = F.concat(F.lit("<body><h2>"), _title(), F.lit("</h2><p>a <b>b</b> <i>c</i> <a href='/l'>d</a></p><ul><li>e</li><li>f</li></ul><pre><code>g\n  h</code></pre><hr></body>"))
    return extract_pages(_pages(spark, d).withColumn("html", body), SITE, fields=("body_md",)).select("page_id", T.normalize_whitespace(F.col("md")).alias("md"))


def markdown_normalize(spark, d):
    dirty = F.concat(F.lit(" \n\n\t"), F.replace("text", F.lit(". "), F.lit(".   \n\n\n\n  ")), F.lit("\t\n \n　"))
    return table(spark, d, "documents").select("doc_id", T.normalize_whitespace(dirty).alias("md"))


def text_sizes(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("n_points"), F.octet_length("text").cast("long").alias("n_bytes"), T.preview(F.col("text")).alias("preview"))


def frontmatter(spark, d):
    crumbs = F.when(F.col("page_id") % 2 == 0, F.array(F.lit("Home"), F.concat(F.lit("Page "), F.col("page_id").cast("string")))).otherwise(F.array().cast("array<string>"))
    heading = F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("H "), _title()))
    return _pages(spark, d).select("page_id", T.frontmatter(_title(), heading, F.col("url"), crumbs).alias("front"))


def corpus_concat(spark, d):
    header = spark.range(1).select(corpus_header("Documentation", F.lit(NOW).cast("timestamp"), F.lit(3), F.lit(1), F.lit(2))).first()[0]
    pages = _pages(spark, d).select(F.col("page_id").alias("ord"), T.frontmatter(_title(), F.lit(""), F.col("url"), F.array().cast("array<string>")).alias("md"))
    return corpus_lines(pages, header)


def page_extract(spark, d):
    return extract_pages(_pages(spark, d), SITE)


def page_text(spark, d):
    return extract_pages(_pages(spark, d), SITE, fields=("text",)).select("page_id", "title", "heading", "text", "error")


def page_markdown(spark, d):
    return extract_pages(_pages(spark, d), SITE, fields=("body_md",)).select("page_id", T.normalize_whitespace(F.col("md")).alias("md"))


ALL = (
    url_clean, url_filename, url_version, url_canonical, href_resolve, url_resolve, page_title, links_of_pages, links_below, page_live_links_below, count_links, links_distinct_new, filename_collisions, filename_last_write, version_dedup, cache_freshness, cache_summary, cache_refetches, redirect_resolve, crawl_frontier, crawl_reachable, crawl_limit, crawl_depth_first, crawl_attempts, crawl_led, crawl_visited,
    cache_pages, cache_folder, cache_redirect_folder, cache_counts, cache_resume, cache_redirects, regenerate_counts, regenerate_order, run_summary, corpus_whole, corpus_file, corpus_headers, utf16_sizes, content_markdown, sample_pages,
    page_breadcrumb, page_live_links, page_cleaned, page_cleaned_html, page_tree, page_structure, markdown_normalize, text_sizes, frontmatter, corpus_concat, page_extract, page_text, page_markdown,
)


def queries() -> dict:
    return {f.__name__: f for f in ALL}


_FILE = r"""(CASE WHEN regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^/', ''), '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') = '' THEN 'index'
    ELSE regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^/', ''), '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') END)"""
_CLEAN = "split_part(split_part({0}, '#', 1), '?', 1)"
_TITLE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
_HREFS = r"""SELECT page_id, url, generate_subscripts(h, 1) AS k, unnest(h) AS href FROM (SELECT page_id, url, regexp_extract_all(html, '(?i)<a[^>]+href=["'']([^"'']+)["''][^>]*>', 1) AS h FROM pages)"""
#: A path as URLs have it: what is no visible ASCII is percent-encoded.
_ENCODED = r"array_to_string(list_transform(string_split(href, ''), lambda c: CASE WHEN regexp_matches(c, '[^\x21-\x7e]') THEN url_encode(c) ELSE c END), '')"
_LINKS = f"""WITH h AS ({_HREFS}),
    f AS (SELECT page_id, k, {_CLEAN.format("CASE WHEN starts_with(href, 'http') THEN href ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || " + _ENCODED + " END")} AS link FROM h),
    u AS (SELECT page_id, link, min(k) AS k FROM f GROUP BY page_id, link),
    l AS (SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY k) - 1)::BIGINT AS pos, link FROM u)"""
_BELOW = f"""WITH h AS ({_HREFS}),
    f AS (SELECT page_id, k, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || {_ENCODED} AS link FROM h WHERE contains(href, '/th') AND starts_with(url, 'https://')),
    u AS (SELECT page_id, link, min(k) AS k FROM f GROUP BY page_id, link),
    l AS (SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY k) - 1)::BIGINT AS pos, link FROM u)"""
_SPACE = r"\t\x0B\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
_VERSION = f"nullif(regexp_extract(url, '{PREFIX}/([0-9]+)/', 1), '')"
_CANONICAL = rf"regexp_replace(url, '{PREFIX}/[0-9]+/', '{PREFIX}/')"
_AGE = "(epoch_us(TIMESTAMP '2024-01-15') - epoch_us(ts))"
_FRESH = f"coalesce({_AGE} < {TTL * 1_000_000}, false)"
_VERSIONED = f"""(SELECT page_id AS ord, '{BASE}' || CASE WHEN page_id % 10 = 9 THEN v WHEN page_id % 10 = 8 THEN '-foo/9/doc' || page_id // 3 ELSE v || '/doc' || page_id // 3 END AS url
    FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN '/133' WHEN 2 THEN '/152' ELSE '/152/133' END AS v FROM pages))"""
_REDIRECTS = f"""(SELECT url AS source, '{BASE}/doc' || ord // 5 || CASE WHEN again THEN '/new' ELSE '' END AS target, ord + CASE WHEN again THEN 1000000000 ELSE 0 END AS seq
    FROM {_VERSIONED}, (VALUES (false), (true)) t(again) WHERE ord % 11 = 3 AND (NOT again OR ord % 3 = 0))"""
#: A walk by depth; a page that is seen at some depth is seen again below, so the walk ends where no tree of this size has pages.
_REACH = f"""WITH RECURSIVE e AS (SELECT '{BASE}/p' || page_id AS src, '{BASE}/p' || t AS dst, pos FROM (SELECT page_id, unnest([2 * page_id + 1, 2 * page_id + 2, CASE WHEN page_id > 0 THEN (page_id - 1) // 2 END]) AS t, unnest([0, 1, 2]) AS pos FROM pages) WHERE t IS NOT NULL),
    r(url, depth) AS (SELECT '{BASE}/p0', 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.url WHERE r.depth < 40),
    m AS (SELECT url, min(depth)::INTEGER AS depth FROM r GROUP BY url)"""
_NODES = f"""WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages), k(i) AS (SELECT 0::BIGINT UNION SELECT unnest([2 * i + 1, 2 * i + 2]) FROM k, n WHERE i < n.n),
    a AS (SELECT i, i < n.n AS ok, CASE WHEN i < n.n AND i % 8 <> 7 OR i % 2 = 0 THEN '{BASE}/p' || i ELSE '{BASE}/152/p' || i END AS url FROM k, n),
    f AS (SELECT i, ok, url, CASE WHEN ok AND i % 8 <> 7 AND i % 13 = 5 THEN '{BASE}/moved' || i ELSE url END AS final FROM a)"""
_HOST = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
_RECORDS = f"""(SELECT *, CASE WHEN page_id % 17 = 3 OR page_id % 19 = 4 THEN NULL ELSE TIMESTAMP '2024-01-15' - ((page_id % 50) - 1) * INTERVAL 1 HOUR END AS made, page_id % 7 <> 2 AND page_id % 23 <> 5 AS complete FROM pages)"""
_STILL_FRESH = f"(complete AND coalesce(epoch_us(TIMESTAMP '2024-01-15') - epoch_us(made) < {TTL * 1_000_000}, false))"
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.') || '000Z'"


def _entities(x: str) -> str:
    return f"replace(replace(replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


def _trimmed(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{_SPACE}\n]+|[{_SPACE}\n]+\z', '', 'g')"


def _spaced(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[ \t\r\n]+', ' ', 'g'))"


def _marked(x: str) -> str:
    """Text with its Markdown marks escaped."""
    for c in "\\*`[]_":
        x = f"replace({x}, '{c}', '\\{c}')"
    return x


def _said(html: str) -> str:
    """The text of a page of the plain template: its body without nav, footer, comments and tags."""
    body = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({html}, '(?s)^.*?<body>', ''), '(?s)<!--.*?-->', '', 'g'), '(?s)<nav>.*?</nav>', '', 'g'), '(?s)<footer>.*?(?:</footer>|\z)', '')"
    return _trimmed(_entities(rf"regexp_replace({body}, '<[a-z/!][^>]*(?:>|\z)', '', 'g')"))


_H1 = _trimmed(_entities("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))
_TEXT = _said("html")
_PLAIN_TITLE = _entities(rf"regexp_replace(trim({_TITLE}), '\s+', ' ', 'g')")


def _blocks_sql() -> str:
    """Of pages of the plain template: ad, heading and, paragraph by paragraph, text, whether a line break ends it, and how many b are open: three of those begun before go on at most."""
    inner = r"regexp_replace(regexp_extract(html, '(?s)<article>(.*?)(?:</article>|\z)', 1), '<[a-z/][^>]*\z', '')"
    ad = _entities(r"regexp_extract(html, '(?s)<div class=\"ad\">(.*?)(?:</div>|\z)', 1)")
    plain = _entities("regexp_replace(part, '<[a-z/][^>]*>', '', 'g')")
    return f"""s AS (SELECT page_id, url, {_H1} AS h1, {_PLAIN_TITLE} AS title, {ad} AS ad, string_split({inner}, '<p>')[2:] AS parts FROM pages),
    q AS (SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM s),
    b AS (SELECT page_id, k, {plain} AS text, contains(part, '<br>') AS br, (least(3, coalesce(sum(contains(part, '<b>')::INTEGER) OVER (PARTITION BY page_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) + contains(part, '<b>')::INTEGER)::BIGINT AS n FROM q)"""


def oracle_sql() -> dict[str, str]:
    fm = f"'# ' || {{0}} || chr(10) || '**URL:** ' || url || {{1}} || chr(10) || '---'"
    return {
        "url_clean": f"SELECT page_id, {_CLEAN.format('url')} AS clean_url FROM pages",
        "url_filename": f"SELECT page_id, {_FILE} || '.json' AS filename, {_FILE} || '.redirect.json' AS redirect_filename, {_FILE} || '.md' AS md_filename FROM pages",
        "url_version": f"SELECT ord, {_VERSION} AS version FROM {_VERSIONED}",
        "url_canonical": f"SELECT ord, {_CANONICAL} AS canonical FROM {_VERSIONED}",
        "page_title": f"SELECT page_id, {_TITLE} AS title FROM pages",
        "links_of_pages": f"{_LINKS} SELECT page_id, pos, link FROM l",
        "count_links": f"{_LINKS} SELECT count(*)::BIGINT AS n_links, count(DISTINCT link)::BIGINT AS n_distinct FROM l",
        "links_distinct_new": f"{_LINKS} SELECT DISTINCT link AS url FROM l WHERE link NOT IN (SELECT {_CLEAN.format('url')} FROM pages)",
        "filename_collisions": f"SELECT {_FILE} || '.json' AS filename, count(DISTINCT url)::BIGINT AS n_urls FROM pages GROUP BY 1 HAVING count(DISTINCT url) > 1",
        "filename_last_write": f"SELECT {_FILE} || '.json' AS filename, page_id, url FROM pages QUALIFY row_number() OVER (PARTITION BY {_FILE} ORDER BY page_id DESC) = 1",
        "version_dedup": f"SELECT ord, url, {_CANONICAL} AS canonical FROM {_VERSIONED} QUALIFY row_number() OVER (PARTITION BY {_CANONICAL} ORDER BY {_VERSION} IS NOT NULL, ord) = 1",
        "cache_freshness": f"SELECT event_id, {_FRESH} AS page_fresh, false AS never, NOT coalesce({_AGE} >= {TTL * 1_000_000}, false) AS redirect_fresh, true AS always FROM events",
        "cache_summary": f"SELECT count(*) FILTER ({_FRESH})::BIGINT AS fresh, count(*) FILTER (NOT {_FRESH})::BIGINT AS stale FROM events",
        "cache_refetches": f"""WITH RECURSIVE p AS (SELECT user_id, event_id, epoch_us(ts) AS u FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
            t(user_id, u) AS (SELECT user_id, min(u) FROM p GROUP BY user_id UNION ALL SELECT p.user_id, min(p.u) FROM t JOIN p ON p.user_id = t.user_id AND p.u >= t.u + {TTL * 1_000_000} GROUP BY p.user_id)
            SELECT '{BASE}/p' || user_id AS key, u AS "at", min(event_id) AS id FROM t JOIN p USING (user_id, u) GROUP BY user_id, u""",
        "redirect_resolve": f"SELECT v.ord, v.url, t.target FROM {_VERSIONED} v LEFT JOIN (SELECT source, arg_max(target, {{'s': seq, 't': target}}) AS target FROM {_REDIRECTS} GROUP BY source) t ON t.source = v.url",
        "crawl_frontier": f"""WITH t AS (SELECT source, arg_max(target, {{'s': seq, 't': target}}) AS target FROM {_REDIRECTS} GROUP BY source),
            l AS (SELECT ord, url, {_VERSION} AS v, {_CANONICAL} AS c, target FROM {_VERSIONED} LEFT JOIN t ON source = url),
            s AS (SELECT DISTINCT '{BASE}/doc' || page_id // 9 AS seen FROM pages WHERE page_id % 5 = 0),
            k AS (SELECT * FROM l WHERE url NOT IN (SELECT seen FROM s) AND (target IS NULL OR target NOT IN (SELECT seen FROM s)) QUALIFY row_number() OVER (PARTITION BY c ORDER BY v IS NOT NULL, ord) = 1)
            SELECT ord, url FROM k WHERE NOT (c <> url AND c IN (SELECT {_CANONICAL.replace("url", "seen")} FROM s))""",
        "crawl_reachable": f"{_REACH} SELECT url, depth FROM m",
        "crawl_limit": f"{_REACH}, v AS (SELECT dst, min({{'s': src, 'p': pos}}) AS via FROM e GROUP BY dst) SELECT url, depth FROM m LEFT JOIN v ON v.dst = m.url WHERE url NOT IN (SELECT '{BASE}/p' || page_id FROM pages WHERE page_id % 7 = 1) ORDER BY depth, via.s NULLS FIRST, via.p, url LIMIT {BREADTH_LIMIT}",
        "crawl_depth_first": f"""WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages), k(i, path) AS (SELECT 0::BIGINT, [0] UNION ALL SELECT 2 * i + c, list_append(path, c) FROM k, n, (VALUES (1), (2)) t(c) WHERE i < n.n),
            o AS (SELECT i, row_number() OVER (ORDER BY path) AS nth FROM k)
            SELECT (row_number() OVER (ORDER BY nth) - 1)::INTEGER AS ord, '{BASE}/p' || i AS url FROM o, n WHERE nth <= {DEPTH_FIRST_LIMIT} AND i < n.n""",
        "crawl_attempts": f"{_NODES} SELECT url, final, ok, ok AS saved FROM f",
        "crawl_led": f"""WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages), k(i) AS (SELECT 0::BIGINT UNION SELECT unnest([2 * i + 1, 2 * i + 2]) FROM k, n WHERE i < n.n AND i % 13 <> 5)
            SELECT '{BASE}/p' || i AS url, '{BASE}/p' || CASE WHEN i < n AND i % 13 = 5 THEN (i - 1) // 2 ELSE i END AS final, i < n AS ok, i < n AND i % 13 <> 5 AS saved FROM k, n""",
        "crawl_visited": f"""WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages), k(i) AS (SELECT unnest([0, 5, 6])::BIGINT UNION SELECT unnest([2 * i + 1, 2 * i + 2]) FROM k, n WHERE i < n.n AND i <> 2),
            {_NODES.split("FROM k, n WHERE i < n.n),", 1)[1].replace("FROM k, n)", "FROM (SELECT i FROM k UNION SELECT 2) k, n)", 1)} SELECT DISTINCT unnest([url, final]) AS url FROM f""",
        "href_resolve": f"""SELECT page_id, form, CASE form WHEN 0 THEN o || regexp_replace(p, '[^/]*/[^/]*$', '') || 'x' WHEN 1 THEN o || f || 'b' WHEN 2 THEN o || '/s?q#f' WHEN 3 THEN o || '/z' WHEN 4 THEN o || f || 'c/' WHEN 5 THEN o || '/b/'
            WHEN 6 THEN {_CLEAN.format("url")} || '?q=1' WHEN 7 THEN split_part(url, '#', 1) || '#f' WHEN 8 THEN regexp_extract(url, '^[a-z]+:') || '//other.example.org/q' WHEN 9 THEN 'mailto:x@y' WHEN 10 THEN 'http://h.example/a/../b' ELSE o || f || 'e%20f' END AS full
            FROM (SELECT page_id, url, unnest(range(12))::INTEGER AS form, {_HOST} AS o, substr({_CLEAN.format("url")}, len({_HOST}) + 1) AS p, regexp_replace(substr({_CLEAN.format("url")}, len({_HOST}) + 1), '[^/]*$', '') AS f FROM pages)""",
        "url_resolve": f"""SELECT page_id, form, CASE form WHEN 0 THEN o || f || 'e%20f' WHEN 1 THEN o || '/a/b' WHEN 2 THEN o || f || 'ab' WHEN 3 THEN CASE WHEN s THEN 'http://x/' ELSE o || f || 'x' END WHEN 4 THEN 'https://ex.com/' WHEN 5 THEN 'http://u:p@x.example/q?%27' WHEN 6 THEN 'http://127.0.0.1/'
            WHEN 7 THEN 'http://[::1]:8080/' WHEN 8 THEN CASE WHEN s THEN 'https://b.example/' ELSE 'http://b.example:443/' END WHEN 9 THEN split_part(url, '#', 1) WHEN 10 THEN {_CLEAN.format("url")} || '?' WHEN 11 THEN split_part(url, '#', 1) || '#x%20y'
            WHEN 12 THEN o || f || '%C3%A9/%F0%9F%99%82?%C3%A9' WHEN 14 THEN 'mailto:a b' WHEN 15 THEN CASE WHEN s THEN 'http://r/' ELSE o || '/r' END WHEN 16 THEN 'http://xn--bcher-kva.example/' END AS href
            FROM (SELECT page_id, url, starts_with(url, 'https:') AS s, unnest(range(17))::INTEGER AS form, {_HOST} AS o, regexp_replace(substr({_CLEAN.format("url")}, len({_HOST}) + 1), '[^/]*$', '') AS f FROM pages)""",
        "links_below": f"{_BELOW} SELECT page_id, pos, link FROM l",
        "page_live_links_below": f"{_BELOW} SELECT page_id, pos, link FROM l",
        "cache_pages": f"SELECT page_id, {_FILE} || '.json' AS filename, complete, {_STILL_FRESH} AS fresh FROM {_RECORDS}",
        "cache_folder": f"""SELECT {_FILE} || '.json' AS filename, url, {_TITLE} AS title, CASE WHEN page_id % 17 = 3 THEN NULL WHEN page_id % 19 = 4 THEN 'no time' ELSE {_ISO.format('made')} END AS crawledAt, CASE WHEN page_id % 23 <> 5 THEN md5(html) END AS html_md5,
            CASE WHEN page_id % 7 <> 2 THEN '# ' || {_TITLE} END AS md, complete, {_STILL_FRESH} AS fresh FROM {_RECORDS} QUALIFY row_number() OVER (PARTITION BY {_FILE} ORDER BY page_id DESC) = 1""",
        "cache_redirect_folder": f"""SELECT max(url) AS source, max(url) || '/"to"' AS target FROM (SELECT *, {_FILE} AS file FROM pages WHERE page_id % 3 = 1) GROUP BY file""",
        "cache_counts": f"SELECT count(*) FILTER ({_STILL_FRESH})::BIGINT AS fresh, count(*) FILTER (NOT {_STILL_FRESH})::BIGINT AS stale FROM {_RECORDS}",
        "cache_resume": f"{_LINKS}, fresh AS (SELECT page_id, url FROM {_RECORDS} WHERE {_STILL_FRESH}) SELECT DISTINCT link AS url FROM l WHERE page_id IN (SELECT page_id FROM fresh) AND link NOT IN (SELECT url FROM fresh)",
        "cache_redirects": f"SELECT url AS source, url || '/to' AS target, {_ISO.format('made')} AS cached_at FROM {_RECORDS} WHERE page_id % 29 <> 7 AND NOT coalesce(epoch_us(TIMESTAMP '2024-01-15') - epoch_us(made) >= {TTL * 1_000_000}, false)",
        "regenerate_counts": "SELECT count(*) FILTER (page_id % 23 <> 5)::BIGINT AS success, count(*) FILTER (page_id % 23 = 5)::BIGINT AS error FROM pages",
        "regenerate_order": f"SELECT url, row_number() OVER (ORDER BY encode({_FILE} || '.json'))::BIGINT AS place FROM (SELECT * FROM pages QUALIFY row_number() OVER (PARTITION BY {_FILE} ORDER BY page_id DESC) = 1) WHERE page_id % 23 <> 5",
        "run_summary": f"SELECT 4::BIGINT AS totalPages, 3::BIGINT AS cachedPages, 4::BIGINT AS newlyFetchedPages, '2024-01-15T00:00:00.000Z' AS crawledAt, '{SITE.base_url}' AS baseUrl, count(*)::BIGINT AS n_pages, md5(string_agg(url, ' ' ORDER BY page_id)) AS pages_md5 FROM pages",
        "corpus_whole": f"SELECT md5(c) AS md5, length(c)::BIGINT AS n_points FROM (SELECT '# Documentation' || chr(10) || chr(10) || '**Generated:** 2024-01-15T00:00:00.000Z' || chr(10) || '**Total Pages:** 3' || chr(10) || chr(10) || '---' || chr(10) || string_agg(chr(10) || chr(10) || chr(10) || {_TITLE}, '' ORDER BY page_id) AS c FROM pages)",
        "corpus_file": f"""WITH v AS (SELECT page_id::BIGINT AS seq, chr(10) || chr(10) || {fm.format(_TITLE, repr(''))} || chr(10) || html AS v FROM pages)
            SELECT seq, (length('# Documentation' || '**Generated:** 2024-01-15T00:00:00.000Z' || '**Total Pages:** 3' || '---') + 7 + coalesce(sum(octet_length(encode(v)) + 1) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS begin, octet_length(encode(v))::BIGINT AS n_bytes, md5(v) AS md5 FROM v""",
        "corpus_headers": "SELECT h || chr(10) || '**Cached Pages:** ' || (n - 1) || chr(10) || '**Newly Fetched Pages:** 1' || t AS crawl, h || chr(10) || '**Regenerated from cache:** true' || t AS regenerated, h || t AS sample FROM (SELECT n, '# Documentation' || chr(10) || chr(10) || '**Generated:** 2024-01-15T00:00:00.000Z' || chr(10) || '**Total Pages:** ' || n AS h, chr(10) || chr(10) || '---' || chr(10) AS t FROM (SELECT count(*) AS n FROM pages))",
        "utf16_sizes": "SELECT doc_id, (length(text) + 5)::BIGINT AS n_units, printf('%.2f', 300 * (length(text) + 5) / 1024.0 / 1024.0) AS megabytes FROM documents",
        "content_markdown": f"SELECT page_id, {fm.format(_TITLE, "chr(10) || '**Breadcrumb:** Home > Here'")} || chr(10) || {_trimmed(_TITLE)} || chr(10) || chr(10) || 'text' AS md FROM pages",
        "sample_pages": f"SELECT (4 - page_id)::INTEGER AS ord, url, {_PLAIN_TITLE} AS title, {_H1} AS heading, length({_TEXT})::BIGINT AS text_length, regexp_replace(({_TEXT})[1:300], '\n+', chr(10), 'g') AS preview FROM pages WHERE page_id < 5",
        "page_text": f"SELECT page_id, {_PLAIN_TITLE} AS title, {_H1} AS heading, {_TEXT} AS text, NULL::VARCHAR AS error FROM pages",
        "page_markdown": rf"""WITH {_blocks_sql()},
            m AS (SELECT page_id, string_agg(chr(10) || chr(10) || repeat('**', n) || {_marked(_spaced("text"))} || CASE WHEN br THEN chr(10) ELSE '' END || repeat('**', n), '' ORDER BY k) AS body FROM b GROUP BY page_id)
            SELECT page_id, '# ' || CASE WHEN h1 = '' THEN title ELSE h1 END || chr(10) || '**URL:** ' || url || chr(10) || '---' || chr(10) || {_marked(_spaced("ad"))} || chr(10) || chr(10) || '# ' || {_marked(_spaced("h1"))} || coalesce(body, '') AS md FROM s LEFT JOIN m USING (page_id)""",
        "page_breadcrumb": f"SELECT page_id, array_to_string(list_concat(['Home'], list_filter(list_transform(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a [^>]*>([^<]*)</a>', 1), lambda x: trim({_entities('x')})), lambda x: x <> '')), ' > ') AS trail FROM pages",
        "page_live_links": f"{_LINKS} SELECT page_id, pos, link FROM l",
        "page_cleaned": f"""SELECT page_id, {_said("replace(html, '<article>', 'L1L2L3 L4L5<article>')")} AS text FROM pages""",
        "page_cleaned_html": f"SELECT page_id, '<p id=\"a\">' || {_TITLE} || '</p><!-- c --><br><img src=\"x.png\">' AS html FROM pages",
        "page_tree": f"""WITH u AS (SELECT page_id, string_split(regexp_replace(replace(regexp_extract(html, '(?s)<article>(.*?)(?:</article>|\\z)', 1), '<p>', chr(8232)), '<[a-z/!][^>]*(?:>|\\z)', '', 'g'), chr(8232)) AS parts FROM pages),
            e AS (SELECT page_id, list_transform(parts, lambda x: replace(replace(replace({_entities("x")}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS p FROM u)
            SELECT page_id, '<p>k</p>' || p[1] || '<table>' || CASE WHEN len(p) > 1 THEN '<tbody><tr><td>' || array_to_string(p[2:], '</td></tr><tr><td>') || '</td></tr></tbody>' ELSE '' END || '</table><b>a</b><div><b>' || p[1] || '</b>c</div><p>1<b>2<i>' || p[1] || '</i></b><i>4</i>5</p><a href="x">d</a><div><a href="x"></a><a href="y">' || p[1]
                || '</a></div><select><option>e</option><option>fg</option></select><dl><dt>h</dt><dd>i</dd><dt>j</dt></dl>' AS html FROM e""",
        "page_structure": f"SELECT page_id, '#' || chr(10) || '**URL:** ' || url || chr(10) || '---' || chr(10) || '## ' || {_marked(_PLAIN_TITLE)} || chr(10) || chr(10) || 'a **b** _c_ [d](/l)' || chr(10) || chr(10) || '*   e' || chr(10) || '*   f' || chr(10) || chr(10) || '```' || chr(10) || 'g' || chr(10) || '  h' || chr(10) || '```' || chr(10) || chr(10) || '* * *' AS md FROM pages",
        "markdown_normalize": rf"""WITH x AS (SELECT doc_id, ' ' || chr(10) || chr(10) || chr(9) || replace(text, '. ', '.  ' || chr(160) || repeat(chr(10), 4) || '  ') || chr(9) || chr(10) || ' ' || chr(10) || chr(12288) AS t FROM documents)
            SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[{_SPACE}]+(\n|\z)', '\1', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '\A[{_SPACE}\n]+|[{_SPACE}\n]+\z', '', 'g') AS md FROM x""",
        "text_sizes": r"SELECT doc_id, length(text)::BIGINT AS n_points, octet_length(encode(text))::BIGINT AS n_bytes, regexp_replace(text[1:300], '\n+', chr(10), 'g') AS preview FROM documents",
        "frontmatter": "SELECT page_id, " + fm.format(f"CASE WHEN page_id % 3 = 0 THEN {_TITLE} ELSE 'H ' || {_TITLE} END", "CASE WHEN page_id % 2 = 0 THEN chr(10) || '**Breadcrumb:** Home > Page ' || page_id ELSE '' END") + " AS front FROM pages",
        "corpus_concat": f"SELECT page_id::BIGINT AS seq, chr(10) || chr(10) || {fm.format(_TITLE, repr(''))} AS value FROM pages UNION ALL SELECT {-(1 << 62)}::BIGINT, '# Documentation' || chr(10) || chr(10) || '**Generated:** 2024-01-15T00:00:00.000Z' || chr(10) || '**Total Pages:** 3' || chr(10) || '**Cached Pages:** 1' || chr(10) || '**Newly Fetched Pages:** 2' || chr(10) || chr(10) || '---' || chr(10)",
    }
