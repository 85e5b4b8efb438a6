"""Which pages a crawl takes: reachability by joins, and the exact order of a depth-first one."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.urls import canonical_url
from corpusmill.operators.dedup import dedup_versions
from corpusmill.sources.tables import written


#: Places that keys are hashed to where a round asks a table that holds all rounds.
PLACES = 1 << 20
#: Rows of all rounds up to which a round joins whole tables, which Spark then broadcasts or shuffles in a moment.
SMALL = 1_000_000


def asked_for(rows: DataFrame, key: Column, *asked: DataFrame) -> DataFrame:
    """The rows whose key is among asked (one column each), and few others: no more is needed to look asked keys up.

    Only the places that asked keys are hashed to are broadcast, PLACES at most whatever is
    asked, so a large table is read but not shuffled: what a round moves follows what it asks.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(PLACES)).cast("int")
    places = _union([a.toDF("__key") for a in asked]).where("__key is not null").select(place(F.col("__key")).alias("__place")).distinct()
    return rows.withColumn("__place", place(key)).join(F.broadcast(places), "__place", "left_semi").drop("__place")


def whole(rows: DataFrame, key: Column, *asked: DataFrame) -> DataFrame:
    """In place of asked_for() where all rows are few."""
    return rows


def resolve_redirects(urls: DataFrame, redirects: DataFrame) -> DataFrame:
    """urls with target: where a redirect leads, by one step; null without one. The last record of a source counts."""
    last = redirects.groupBy("source").agg(F.max_by("target", F.struct("cachedAt", "target")).alias("target"))
    return urls.join(last, urls["url"] == last["source"], "left").drop("source")


def frontier(links: DataFrame, visited: DataFrame, redirects: DataFrame, prefix: str) -> DataFrame:
    """Of links (url, ord): those not visited, not redirected to what is, and no version of what is.

    visited has url. Of the versions of a page one stays, by dedup_versions.
    """
    seen = visited.select("url").distinct()
    fresh = links.join(seen, "url", "left_anti")
    led = resolve_redirects(fresh, redirects).join(seen.select(F.col("url").alias("target")), "target", "left_anti")
    kept = dedup_versions(led.select(*links.columns), prefix)
    versioned = kept["canonical"] != kept["url"]
    canonical = dedup_versions(seen.withColumn("ord", F.lit(0)), prefix).select("canonical").distinct().withColumn("known", F.lit(True))
    out = kept.join(canonical, "canonical", "left").where(~(versioned & F.coalesce("known", F.lit(False))))
    return out.select(*links.columns)


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None) -> DataFrame:
    """url, depth of all that edges (src, dst) lead to from seeds (url), by breadth.

    Each round joins the last round's pages with the edges and writes what is new: as many
    rounds as the longest of the shortest paths, no state but the written table.
    """
    part = asked_for if edges.count() > SMALL else whole
    found = written(seeds.select("url").distinct().withColumn("depth", F.lit(0)), "reached")
    last, depth, rounds = found, 0, [found]
    while max_depth is None or depth < max_depth:
        depth += 1
        here = last.select(F.col("url").alias("src"))
        step = part(edges, F.col("src"), here).join(here, "src").select(F.col("dst").alias("url")).where("url is not null").distinct()
        step = step if part is whole else written(step, "step")
        seen = _union(rounds)
        last = written(step.join(part(seen, F.col("url"), step), "url", "left_anti").withColumn("depth", F.lit(depth)), "reached")
        if last.isEmpty():
            break
        rounds.append(last)
        if len(rounds) > 16:
            rounds = [written(seen.union(last), "reached")]
    return _union(rounds)


def reachable_within(edges: DataFrame, seeds: DataFrame, max_pages: int | None, cached: DataFrame | None = None) -> DataFrame:
    """url, depth, ord of the pages that a crawl by breadth fetches, max_pages at most; cached ones are free."""
    found = reachable(edges, seeds)
    if cached is not None:
        found = found.join(cached.select("url").distinct(), "url", "left_anti")
    first = edges.groupBy(F.col("dst").alias("url")).agg(F.min(F.struct("src", "pos")).alias("via"))
    ordered = found.join(first, "url", "left").orderBy("depth", "via.src", "via.pos", "url")
    return (ordered if max_pages is None else ordered.limit(max_pages)).select("url", "depth")


@dataclass(frozen=True)
class Rounds:
    """What a crawl by breadth has done: tried (url, final, ok, saved, round, number), visited (url, round, number, step), redirects."""

    tried: DataFrame
    visited: DataFrame
    redirects: DataFrame


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def crawl_rounds(links: DataFrame, there: DataFrame, seeds: DataFrame, prefix: str, leads: DataFrame, known: DataFrame, cached: DataFrame, max_pages: int | None = None) -> Rounds:
    """A crawl by breadth, round by round, each a few joins and written tables. What a round
    shuffles follows its links: of the tables of all pages and all rounds it takes what it asks for.

    links: src, dst, pos of the pages that are there (url). leads: source, target of what a
    fetch is led to. known: source, target, cachedAt of redirects known before. seeds: url,
    ord. cached: url of pages that are taken over and free. In a round, of the links found in
    the one before, those go on that frontier() takes; a version gives way to the page
    without it where that is there. Every attempt counts against max_pages and makes its url
    visited, also when it fails; one that is led elsewhere makes that visited too, and saves
    nothing if that was visited before or by an earlier attempt of the round.
    """
    leads = written(leads.groupBy("source").agg(F.max("target").alias("target")), "leads")
    found = written(there.select("url").distinct(), "there")
    answers = written(found.union(leads.join(found.withColumnRenamed("url", "target"), "target", "left_semi").select("source")).distinct(), "answers")
    queue = seeds.groupBy("url").agg(F.min(F.struct(F.lit(0).cast("long").alias("number"), F.col("ord").cast("long").alias("pos"))).alias("ord"))
    memo = [written(known.select("source", "target", F.col("cachedAt").cast("string").alias("cachedAt"), F.lit(-1).alias("round")), "memo")]
    visited = [written(cached.select("url").distinct().select("url", F.lit(-1).alias("round"), F.lit(0).cast("long").alias("number"), F.lit(0).alias("step")), "visited")]
    tried: list[DataFrame] = []
    room, round_, total = max_pages, 0, answers.count() + visited[0].count()
    while room is None or room > 0:
        part = asked_for if total > SMALL else whole
        kept = written if total > SMALL else (lambda df, name: df)
        canonical = canonical_url(F.col("url"), prefix)
        urls, plain = queue.select("url"), queue.select(canonical.alias("url"))
        led = kept(part(_union(memo), F.col("source"), urls, plain).select("source", "target", F.struct("round", "cachedAt").alias("cachedAt")), "led")
        every = _union(visited).select("url")
        seen = every if part is whole else written(part(every, F.col("url"), urls, plain, led.select("target")).union(part(every, canonical, plain)).distinct(), "seen")
        new = frontier(queue, seen, led, prefix)
        can = part(answers, F.col("url"), plain)
        new = new.withColumn("canonical", canonical).join(can.withColumnRenamed("url", "canonical").withColumn("answers", F.lit(True)), "canonical", "left")
        new = new.groupBy(F.when(F.col("answers"), F.col("canonical")).otherwise(F.col("url")).alias("url")).agg(F.min("ord").alias("ord"))
        # the page that a version gives way to may be visited itself, or led to what is
        new = new.join(seen.select("url"), "url", "left_anti")
        new = resolve_redirects(new, led).join(seen.select(F.col("url").alias("target")), "target", "left_anti").select("url", "ord").orderBy("ord.number", "ord.pos", "url")
        new = new if room is None else new.limit(room)
        goes = written(new.select("url", F.monotonically_increasing_id().alias("number")), "goes")
        n = goes.count()
        if not n:
            break
        led_to = kept(goes.join(part(leads, F.col("source"), goes.select("url")).withColumnRenamed("source", "url"), "url", "left").select("url", "number", F.coalesce("target", "url").alias("final")), "led_to")
        finals = led_to.select("final")
        there_now, old = (part(x, F.col("url"), finals).select(F.col("url").alias("final")).distinct() for x in (found, every))
        got = led_to.join(there_now.withColumn("ok", F.lit(True)), "final", "left").join(old.withColumn("old", F.lit(True)), "final", "left")
        first = written(got.where("ok").groupBy("final").agg(F.min(F.struct((F.col("final") != F.col("url")).alias("led"), "number")).alias("first")), "first")
        got = got.join(first, "final", "left").select("url", "final", F.coalesce("ok", F.lit(False)).alias("ok"), "number", (F.col("ok") & F.col("old").isNull() & (F.col("first.number") == F.col("number"))).alias("saved"))
        got = written(got.withColumns({"saved": F.coalesce("saved", F.lit(False)), "round": F.lit(round_)}), "tried")
        tried.append(got)
        own = got.select("url", "round", "number", F.lit(0).alias("step"))
        also = got.where("ok and final <> url").join(got.select(F.col("url").alias("final")), "final", "left_anti").groupBy("final").agg(F.min("number").alias("number")).select(F.col("final").alias("url"), F.lit(round_).alias("round"), "number", F.lit(1).alias("step"))
        visited.append(written(own.unionByName(also), "visited"))
        memo.append(written(got.where("ok and final <> url").select(F.col("url").alias("source"), F.col("final").alias("target"), F.lit("").alias("cachedAt"), "round"), "memo"))
        sources = got.where("saved").select(F.col("final").alias("src"), "number")
        queue = written(sources.join(part(links, F.col("src"), sources.select("src")), "src").where("dst is not null").groupBy(F.col("dst").alias("url")).agg(F.min(F.struct("number", F.col("pos").cast("long").alias("pos"))).alias("ord")), "queue")
        room, round_, total = None if room is None else room - n, round_ + 1, total + n
        if round_ % 16 == 0:
            visited, memo = [written(_union(visited), "visited")], [written(_union(memo), "memo")]
    empty = visited[0].limit(0).select("url", F.col("url").alias("final"), F.lit(False).alias("ok"), "number", F.lit(False).alias("saved"), "round")
    return Rounds(_union(tried) if tried else empty, _union(visited), _union(memo).select("source", "target"))


@dataclass
class Site:
    """What a depth-first crawl asks: the links of a page, where its fetch leads, whether it is there."""

    links: Callable[[str], list[str]]
    final: Callable[[str], str] = lambda url: url
    ok: Callable[[str], bool] = lambda url: True
    fails: Callable[[str], bool] = lambda url: False


@dataclass
class Crawl:
    """The state of a depth-first crawl and the pages it has taken, in order."""

    prefix: str
    max_pages: int | None = None
    visited: dict[str, None] = field(default_factory=dict)
    canonical: set[str] = field(default_factory=set)
    redirects: dict[str, str] = field(default_factory=dict)
    cached: set[str] = field(default_factory=set)
    fetched: int = 0
    saved: list[str] = field(default_factory=list)

    def version(self, url: str) -> str | None:
        m = re.search(re.escape(self.prefix) + r"/([0-9]+)/", url)
        return m and m[1]

    def without_version(self, url: str) -> str:
        return re.sub(re.escape(self.prefix) + r"/[0-9]+/", lambda m: self.prefix + "/", url, count=1)

    def full(self) -> bool:
        return self.max_pages is not None and self.fetched >= self.max_pages

    def take_cached(self, url: str) -> None:
        self.visited[url] = None
        self.canonical.add(self.without_version(url))
        self.cached.add(url)

    def run(self, site: Site, seeds: list[str]) -> None:
        """Visits seeds one after another, each with all it leads to. A stack stands for the calls."""
        for seed in seeds:
            if self.full():
                break
            stack = [iter([seed])]
            while stack:
                url = next(stack[-1], None)
                if url is None or len(stack) > 1 and self.full():
                    stack.pop()
                    continue
                more = self.visit(site, url)
                if more:
                    stack.append(iter(more))

    def visit(self, site: Site, url: str) -> list[str]:
        """Takes url, or not; gives the URLs to go on with."""
        if url in self.visited or self.full():
            return []
        if self.redirects.get(url) in self.visited:
            return []
        canonical = self.without_version(url)
        if self.version(url):
            if canonical in self.canonical:
                return []
            known = self.redirects.get(canonical)
            if known:
                return [] if known in self.visited else [canonical]
            if not site.fails(canonical):
                final = site.final(canonical)
                if final != canonical:
                    self.redirects[canonical] = final
                if site.ok(canonical):
                    return [] if final in self.visited else [canonical]
        if url in self.cached:
            return []
        self.visited[url] = None
        self.canonical.add(canonical)
        self.fetched += 1
        if site.fails(url):
            return []
        final = site.final(url)
        if final != url:
            self.redirects[url] = final
            if final in self.visited:
                return []
            self.visited[final] = None
            self.canonical.add(self.without_version(final))
        self.saved.append(final)
        return site.links(url)


#: Pages whose links are asked for in one job, and links that the driver keeps.
AHEAD, KEPT_LINKS = 500, 1_000_000


def crawl_depth_first(edges: DataFrame, seeds: list[str], prefix: str, max_pages: int | None = None, redirects: dict[str, str] | None = None, missing: frozenset[str] = frozenset(), cached: list[str] | None = None, failing: Callable[[str], bool] = lambda url: False) -> Crawl:
    """The exact pages of a depth-first crawl, whose order decides what a limit lets in.

    The order is sequential by nature, so this runs on the driver. It asks for the links of a
    page together with those of the pages that its siblings lead to, AHEAD at a time, so that
    jobs are far fewer than pages; use crawl_rounds() for link graphs of any size.
    """
    ahead, spark = redirects or {}, edges.sparkSession
    known: dict[str, list[str]] = {}
    waiting: deque[str] = deque(seeds, maxlen=AHEAD)

    def links(url: str) -> list[str]:
        at = ahead.get(url, url)
        if at not in known:
            if sum(map(len, known.values())) > KEPT_LINKS:
                known.clear()
            wanted = [at, *({ahead.get(u, u) for u in waiting} - known.keys() - {at})]
            known.update({u: [] for u in wanted})
            rows = edges.where(F.col("dst").isNotNull()).join(F.broadcast(spark.createDataFrame([(u,) for u in wanted], "src string")), "src").select("src", "pos", "dst").collect()
            for r in sorted(rows, key=lambda r: (r.src, r.pos)):
                known[r.src].append(r.dst)
            waiting.extendleft(reversed([x for u in wanted for x in known[u]][:AHEAD]))
        return known[at]

    crawl = Crawl(prefix, max_pages)
    for url in cached or []:
        crawl.take_cached(url)
    crawl.run(Site(links, lambda u: ahead.get(u, u), lambda u: u not in missing, failing), seeds)
    return crawl
