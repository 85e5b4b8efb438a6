import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusmill.config import CrawlOptions, SiteProfile
from corpusmill.sources import folder, progress

SITE = SiteProfile()
SCHEMA = "stem string, json string, html string, md string"


def rows(n, mark=""):
    return [(f"p{k}", f'{{"url": "u{k}"}}', f"<p>é{k}{mark}", None if k % 5 == 0 else f"# {k}") for k in range(n)]


def save(spark, data, path, kinds="json,html,md", schema=SCHEMA):
    spark.createDataFrame(data, schema).repartition(4).write.format("stems").option("kinds", kinds).mode("append").save(path)


def load(spark, path, **options):
    return spark.read.format("stems").options(**options).load(path)


@pytest.fixture(autouse=True)
def known(spark):
    folder.register(spark)


def test_what_was_written_is_read(spark, tmp_path):
    path = f"{tmp_path}/a/b"
    save(spark, rows(23), path)
    assert sorted(map(tuple, load(spark, path).collect())) == sorted(rows(23))
    assert {f.rpartition(".")[2] for f in os.listdir(path)} == {"json", "html", "md"} and len(os.listdir(path)) == 23 * 3 - 5
    assert open(f"{path}/p1.html", encoding="utf-8").read() == "<p>é1"
    # a later record takes the place of an earlier one, with the files that it has
    save(spark, [("p1", "{}", None, "new"), (None, "{}", None, None)], path)
    assert tuple(load(spark, path).where("stem = 'p1'").first()) == ("p1", "{}", None, "new") and load(spark, path).count() == 23
    assert sorted(r.md or "" for r in load(spark, path, bodies="false").collect()) == [""] * 23


def test_conditions_on_names_open_no_other_files(spark, tmp_path):
    path = f"file://{tmp_path}/x"
    save(spark, rows(50), path)
    reader = folder.StemsReader(path, ["json", "html", "md"], True, ())
    left = list(reader.pushFilters([folder.EqualTo(("stem",), "p7"), folder.EqualTo(("md",), "x")]))
    assert left == [folder.EqualTo(("md",), "x")] and [p.stems for p in reader.partitions()] == [("p7",)]
    df = load(spark, path)
    for condition, want in (("stem = 'p7'", ["p7"]), ("stem in ('p1', 'p2', 'q')", ["p1", "p2"]), ("stem like 'p4%' and stem > 'p47'", ["p48", "p49"]), ("stem >= 'p8' and stem <> 'p9'", ["p8"]), ("stem < 'p1'", ["p0"]), ("stem is null", [])):
        assert sorted(r.stem for r in df.where(condition).collect()) == want, condition


def test_ranges_of_names_go_to_tasks(spark, tmp_path, monkeypatch):
    save(spark, rows(30), str(tmp_path))
    monkeypatch.setattr(folder, "RANGE", 8)
    parts = folder.StemsReader(str(tmp_path), ["json", "html", "md"], True, ()).partitions()
    assert [len(p.stems) for p in parts] == [8, 8, 8, 6] and parts[0].stems == tuple(sorted(r[0] for r in rows(30))[:8])
    assert parts[0].others[:2] == (("html",), ("html", "md"))


def test_odd_folders(spark, tmp_path):
    assert load(spark, f"{tmp_path}/none").count() == 0
    os.makedirs(f"{tmp_path}/f/sub.json")
    for name in ("a.redirect.json", "_summary.json", "b.html", ".c.json", "d.json"):
        (tmp_path / "f" / name).write_text("{broken")
    got = load(spark, f"{tmp_path}/f", without=progress.NO_PAGES)
    assert [tuple(r) for r in got.collect()] == [("d", "{broken", None, None)]
    options = CrawlOptions(output_dir=f"{tmp_path}/g")
    os.makedirs(f"{tmp_path}/g/progress")
    (tmp_path / "g/progress/d.json").write_text("{broken")
    row = progress.read_pages(spark, options).first()
    assert (row.filename, row.url, row.fresh, row.complete) == ("d.json", None, False, False)


def test_a_task_that_fails_leaves_no_half_records(spark, tmp_path):
    """One task dies between the files of a record: what is there is whole, and nothing else is there."""
    path = str(tmp_path / "out")
    save(spark, rows(10, "old"), path)
    # a name that is a folder can't be replaced by a file, so this task fails at its second file
    os.makedirs(f"{path}/p33.md")
    with pytest.raises(Exception, match="p33"):
        save(spark, rows(40, "new"), path)
    os.rmdir(f"{path}/p33.md")
    found = {r.stem: tuple(r) for r in load(spark, path).collect()}
    assert "p33" not in found and set(found) >= {f"p{k}" for k in range(10)}
    old, new = {r[0]: r for r in rows(10, "old")}, {r[0]: r for r in rows(40, "new")}
    assert all(r in (old.get(s), new[s]) for s, r in found.items())
    assert not [n for n in os.listdir(path) if n.startswith(".staging")]
    save(spark, rows(40, "new"), path)
    assert sorted(map(tuple, load(spark, path).collect())) == sorted(rows(40, "new"))


def test_pages_in_the_form_of_a_crawl(spark, tmp_path):
    now = dt.datetime(2024, 1, 2, 3, 4, 5, 678000, tzinfo=dt.timezone.utc)
    options = CrawlOptions(output_dir=str(tmp_path), now=now)
    pages = spark.createDataFrame(
        [(1, f"{SITE.base_url}/a", "T \"q\" \\ é\n\t ", "H", ["x", "y\"z"], "text", "<p>1", "# 1"), (2, f"{SITE.base_url}/a", "later", None, [], "", None, "# 2"), (3, f"{SITE.base_url}/b", "B", "", None, "", "<p>3", None)],
        "ord int, url string, title string, heading string, breadcrumb array<string>, text string, html string, md string",
    )
    progress.save_pages(pages, SITE, options)
    assert sorted(os.listdir(options.progress_dir)) == ["a.html", "a.json", "a.md", "b.html", "b.json", "b.md"]
    want = {"url": f"{SITE.base_url}/a", "title": "later", "heading": None, "breadcrumb": [], "text": "", "crawledAt": "2024-01-02T03:04:05.678Z"}
    assert open(f"{options.progress_dir}/a.json").read() == json.dumps(want, indent=2)
    progress.save_pages(pages.where("ord = 1"), SITE, options)
    got = open(f"{options.progress_dir}/a.json", encoding="utf-8").read()
    want |= {"title": "T \"q\" \\ é\n\t ", "heading": "H", "breadcrumb": ["x", "y\"z"], "text": "text"}
    assert json.loads(got) == want and got == json.dumps(want, indent=2, ensure_ascii=False)
    read = progress.read_pages(spark, options)
    assert sorted((r.filename, r.breadcrumb, r.complete, r.fresh) for r in read.collect()) == [("a.json", ["x", "y\"z"], True, True), ("b.json", [], True, True)]
    assert progress.read_pages(spark, options, bodies=False).where("complete and html = ''").count() == 2


def test_the_plan_has_no_join_and_no_exchange(spark, tmp_path):
    options = CrawlOptions(output_dir=str(tmp_path))
    plan = progress.read_pages(spark, options)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_redirects_of_many_sources(spark, tmp_path):
    options = CrawlOptions(output_dir=str(tmp_path))
    leads = spark.range(20).select(F.concat(F.lit(f"{SITE.base_url}/s"), F.col("id").cast("string")).alias("source"), F.lit(f"{SITE.base_url}/t").alias("target"))
    progress.save_redirects(leads.union(leads), SITE, options)
    assert len(os.listdir(options.progress_dir)) == 20 and progress.read_redirects(spark, options).count() == 20
    assert progress.lookup_redirect(spark, f"{SITE.base_url}/s7", SITE, options) == f"{SITE.base_url}/t"
    assert progress.read_pages(spark, options).count() == 0


def test_of_redirects_with_one_name_the_largest_source_stays(spark, tmp_path):
    options = CrawlOptions(output_dir=str(tmp_path))
    plain, anchored = f"{SITE.base_url}/s", f"{SITE.base_url}/s#top"
    # the order of the targets is not that of the sources: '#' comes before '/'
    leads = spark.createDataFrame([(plain, f"{plain}/to"), (anchored, f"{anchored}/to"), (anchored, f"{anchored}/later")], "source string, target string")
    progress.save_redirects(leads, SITE, options)
    assert [r[:2] for r in progress.read_redirects(spark, options).collect()] == [(anchored, f"{anchored}/to")]
