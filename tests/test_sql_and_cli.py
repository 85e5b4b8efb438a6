from corpusmill.__main__ import main
from corpusmill.config import SiteProfile
from corpusmill.functions.sql import register_functions, register_links

SITE = SiteProfile()
B = SITE.base_url


def test_sql_functions(spark):
    register_functions(spark, SITE)
    row = spark.sql(f"SELECT clean_url('{B}/a?b#c') a, extract_version('{B}/12/a') b, canonical_url('{B}/12/13/a') c, normalize_markdown('\\n x  \\n\\n\\n\\ny\\t ') d, js_trim('\\u00a0 x\\n') e").first()
    assert tuple(row) == (f"{B}/a", "12", f"{B}/13/a", "x\n\ny", "x")


def test_sql_functions_of_a_prefix_with_quotes_and_marks(spark):
    odd = SiteProfile(base_url="https://h.example/it's\\(a$1)", path_prefix="/it's\\(a$1)")
    register_functions(spark, odd)
    row = spark.createDataFrame([(f"{odd.base_url}/12/a",)], "u string").selectExpr("extract_version(u)", "canonical_url(u)").first()
    assert tuple(row) == ("12", f"{odd.base_url}/a")


def test_links_view(spark):
    html = f"<a href='{SITE.path_prefix}/x#1'><a href='{SITE.path_prefix}/x'><a class=c href='../y'><a href='/other/y'><a href='HTTPS:{SITE.path_prefix}/e f'>"
    register_links(spark, spark.createDataFrame([(1, f"{B}/a/b", html)], "page_id int, url string, html string"), SITE)
    assert [tuple(r) for r in spark.sql("SELECT pos, link FROM page_links ORDER BY pos").collect()] == [(0, f"{B}/x"), (1, f"{B}/e%20f")]


def test_command(spark, tmp_path, capsys):
    link = f'<a href="{SITE.path_prefix}/a">a</a>'
    spark.createDataFrame([(B, f"<h1>Root</h1>{link}"), (f"{B}/a", "<h1>A</h1>")], "url string, html string").write.parquet(f"{tmp_path}/pages")
    for kept, new in ((0, 2), (2, 0)):
        assert main(["--pages", f"{tmp_path}/pages", "--output", f"{tmp_path}/out", "Infinity"]) == 0
        assert f"({kept} kept, {new} new)" in capsys.readouterr().out
    assert (tmp_path / "out" / "progress" / "index.md").read_text().startswith(f"# Root\n**URL:** {B}\n---\n")
    assert len(spark.read.text(f"{tmp_path}/out/llms-full.txt").collect()) > 10
