"""The column functions under names for SQL, and the links of pages as a view."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from corpusmill.config import SiteProfile
from corpusmill.functions.text import SPACE
from corpusmill.operators.links import page_links


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_functions(spark: SparkSession, profile: SiteProfile) -> list[str]:
    """Temporary SQL functions that the optimizer writes out in place."""
    quoted = re.sub(r"([^A-Za-z0-9/])", r"\\\1", profile.path_prefix)
    lit = _literal
    made = {
        "clean_url": "substring_index(substring_index(u, '#', 1), '?', 1)",
        "extract_version": f"nullif(regexp_extract(u, {lit(quoted + '/([0-9]+)/')}, 1), '')",
        "canonical_url": f"regexp_replace(u, {lit('(?s)^(.*?)' + quoted + '/[0-9]+/')}, {lit('$1' + re.sub(r'([\\$])', r'\\\1', profile.path_prefix) + '/')})",
        "normalize_markdown": f"trim({lit(SPACE + '\n')} FROM regexp_replace(array_join(transform(split(u, '\\n'), x -> rtrim({lit(SPACE)}, x)), '\\n'), {lit('\n{3,}')}, '\\n\\n'))",
        "js_trim": f"trim({lit(SPACE + '\n')} FROM u)",
    }
    for name, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(u STRING) RETURNS STRING RETURN {body}")
    return [*made]


def register_links(spark: SparkSession, pages: DataFrame, profile: SiteProfile, name: str = "page_links") -> str:
    """A view of page_id, url, pos, link over pages (page_id, url, html), by the same expressions as everywhere."""
    page_links(pages, profile).createOrReplaceTempView(name)
    return name
