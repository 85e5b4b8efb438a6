"""Quality rules as a short-circuit cascade of native expressions.

A rule reads statistics of a text; each statistic is a built-in function of the whole text
and is made only for the rows that reach the first rule that reads it: every step of the
cascade is a CASE on "not rejected yet", so a row that a cheap rule rejects never pays for
a dear one. No shuffle, no Python and no UDF on the way.

The order comes from a sample: one row in SAMPLE_ONE_IN, by a hash of key and whole text,
over all files. One aggregate counts, for each set of rules that reject a row, the rows and
their characters, words and lines; the driver gets these counts alone (a row for each set
that occurs). A rule's cost is counted work, not time: WORK says what a step costs for a
character, a word, a line. Then, again and again, that rule comes next which rejects most
for its cost among the rows that are left, where a statistic that an earlier rule has made
costs nothing more. The order is the same in every run over the same table; the verdict is
the same in any order, because a row is kept only if no rule rejects it.

Words are runs of characters other than U+0020 and U+0009-U+000D. A repeated word is one
inside a 3-word window found twice or more in the text. Windows are compared by a 64-bit
hash first; equal hashes count only if the words are equal.

Defined results: a null or empty text has no words, all counts 0, and is rejected; a null
doc_id is passed on; repeated rows each give a row, with the same verdict; a very long text
is read whole; rules of equal gain go by name; where no row is sampled the rules keep the
order in which they are given; an empty table gives an empty result; other columns are not
read by quality(), and keep_good() carries them along inside one struct, where their names
clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import named, whole_row

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "A-Z"
SAMPLE_ONE_IN = 32


def count_of(text: Column, characters: str) -> Column:
    """How many characters of text are in a class of a regular expression."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("long")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")


def window_hashes(words: Column) -> Column:
    at = lambda i: F.get(words, i)
    return F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))
    )


def repeat_words(words: Column, hashes: Column) -> Column:
    """Words in 3-word windows that the text has twice or more.

    Most texts have no equal windows, which a hash set shows; only the others sort.
    """
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def repeated(pairs: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            words_equal = F.lit(True)
            for k in range(3):
                words_equal = words_equal & (F.get(words, a["p"] + k) == F.get(words, b["p"] + k))
            return F.coalesce((a["h"] == b["h"]) & words_equal, F.lit(False))

        return F.sort_array(
            F.transform(
                F.filter(pairs, lambda x, i: same(x, F.get(pairs, i - 1)) | same(x, F.get(pairs, i + 1))),
                lambda x: x["p"],
            )
        )

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
            lambda acc: acc["n"],
        )

    # transform over one element binds a value once, where a plain column would be written out at each use
    bound = F.transform(F.array(pairs), lambda x: covered(repeated(x)))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(F.get(bound, F.lit(0)))


@dataclass(frozen=True)
class Rule:
    """name, the test that is true of a row to reject, and the statistics that the test reads."""

    name: str
    rejects: Column
    needs: tuple[str, ...]


def default_rules() -> list[Rule]:
    n = F.col("n_words")
    return [
        Rule("few_words", n < 50, ("n_words",)),
        Rule("repeated_windows", 100 * F.col("n_repeat_words") > 50 * n, ("n_words", "n_repeat_words")),
        Rule("symbols", 10 * F.col("n_symbols") > n, ("n_words", "n_symbols")),
        Rule("repeated_lines", (F.col("n_dup_lines") >= 5) & (10 * F.col("n_dup_lines") > 3 * F.col("n_lines")), ("n_dup_lines", "n_lines")),
        Rule("capitals", 2 * F.col("n_capitals") > F.col("word_chars"), ("word_chars", "n_capitals")),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 40 * n), ("n_words", "word_chars")),
    ]


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")
#: What op7 owes for every row, whatever the cascade says.
BASE = STATISTICS[:5]
#: What each step reads, in an order in which it can be made; __words, __lines and __hashes are arrays on the way.
READS = {
    "__words": (), "__lines": (), "__hashes": ("__words",),
    "n_words": ("__words",), "word_chars": (), "n_symbols": (), "n_capitals": (),
    "n_lines": ("__lines",), "n_dup_lines": ("__lines",), "n_repeat_words": ("__words", "__hashes"),
}
#: Counted work of a step: units a character, a word and a line of the text (about nanoseconds of one core).
WORK = {
    "__words": (41, 0, 0), "__lines": (13, 0, 0), "__hashes": (0, 380, 0),
    "n_words": (0, 0, 0), "word_chars": (32, 0, 0), "n_symbols": (19, 0, 0), "n_capitals": (20, 0, 0),
    "n_lines": (0, 0, 0), "n_dup_lines": (0, 0, 90), "n_repeat_words": (0, 800, 0),
}


def step(name: str) -> Column:
    """A step as an expression of the text and of the steps that it reads."""
    text, words, lines, hashes = (F.col(c) for c in ("__text", "__words", "__lines", "__hashes"))
    return {
        "__words": lambda: words_of(text),
        "__lines": lambda: lines_of(text),
        "__hashes": lambda: window_hashes(words),
        "n_words": lambda: F.size(words).cast("long"),
        "word_chars": lambda: F.length(text) - count_of(text, r"\x20\x09-\x0D"),
        "n_symbols": lambda: count_of(text, SYMBOLS),
        "n_capitals": lambda: count_of(text, CAPITALS),
        "n_lines": lambda: F.size(lines).cast("long"),
        "n_dup_lines": lambda: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": lambda: repeat_words(words, hashes).cast("long"),
    }[name]()


def steps_for(names: Iterable[str]) -> list[str]:
    """The steps that make the given statistics, in order."""
    wanted = set(names)
    for name in reversed(READS):
        if name in wanted:
            wanted.update(READS[name])
    return [s for s in READS if s in wanted]


def judged(rows: DataFrame, ordered: list[Rule], always: tuple[str, ...] = ()) -> DataFrame:
    """rows, which have __text, with the statistics and __by: the first rule that rejects, or null.

    The steps of always are made for every row, any other one only where __by is still null
    when a rule asks for it. Steps stay columns of their own: as fields of one struct, each
    use of a field would be replaced by the expression behind it. The column __part stands
    in the way of filters for the same reason: a filter on __by that is pushed below the
    steps would have them written out inside it, and evaluated again for each element of an
    array. Tests of __by read it through kept().
    """
    made: set[str] = set()
    rows = rows.withColumn("__by", F.lit(None).cast("string"))
    for name in steps_for(always):
        rows = rows.withColumn(name, step(name))
        made.add(name)
    for rule in ordered:
        for name in steps_for(rule.needs):
            if name not in made:
                rows = rows.withColumn(name, F.when(F.col("__by").isNull(), step(name)))
                made.add(name)
        rows = rows.withColumn("__by", F.when(F.col("__by").isNotNull(), F.col("__by")).when(rule.rejects, F.lit(rule.name)))
    return rows.withColumn("__part", F.spark_partition_id())


def kept() -> Column:
    """Whether no rule rejects."""
    return F.col("__by").isNull() & (F.col("__part") >= 0)


@dataclass(frozen=True)
class Sampled:
    """Of the sampled rows that exactly the rules of mask reject: their number, and their characters, words and lines."""

    mask: int
    rows: int
    sizes: tuple[int, int, int]


def sample_counts(docs: DataFrame, rules: list[Rule], doc_id: str = "doc_id", text: str = "text", one_in: int = SAMPLE_ONE_IN) -> list[Sampled]:
    """What the hash sample says of the rules, a row for each set of rules that reject a row."""
    if len(rules) > 62:
        raise ValueError("at most 62 rules have a bit each")
    whole = F.coalesce(F.col(text), F.lit(""))
    key = [F.col(doc_id)] if doc_id in docs.columns else []
    # equal texts with other keys fall apart, so a hot group of copies is sampled by its share
    rows = docs.where(F.pmod(F.xxhash64(*key, whole), F.lit(one_in)) == 0).select(whole.alias("__text"))
    for name in steps_for({"n_words", "n_lines"}.union(*(r.needs for r in rules))):
        rows = rows.withColumn(name, step(name))
    mask = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        mask = mask + F.when(rule.rejects, F.lit(1 << k)).otherwise(0).cast("long")
    found = rows.select(mask.alias("mask"), F.length("__text").alias("c"), F.col("n_words").alias("w"), F.col("n_lines").alias("l"))
    counts = found.groupBy("mask").agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.sum("w").alias("w"), F.sum("l").alias("l")).collect()
    return [Sampled(r["mask"], r["n"], (r["c"], r["w"], r["l"])) for r in counts]


def work_of(names: Iterable[str], part: list[Sampled]) -> int:
    """Counted work of steps over the rows of part, and one unit a row for the test itself."""
    sizes = [sum(p.sizes[k] for p in part) for k in range(3)]
    return sum(w * n for name in names for w, n in zip(WORK[name], sizes, strict=True)) + sum(p.rows for p in part)


def rule_order(rules: list[Rule], sampled: list[Sampled], always: tuple[str, ...] = ()) -> list[tuple[Rule, int, int]]:
    """(rule, counted work, rows rejected) in the cascade's order, over the rows that reach the rule."""
    left, part, made, out = list(enumerate(rules)), sampled, set(steps_for(always)), []
    while left:
        if part:
            gains = []
            for k, rule in left:
                work = work_of([s for s in steps_for(rule.needs) if s not in made], part)
                gone = sum(p.rows for p in part if p.mask >> k & 1)
                gains.append((-gone / work, work, rule.name, k, rule, gone))
            _, work, _, k, rule, gone = min(gains, key=lambda g: g[:3])
        else:
            (k, rule), work, gone = left[0], 0, 0
        out.append((rule, work, gone))
        left.remove((k, rule))
        made.update(steps_for(rule.needs))
        part = [p for p in part if not p.mask >> k & 1]
    return out


def ordered_rules(docs: DataFrame, rules: list[Rule] | None, doc_id: str, text: str, always: tuple[str, ...] = ()) -> list[Rule]:
    rules = default_rules() if rules is None else rules
    return [r for r, _, _ in rule_order(rules, sample_counts(docs, rules, doc_id, text), always)]


def quality(docs: DataFrame, rules: list[Rule] | None = None, doc_id: str = "doc_id", text: str = "text", statistics: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the asked-for statistics of every row, rejected_by and kept."""
    ordered = ordered_rules(docs, rules, doc_id, text, statistics)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return judged(rows, ordered, statistics).select("doc_id", *statistics, F.col("__by").alias("rejected_by"), kept().alias("kept"))


def keep_good(docs: DataFrame, rules: list[Rule] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that no rule rejects, with the columns of docs."""
    ordered = ordered_rules(docs, rules, doc_id, text)
    rows = docs.select(whole_row(docs).alias("__row"), F.coalesce(named(text), F.lit("")).alias("__text"))
    return judged(rows, ordered).where(kept()).select("__row.*")


def op7(docs: DataFrame) -> DataFrame:
    out = quality(docs, statistics=BASE)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *BASE, base.alias("base_failed"), (~base & F.col("kept")).alias("kept"))


KEPT_TESTS = "10 * n_symbols <= n_words AND NOT (n_dup_lines >= 5 AND 10 * n_dup_lines > 3 * n_lines) AND 2 * n_capitals <= word_chars AND word_chars BETWEEN 2 * n_words AND 40 * n_words"


def stats_sql(source: str) -> str:
    """DuckDB SQL of the statistics of a relation with doc_id and text, one row for each doc_id."""
    return rf"""
    t AS (SELECT doc_id, coalesce(text, '') AS text FROM {source}),
    w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
    g AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
    r AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
    c AS (SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT g.doc_id, g.i + k AS p FROM g JOIN r ON g.doc_id = r.doc_id AND g.g = r.g CROSS JOIN (VALUES (0), (1), (2)) v(k)) GROUP BY doc_id),
    stats AS (SELECT w.doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(l)::BIGINT AS n_lines,
        (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
        FROM w LEFT JOIN c ON w.doc_id = c.doc_id)"""


ORACLE = f"""WITH {stats_sql("documents")},
    b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM stats)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND {KEPT_TESTS}) AS kept FROM b"""
