"""What each of five filters does to a corpus in every order in which they can stand.

A row of the text pass has one bit for each filter it fails. Rows are counted to cells of
equal part and bits at once, and only the cells meet the 120 orders: each cell is set
against all steps of all orders (long form), a running bit_or over the steps before tells
what an earlier filter has taken, conditional sums make a step's figures, and a sum over
a part's steps of one filter its share over all orders.

Results: a null text is an empty one (which fails A, and E where an earlier row is empty
too), a null source the part ''. Texts are compared by their SHA-256 over the whole
table. A row with a null doc_id is no earlier copy of another, and no other is one of it.
Rows that repeat a doc_id are rows of their own; with equal texts neither is the other's
earlier copy. Labels that repeat a doc_id hold if one of them does. An empty table gives no
rows. Of documents and labels only the named columns are read, whatever else they have.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import slices, texts, written

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2
CAPITALS, MARKS = bytes(range(65, 91)), b"#$%&*|"
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}


def failed(text: str) -> tuple[int, bytes]:
    """The bits of the filters A to D that text fails, and its digest.

    Words stand between ASCII white space, which is where bytes.split() cuts.
    """
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    bits = (
        BIT["A"] * (len(words) < MIN_WORDS)
        | BIT["B"] * (100 * len(set(words)) < MIN_DISTINCT * len(words))
        | BIT["C"] * (100 * capitals > MAX_CAPITALS * len(text))
        | BIT["D"] * (len(raw.translate(None, MARKS)) < len(raw))
    )
    return bits, hashlib.sha256(raw).digest()


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, part, bits (A to D) and digest of every row, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [failed(t) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b for b, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())], names=["doc_id", "part", "bits", "digest"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, bits int, digest binary")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits (A to E), and how many rows of them there are: n, good, toxic.

    The first copy of a text is found by a combining minimum, and meets its row by doc_id and
    digest, so a text with very many copies lies on no single key; neither do null doc_ids,
    which join nothing.
    """
    rows = written(judged(docs), "filter_audit")
    known = rows.where("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    found = known.join(marks, "doc_id", "left").join(first, ["doc_id", "digest"], "left")
    found = found.select("part", (F.col("bits") + F.when(F.col("first").isNull(), BIT["E"]).otherwise(0)).alias("bits"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    lone = rows.where("doc_id is null").select("part", "bits", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return found.unionAll(lone).groupBy("part", "bits").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step; a part has 32 cells at most, so no group is larger than 32 x 600 rows."""
    orders = F.array(*(F.lit("".join(p)) for p in itertools.permutations(FILTERS)))
    bit = F.create_map(*(F.lit(x) for pair in BIT.items() for x in pair))
    steps = cells(docs, labels).select("*", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.posexplode(F.split("filter_order", "")).alias("pos", "filter")).withColumn("step", F.col("pos") + 1)
    steps = steps.withColumn("hit", F.col("bits").bitwiseAND(F.element_at(bit, F.col("filter"))))
    before = Window.partitionBy("part", "bits", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("earlier", F.coalesce(F.bit_or("hit").over(before), F.lit(0)))
    fails, gone = F.col("hit") != 0, F.col("earlier") != 0
    total = lambda test, what="n": F.coalesce(F.sum(F.when(test, F.col(what))), F.lit(0))
    rows = steps.groupBy("part", "filter_order", "step", "filter").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(fails & (F.col("bits") == F.col("hit"))).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


_SPACES = r"[\x20\x09-\x0D]+"

ORACLE = rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}'), lambda w: w <> '') AS words FROM documents),
f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first, part, text, len(words) AS n_words, len(list_distinct(words)) AS n_distinct, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals FROM t),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
b AS (SELECT part, good, toxic, {{'A': n_words < 200, 'B': 100 * n_distinct < 50 * n_words, 'C': 100 * capitals > 2 * length(text), 'D': regexp_matches(text, '[#$%&*|]'), 'E': doc_id > first}} AS m FROM f LEFT JOIN l USING (doc_id)),
c AS (SELECT part, m.A AS a, m.B AS b, m.C AS c, m.D AS d, m.E AS e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM b GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM x p, x q, x r, x s, x t WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
s AS (SELECT c.*, filter_order, step::INTEGER AS step, filter_order[step] AS filter, list_filter([CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c.c THEN 'C' END, CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END], lambda v: v IS NOT NULL) AS fails FROM c, o, range(1, 6) r(step)),
u AS (SELECT *, list_contains(fails, filter) AS hit, list_has_any(fails, string_split(filter_order[:step - 1], '')) AS gone FROM s),
g AS (SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (hit AND len(fails) = 1), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost FROM u GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM g"""
