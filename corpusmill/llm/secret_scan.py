"""Secret scans: fixed patterns, and the guess cost of values in a credential context.

Patterns find assignments, access keys and long hex runs. Besides, a value that stands
after a credential word (`pwd: ...`, `Authorization = ...`) is a secret if guessing it is
dear: dynamic programming over its characters finds the cheapest segmentation into
dictionary words, dates, repeats, keyboard walks and brute-force spans, and a value whose
cheapest segmentation needs at least 10**MIN_LOG10 guesses gives a span of kind `guess`,
unless it is a reference by its form: a variable, a template, a call, a file path, a web address.
A quoted value goes up to its closing quote on the line, any other up to white space, and
every character of it is costed, whatever its length (but punctuation that ends an unquoted
one). Dates are tried at every character, words come from a ranked list: common words of
passwords, then the whole words of a public tokenizer's vocabulary, in its order. The program
is linear in the length: words, walks and dates are bounded, and a repeat ends within
SPAN_CHARS of its start or of its last character.

Spans are code points of the whole text, end exclusive. Kinds are assign, access, hex,
guess, in this order. Per kind, matches are leftmost and do not overlap; a match that
fails its length test is dropped, and the search goes on behind it.

Defined results: a null or empty text has no spans; a null doc_id is passed on; repeated
rows each give a row, with the same spans; a value of any length is costed whole, and only
costs of short ones are remembered; of segmentations of equal cost only the cost counts; an empty table gives an empty result; other columns are not read by
scan(), and redacted() passes them on whatever their names.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import cache, lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusmill.llm.common import beside, named, restored, slices, texts

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
#: Each match of ASSIGN holds one of these in some case, each match of CONTEXT too.
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|private[_-]?key|access[_-]?key|auth(?:orization|entication)?|credentials?)["']?[ \t]*(?::|=>?|:=)[ \t]*(?:(?:bearer|basic)[ \t]+)?(?:(["'`])((?:\\.|(?!\1)[^\\\r\n])+)\1|["'`]?(\S+))""",
    re.I | re.A,
)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "auth", "credential")
#: Punctuation behind an unquoted value, which is no part of what is costed.
ENDS = ".,;:)}]>\"'`|"
MIN_LOG10 = 9.0
#: Values that say where a secret is, and are none: variables and templates, calls and members, file paths, plain web addresses.
REFERENCE = re.compile(
    r"""\$\{[^{}]*\}|\$\(.*\)|\$[A-Za-z_]\w*|%[A-Za-z_]\w*%|\{\{.*\}\}|<[A-Za-z][\w -]*>|(?:[A-Za-z_]\w*(?:\.|->|::))*[A-Za-z_]\w*\((?:[^()'"`]|["'][\w.-]*["'])*\)?|[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*\[["']?\w+["']?\]"""
    r"""|(?:process\.env|os\.environ|config|settings|self|this)(?:\.[A-Za-z_]\w*)+|(?:~|\.{1,2}|[A-Za-z]:)?(?:[/\\]\.?[A-Za-z][a-z0-9_-]*)+(?:\.[a-z]{1,5})+|(?:~|\.{1,2})?(?:/[a-z][a-z_-]*){2,}/?|https?://[a-z0-9.-]+(?::\d+)?(?:/[a-z0-9._-]*[a-z]{2}[a-z0-9._-]*)*/?""",
    re.A,
)

#: Words that passwords are made of more often than prose; they come first in the list.
FIRST_WORDS = (
    "password love admin welcome dragon monkey letmein master shadow login princess football baseball sunshine iloveyou superman "
    "michael jordan hello secret token user test guest root system server default change changeme example sample public private "
    "access key code pass word name mail"
).split()


@cache
def word_ranks(path: str) -> dict[str, int]:
    """Rank of each lower-case word of three letters or more: FIRST_WORDS, then the whole words of a BPE with word ends, by id."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    end = model["end_of_word_suffix"]
    words = (t.removesuffix(end) for t, _ in sorted(model["vocab"].items(), key=lambda x: x[1]) if t.endswith(end))
    ranks: dict[str, int] = {}
    for w in (*FIRST_WORDS, *words):
        if len(w) >= 3 and w.isascii() and w.isalpha():
            ranks.setdefault(w, len(ranks) + 1)
    return ranks


@cache
def longest_word(path: str) -> int:
    return max(map(len, word_ranks(path)))


#: Rows of a keyboard; walks go along them in either direction.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0987654321", "poiuytrewq", "lkjhgfdsa", "mnbvcxz", "zyxwvutsrqponmlkjihgfedcba", "1qaz2wsx3edc4rfv", "qazwsxedcrfv")
LEET = str.maketrans("4@310$57!", "aaeiossti")
YEAR, MONTH, DAY, BETWEEN = "(?:19|20)[0-9]{2}", "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])", "[-/.]?"
#: Each form of a date, and log10 of how many there are of it.
DATES = tuple(
    (re.compile(BETWEEN.join(form)), math.log10(n))
    for form, n in (((YEAR,), 120), ((YEAR, MONTH), 120 * 12), ((YEAR, MONTH, DAY), 365 * 120), ((DAY, MONTH, YEAR), 365 * 120), ((MONTH, DAY, YEAR), 365 * 120), ((DAY, MONTH, "[0-9]{2}"), 365 * 100), ((MONTH, DAY, "[0-9]{2}"), 365 * 100))
)
SPAN_CHARS = 32
#: log10 of the choice of a segment's kind, paid at each segment.
SEGMENT = math.log10(5)
#: Of an upper-case letter in a word, and of digits that stand for letters.
CAPITALS, LEETS = 0.3, 0.3
CACHED_CHARS = 64


def _alphabet(span: str) -> int:
    size = 26 * any("a" <= c <= "z" for c in span) + 26 * any("A" <= c <= "Z" for c in span) + 10 * any("0" <= c <= "9" for c in span)
    return size + 33 * any(33 <= ord(c) < 127 and not c.isalnum() for c in span) + 100 * any(ord(c) > 126 for c in span) or 1


def each_cost(value: str) -> float:
    """log10 guesses of a brute-force character of value."""
    return math.log10(max(_alphabet(value), 2))


def guess_cost(value: str, words: str) -> float:
    """log10 of the guesses of the cheapest segmentation of value; words: path of the vocabulary."""
    return _remembered(value, words) if len(value) <= CACHED_CHARS else _cheapest(value, words)


def _cheapest(value: str, words: str) -> float:
    n, low = len(value), value.lower()
    if len(low) != n:  # a few letters have two in lower case
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain, ranks, longest, each = low.translate(LEET), word_ranks(words), longest_word(words), each_cost(value)
    best = [0.0] + [math.inf] * n
    repeats = {unit: [0] * (n + 1) for unit in (1, 2, 3, 4)}  # how far each character equals that one unit on
    for unit, same in repeats.items():
        for i in range(n - unit - 1, -1, -1):
            same[i] = same[i + 1] + 1 if value[i] == value[i + unit] else 0
    brute_from = [math.inf] * (n + 1)  # the best cost of a segmentation whose last span is brute force and still open
    for i in range(n + 1):
        if brute_from[i] < best[i]:
            best[i] = brute_from[i]
        if i == n:
            break
        here = best[i] + SEGMENT
        brute_from[i + 1] = min(here, brute_from[i]) + each
        for k in range(3, min(longest, n - i) + 1):
            for form, extra in ((low, 0.0), (plain, LEETS)):
                rank = ranks.get(form[i : i + k])
                if rank:
                    best[i + k] = min(best[i + k], here + math.log10(rank + 1) + extra + CAPITALS * (value[i : i + k] != low[i : i + k]))
        if "0" <= value[i] <= "9":
            for form, cost in DATES:
                m = form.match(value, i)
                if m:
                    best[m.end()] = min(best[m.end()], here + cost)
        for unit, same in repeats.items():
            count = same[i] // unit + 1
            if count < 2 or unit > 1 and same[i] <= repeats[1][i] or unit == 4 and same[i] <= repeats[2][i]:
                continue  # no repeat, or one of a shorter unit over the same characters, which costs less
            few = SPAN_CHARS // unit + 1
            for c in range(2, count + 1) if count <= 2 * few else (*range(2, few + 1), *range(count - few, count + 1)):
                if c * unit >= 3:
                    best[i + c * unit] = min(best[i + c * unit], here + unit * each + math.log10(c + 1))
        for row in KEYBOARD:
            at = row.find(low[i])
            if at >= 0:
                k = 1
                while i + k < n and at + k < len(row) and low[i + k] == row[at + k]:
                    k += 1
                for length in range(3, k + 1):
                    best[i + length] = min(best[i + length], here + math.log10(len(KEYBOARD) * len(row) * length))
    return best[n]


#: Values of at most CACHED_CHARS characters: a few MB.
_remembered = lru_cache(10_000)(_cheapest)


def find_spans(text: str, words: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span of text by start, then kind as in KINDS."""
    found: list[tuple[int, int, str]] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    if (":" in text or "=" in text) and any(w in low for w in CONTEXT_WORDS):
        for m in CONTEXT.finditer(text):
            value = m[2] or m[3].rstrip(ENDS)
            if not REFERENCE.fullmatch(m[2] or m[3].rstrip(".,;")) and not REFERENCE.fullmatch(value) and guess_cost(value, words) >= MIN_LOG10:
                found.append((*m.span(2 if m[2] else 3), "guess"))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def scan(docs: DataFrame, words: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and an array of spans (start, end, kind) of each row. words: path of the vocabulary whose words are common."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = [[{"start": s, "end": e, "kind": k} for s, e, k in find_spans(t, words)] for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<start: int, end: int, kind: string>>")


def op2(docs: DataFrame, words: str) -> DataFrame:
    """The spans of scan() as counts, a digest of the base kinds, and one string."""
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"] != "guess")
    return scan(docs, words).select(
        "doc_id",
        *(of(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(F.transform(base, one), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", one), ",").alias("spans"),
    )


MARK = "[REDACTED]"


def redact(text: str, words: str) -> str:
    """text with every span replaced by MARK; overlapping or touching spans by one."""
    out, last, until = [], 0, -1
    for start, end, _ in find_spans(text, words):
        if start > until:
            out += [text[last:start], MARK]
        until = max(until, end)
        last = until
    return "".join([*out, text[last:]]) if out else text


def redacted(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", words: str | None = None) -> DataFrame:
    """docs with every secret replaced by MARK, and n_chars made anew where a text changed."""
    words = words or public_tokenizers.path("word_bpe_49k.json")
    rows = beside(docs, named(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            old = batch.column(1).to_pylist()
            new = [t and redact(t, words) for t in old]
            changed = [None if a == b else len(b) for a, b in zip(old, new, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, batch.schema.field(1).type), pa.array(changed, pa.int64())], names=["row", "text", "n"])

    found = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("n", LongType())]))
    new = {text: F.col("text")}
    if n_chars in docs.columns:
        new[n_chars] = F.coalesce(F.col("n").cast(docs.schema[n_chars].dataType), F.col("row").getField(n_chars))
    return restored(found, docs.columns, **new)
