"""Secrets in text: fixed patterns, and a battery of randomness tests over long runs.

Everything is a column expression; what is found in a text depends on no other row but
through the levels of the false-discovery control.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import fresh, table

# --- fixed values: kinds in the order of listing, and their patterns -----------
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the longest run, of 20 characters or more
HEX = r"[0-9a-f]{24,}"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")
# --- fixed values: alphabets as (pattern, size, sum of squares and of cubes of the
# --- frequencies of their characters in ordinary names and words) ----------------
ALPHABETS = (
    ("^[0-9]+$", 10, 1.0, 1.0),
    ("^([0-9a-f]+|[0-9A-F]+)$", 16, 0.11, 0.0135),
    ("^([a-z]+|[A-Z]+)$", 26, 0.066, 0.0055),
    ("^([A-Z2-7]+=*)$", 32, 0.066, 0.0055),
    ("^([a-z0-9]+|[A-Z0-9]+)$", 36, 0.064, 0.0052),
    ("^[A-Za-z]+$", 52, 0.062, 0.005),
    ("^[A-Za-z0-9]+$", 62, 0.06, 0.0048),
    ("", 64, 0.06, 0.0048),
)
#: how often neighbours differ in kind (digit, small, capital) in ordinary names
CHANGES = 0.12
#: lower ends of the length classes, each with false discoveries controlled for itself
LENGTHS = (20, 32, 64)
TOP = 400  # p-values in steps of a tenth of a power of ten, down to 10^-40

SPAN = "struct<start: int, rank: int, kind: string, end: int>"
CANDIDATE = "struct<start: int, end: int, len: int, level: int>"


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.transform(F.array(value), body)[0]


def _located(text: Column, pattern: str, group: int) -> Column:
    """(start, end, group text) of each match, from the matches and what lies between them."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("parts"),
    )
    empty = "struct<at: int, out: array<struct<start: int, end: int, part: string>>>"

    def walk(f: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.char_length(f["gaps"][i])
            end = start + F.char_length(f["hits"][i])
            one = F.struct(start.alias("start"), end.alias("end"), f["parts"][i].alias("part"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        zero = F.from_json(F.lit('{"at": 0, "out": []}'), empty)
        return F.aggregate(F.sequence(F.lit(0), F.size(f["hits"]) - 1), zero, step, lambda acc: acc["out"])

    nothing = F.array().cast("array<struct<start: int, end: int, part: string>>")
    return F.when(text.rlike(pattern), _let(found, walk)).otherwise(nothing)


def _spans(found: Column, kind: str) -> Column:
    rank = F.lit(KINDS.index(kind))
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), rank.alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    )


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, leftmost and non-overlapping for each kind."""
    assigned = F.filter(_located(text, ASSIGN, 2), lambda m: F.char_length(m["part"]) >= 6)
    return F.concat(_spans(assigned, "assign"), _spans(_located(text, ACCESS, 0), "access"), _spans(_located(text, HEX, 0), "hex")).cast(
        f"array<{SPAN}>"
    )


def _by_alphabet(token: Column, values: list[float]) -> Column:
    out = F.lit(float(values[-1]))
    for (pattern, *_), value in reversed(list(zip(ALPHABETS[:-1], values[:-1], strict=True))):
        out = F.when(token.rlike(pattern), F.lit(float(value))).otherwise(out)
    return out


def _upper_tail(z: Column) -> Column:
    """-log10 of the normal distribution's upper tail at z, to a few thousandths (Abramowitz and Stegun 26.2.17)."""
    x = F.greatest(z, F.lit(0.0))
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return (x * x / 2 + 0.5 * math.log(2 * math.pi)) / math.log(10) - F.log10(poly)


def level(token: Column) -> Column:
    """Evidence that a token is random: -10 log10 p, whole, from 0 to ``TOP``.

    The hypothesis held against it is that the token is an ordinary name of its alphabet.
    Chi-squared: its characters are spread more evenly than those of names. Runs: digits,
    small and capital letters take turns more often. The two normal scores count alike.
    Serial correlation: a token whose neighbours depend on each other (a count, an
    alphabet) is no secret, nor is a plain number.
    """
    chars = F.split(token, "")
    square = F.from_json(F.lit('{"last": "", "run": 0, "sum": 0}'), "struct<last: string, run: long, sum: long>")

    def add(acc: Column, c: Column) -> Column:
        run = F.when(c == acc["last"], acc["run"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(c.alias("last"), run.alias("run"), (acc["sum"] + 2 * run - 1).alias("sum"))

    squares = F.aggregate(F.array_sort(chars), square, add, lambda acc: acc["sum"].cast("double"))
    serial = F.from_json(
        F.lit('{"last": null, "x": 0, "xx": 0, "xy": 0, "first": 0}'), "struct<last: double, x: double, xx: double, xy: double, first: double>"
    )

    def pair(acc: Column, c: Column) -> Column:
        x = F.ascii(c).cast("double")
        return F.struct(
            x.alias("last"),
            (acc["x"] + x).alias("x"),
            (acc["xx"] + x * x).alias("xx"),
            (acc["xy"] + x * F.coalesce(acc["last"], F.lit(0.0))).alias("xy"),
            F.when(acc["last"].isNull(), x).otherwise(acc["first"]).alias("first"),
        )

    n = F.char_length(token).cast("double")
    sums = F.aggregate(chars, serial, pair)

    def correlation(a: Column) -> Column:
        spread = n * a["xx"] - a["x"] * a["x"]
        return F.when(spread > 0, (n * (a["xy"] + a["last"] * a["first"]) - a["x"] * a["x"]) / spread).otherwise(F.lit(1.0))

    s2, s3 = (_by_alphabet(token, [a[i] for a in ALPHABETS]) for i in (2, 3))
    pairs = n * (n - 1) / 2

    def tested(t: Column) -> Column:
        mean = n + 2 * pairs * t["s2"]
        spread = F.sqrt(4 * (pairs * (t["s2"] - t["s2"] * t["s2"]) + n * (n - 1) * (n - 2) * F.greatest(t["s3"] - t["s2"] * t["s2"], F.lit(0.0))))
        even = F.when(spread > 0, (mean - t["squares"]) / spread).otherwise(F.lit(0.0))
        turns = F.regexp_count(F.regexp_replace(token, "[^A-Za-z0-9]", ""), F.lit("[0-9]+|[a-z]+|[A-Z]+")) - 1
        chances = n - 1
        alternate = (turns - chances * CHANGES) / F.sqrt(chances * CHANGES * (1 - CHANGES))
        alternate = F.when(token.rlike("^([a-z]+|[A-Z]+)$"), F.lit(0.0)).otherwise(alternate)
        p = F.floor(10 * _upper_tail((even + alternate) / math.sqrt(2)))
        ordered = F.abs(t["r"]) * F.sqrt(n) > 4
        return F.when(ordered | token.rlike("^[0-9]+$"), F.lit(0)).otherwise(F.least(F.lit(TOP), p)).cast("int")

    facts = F.struct(s2.alias("s2"), s3.alias("s3"), squares.alias("squares"), _let(sums, correlation).alias("r"))
    return _let(facts, tested)


def candidates(text: Column) -> Column:
    """Long runs of a text with their evidence, in order."""
    return F.transform(
        _located(text, RUN, 0),
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), (m["end"] - m["start"]).alias("len"), level(m["part"]).alias("level")
        ),
    ).cast(f"array<{CANDIDATE}>")


def _class(length: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(LENGTHS[1:], 1):
        out = F.when(length >= least, F.lit(i)).otherwise(out)
    return out


def levels(docs: DataFrame, rate: float = 1e-4, text_col: str = "text") -> list[int]:
    """The least evidence that counts as random, for each length class.

    Benjamini and Hochberg's step-up rule at ``rate`` over all runs of the corpus, on a
    histogram of their p-values, which has a few hundred rows whatever the corpus.
    """
    found = docs.select(F.explode(candidates(F.col(text_col).cast("string"))).alias("c"))
    counts = found.groupBy(_class(F.col("c.len")).alias("cls"), F.col("c.level").alias("level")).count().collect()
    out = []
    for cls in range(len(LENGTHS)):
        own = {r["level"]: r["count"] for r in counts if r["cls"] == cls}
        total, above, cut = sum(own.values()), 0, TOP + 1
        for b in sorted(own, reverse=True):
            above += own[b]
            if total * 10 ** (-b / 10) <= rate * above:
                cut = b
        out.append(cut)
    return out


def secret_spans(text: Column, cuts: list[int]) -> Column:
    """All spans (start, rank, kind, end) of a text in order; NULL counts as the empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    bar = F.lit(cuts[0])

    def random(c: Column) -> Column:
        least = bar
        for i, cut in enumerate(cuts[1:], 1):
            least = F.when(_class(c["len"]) == i, F.lit(cut)).otherwise(least)
        return c["level"] >= least

    return F.array_sort(F.concat(base_spans(text), _spans(F.filter(candidates(text), random), "random").cast(f"array<{SPAN}>")))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of spans replaced by a mark; a text without spans stays as it is."""
    zero = F.from_json(F.lit('{"at": 0, "out": []}'), "struct<at: int, out: array<string>>")

    def step(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["at"]
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(clear, F.concat(acc["out"], F.array(between, F.lit(mark)))).otherwise(acc["out"]).alias("out"),
        )

    def end(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, zero, step, end)).otherwise(text)


def scan(docs: DataFrame, rate: float = 1e-4, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with an array ``spans`` of (start, rank, kind, end).

    Positions are code points, ends exclusive. NULL and empty texts have no spans. Rows are
    kept one for one, repeated ones too; an empty table gives an empty result; a column
    named ``spans`` is replaced.
    """
    return docs.withColumn("spans", secret_spans(F.col(text_col), levels(docs, rate, text_col)))


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with secrets replaced by a mark; n_chars, where there is one, follows the new text."""
    spans, new_text = fresh(docs, "spans", "new_text")
    found = docs.withColumn(spans, secret_spans(F.col("text"), levels(docs)))
    found = found.withColumn(new_text, redacted(F.col("text"), F.col(spans)))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col(new_text).alias("text"))
        elif c == "n_chars":
            new = F.char_length(new_text).cast(docs.schema["n_chars"].dataType)
            out.append(F.when(F.size(spans) > 0, new).otherwise(F.col("n_chars")).alias("n_chars"))
        else:
            out.append(F.col(f"`{c}`"))
    return found.select(*out)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5(spark, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
