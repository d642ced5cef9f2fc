"""Text statistics, and a decision list over them learned by sequential covering.

The statistics, the counts the learner needs and the verdict are Spark expressions; the
learner reads histograms of a few hundred rows and gives back an ordered CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import table
from acuity.session import stored

# --- fixed values: symbols counted, and the base rule's bounds ------------------
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
#: what the learned rules may look at
FEATURES = (
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share",
    "upper_share", "digit_share", "mark_share", "distinct_share", "words_per_line",
)


#: a word, and a whole line that has one
_WORD, _LINE = r"[^\x20\x09-\x0D]+", r"(?<![^\n])[\x20\x09\x0B-\x0D]*+[^\x20\x09-\x0D][^\n]*+"


def _count(text: Column, others: str) -> Column:
    """How many characters are left without the ``others``."""
    return F.char_length(F.regexp_replace(text, others, ""))


def _windows(words: Column) -> Column:
    """64-bit hashes of the 3-word windows, by which they are told apart."""
    each = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(each)


def _in_order(windows: Column) -> Column:
    """(hash, position) in order where a window occurs twice or more, else NULL."""
    places = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(places))


def _repeated(windows: Column) -> Column:
    """How many words stand in a window that occurs twice or more, from what ``_in_order`` gives."""

    def place(x: Column, j: Column) -> Column:
        def same(k: Column) -> Column:
            return F.coalesce(F.get(windows, k)["h"] == x["h"], F.lit(False))

        return F.when(same(j - 1) | same(j + 1), x["i"])

    places = F.sort_array(F.filter(F.transform(windows, place), lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, i: Column) -> Column:
        return F.struct((i + 3).alias("end"), (acc["n"] + 3 - F.greatest(acc["end"] - i, F.lit(0))).alias("n"))

    return F.when(windows.isNull(), F.lit(0).cast("long")).otherwise(F.aggregate(places, zero, add, lambda acc: acc["n"]))


def statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with the base counts and the features of every whole text.

    A NULL text counts as one without words. Rows are kept one for one, repeated ones too;
    an empty table gives an empty result; other columns are left out.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    parts = docs.select(
        *kept,
        F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("words"),
        F.regexp_extract_all(text, F.lit(_LINE), F.lit(0)).alias("lines"),
        _count(text, f"[^{SYMBOLS}]+").cast("long").alias("n_symbols"),
        _count(text, "[^A-Z]+").alias("upper"),
        _count(text, "[^0-9]+").alias("digits"),
        _count(text, "[^!?.,;:]+").alias("marks"),
    )
    counts = parts.select(
        *kept, "n_symbols", "upper", "digits", "marks",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("lines")).alias("distinct_lines"),
        _windows(F.col("words")).alias("windows"),
    )
    # what more than one expression reads is a column, so it is worked out once
    rows = counts.withColumn("windows", _in_order(F.col("windows"))).withColumn("n_repeat_words", _repeated(F.col("windows")))

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))

    n_words, repeat = F.col("n_words"), F.col("n_repeat_words")
    return rows.select(
        *kept,
        n_words,
        "word_chars",
        "n_symbols",
        (F.col("n_lines") - F.col("distinct_lines")).cast("long").alias("n_dup_lines"),
        repeat,
        ((n_words < LEAST_WORDS) | (100 * repeat > 50 * n_words)).alias("base_failed"),
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        F.coalesce(F.try_divide(F.col("n_lines") - F.col("distinct_lines"), F.col("n_lines")).cast("double"), F.lit(0.0)).alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("upper", "word_chars").alias("upper_share"),
        share("digits", "word_chars").alias("digit_share"),
        share("marks", "word_chars").alias("mark_share"),
        share("n_distinct", "n_words").alias("distinct_share"),
        share("n_words", "n_lines").alias("words_per_line"),
    )


@dataclass(frozen=True)
class Literal:
    """feature > cut, or feature <= cut."""

    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


@dataclass
class DecisionList:
    """Conjunctions in order; a row that meets one is rejected by the first it meets."""

    rules: list[tuple[Literal, ...]] = field(default_factory=list)

    def number(self) -> Column:
        """Which rule rejects a row, from 1; 0 for none."""
        out = F.lit(0)
        for k, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(_all(rule), F.lit(k)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join([f"if {' and '.join(map(str, r))} then reject" for r in self.rules] + ["else keep"])


def _all(rule: tuple[Literal, ...]) -> Column:
    out = F.lit(True)
    for literal in rule:
        out = out & literal.column()
    return out


def learn(
    labelled: DataFrame,
    label_col: str = "quality",
    most_rules: int = 8,
    most_literals: int = 3,
    cuts: int = 32,
    precision: float = 0.95,
    least_rows: int = 10,
    folder: str | None = None,
) -> DecisionList:
    """Rules that reject rows with label 0, from all rows with a label and the ``FEATURES``.

    Two thirds of the rows grow a rule, literal by literal, by FOIL's gain over ``cuts``
    quantiles of each feature; the other third prunes it from the end while (rejected -
    kept) / covered doesn't fall, and admits it if its share of label 0 is ``precision`` or
    more. What a rule covers is taken away before the next one grows. Thirds go by a hash
    of the features, so copies fall together. No labels, or only one, give an empty list.
    """
    bad = (F.col(label_col) == 0).cast("long").alias("bad")
    chosen = labelled.where(F.col(label_col).isNotNull()).select(*FEATURES, bad)
    third = F.pmod(F.xxhash64(*FEATURES), F.lit(3)) == 0
    # equal rows are one row with a weight
    rows = stored(
        chosen.groupBy(*FEATURES).agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).withColumn("prune", third),
        "labelled", folder,
    )
    marks = [k / cuts for k in range(1, cuts)]
    found = rows.where("bad > 0").agg(*[F.percentile_approx(f, F.lit(marks), F.lit(10_000)).alias(f) for f in FEATURES]).first()
    other = rows.where("good > 0").agg(*[F.percentile_approx(f, F.lit(marks), F.lit(10_000)).alias(f) for f in FEATURES]).first()
    edges = {f: _edges([float(x) for r in (found, other) for x in (r[f] or [])]) for f in FEATURES}
    if not all(edges.values()):
        return DecisionList()
    binned = F.array(*[_bin(i, f, edges[f]) for i, f in enumerate(FEATURES)])
    grow = stored(rows.where(~F.col("prune")).withColumn("bins", binned), "grow", folder)
    out = DecisionList()
    left = F.lit(True)
    while len(out.rules) < most_rules:
        rule = _grow(grow.where(left), edges, most_literals, least_rows)
        rule = _prune(rows.where(F.col("prune") & left), rule)
        if not rule:
            break
        bads, goods = _weigh(rows.where(left), [rule])[0]
        held, lost = _weigh(rows.where(F.col("prune") & left), [rule])[0]
        if bads < least_rows or bads < precision * (bads + goods) or held < precision * (held + lost):
            break
        out.rules.append(rule)
        left = left & ~_all(rule)
    return out


def _edges(marks: list[float]) -> list[float]:
    """The quantiles and the middle between each two neighbours."""
    marks = sorted(set(marks))
    return sorted({*marks, *((a + b) / 2 for a, b in zip(marks, marks[1:], strict=False))})


def _bin(i: int, feature: str, edges: list[float]) -> Column:
    """How many edges lie below the feature's value."""
    value = F.col(feature).cast("double")
    below = F.aggregate(F.array(*map(F.lit, edges)), F.lit(0), lambda n, edge: n + (edge < value).cast("int"))
    return F.struct(F.lit(i).alias("f"), below.alias("b"))


def _weigh(rows: DataFrame, rules: list[tuple[Literal, ...]]) -> list[tuple[int, int]]:
    """(rows of label 0, of label 1) that each rule covers."""
    sums = [F.coalesce(F.sum(F.when(_all(r), F.col(c))), F.lit(0)) for r in rules for c in ("bad", "good")]
    flat = list(rows.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first())
    return list(zip(flat[::2], flat[1::2], strict=True))


def _grow(rows: DataFrame, edges: dict[str, list[float]], most: int, least: int) -> tuple[Literal, ...]:
    rule: tuple[Literal, ...] = ()
    while len(rule) < most:
        covered = rows.where(_all(rule)).select(F.explode("bins").alias("x"), "bad", "good")
        hist = covered.groupBy("x.f", "x.b").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
        if not hist:
            return ()
        first = hist[0]["f"]
        p0 = sum(r["bad"] for r in hist if r["f"] == first)
        n0 = sum(r["good"] for r in hist if r["f"] == first)
        if p0 == 0 or n0 == 0:
            return rule
        best: tuple[float, list[Literal], int] = (0.0, [], 0)
        for i, f in enumerate(FEATURES):
            own = sorted((r["b"], r["bad"], r["good"]) for r in hist if r["f"] == i)
            p = n = at = 0
            for j, edge in enumerate(edges[f]):
                while at < len(own) and own[at][0] <= j:
                    p, n, at = p + own[at][1], n + own[at][2], at + 1
                for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                    if pp < least:
                        continue
                    gain = pp * (math.log2(pp / (pp + nn)) - math.log2(p0 / (p0 + n0)))
                    literal = Literal(f, above, edge)
                    if gain > best[0]:
                        best = gain, [literal], nn
                    elif gain == best[0] and best[1] and (best[1][0].feature, best[1][0].above) == (f, above):
                        best[1].append(literal)
        if not best[1]:
            return rule
        # of cuts that part the rows alike, the middle one keeps farthest from either side
        rule = (*rule, best[1][len(best[1]) // 2])
        if best[2] == 0:
            return rule
    return rule


def _prune(rows: DataFrame, rule: tuple[Literal, ...]) -> tuple[Literal, ...]:
    if not rule:
        return rule
    forms = [rule[:k] for k in range(1, len(rule) + 1)]
    worth = [((p - n) / (p + n) if p + n else -1.0) for p, n in _weigh(rows, forms)]
    return forms[max(range(len(forms)), key=lambda k: (worth[k], -k))]


def judge(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """Add ``rule`` (the rule that rejects a row, 0 for none) and ``kept`` to the statistics."""
    return stats.withColumn("rule", rules.number()).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op2(spark, folder: str) -> DataFrame:
    stats = stored(statistics(table(spark, folder, "documents")), "statistics")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    rules = learn(stats.join(labels, "doc_id"))
    return judge(stats, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
