"""Spelling variants by sorted-list dynamic programming.

Words within one edit of each other share the first half of the shorter one or the rest
of it at the end. So words are dealt by length and half, once as they stand and once reversed, and a
bucket holds its groups as one sorted list. Banded edit-matrix rows go down that list: words
that share a prefix (adjacent LCPs at least its length) share the row, which is worked out
once for each asking word, and a range whose prefix has no cell of one edit or less is
skipped as a whole. All asking words of a bucket go down together, one code point at a time.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import ship, table
from acuity.session import stored

LETTERS = "[A-Za-zÀ-ÿ]"
_STEP = 8192  # words that go down the list together


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_count: int = 2, every: int = 31
) -> DataFrame:
    """(word, n) of the letter runs of whole texts, A-Z lowered, that are long and frequent enough.

    A run whose CRC-32 with its document's id is divisible by ``every`` loses the code point that the
    CRC-32 picks. Each occurrence counts. A NULL text has no run, a NULL id counts as
    the empty text. Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # shorter runs can't give a word that is long enough
    runs = rows.select("id", F.explode(F.regexp_extract_all(low, F.lit(f"({LETTERS}{{{least_length},}})"), F.lit(1))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    words = runs.withColumn("h", h).select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return words.where((F.char_length("word") >= least_length) & (F.col("n") >= least_count))


def sorted_list(groups: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, code points, start of each word, length, LCP with the word before; -1 at a group's first)."""
    order = np.array(sorted(range(len(words)), key=lambda i: (groups[i], words[i])), np.int64)
    length = np.array([len(words[i]) for i in order], np.int64)
    codes = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
    start = np.cumsum(length) - length
    lcp = np.full(len(words), -1, np.int64)
    alike = np.flatnonzero(groups[order][1:] == groups[order][:-1]) + 1
    depth = 0
    while len(alike):
        lcp[alike] = depth
        alike = alike[np.minimum(length[alike], length[alike - 1]) > depth]
        alike = alike[codes[start[alike] + depth] == codes[start[alike - 1] + depth]]
        depth += 1
    return order, codes, start, length, lcp


def one_edit(
    codes: np.ndarray, start: np.ndarray, length: np.ndarray, lcp: np.ndarray, asking: np.ndarray, listed: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(asking, listed) places of the sorted list with an edit distance of exactly one, in a group.

    A row of the matrix at depth d holds the distances of the list's prefix of d code points
    to the asking word's prefixes of d-1, d and d+1; what is over one counts as two.
    """
    first = np.flatnonzero(lcp < 0)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in range(0, len(asking), _STEP):
        q = asking[part : part + _STEP]
        group = np.searchsorted(first, q, side="right")
        lo, hi = first[group - 1], np.append(first, len(lcp))[group]
        band = np.tile(np.array([2, 0, 1], np.int8), (len(q), 1))
        depth = 0
        while len(q):
            m = length[q]
            # words that end here stand first in their range
            ends = length[lo] == depth
            off = m - depth + 1
            near = ends & (off >= 0) & (off <= 2)
            hit = np.flatnonzero(near)
            hit = hit[(band[hit, off[hit]] == 1) & listed[lo[hit]]]
            left.append(q[hit])
            right.append(lo[hit])
            lo = lo + ends
            alive = lo < hi
            q, lo, hi, band = q[alive], lo[alive], hi[alive], band[alive]
            # a range falls into those that share one code point more
            cuts = np.flatnonzero(lcp <= depth)
            a, b = np.searchsorted(cuts, lo, side="right"), np.searchsorted(cuts, hi)
            many = b - a + 1
            who = np.repeat(np.arange(len(q)), many)
            nth = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
            inner = a[who] + nth - 1
            low = np.where(nth == 0, lo[who], cuts[np.maximum(inner, 0)] if len(cuts) else 0)
            last = nth == many[who] - 1
            high = np.where(last, hi[who], cuts[np.minimum(inner + 1, len(cuts) - 1)] if len(cuts) else 0)
            q, above, m = q[who], band[who], length[q[who]]
            c = codes[start[low] + depth]

            def differs(j: np.ndarray | int, q=q, m=m, c=c) -> np.ndarray:
                inside = (j >= 0) & (j < m)
                return np.where(inside, codes[start[q] + np.clip(j, 0, m - 1)] != c, True).astype(np.int8)

            row = np.empty_like(above)
            row[:, 0] = np.minimum(above[:, 0] + differs(depth - 1), above[:, 1] + 1)
            row[:, 1] = np.minimum(np.minimum(above[:, 1] + differs(depth), above[:, 2] + 1), row[:, 0] + 1)
            row[:, 2] = np.minimum(above[:, 2] + differs(depth + 1), row[:, 1] + 1)
            # no cells beyond the asking word's end
            for k in range(3):
                row[depth + k > m, k] = 2
            depth += 1
            row = np.minimum(row, 2)
            # a range that holds only the asking word itself has nothing to tell
            goes = (row.min(axis=1) < 2) & ~((high - low == 1) & (low == q))
            q, lo, hi, band = q[goes], low[goes], high[goes], row[goes]
    return np.concatenate(left), np.concatenate(right)


def _solve(pdf: pd.DataFrame) -> pd.DataFrame:
    """(word, n_near, least) of a bucket: near words met there and the best of them."""
    words = pdf["view"].tolist()
    group = pd.factorize(pdf["cell"])[0]
    order, codes, start, length, lcp = sorted_list(group, words)
    pdf = pdf.iloc[order].reset_index(drop=True)
    m, half = pdf["m"].to_numpy(), pdf["half"].to_numpy()
    back = pdf["back"].to_numpy()
    asking = np.flatnonzero(pdf["asks"].to_numpy() & (length == m))
    a, b = one_edit(codes, start, length, lcp, asking, pdf["listed"].to_numpy())
    # a reversed pair that shares its first half as well is met in the other direction
    text = pdf["word"].to_numpy()
    again = np.array([back[i] and text[i][: half[i]] == text[j][: half[j]] for i, j in zip(a, b, strict=True)], bool)
    a, b = a[~again], b[~again]
    # words of one length ask each other; of two lengths only the shorter one asks
    longer = length[b] > length[a]
    one, other = np.concatenate((a, b[longer])), np.concatenate((b, a[longer]))
    pairs = pd.DataFrame({"word": text[one], "near": text[other], "near_n": pdf["n"].to_numpy()[other]})
    pairs = pairs.sort_values(["word", "near_n", "near"], ascending=[True, False, True], kind="stable")
    found = pairs.groupby("word", sort=False).agg(n_near=("near", "size"), near=("near", "first"), near_n=("near_n", "first"))
    return found.reset_index()[["word", "n_near", "near_n", "near"]]


def near_words(words: DataFrame, bucket: int = 50_000, most: int = 20_000) -> DataFrame:
    """(word, n_near, near_n, near): how many words are one edit away, and the most frequent of them.

    ``words`` has distinct (word, n) with words of two code points or more. ``bucket`` is about the
    rows of a task; a group of more than ``most`` words is dealt over several lists, and its
    words ask each of them.
    """
    ship(words.sparkSession)
    size = F.char_length("word")
    # m: the length of the shorter word of a pair
    both = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"))
    half = F.floor(F.col("m") / 2).cast("int")
    both = both.withColumn("half", half).withColumn("back", F.explode(F.array(F.lit(False), F.lit(True))))
    view = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    shared = F.when(F.col("back"), F.col("m") - F.col("half")).otherwise(F.col("half"))
    rows = both.withColumn("view", view).withColumn("key", F.substring(F.col("view"), F.lit(1), shared))
    rows = rows.withColumn("asks", F.char_length("word") == F.col("m"))
    group = ["back", "m", "key"]
    # a group needs a word that asks and another one
    size_of = rows.groupBy(*group).agg(F.count("*").alias("size"), F.max("asks").alias("any"))
    size_of = size_of.where((F.col("size") > 1) & F.col("any"))
    rows = rows.join(size_of.withColumn("lists", F.ceil(F.col("size") / most)).drop("size", "any"), group)
    home = F.pmod(F.xxhash64("word"), F.col("lists"))
    everywhere = F.when(F.col("asks"), F.sequence(F.lit(0).cast("long"), F.col("lists") - 1)).otherwise(F.array(home))
    rows = rows.withColumn("home", home).withColumn("list", F.explode(everywhere))
    rows = rows.withColumn("listed", F.col("list") == F.col("home"))
    cell = F.xxhash64(*group, "list")
    buckets = max(1, math.ceil(4 * words.count() / bucket))
    named = F.concat_ws("/", "back", "m", "key", "list")
    rows = rows.select(
        "word", "n", "m", "half", "back", "view", "asks", "listed", named.alias("cell"), F.pmod(cell, F.lit(buckets)).alias("bucket")
    )
    found = rows.groupBy("bucket").applyInPandas(_solve, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    met = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return met.select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def roots(forms: DataFrame, steps: int, folder: str | None = None) -> DataFrame:
    """(word, root) of a table (word, root) of first steps, whose ways are ``steps`` long at most.

    Ways are doubled, so their length takes its logarithm in rounds, each of them written.
    """
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        on = forms.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = forms.join(on, forms["root"] == on["at"], "left")
        forms = stored(moved.select("word", F.coalesce("further", "root").alias("root")), "roots", folder)
    return forms


def variants(words: DataFrame, times: int = 10, folder: str | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary of distinct (word, n).

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its
    most frequent near word (of equals the least by code points) if that has at least ``times`` its
    count. Its root is where forms lead to, the word itself without one. An empty vocabulary gives
    an empty result.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary", folder)
    facts = words.join(near_words(words), "word", "left")
    stands = F.col("near_n") >= times * F.col("n")
    facts = facts.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(stands, F.col("near")).alias("form"), F.when(stands, F.col("near_n")).alias("form_n"),
    )
    facts = stored(facts, "forms", folder)
    # each step multiplies the count
    low, high = words.agg(F.min("n"), F.max("n")).first()
    steps = int(math.log(high / max(low, 1), times)) + 1 if high and times > 1 else 1
    ways = roots(facts.where("form is not null").select("word", F.col("form").alias("root")), steps, folder)
    joined = facts.join(ways, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11(spark, folder: str) -> DataFrame:
    return variants(vocabulary(table(spark, folder, "documents")))


def op11_sql() -> str:
    """CRC-32 is worked out byte by byte; near words meet by what is left without one code point."""
    byte = "list_reduce(list_concat([i::UBIGINT], [0::UBIGINT for _ in range(8)]), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)"
    return f"""
WITH steps AS (SELECT list({byte} ORDER BY i) AS crc FROM range(256) r(i)),
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{LETTERS}+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
digits AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, times, xor(list_reduce(
      list_concat([4294967295::UBIGINT], [('0x' || x[2 * k + 1 : 2 * k + 2])::UBIGINT for k in range(length(x) // 2)]),
      lambda c, b: xor(c // 256, crc[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) AS h
  FROM digits, steps),
words AS (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (
  SELECT word, n, k, left(word, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
met AS (
  SELECT word, count(*) AS n_near, max(near_n) AS form_n, arg_min(near, (-near_n, near)) AS form FROM pairs GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words LEFT JOIN met USING (word)),
ways AS (
  {_ways()})
SELECT word, form, root, n, n_near, form_n FROM ways"""


def _ways(steps: int = 12) -> str:
    """Counts grow tenfold along forms, so twelve steps reach the end of any way."""
    at = ["f0"] + [f"f{k}" for k in range(1, steps + 1)]
    joins = " ".join(f"LEFT JOIN forms {b} ON {b}.word = {a}.form" for a, b in zip(at, at[1:], strict=False))
    last = reduce(lambda text, a: f"coalesce({a}.word, {text})", at[1:], "f0.word")
    return f"SELECT f0.*, {last} AS root FROM forms f0 {joins}"
