"""Language identification by rank-order profiles of character n-grams (Cavnar and Trenkle 1994)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from acuity.llm.common import fresh, remainder, ship, table

UNDECIDED = "und"
_EDGE = 1  # stands for the bounds of words; no letter has this code
_WIDTH = 21  # bits of a code point
_SLICE = 1 << 18
_LETTERS: list[np.ndarray] = []


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, with one edge around each run of letters."""
    if not text:
        return np.zeros(0, np.int64)
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = _LETTERS[0][codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    found = np.where(is_letter, codes, _EDGE)[keep].astype(np.int64)
    if not is_letter.any():
        return np.zeros(0, np.int64)
    edge = np.array([_EDGE])
    return np.concatenate((edge[: int(found[0] != _EDGE)], found, edge[: int(found[-1] != _EDGE)]))


def grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, count) of all 1- to 3-grams, by n-gram; an n-gram is packed into a long."""
    keys, counts = [], []
    for lo in range(0, len(codes), _SLICE):
        part = codes[lo : lo + _SLICE + 2]
        own = min(_SLICE, len(codes) - lo)
        one = part[:own]
        two = (part[:-1] << _WIDTH | part[1:])[:own]
        three = (part[:-2] << 2 * _WIDTH | part[1:-1] << _WIDTH | part[2:])[:own]
        middle = part[1:-1][:own]
        # an edge alone, and what reaches over an edge, is no n-gram of a word
        k = np.concatenate((one[one != _EDGE], two[two != (_EDGE << _WIDTH | _EDGE)], three[middle != _EDGE]))
        k.sort()
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
        keys.append(k[first])
        counts.append(np.diff(np.append(first, len(k))))
    return merge(keys, counts)


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) == 1:
        return keys[0], counts[0]
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, weights=np.concatenate(counts), minlength=len(found)).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams in order; of equals the lesser n-gram first."""
    if len(keys) > 4 * most:
        # those at or above the count of the last place
        floor = np.partition(counts, len(counts) - most)[len(counts) - most]
        sure = counts >= floor
        keys, counts = keys[sure], counts[sure]
    return keys[np.lexsort((keys, -counts))[:most]]


@dataclass
class Profiles:
    """Ranks of n-grams in each language: ``ranks`` [n-gram, language], ``penalty`` where there is none."""

    names: list[str]
    keys: np.ndarray
    ranks: np.ndarray
    depth: int
    penalty: int

    def score(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, lead over the next language), the last two from 0 to 1.

        The score is 1 less the out-of-place distance as a share of the greatest
        possible one. Of equally near languages the first by name is taken.
        """
        codes = letters(text)
        if not len(codes) or not self.names:
            return UNDECIDED, 0.0, 0.0
        top = ranked(*grams(codes), self.depth)
        at = np.minimum(np.searchsorted(self.keys, top), len(self.keys) - 1)
        ranks = np.where((self.keys[at] == top)[:, None], self.ranks[at], -1)
        away = np.abs(ranks - np.arange(len(top))[:, None])
        far = np.where(ranks < 0, self.penalty, np.minimum(away, self.penalty)).sum(axis=0) / (len(top) * self.penalty)
        best = int(np.argmin(far))
        others = np.delete(far, best)
        return self.names[best], float(1 - far[best]), float(others.min() - far[best]) if len(others) else 1.0


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", depth: int = 400) -> Profiles:
    """Profiles of the languages in ``lang_col`` from all whole texts; NULL labels and texts are left out.

    A task counts the n-grams of its texts by language, Spark adds the counts up and
    ranks them in salted parts, and ``depth`` n-grams a language come to the driver.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
        waiting: dict[str, list] = defaultdict(list)

        def settle(lang: str) -> None:
            keys, counts = grams(np.concatenate(waiting.pop(lang)))
            own = found[lang]
            own[0].append(keys)
            own[1].append(counts)
            if len(own[0]) > 16:
                found[lang] = tuple([x] for x in merge(*own))

        size: dict[str, int] = defaultdict(int)
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                codes = letters(text)
                if len(codes):
                    waiting[lang].append(codes)
                    size[lang] += len(codes)
                    if size[lang] > _SLICE:
                        settle(lang)
                        size[lang] = 0
        for lang in list(waiting):
            settle(lang)
        for lang, own in found.items():
            keys, counts = merge(*own)
            yield pd.DataFrame({"lang": lang, "gram": keys, "n": counts})

    counts = rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = [F.col("n").desc(), F.col("gram")]
    salt = F.pmod(F.xxhash64("gram"), F.lit(16))
    some = counts.withColumn("salt", salt).withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best)))
    top = some.where(F.col("r") <= depth).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    found = top.where(F.col("rank") <= depth).select("lang", "gram", "rank").collect()
    names = sorted({r.lang for r in found})
    keys = np.unique(np.array([r.gram for r in found], np.int64))
    ranks = np.full((len(keys), len(names)), -1, np.int64)
    for r in found:
        ranks[np.searchsorted(keys, r.gram), names.index(r.lang)] = r.rank - 1
    return Profiles(names, keys, ranks, depth, depth)


def identify(
    docs: DataFrame, profiles: Profiles, text_col: str = "text", keep: list[str] | None = None,
    added: tuple[str, str, str] = ("lang_pred", "score", "lead"),
) -> DataFrame:
    """The columns in ``keep`` (all by default) with lang_pred, score and lead of every whole text.

    A text that is NULL or has no letters is ``und`` with score 0, as is every text
    when no language was learned. Rows are kept one for one; an empty table gives an
    empty result; a column of ``docs`` named like a new one is replaced.
    """
    spark = ship(docs.sparkSession)
    sent = spark.sparkContext.broadcast(profiles)
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    (whole,) = fresh(docs, "whole")
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text_col).cast("string").alias(whole))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [sent.value.score(t) for t in pdf.pop(whole)]
            for i, name in enumerate(added):
                pdf[name] = [f[i] for f in found]
            yield pdf

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop(whole).schema)
    new = ", ".join(f"`{n}` {kind}" for n, kind in zip(added, ("string", "double", "double"), strict=True))
    return rows.mapInPandas(work, f"{schema}, {new}")


def least_score(docs: DataFrame, profiles: Profiles, share: float = 0.5, rare: float = 0.001) -> float:
    """A score that next to no text of a known language falls below.

    It is ``share`` of the score that all but the share ``rare`` of the labelled texts reach which the profiles
    have not seen and call by their label. Without such texts it is 0.
    """
    (pred, score, lead) = fresh(docs, "pred", "score", "lead")
    unseen = docs.where((remainder(F.col("doc_id"), 3) == 1) & F.col("lang").isNotNull())
    found = identify(unseen, profiles, keep=["lang"], added=(pred, score, lead)).where(F.col(pred) == F.col("lang"))
    bound = found.agg(F.percentile_approx(score, rare, 10_000)).first()[0]
    return share * (bound or 0.0)


def accept(docs: DataFrame, least: float | None = None) -> DataFrame:
    """The rows of ``docs`` in a known language, with all their columns; a NULL lang becomes the language found.

    Profiles are learned from the two thirds of labelled rows with a CRC-32 of doc_id that leaves
    0 or 2 modulo 3. Rejected are texts that are NULL, have no letters, or score below
    ``least``, by default the :func:`least_score` of the third that was left out.
    """
    names = tuple(fresh(docs, "pred", "score", "lead"))
    profiles = learn(docs.where(remainder(F.col("doc_id"), 3) != 1))
    if least is None:
        least = least_score(docs, profiles)
    found = identify(docs, profiles, added=names).where((F.col(names[0]) != UNDECIDED) & (F.col(names[1]) >= least))
    lang = F.coalesce(F.col("lang"), F.col(names[0])).alias("lang")
    return found.select(*[lang if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def op3(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    profiles = learn(docs.where(remainder(F.col("doc_id"), 3) != 1))
    found = identify(docs.withColumn("held_out", held), profiles, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "lead")
