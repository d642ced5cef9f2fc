import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from acuity.llm import registry, variants
from checks.compare import compare, connect


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_words(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def plain_variants(words, times=10):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= times * n else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def got(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_the_query_equals_its_sql_form(spark, sf_dir):
    same, note = compare(spark, connect(sf_dir), sf_dir, "op11_spelling_variants")
    assert same, note


def test_words_equal_a_plain_count(spark, sf_dir, texts):
    found = variants.vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert dict(found.collect()) == plain_words(texts.items())
    assert "op11_spelling_variants" in registry.oracle_sql()


def changed(rng, word, letters):
    at = rng.randrange(len(word))
    kind = rng.randrange(3)
    return word[:at] + (rng.choice(letters) if kind else "") + word[at + (kind != 1) :]


@pytest.mark.parametrize("bucket, most", [(50_000, 20_000), (60, 5)])
def test_near_words_equal_all_pairs(spark, bucket, most):
    """Random words with near ones around them; small lists split every group."""
    rng = random.Random(11)
    letters = "abéÿ"
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(7, 11))) for _ in range(60)}
    for w in sorted(words):
        for _ in range(4):
            v = changed(rng, w, letters)
            words |= {v, changed(rng, v, letters)}
    words = {w: rng.choice([2, 3, 20, 30, 300, 3000]) for w in sorted(words) if len(w) >= 7}
    want = {w: [v for v in words if edits(v, w) == 1] for w in words}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = {r.word: (r.n_near, r.near_n, r.near) for r in variants.near_words(table, bucket, most).collect()}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in want.items() if v}
    assert found == {w: (len(want[w]), words[best[w]], best[w]) for w in best}
    assert got(variants.variants(table)) == plain_variants(words)


def test_rows_of_a_list_are_shared():
    """Words of one group in order; LCPs tell what they share with the word before."""
    words = ["abcdefg", "abcdefh", "abdzzzz", "abcdefgh", "xbcdefg"]
    order, codes, start, length, lcp = variants.sorted_list(np.array([0, 0, 0, 0, 1]), words)
    assert [words[i] for i in order] == ["abcdefg", "abcdefgh", "abcdefh", "abdzzzz", "xbcdefg"]
    assert lcp.tolist() == [-1, 7, 6, 2, -1]
    a, b = variants.one_edit(codes, start, length, lcp, np.arange(5), np.ones(5, bool))
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]


def test_ways_are_followed_to_their_end(spark):
    chain = [("aaaaaaa" + "b" * k, 2 * 10**k) for k in range(7)]
    found = got(variants.variants(spark.createDataFrame(chain, "word string, n long")))
    assert {v[1] for v in found.values()} == {chain[-1][0]}
    assert found["aaaaaaa"] == ("aaaaaaab", chain[-1][0], 2, 1, 20)


def test_ties_go_to_the_least_word(spark):
    words = [("aaaaaaa", 2), ("aaaaaaz", 30), ("aaaaaab", 30), ("éaaaaaa", 30)]
    assert got(variants.variants(spark.createDataFrame(words, "word string, n long")))["aaaaaaa"][0] == "aaaaaab"


def test_odd_rows(make, spark):
    """NULL and empty texts, repeated rows, a NULL id, a very long word, clashing columns."""
    long = "x" * 3000 + "y"
    rows = [(1, None), (2, ""), (3, "Longword longword LONGWORD"), (3, "Longword"), (None, "longword longwort longwort"), (4, f"{long} {long} {long}z {long}z"), (5, "shorty 12 ×÷ Àbcdefgh Àbcdefgh")]
    docs = make(rows)
    plain = plain_words([("" if i is None else i, t) for i, t in rows])
    assert dict(variants.vocabulary(docs).collect()) == plain
    assert got(variants.variants(variants.vocabulary(docs))) == plain_variants(plain)
    empty = variants.variants(variants.vocabulary(docs.where("false")))
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_no_word_has_a_near_one(spark):
    found = got(variants.variants(spark.createDataFrame([("abcdefg", 5)], "word string, n long")))
    assert found == {"abcdefg": (None, "abcdefg", 5, 0, None)}
