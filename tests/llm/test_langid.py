import random
from collections import Counter

import numpy as np

from acuity.llm import langid


def plain_grams(text):
    found = Counter()
    word = ""
    for c in [*text.lower(), " "]:
        if c.isalpha():
            word += c
        elif word:
            edged = f"\x01{word}\x01"
            found.update(c for c in word)
            found.update(edged[i : i + 2] for i in range(len(edged) - 1))
            found.update(edged[i : i + 3] for i in range(len(edged) - 2) if edged[i + 1] != "\x01")
            word = ""
    return found


def key(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def test_grams_equal_brute_force(monkeypatch):
    rng = random.Random(2)
    for size in (langid._SLICE, 7, 3):
        monkeypatch.setattr(langid, "_SLICE", size)
        for _ in range(60):
            text = "".join(rng.choice("ab ÄßЖ中1.\n") for _ in range(rng.randint(0, 40)))
            keys, counts = langid.grams(langid.letters(text))
            assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == {key(g): n for g, n in plain_grams(text).items()}, text


def test_profiles_and_distance_equal_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()
    got = langid.learn(spark.createDataFrame(rows, "lang string, text string"), depth=60)
    counts = {}
    for lang, text in rows:
        counts.setdefault(lang, Counter()).update(plain_grams(text))
    top = {la: sorted((-n, key(g)) for g, n in c.items())[:60] for la, c in counts.items()}
    assert got.names == sorted(top)
    for i, la in enumerate(got.names):
        mine = [k for _, k in sorted((r, k) for k, r in zip(got.keys, got.ranks[:, i], strict=True) if r >= 0)]
        assert mine == [k for _, k in top[la]]
    for _, text in rows[:30]:
        doc = [k for _, k in sorted((-n, key(g)) for g, n in plain_grams(text).items())[:60]]
        far = []
        for la in got.names:
            rank = {k: i for i, (_, k) in enumerate(top[la])}
            far.append(sum(min(abs(rank[k] - i), 60) if k in rank else 60 for i, k in enumerate(doc)) / (60 * len(doc)))
        lang, score, _ = got.score(text)
        assert lang == got.names[int(np.argmin(far))] and abs(score - (1 - min(far))) < 1e-12


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect())
    got = langid.op3(spark, folder).collect()
    assert len(got) == len(truth)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_null_empty_and_clashing_columns(make, spark):
    profiles = langid.learn(spark.createDataFrame([("en", "the cat and the dog"), ("de", "der hund und die katze"), (None, "x"), ("fr", None)], "lang string, text string"))
    assert profiles.names == ["de", "en"]
    df = make([(1, None), (2, ""), (3, "123 ?!"), (4, "the dog"), (4, "the dog"), (None, "die katze"), (5, "the " * 200_000)])
    got = langid.identify(df, profiles)
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got.collect()) == [(0, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "en")]
    assert got.columns == [*(c for c in df.columns if c != "score"), "lang_pred", "score", "lead"]
    assert langid.identify(df.limit(0), profiles).count() == 0
    empty = langid.learn(df.limit(0))
    assert empty.names == [] and empty.score("text") == ("und", 0.0, 0.0)


def test_the_stage_keeps_text_in_a_language(make):
    df = make([(i, "the quick cat and the dog are here with us") for i in range(9)] + [(20, None), (21, "12 34"), (22, "")])
    kept = langid.accept(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(9))
