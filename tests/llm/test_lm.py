import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from acuity.llm import lm, successors


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\n"]


def check(rows, texts, learned):
    counts = Counter()
    for i in learned:
        counts.update(tokens(texts[i]))
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        words = tokens(texts[r.doc_id])
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score < 0


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    return texts, lm.op8(spark, folder).collect()


def test_base_columns_equal_brute_force(scored):
    texts, rows = scored
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    assert {r.doc_id for r in rows if r.held_out} == held
    check(rows, texts, set(texts) - held)


def test_the_model_says_more_than_bytes_alone_on_held_out_text(scored):
    texts, rows = scored
    held = [r for r in rows if r.held_out]
    size = sum(len(" ".join(tokens(texts[r.doc_id])).encode()) for r in held)
    bits = -sum(r.score for r in held) * math.log2(10) / size
    # order-0 bytes of this corpus take more than 4 bits
    assert bits < 3.0


@pytest.fixture(scope="module")
def model(spark):
    words = [("the", 0, 900), ("then", 0, 40), ("thin", 0, 9), ("été", 0, 7), ("été", 169, 20), ("x" * 300, 0, 2), ("\n", 0, 50)]
    df = spark.createDataFrame([(w.encode(), m, n) for w, m, n in words], "word binary, mark int, cw long")
    return lm.train(df)


def test_probabilities_of_the_next_byte_add_up(model):
    for beginning, mark in ((b"", 0), (b"th", 0), (b"t", 169), (b"zq", 0)):
        total = 0.0
        for b in range(256):
            word = beginning + bytes([b])
            (some, events) = next(lm._events([word], np.array([mark], np.int32), np.ones(1)))
            total += 10 ** model.cost(events)[len(beginning)]
        assert total == pytest.approx(1, abs=1e-6)


def test_shared_beginnings_cost_the_same_as_single_words(model):
    words = sorted([b"the", b"then", b"thin", b"the", b"", b"\n", b"x" * 60, b"x" * 300, "été".encode(), b"a" * 5000])
    marks = np.array([0, 1, 0, 169, 0, 0, 1, 0, 0, 2], np.int32)
    together = model.words(words, marks)
    alone = [float(model.words([w], marks[i : i + 1])[0]) for i, w in enumerate(words)]
    assert np.allclose(together, alone, atol=1e-9)


def test_counts_are_of_the_words(spark):
    df = spark.createDataFrame([(b"ab", 0, 10), (b"ac", 0, 30)], "word binary, mark int, cw long")
    counts = lm.count_contexts(df)
    _, e = next(lm._events([b"ab", b"ac"], np.zeros(2, np.int32), np.array([10.0, 30.0])))
    assert e.byte.tolist() == [97, 98, 99, 32, 32] and e.weight.tolist() == [40, 10, 30, 10, 30] and e.before.tolist() == [40, 40, 40, 10, 30]
    pair = counts[lm._slots(e.hashes, e.byte, 0)[1]]  # the decisions of b after a
    assert [(int(p) & 65535) + (int(p) >> 16) for p in pair] == [40] * 7 + [40]
    assert (int(pair[7]) & 65535, int(pair[7]) >> 16) == (10, 30)


def test_large_counts_are_scaled_by_slot(spark):
    df = spark.createDataFrame([(b"a", 0, 3_000_000), (b"c", 0, 1)], "word binary, mark int, cw long")
    counts = lm.count_contexts(df)
    _, e = next(lm._events([b"a"], np.zeros(1, np.int32), np.ones(1)))
    pair = counts[lm._slots(e.hashes, e.byte, 0)[0, 6]]
    assert (int(pair) & 65535, int(pair) >> 16) == (65535, 1)


def test_chunks_and_odd_texts(spark, make):
    texts = {1: None, 2: "", 3: "The the THE été x", 4: "été The", 5: "w" * 100_000, 6: "a \n\n b " * 3000}
    df = make(list(texts.items()))
    for size in (1, 24_000_000):
        got = lm.score(df, F.col("doc_id") == 4, chunk=size).withColumnRenamed("id", "doc_id").collect()
        check(got, texts, {1, 2, 3, 5, 6})
    again = lm.score(df.union(df), F.lit(False)).collect()
    assert len(again) == 12 and len({(r.id, r.score) for r in again}) == 6
    assert lm.score(df.limit(0), F.lit(False)).count() == 0
    nothing = lm.score(df.where("doc_id < 4"), F.lit(True)).orderBy("id").collect()
    assert [r.train_tokens for r in nothing] == [0, 0, 0] and [r.base_score for r in nothing] == [0, 0, 0]
    assert nothing[0].score == pytest.approx(8 * math.log10(0.5), rel=0.05)


def test_a_text_costs_the_sum_of_its_words(spark, make, model):
    text = "The été then thin"
    parts = [("the", 0), ("été", 0), ("then", 169), ("thin", 169), ("\n", 169)]
    want = sum(float(model.words([w.encode()], np.array([m], np.int32))[0]) for w, m in parts)
    assert model.text(text) == pytest.approx(want)


def test_blocks_know_the_counts_of_the_whole_corpus(spark):
    rng = np.random.default_rng(5)
    rows = {("".join(rng.choice(list("abcé"), rng.integers(1, 6))).encode(), int(m)): int(rng.integers(1, 9)) for m in rng.choice([0, 169, 200], 900)}
    df = spark.createDataFrame([(w, m, n) for (w, m), n in rows.items()], "word binary, mark int, cw long")
    counts = lm.count_contexts(df)
    for parts, least in ((1, 1 << 15), (7, 20)):
        own = df.repartitionByRange(parts, "word").sortWithinPartitions("word", "mark")
        own = own.selectExpr("0L chunk", "0 place", "word", "mark", "cw c", "cw", "true head", "true first")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
        try:
            found = lm.stored(lm.blocks(own, least), "blocks")
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        answers = lm.exchange(found, 1 << 10).toPandas()
        some = found.collect()
        assert len(some) == 1 if parts == 1 else len(some) > 20
        for r in some:
            block = lm._Block(r.words, r.marks, r.weights)
            pairs = block.pairs(*lm._answered(answers[answers["block"] == r.block]))
            assert (pairs == counts.at(block.keys.ravel()).reshape(pairs.shape)).all()


def test_beginnings_count_from_their_first_occurrence_whatever_the_mark(spark):
    df = spark.createDataFrame([(b"ab", 0, 1), (b"ac", 169, 2)], "word binary, mark int, cw long").repartition(2)
    counts = lm.count_contexts(df)
    (_, e) = next(lm._events([b"ab"], np.zeros(1, np.int32), np.ones(1)))
    for k, want in ((3, (1, 2)), (4, (1, 0))):  # the last decision of b after a
        pair = int(counts[lm._slots(e.hashes, e.byte, k)[1, 7]])
        assert (pair & 65535, pair >> 16) == want


def plain_scores(spark, texts, held):
    """Scores text by text and token by token, from plain counts of words, pairs and triples."""
    learned = {i: tokens(t) for i, t in texts.items() if i not in held}
    one, two, pair, triple = Counter(), Counter(), Counter(), Counter()
    marked = Counter()
    for words in learned.values():
        mark = 0
        for k, w in enumerate(words):
            last = words[k - 1] if k else "\n"
            one[last] += 1
            pair[last, w] += 1
            if k:
                before = words[k - 2] if k > 1 else "\n"
                two[before, last] += 1
                triple[before, last, w] += 1
            marked[w, mark] += 1
            if not w.isascii():
                mark = lm._mark(w.encode())
    counted = spark.createDataFrame([(w.encode(), m, n) for (w, m), n in marked.items()], "word binary, mark int, cw long")
    model = lm.train(counted)
    taken, fixed = {}, {}
    sums = np.zeros((2, successors.CELLS, 2))
    for i, text in texts.items():
        words, own = tokens(text), int(i not in held)
        mark, run, before_said, taken[i], fixed[i] = 0, 0, 0, [], 0.0
        for k, w in enumerate(words):
            last = words[k - 1] if k else "\n"
            before = words[k - 2] if k > 1 else "\n"
            t2, c2 = (two[before, last] - own, triple[before, last, w] - own) if k else (0, 0)
            t1, c1 = one[last] - own, pair[last, w] - own
            said = 2 if c2 > 0 and t2 > 0 else 1 if c1 > 0 and t1 > 0 else 0
            classes = [np.searchsorted(cuts, x) for cuts, x in ((successors._TWO, t2), (successors._ONE, t1), (successors._RUN, run))]
            state = np.ravel_multi_index((*classes, before_said), successors.SHAPE)
            if t2 > 0:
                taken[i].append((0, state, int(said == 2)))
            if said != 2 and t1 > 0:
                taken[i].append((1, state, int(said == 1)))
            if said == 2:
                fixed[i] += math.log10(c2 / t2)
            elif said == 1:
                fixed[i] += math.log10(c1 / t1)
            else:
                fixed[i] += float(model.words([w.encode()], np.array([mark], np.int32))[0])
            run, before_said = run + 1 if said == 2 else 0, said
            if not w.isascii():
                mark = lm._mark(w.encode())
        if own:
            for decision in taken[i]:
                sums[decision] += 1
    chosen = successors.fit(sums).reshape(2, successors.CELLS, 2)
    return {i: fixed[i] + sum(chosen[d] for d in taken[i]) for i in texts}


CORPUS = {
    1: "the cat sat on the mat and the cat sat on the hat", 2: "The cat sat on the mat again", 3: None, 4: "", 5: "été the cat naïve sat on the mat",
    6: "on the mat the cat sat", 7: "a dog ran by the old mill and a dog sat on the mat", 8: "the the the the the", 9: "the cat sat on the mat and the dog ran by",
    10: "mat the on sat cat the", 11: "x" * 70 + " the cat",
}


@pytest.mark.parametrize("parts, chunk", [("1", 12_000_000), ("9", 60)])
def test_the_score_equals_brute_force_for_any_partitions(spark, make, parts, chunk):
    held = {2, 9, 10}
    want = plain_scores(spark, CORPUS, held)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = lm.score(make(list(CORPUS.items())), F.col("doc_id").isin(*held), chunk=chunk).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.id for r in rows} == set(CORPUS)
    for r in rows:
        assert r.score == pytest.approx(want[r.id], rel=1e-6), r.id
        size = sum(len(w.encode()) + (w != "\n") for w in tokens(CORPUS[r.id]))
        assert r.n_bytes == size and r.bits_per_byte == pytest.approx(-r.score / size * math.log2(10))


def test_the_order_of_words_counts(spark, make):
    """A text in known order is likelier than its words shuffled, and a repeated passage than a new one."""
    score = {r.id: r.score for r in lm.score(make(list(CORPUS.items())), F.col("doc_id").isin(9, 10)).collect()}
    assert score[6] > score[10] + 1
    assert score[9] / len(tokens(CORPUS[9])) > score[7] / len(tokens(CORPUS[7]))


def test_the_gain_over_single_words_is_large_on_held_out_text(scored):
    _, rows = scored
    held = [r for r in rows if r.held_out]
    n = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / n > sum(r.base_score for r in held) / n + 0.7


def test_keys_pack_and_runs():
    rng = np.random.default_rng(1)
    for n in (0, 1, 500):
        k = np.unique(rng.integers(0, 1 << 46, n, dtype=np.uint64))
        assert (successors.unpack(successors.pack(k)) == k).all()
    yes = np.array([1, 1, 1, 0, 1, 1, 1, 1, 0, 0, 1], bool)
    begins = np.zeros(11, bool)
    begins[[0, 6]] = True
    assert successors._runs(yes, begins).tolist() == [0, 1, 2, 3, 0, 1, 0, 1, 2, 0, 0]


def test_decisions_are_probabilities():
    sums = np.zeros((2, successors.CELLS, 2))
    sums[0, 5:900:7] = (30, 70)
    chosen = 10 ** successors.fit(sums).reshape(2, successors.CELLS, 2)
    assert np.allclose(chosen.sum(axis=2), 1) and chosen[0, 5, 1] > 0.6
    assert np.allclose(successors.fit(np.zeros_like(sums)), math.log10(0.5))


@pytest.mark.parametrize("piece", [1, 7, 1 << 16])
def test_counts_of_held_keys_need_no_search_for_each(piece, monkeypatch):
    """The counts of all keys are those that a search finds, also where they are scaled down."""
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 40, 600).astype(np.uint64) << np.uint64(56) | rng.integers(0, 256, 600).astype(np.uint64))
    for high in (3, 200_000):
        counts = lm.Counts(keys, rng.integers(0, high, len(keys)))
        want = counts.at(keys)
        with monkeypatch.context() as m:
            m.setattr(lm.Counts, "at", None)
            assert (counts.all(piece) == want).all()
    assert lm.Counts(keys[:0], np.empty(0)).all().shape == (0, 8)
    assert (lm.Counts(keys[:1], np.ones(1)).all() == lm.Counts(keys[:1], np.ones(1)).at(keys[:1])).all()


ODD = ["", None, "a", "b a", "É a", "x\ty\x0bz\rw \n", "  the THE\x0cthe", "\x85a\u00a0b \u3000c", "a\0 a a\0\0 a\0b", "w" * 60, "w" * 60 + "x " + "w" * 60 + "a", "w" * 48, "été the naïve the été"]


def test_tokens_of_many_texts_at_once_are_those_of_each():
    for texts in (ODD, ODD[::-1], [""], ["a"], ["", ""], [" "], ["a", "", "b"]):
        for cut in (0, 1):  # a slice does not begin at the buffer's beginning
            some = [t or "" for t in texts]
            own = lm.pa.array([*["zz"] * cut, *some], lm.pa.large_binary()).slice(cut)
            words, sequence, lens = lm._tokens(own)
            want = [[w.encode() for w in tokens(t)] for t in some]
            assert lens.tolist() == [len(x) for x in want]
            assert [words[i] for i in sequence] == [w for x in want for w in x]
            # each behind the latest mark of its own text
            marked, marks, numbers = lm._marked(words, sequence, lens)
            plain = []
            for x in want:
                mark = 0
                for w in x:
                    plain.append((w, mark))
                    mark = mark if w.isascii() else lm._mark(w)
            assert [(marked[i], int(marks[i])) for i in numbers] == plain
            assert len(marked) == len(set(plain))


@pytest.mark.parametrize("chunk, part, size", [(1, 3, 2), (100, 7, 100), (10_000, 1 << 19, 1 << 18)])
def test_blocks_of_chunks_are_stretches_of_the_word_order(spark, make, chunk, part, size):
    df = make(list(enumerate(ODD)))
    found = lm.stored(lm.chunks(df, F.col("doc_id") % 5 == 2, "doc_id", "text", chunk), "chunks")
    blocks = lm.vocabulary(found, part, size).collect()
    want, known = Counter(), Counter()
    for i, t in enumerate(ODD):
        mark = 0
        for w in tokens(t):
            want[w.encode(), mark] += i % 5 != 2
            known[w.encode()] += i % 5 != 2
            mark = mark if w.isascii() else lm._mark(w.encode())
    got, rows = [], 0
    for b in sorted(blocks, key=lambda b: b.block):
        words, marks, weights = lm.parted(b.words), np.frombuffer(b.marks, np.int32), np.frombuffer(b.weights, np.int64)
        got += zip(words, marks.tolist(), weights.tolist(), strict=True)
        raw = lm.zstandard.decompress(b.rest)
        n = len(raw) // 24
        c, of = np.frombuffer(raw, np.int64, n, 8 * n), np.frombuffer(raw, np.int32, n, 20 * n)
        assert c.tolist() == [known[words[i]] for i in of]
        assert b.v == sum(known[w] > 0 for w in set(words)) and b.n == weights.sum()
        rows += n
    assert got == sorted((w, m, n) for (w, m), n in want.items())
    assert rows >= len(got) and (len(blocks) == 1) == (part > 7)


def test_words_are_not_sorted_one_by_one_in_spark(make):
    """Their windows and the explode before them took a fifth of the whole score's CPU seconds."""
    found = lm.stored(lm.chunks(make([(1, "a b"), (2, "b c")]), F.lit(False), "doc_id", "text", 100), "chunks")
    plan = lm.vocabulary(found)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("bits", [8, 39, 58, 64])
def test_places_in_the_order_of_keys(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 5000):
        key = rng.integers(0, 1 << 64, n, dtype=np.uint64) >> np.uint64(64 - bits)
        key[: n // 3] = key[n // 2 : n // 2 + n // 3] ^ np.uint64(1)  # some differ in the last bit alone
        order = successors.ordered(key, bits)
        assert sorted(order.tolist()) == list(range(n)) and (key[order] == np.sort(key)).all()
