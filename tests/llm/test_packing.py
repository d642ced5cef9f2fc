import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from acuity.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def check(rows, texts, plain, size):
    """Every id once, in order, in gapless sequences."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(docs) == set(texts)
    for doc, found in docs.items():
        ids = np.array([*plain(texts[doc] or ""), 0], "<u4")
        at = 0
        for k, (piece, start, n, crc) in enumerate(sorted(found)):
            assert (piece, start) == (k, at)
            assert crc == zlib.crc32(ids[start : start + n].tobytes())
            at += n
            assert len(found) == 1 or n == size or k == 0
        assert at == len(ids)
    for found in seqs.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= size
    total = sum(n for f in seqs.values() for _, n in f)
    return len(seqs), -(-total // size)


def test_the_query_packs_every_id(spark, sf_dir, plain):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    used, least = check(packing.op7(spark, sf_dir).collect(), texts, plain, 2048)
    assert used <= least + 1


def test_odd_texts(spark, plain):
    texts = {1: None, 2: "", 8: "a <|endoftext|> b<|endoftext|><|endoftext|>\n<|endoftext| >", 3: "<|endoftext|> 's  　 \U0001f600" * 3, 4: "word " * 9000, 5: " " * 70_000, 6: "x" * 30_000, 7: "ab\n\n\n  c"}
    df = spark.createDataFrame([(k, v, 0) for k, v in texts.items()], "doc_id long, text string, length int")
    check(packing.pack_documents(df, PATH).withColumnRenamed("id", "doc_id").collect(), texts, plain, 2048)
    assert packing.pack_documents(df.limit(0), PATH).count() == 0
    again = packing.pack_documents(df.where("doc_id = 7").union(df.where("doc_id = 7")), PATH).collect()
    assert sorted(r.offset for r in again) == [0, again[0].length]


@pytest.mark.parametrize("size, lengths, bins", [
    (10, [6, 6, 4, 4], 2),
    (100, [51, 27, 26, 23, 51, 24, 24, 24, 25, 25], 3),
    (7, [3, 3, 2, 2, 2, 2], 2),
    (20, [10, 7, 7, 6, 5, 5], 2),
    (5, [5, 5, 5], 3),
    (8, [], 0),
])
def test_few_bins(size, lengths, bins):
    where, at = packing.place(np.array(lengths, np.int64), size)
    assert len(set(where.tolist())) == bins
    for b in set(where.tolist()):
        mine = sorted((at[i], lengths[i]) for i in np.flatnonzero(where == b))
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))]


def least_bins(lengths, size):
    best = len(lengths)

    def walk(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(lengths):
            best = len(room)
            return
        for i in range(len(room)):
            if room[i] >= lengths[k]:
                walk(k + 1, (*room[:i], room[i] - lengths[k], *room[i + 1 :]))
        walk(k + 1, (*room, size - lengths[k]))

    walk(0, ())
    return best


@pytest.mark.parametrize("seed", range(40))
def test_the_search_finds_the_least(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.integers(8, 60, 9))[::-1]
    where, _ = packing.place(lengths, 100)
    assert len(set(where.tolist())) == least_bins(lengths.tolist(), 100)


def test_shards_lose_no_row(spark):
    df = spark.range(1000).selectExpr("id", "cast(1 + id % 97 as long) as length")
    got = packing.pack(df, 100, 300).collect()
    assert sorted(r.id for r in got) == list(range(1000))
    room = defaultdict(int)
    for r in got:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 100


def test_bins_of_the_whole_shard_are_searched_again():
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(34, 45, 200), rng.integers(26, 33, 200)])
    counts = np.bincount(lengths, minlength=101)
    bins = packing.bin_completion(counts, 100)
    assert sorted(x for b in bins for x in b) == sorted(lengths.tolist())
    assert max(map(sum, bins)) <= 100
    # searching the last 48 bins alone leaves 150
    assert len(bins) <= 146
