import math
import re
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import corpus_pipeline  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

import __spark_entry__ as job  # noqa: E402
from acuity.llm import langid, simhash  # noqa: E402
from acuity.llm.common import remainder  # noqa: E402
from acuity.session import stored  # noqa: E402
from tests.llm.test_secrets import plain as secret_spans  # noqa: E402
from tests.llm.test_simhash import plain_print, plain_roots  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark):
    """The documents and what each stage makes of what the one before it kept."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], folder), "step"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "secret scans", "mixing to target weights", "best-fit packing"]
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns
    assert steps[-1].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_language_keeps_what_scores_like_a_known_language(steps):
    docs, after = rows(steps[0]), rows(steps[1])
    profiles = langid.learn(steps[0].where(remainder(F.col("doc_id"), 3) != 1))
    found = {i: profiles.score(r.text) for i, r in docs.items()}
    unseen = sorted(found[i][1] for i, r in docs.items() if zlib.crc32(str(i).encode()) % 3 == 1 and r.lang is not None and found[i][0] == r.lang)
    bound = unseen[max(0, math.ceil(0.001 * len(unseen)) - 1)] / 2
    assert 0.1 < bound < 0.5
    assert set(after) == {i for i, (lang, score, _) in found.items() if lang != langid.UNDECIDED and score >= bound}
    assert all(r.lang == (docs[i].lang or found[i][0]) and r.text == docs[i].text for i, r in after.items())


def test_letter_noise_goes(spark, steps):
    noise = spark.createDataFrame([(-1, "zzxq kkjv wwqp xxzz", None, "src1", 19)], steps[0].schema)
    assert -1 not in rows(langid.accept(steps[0].unionByName(noise)))


NAMES = (
    "key copies row whole pred score lead spans new_text fp id cut_domain cut_lang cut_source cut_epoch cut_key domain epoch n_tokens "
    "__text __lang __spans __key __domain shard piece length sequence_id offset"
).split()


def test_no_name_clashes(spark, steps):
    """Each stage takes columns with names that it uses itself, and returns them as they were."""
    docs = steps[0].withColumns({name: F.concat(F.lit(f"{name}:"), F.col("doc_id")) for name in NAMES})
    for (_, stage), plain in zip(corpus_pipeline.STAGES[:-1], steps[1:], strict=False):
        docs = stored(stage(spark, docs, ""), "step")
        assert docs.columns == [*steps[0].columns, *NAMES]
        assert all(r[name] == f"{name}:{r.doc_id}" for r in docs.collect() for name in NAMES)
        assert set(rows(docs)) == set(rows(plain))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert packed.columns == steps[-1].columns and {r.doc_id for r in packed.collect()} == set(rows(docs))


def test_near_dedup_loses_no_row_if_files_are_read_otherwise(spark, steps, monkeypatch):
    """The documents are read twice; the second time in other pieces."""
    docs = stored(steps[1].repartition(12), "pieces")
    want = set(rows(steps[2]))
    real = simhash.near_duplicates

    def then_otherwise(*args, **kwargs):
        found = stored(real(*args, **kwargs), "found")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        return found

    monkeypatch.setattr(simhash, "near_duplicates", then_otherwise)
    try:
        found = simhash.one_of_each(docs)
        assert found.rdd.getNumPartitions() and set(rows(found)) == want and found.count() == len(want)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_of_repeated_rows_stays(spark):
    data = [(1, "one two three four five", "en", "a", 1)] * 3 + [(1, "another text under the same number", "en", "a", 1)]
    data += [(None, "one two three four five", "en", "b", 2), (None, "and a third text without one", None, "b", 2), (2, None, None, "c", 0), (2, None, None, "d", 0)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    found = [(r.doc_id, r.text) for r in simhash.one_of_each(df).collect()]
    assert sorted(found, key=str) == sorted([(1, data[0][1]), (1, data[3][1]), (None, data[5][1]), (2, None)], key=str)


def test_one_document_of_each_group_stays(steps):
    docs = rows(steps[1])
    ids = sorted(docs)
    roots = plain_roots(ids, [plain_print(docs[i].text) for i in ids])
    assert set(rows(steps[2])) == set(roots)
    assert all(r.text == docs[i].text for i, r in rows(steps[2]).items())


def test_no_secret_is_left_and_nothing_else_changes(steps):
    before, after = rows(steps[2]), rows(steps[3])
    assert set(before) == set(after)
    for i, r in after.items():
        assert secret_spans(r.text) == []
        if secret_spans(before[i].text):
            pattern = ".*".join(re.escape(x) for x in r.text.split("[SECRET]"))
            assert re.fullmatch(pattern, before[i].text, re.S) and r.n_chars == len(r.text)
        else:
            assert r == before[i]


def test_mixing_takes_whole_documents_within_the_budget(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert steps[4].count() == len(after)
    assert all(before[i] == r for i, r in after.items())

    def words(found):
        return sum(len(re.findall("[^\x20\x09-\x0d]+", r.text or "")) for r in found.values())

    budget = words(before) * corpus_pipeline.MIX_SHARE // 100
    assert budget <= words(after) <= words(before)


def test_sequences_hold_all_that_was_left(steps):
    texts = {i: r.text for i, r in rows(steps[4]).items()}
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, room = defaultdict(list), defaultdict(list)
    for r in steps[5].collect():
        pieces[r.doc_id].append(r)
        room[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, own in pieces.items():
        ids = np.array([*t.encode(texts[i], add_special_tokens=False).ids, 0], "<u4")
        own.sort(key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for found in room.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= corpus_pipeline.SEQUENCE


def test_run_is_the_stages_one_after_another(spark, steps):
    got = job.queries()["pipeline"](spark, "/root/testdata/sf0.001")
    plain = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(plain).collect())) == sorted(map(tuple, steps[-1].select(plain).collect()))


def test_stages_take_odd_documents(spark):
    data = [(1, None, "en", "src1", None), (2, "", None, None, 0), (3, "!! 1", "en", "src1", 4)]
    data += [(10 + i, f"some plain words for document number {i} about topic {i * 7} and {i * 31}", "en" if i % 3 else None, None if i == 4 else "src0", 9) for i in range(12)]
    data += [data[-1], (None, "a text without a number is a text too", "en", "src2", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        docs = df.limit(0) if empty else df
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, ""), "step")
        assert (docs.count() == 0) == empty
