import hashlib
import random
import re

import pytest

from acuity.llm import pii

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d: str) -> bool:
    odd = [int(c) for c in d[-1::-2]]
    even = [int(c) * 2 for c in d[-2::-2]]
    return (sum(odd) + sum(x // 10 + x % 10 for x in even)) % 10 == 0


def plain(text: str | None) -> list[tuple]:
    """The base spans by whole-text patterns."""
    keep = {
        "email": lambda s: True,
        "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 14 <= len(re.sub("[ -]", "", s)) <= 19 and luhn(re.sub("[ -]", "", s)),
        "phone": lambda s: 10 <= len(re.sub(r"\D", "", s)) <= 15,
    }
    return sorted(
        (m.start(), i, k, m.end())
        for i, (k, p) in enumerate(BASE.items())
        for m in p.finditer(text or "")
        if keep[k](m.group())
    )


def base_of(text):
    return [s for s in pii.find(text) if s[2] in BASE]


@pytest.mark.parametrize("seed", range(60))
def test_base_spans_equal_the_patterns_on_random_text(seed):
    rng = random.Random(seed)
    parts = ["a@b.co", "@", ".", "1.2.3.4", "+1 (743) 555-3824", "4465758382889437", " ", "-", "+", "9", "00", "é", "x", "\n", "(", "255.256", "%", "://", "::"]
    for _ in range(200):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert base_of(text) == plain(text), text


def test_base_spans_equal_the_patterns_on_the_documents(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        assert base_of(r.text) == plain(r.text)


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("see ftp://joe:pw@files.example.com/a now", "url", "ftp://joe:pw@files.example.com/a"),
        ("IBAN: DE89 3704 0044 0532 0130 00.", "iban", "DE89 3704 0044 0532 0130 00"),
        ("SSN 078-05-1120 here", "ssn", "078-05-1120"),
        ("account no. 12345678 is", "account", "12345678"),
    ],
)
def test_the_anchors_add_kinds(text, kind, found):
    assert [text[s:e] for s, _, k, e in pii.find(text) if k == kind] == [found]


def test_clean_text_is_left_alone():
    assert pii.find("The account was closed in 2020. See https://example.com/a?x=1, item 12.5 @ home") == []
    assert pii.find("IBAN DE89 3704 0044 0532 0130 01") == []


def test_long_runs_take_linear_time():
    for text in ("a" * 2_000_000 + "@", "1" * 300_000, "1." * 300_000, "+1 " * 300_000, "a@" * 300_000, "(" * 100_000 + "+1" + "(" * 100_000):
        assert isinstance(pii.find(text), list)


def test_null_empty_repeated_rows_and_clashing_columns(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "x@y.zz", "s"), (3, "x@y.zz", "s"), (None, "1.2.3.4", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(((r.id or 0, len(r.spans)) for r in pii.personal_data(df).collect()))
    assert got == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1)]
    assert pii.personal_data(df.limit(0)).count() == 0


def test_the_query_digest(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = pii.op10(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = plain(texts[r.doc_id])
        line = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in BASE]
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))
