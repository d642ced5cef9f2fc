"""Personal data by anchor expansion.

One Aho-Corasick pass finds at-signs, plus signs, digits, schemes and cues; a small
parser for each kind grows the anchor to its bounds and checks what it found. The parsers
read each character a bounded number of times, however long a run is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import ship, table

# --- fixed values: kinds in the order of listing -------------------------------
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "ssn", "account")
# --- fixed values: cues of identifiers, any letter case ------------------------
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security"),
    "account": ("account", "acct", "kontonummer", "numéro de compte", "número de cuenta", "cuenta no"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_DIGITS = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_REST = re.compile(r"[^\s\"'<>]+")
_IBAN = re.compile(r"[^A-Za-z0-9]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[^0-9\n]{0,12}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"(?:\x20?(?:number|no|nr|n°)\b)?[\x20.:#=]{1,4}([0-9][0-9-]{4,18}[0-9])(?![0-9A-Za-z.])")

Span = tuple[int, int, str, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_ok(code: str) -> bool:
    plain = code.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    found.add_word("://", ("url", 3))
    for kind, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


_AUTOMATON: list[ahocorasick.Automaton] = []


def find(text: str | None) -> list[Span]:
    """All spans of a text as (start, rank of the kind, kind, end), code points, end exclusive."""
    if not text:
        return []
    if not _AUTOMATON:
        _AUTOMATON.append(automaton())
    out: list[Span] = []
    past = dict.fromkeys((*KINDS, "run"), 0)

    def add(kind: str, start: int, end: int) -> None:
        out.append((start, KINDS.index(kind), kind, end))

    for last, (what, size) in _AUTOMATON[0].iter(text):
        at = last - size + 1
        if what == "digit":
            if at >= past["run"]:  # first digit of a run
                end = _DIGITS.match(text, at).end()
                past["run"] = end
                if at >= past["ip"] and (m := _QUAD.match(text, at)):
                    past["ip"] = m.end()
                    if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups()):
                        add("ip", at, m.end())
                if at >= past["card"]:
                    m = _RUN.match(text, at)
                    past["card"] = m.end()
                    if 14 <= m.end() - at:
                        digits = m.group().replace(" ", "").replace("-", "")
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            add("card", at, m.end())
        elif what == "email":
            if at >= past["email"] and (m := _DOMAIN.match(text, at + 1)):
                start = at
                while start > past["email"] and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    past["email"] = m.end()
                    add("email", start, m.end())
        elif what == "phone":
            if at >= past["phone"] and (m := _PHONE.match(text, at)):
                body = m.group().rstrip(" ().-")
                if len(body) >= 4:
                    past["phone"] = at + len(body)
                    if 10 <= sum(c.isdigit() for c in body) <= 15:
                        add("phone", at, at + len(body))
        elif what == "url":
            start = at
            while start > past["url"] and at - start < 16 and text[start - 1] in _SCHEME:
                start -= 1
            m = _REST.match(text, at + 3)
            if m and start < at:
                past["url"] = m.end()
                host = m.group().split("/", 1)[0]
                if "@" in host and _DOMAIN.search(host.rsplit("@", 1)[1]):
                    add("url", start, m.end())  # an address that names a user
        elif last + 1 >= past[what] and (at == 0 or not text[at - 1].isalnum()):
            pattern = {"iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT}[what]
            if (m := pattern.match(text, last + 1)) and (what != "iban" or iban_ok(m[1])):
                past[what] = m.end()
                add(what, m.start(1), m.end(1))
    return sorted(out)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): an array of (start, rank, kind, end) for every whole text.

    NULL and empty texts have no spans. Rows are kept one for one, in any number; an
    empty table gives an empty result; other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            spans = [[dict(zip(("start", "rank", "kind", "end"), s, strict=True)) for s in find(t)] for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "spans": spans})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(work, f"id {kind}, spans array<struct<start: int, rank: int, kind: string, end: int>>")


def joined(spans: F.Column) -> F.Column:
    """kind:start:end of each span, comma-joined in the order of the array."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def op10(spark, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in BASE]
    counts = [(F.size("spans") - rest).cast("long").alias(f"n_{k}") for k, rest in zip(BASE, counts, strict=True)]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
