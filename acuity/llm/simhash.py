"""SimHash near-duplicates by vantage-point trees over Hamming distance.

Two fingerprints of 64 bits within 4 bits agree to within 1 bit in at least one of
their four 16-bit quarters. Each quarter has a vantage-point tree: a node takes a vantage
value and the median distance to it, nearer values go inside, others outside. A
fingerprint lives in the leaf its quarter falls in, and also visits each leaf that the
triangle inequality can't rule out within 1 bit. A leaf (a shard) compares its members
and visitors by all 64 bits, so every pair within the bound meets at least once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import fresh, ship
from acuity.llm.components import components
from acuity.session import stored

BITS = 64
#: A-Z lowered, white space to one kind
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b"\x20\x09\x0a\x0b\x0c\x0d" else c for c in range(256))
_SLICE = 1 << 16


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of a text's word shingles, unsigned; 0 for a text without words or NULL."""
    found = text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []
    if not found:
        return 0
    line = b" ".join(found)
    width = min(words, len(found))
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(found) - width + 1
    sums = np.zeros(BITS, np.int64)
    hash64 = xxhash.xxh64_intdigest
    for lo in range(0, n, _SLICE):
        hi = min(n, lo + _SLICE)
        first, last = starts[lo:hi].tolist(), ends[lo + width - 1 : hi + width - 1].tolist()
        hashes = np.array([hash64(line[a:b], seed) for a, b in zip(first, last, strict=True)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += bits.sum(axis=0, dtype=np.int64)
    return int((((sums * 2) > n).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp): the fingerprint of every whole text, as a signed long."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            fps = np.array([fingerprint(t, words, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    return rows.mapInArrow(work, f"id {kind}, fp long")


@dataclass
class Forest:
    """Where each 16-bit value lives and which later leaves it visits, for each quarter.

    ``home`` [quarter, value] is a leaf; the leaves that a value visits stand in ``visits``
    from ``first[q][value]`` to ``first[q][value + 1]``. ``parts`` [quarter][leaf] is (chunks of
    members, chunks of visitors). At most 4 x 65,536 values, however large the corpus.
    """

    home: np.ndarray
    first: list[np.ndarray]
    visits: list[np.ndarray]
    parts: list[np.ndarray]


def _tree(weights: np.ndarray, target: int) -> tuple[np.ndarray, list[tuple[np.ndarray, int]]]:
    """Leaf of each 16-bit value and (values, leaf) of visits; weights: rows by value."""
    home = np.zeros(1 << 16, np.int32)
    visits: list[tuple[np.ndarray, int]] = []
    leaves = 0
    everything = np.arange(1 << 16, dtype=np.uint32)
    # (members of the node's region, values that may come within 1 bit of it)
    todo = [(everything, everything, np.uint32(0))]
    while todo:
        own, near, last = todo.pop()
        w = weights[own]
        present = own[w > 0]
        split = None
        if w.sum() > target and len(present) > 1:
            # the value farthest from the last vantage; the least of equals
            vantage = present[np.argmax(np.bitwise_count(present ^ last))]
            d = np.bitwise_count(own ^ vantage).astype(np.int64)
            by = np.bincount(d, weights=w, minlength=17)
            run = np.cumsum(by)
            cuts = np.flatnonzero((run > 0) & (run < run[-1]))
            if len(cuts):
                split = vantage, d, int(cuts[np.argmin(np.abs(run[cuts] - run[-1] / 2))])
        if split is None:
            home[own] = leaves
            visits.append((near, leaves))
            leaves += 1
            continue
        vantage, d, mu = split
        dn = np.bitwise_count(near ^ vantage).astype(np.int64)
        todo.append((own[d > mu], near[dn + 1 > mu], vantage))
        todo.append((own[d <= mu], near[dn - 1 <= mu], vantage))
    # a pair of two leaves is met in the later one
    return home, [(v[home[v] < leaf], leaf) for v, leaf in visits]


def build_forest(counts: np.ndarray, target: int, chunk: int) -> Forest:
    """counts [quarter, value]: how many fingerprints hold the value there."""
    home, first, to, parts = [], [], [], []
    for q in range(4):
        own, visits = _tree(counts[q], target)
        n = own.max() + 1
        members = np.bincount(own, weights=counts[q], minlength=n)
        guests = np.array([counts[q][v].sum() for v, _ in visits])
        parts.append(np.maximum(np.ceil(np.stack([members, guests]).T / chunk), [[1, 0]]).astype(np.int64))
        values = np.concatenate([v for v, _ in visits])
        leaves = np.concatenate([np.full(len(v), leaf, np.int32) for v, leaf in visits])
        order = np.argsort(values, kind="stable")
        first.append(np.searchsorted(values[order], np.arange((1 << 16) + 1)))
        to.append(leaves[order])
        home.append(own)
    return Forest(np.array(home), first, to, parts)


def _spread(x: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """A chunk for each fingerprint, by a mix of all its bits."""
    h = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64)


def _cells(q: int, leaf: np.ndarray, target: np.ndarray, query: np.ndarray, guest: bool) -> np.ndarray:
    """One number for a task: quarter, leaf, chunk of members, chunk it is compared with."""
    return (((np.int64(q) << 17 | leaf.astype(np.int64)) << 21 | target) << 22) | (query << 1) | int(guest)


def deal(fps: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, fingerprint, role) rows: role 1 is a member, 2 is compared with members, 3 is both."""
    cells, out, roles = [], [], []

    def add(cell: np.ndarray, fp: np.ndarray, role: int) -> None:
        cells.append(cell)
        out.append(fp)
        roles.append(np.full(len(fp), role, np.int8))

    for q in range(4):
        value = ((fps >> np.uint64(16 * q)) & np.uint64(0xFFFF)).astype(np.int64)
        leaf = forest.home[q][value]
        n, guests = forest.parts[q][leaf].T
        own = _spread(fps, n)
        add(_cells(q, leaf, own, own, False), fps, 3)
        for j in range(int(n.max(initial=1))):
            lower, higher = np.flatnonzero((j < own) & (j < n)), np.flatnonzero((j > own) & (j < n))
            add(_cells(q, leaf[lower], own[lower], np.int64(j), False), fps[lower], 1)
            add(_cells(q, leaf[higher], np.int64(j), own[higher], False), fps[higher], 2)
        for j in range(int(guests.max(initial=0))):
            hosts = np.flatnonzero(j < guests)
            add(_cells(q, leaf[hosts], own[hosts], np.int64(j), True), fps[hosts], 1)
        lo, hi = forest.first[q][value], forest.first[q][value + 1]
        who = np.repeat(np.arange(len(fps)), hi - lo)
        at = np.arange(len(who)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[who]
        to = forest.visits[q][at]
        n, guests = forest.parts[q][to].T
        mine = _spread(fps[who], guests)
        for j in range(int(n.max(initial=0))):
            meets = np.flatnonzero(j < n)
            add(_cells(q, to[meets], np.int64(j), mine[meets], True), fps[who[meets]], 2)
    return np.concatenate(cells), np.concatenate(out), np.concatenate(roles)


def match(fps: np.ndarray, roles: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, least linked one) within a cell, by all pairs of a member and another."""
    order = np.argsort(fps, kind="stable")
    fps, roles = fps[order], roles[order]
    members, others = np.flatnonzero(roles & 1), np.flatnonzero(roles & 2)
    label = np.arange(len(fps))
    step = max(1, (1 << 21) // max(1, len(members)))
    for lo in range(0, len(others), step):
        rows = others[lo : lo + step]
        near = np.bitwise_count(fps[rows][:, None] ^ fps[members][None, :]) <= bits
        i, j = np.nonzero(near)
        a, b = rows[i], members[j]
        apart = a != b
        a, b = a[apart], b[apart]
        while len(a):
            la, lb = label[a], label[b]
            if (la == lb).all():
                break
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while (label[label] != label).any():
                label = label[label]
    linked = label != np.arange(len(fps))
    return fps[linked], fps[label[linked]]


def links(distinct: DataFrame, bits: int = 4, target: int = 1024, chunk: int = 16384) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``bits`` <= 4 of each other.

    ``distinct`` has each fingerprint once in a long column ``fp``. Of a group of linked
    fingerprints in a cell only the spanning star is returned, never all pairs. ``target``
    is the least size at which a leaf is split, ``chunk`` the most rows of one leaf in a task;
    larger leaves are compared chunk by chunk.
    """
    if not 0 <= bits <= 4:
        raise ValueError("the trees over 16-bit quarters are exact for up to 4 bits")
    spark = ship(distinct.sparkSession)
    quarters = F.posexplode(F.array(*[F.shiftrightunsigned("fp", 16 * q).bitwiseAND(0xFFFF) for q in range(4)]))
    found = distinct.select(quarters.alias("q", "value")).groupBy("q", "value").count()
    counts = np.zeros((4, 1 << 16))
    for q, value, n in found.collect():  # 4 x 65,536 rows at most
        counts[q, value] = n
    forest = spark.sparkContext.broadcast(build_forest(counts, target, chunk))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for lo in range(0, len(fps), 4096):
                cell, fp, role = deal(fps[lo : lo + 4096], forest.value)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fp.view(np.int64)), pa.array(role)], ["cell", "fp", "role"])

    def matched(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = match(pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["role"].to_numpy(), bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    rows = distinct.select("fp").mapInArrow(dealt, "cell long, fp long, role byte")
    return rows.groupBy("cell").applyInPandas(matched, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = 4, seed: int = 42, folder: str | None = None
) -> DataFrame:
    """(id, fp, component_id) of every row: the least id that links within ``bits`` can reach.

    Equal fingerprints are one node of the graph, whatever their number. A NULL or
    wordless text has fingerprint 0 and links like any other. A NULL id counts as no id
    in the choice of the least. Repeated rows stay repeated. An empty table gives an
    empty result; other columns of ``docs`` are ignored, whatever their names.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words, seed), "fingerprints", folder)
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct", folder)
    roots = components(links(distinct, bits), folder)
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = grouped.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    label = stored(grouped.join(ids, "root").select("fp", "component_id"), "labels", folder)
    return prints.join(label, "fp").select("id", "fp", "component_id")


def one_of_each(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """One row of each group of linked texts, with all its columns: that of the least doc_id.

    Rows are told apart by doc_id and two hashes of the text, never by their place, so it is of no
    effect if the documents are read in other pieces the second time. Of rows that share both, one
    stays: that with the least hash of all its columns. A NULL doc_id counts as the largest.
    """
    key, copies, row = fresh(docs, "key", "copies", "row")
    text = F.col("text").cast("string")
    named = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(text).alias("a"), F.crc32(text.cast("binary")).alias("b")
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*columns, named.alias(key))
    found = near_duplicates(keyed, key, folder=folder).where("id <=> component_id")
    found = stored(found.groupBy(F.col("id").alias(key)).agg(F.count("*").alias(copies)), "kept", folder)
    joined = keyed.join(found, keyed[key].eqNullSafe(found[key])).select(*columns, keyed[key], copies)
    # repeated rows are merged apart from the others, which need no further step
    again = joined.where(F.col(copies) > 1).groupBy(key).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias(row))
    again = again.select(*[F.col(row)[c].alias(c) for c in docs.columns])
    return joined.where(F.col(copies) == 1).select(*columns).unionByName(again)


def op4(spark, folder: str) -> DataFrame:
    """The contract's digest of ``documents``: doc_id, fingerprint, component_id."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = near_duplicates(docs)
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
