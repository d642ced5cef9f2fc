"""Best-fit packing of token sequences by bin completion."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import ship, table
from acuity.session import stored

_ENCODERS: dict[str, Callable] = {}


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids of a byte-level BPE file; the string of a special token in a text is that token.

    Ranks equal ids there, so the faster library gives the same ids as the one that
    wrote the file (held against it in the tests).
    """
    if path not in _ENCODERS:
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_alphabet()
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", []) if x.get("special")}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        core = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        _ENCODERS[path] = lambda text: np.array(core.encode(text, allowed_special="all"), "<u4")
    return _ENCODERS[path]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, the rest in the first."""
    first = n % size or size if n > size else n
    return [(0, first), *((at, size) for at in range(first, n, size))]


def pieces(docs: DataFrame, path: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text", end: int = 0) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids with ``end`` behind them.

    NULL counts as the empty text, which is the end id alone.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            who, rest = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                for k, (start, n) in enumerate(cut(len(ids), size)):
                    who.append(row)
                    rest.append((k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
            columns = [pa.array(c, t) for c, t in zip(zip(*rest, strict=True), (pa.int32(), *[pa.int64()] * 3), strict=True)] if rest else []
            if rest:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(who)), *columns], ["id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(work, f"id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: np.ndarray, size: int) -> list[list[int]]:
    """Best-fit decreasing over a histogram of lengths, one bin at a time."""
    left = counts.copy()
    bins = []
    largest = len(left) - 1
    while True:
        while largest and not left[largest]:
            largest -= 1
        if not largest:
            return bins
        bins.append(_fill(left, [largest], size - largest))


def _fill(left: np.ndarray, taken: list[int], room: int) -> list[int]:
    """Take the largest that fits, again and again."""
    left[taken[-1]] -= 1
    at = room
    while at > 0:
        fits = np.flatnonzero(left[: at + 1])
        if not len(fits):
            break
        at = int(fits[-1])
        left[at] -= 1
        taken.append(at)
        room -= at
        at = room
    return taken


def completions(left: np.ndarray, room: int, waste: int, most: int = 64, effort: list[int] | None = None) -> list[tuple[int, tuple[int, ...]]]:
    """Undominated fillings of ``room`` that waste at most so much, least waste first.

    A filling is dominated if a length in it can be exchanged for a larger one that is
    left and still fits. ``most`` bounds how many are weighed at a node of the search;
    the steps taken are counted off ``effort``.
    """
    out: list[tuple[int, tuple[int, ...]]] = []
    have = np.flatnonzero(left[: room + 1])[::-1].tolist()
    left = left.copy()
    steps = [0]

    def walk(at: int, room: int, taken: tuple[int, ...]) -> None:
        steps[0] += 1
        if len(out) >= most or steps[0] > 50 * most:
            return
        fit = False
        for k in range(at, len(have)):
            x = have[k]
            if x <= room and left[x]:
                fit = True
                left[x] -= 1
                walk(k, room - x, (*taken, x))
                left[x] += 1
                if out and out[-1][0] == 0 and len(out) >= most // 4:
                    return
        if not fit and room <= waste and not any(left[x + 1 : x + room + 1].any() for x in taken):
            # a smaller length left out earlier may still fit: then it isn't maximal
            if not left[1 : room + 1].any():
                out.append((room, taken))

    walk(0, room, ())
    if effort is not None:
        effort[0] -= steps[0]
    return sorted(set(out), key=lambda f: (f[0], tuple(-x for x in f[1])))


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Bins that any packing needs: by volume, and by the lengths of which no two share a bin."""
    total = int((counts * np.arange(len(counts))).sum())
    return max(-(-total // size), int(counts[size // 2 + 1 :].sum()))


def bin_completion(counts: np.ndarray, size: int, effort: int = 50_000, tail: int = 48) -> list[list[int]]:
    """Bins of at most ``size``, as few as the search finds.

    The incumbent is best-fit decreasing. If that is above the lower bound, bins are
    completed around the largest length left, best filling first, and a branch ends once
    its waste leaves no way to fewer bins than the incumbent. Depth first; all bins are
    searched again with other fillings, ``tail`` bins together in at most about ``effort`` steps: the
    last ones, then all by waste, the most first, then bins of much waste beside bins of little,
    until no group gets better. All lengths are packed whatever the search finds.
    """
    best = best_fit(counts, size)
    bound = lower_bound(counts, size)
    if len(best) <= bound:
        return best
    first = _complete(counts.copy(), size)
    if len(first) < len(best):
        best = first
    if len(best) <= bound:
        return best
    best = best[:-tail] + _again(best[-tail:], counts, size, effort)
    fewer = True
    while fewer and len(best) > bound:
        before = len(best)
        for mixed in (False, True):
            best.sort(key=sum)
            groups = max(1, -(-len(best) // tail))
            dealt = [best[k::groups] if mixed else best[k * tail : (k + 1) * tail] for k in range(groups)]
            best = []
            for k, group in enumerate(dealt):
                if len(best) + sum(map(len, dealt[k:])) > bound:
                    group = _again(group, counts, size, effort)
                best += group
        fewer = len(best) < before
    return best


def _again(bins: list[list[int]], counts: np.ndarray, size: int, effort: int) -> list[list[int]]:
    """What some bins hold, in fewer if the search finds that."""
    own = np.zeros_like(counts)
    for b in bins:
        np.add.at(own, b, 1)
    return _search(own, size, bins, effort)


def _complete(left: np.ndarray, size: int) -> list[list[int]]:
    """Complete each bin by its best filling, found among few."""
    bins = []
    while left.any():
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        found = completions(left, size - largest, size, 8)
        taken = [largest, *(found[0][1] if found else ())]
        for x in taken[1:]:
            left[x] -= 1
        if not found:
            left[largest] += 1
            taken = _fill(left, [largest], size - largest)
        bins.append(taken)
    return bins


def _search(counts: np.ndarray, size: int, incumbent: list[list[int]], effort: int) -> list[list[int]]:
    best = incumbent
    total = int((counts * np.arange(len(counts))).sum())
    bound = lower_bound(counts, size)
    steps = [effort]
    # (lengths left, bins so far, waste so far)
    todo: list[tuple[np.ndarray, list[list[int]], int]] = [(counts, [], 0)]
    while todo and steps[0] > 0 and len(best) > bound:
        left, bins, waste = todo.pop()
        steps[0] -= 1
        spare = (len(best) - 1) * size - total - waste
        if spare < 0:
            continue
        if not left.any():
            best = bins
            continue
        largest = int(np.flatnonzero(left)[-1])
        after = left.copy()
        after[largest] -= 1
        for lost, filling in reversed(completions(after, size - largest, spare, effort=steps)):
            rest = after.copy()
            np.subtract.at(rest, list(filling), 1)
            todo.append((rest, [*bins, [largest, *filling]], waste + lost))
    return best


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length."""
    counts = np.bincount(lengths, minlength=size + 1)
    full = int(counts[size])
    counts[size] = 0
    bins = [[size]] * full + bin_completion(counts, size)
    flat = np.fromiter((x for b in bins for x in b), np.int64)
    number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    ends = np.cumsum(flat)
    starts = ends - flat
    first = np.concatenate(([0], np.flatnonzero(np.diff(number)) + 1)).astype(np.int64) if len(flat) else np.zeros(0, np.int64)
    offset = starts - np.repeat(starts[first], np.diff(np.append(first, len(flat))))
    slots, items = np.argsort(flat, kind="stable"), np.argsort(lengths, kind="stable")
    where, at = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    where[items], at[items] = number[slots], offset[slots]
    return where, at


def pack(rows: DataFrame, size: int = 2048, shard: int = 50_000, folder: str | None = None) -> DataFrame:
    """Add (sequence_id, offset) to rows with a long column ``length`` from 1 to ``size``.

    Rows are dealt evenly into shards of about ``shard`` rows by their place in the
    written table, whatever their values, and each shard is packed by its histogram of
    lengths. A shard costs at most the unfilled end of its packing.
    """
    kept = stored(rows, "pieces", folder)
    shards = max(1, -(-kept.count() // shard))
    place_in = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    ship(rows.sparkSession)

    def packed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        where, at = place(pdf["length"].to_numpy(np.int64), size)
        return pdf.drop(columns="shard").assign(sequence_id=where + (np.int64(key[0]) << 40), offset=at)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.withColumn("shard", place_in).groupBy("shard").applyInPandas(packed, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, path: str, size: int = 2048, id_col: str = "doc_id", text_col: str = "text", shard: int = 50_000, folder: str | None = None
) -> DataFrame:
    """Tokenise, cut and pack whole documents.

    Returns (id, piece, start, length, ids_crc32, sequence_id, offset). A NULL or empty text
    is the end id alone. Repeated rows are packed each for itself; an empty table
    gives an empty result; other columns are ignored.
    """
    return pack(pieces(docs, path, size, id_col, text_col), size, shard, folder)


def op7(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")
