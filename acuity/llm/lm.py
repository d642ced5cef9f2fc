"""Language model scoring by logistic mixing of hashed-context bit predictors (after Mahoney 2005).

A text is its words, lower-cased, each followed by a space, and an end. A word that has followed the
last two words or the last one before is coded by binary decisions over these contexts (:mod:`successors`).
Any other is spelled: every byte is coded as eight binary decisions. Each decision is predicted from the
counts of several contexts: the last one, two and three bytes of the word, its whole beginning, and the
beginning with the mark, the last byte of the latest non-ASCII letter before the word
(which tells languages apart). A mixer weighs the predictions by logistic weights, of
which a gate picks one set for each level of confidence, and a refinement table corrects
its result by what followed such predictions.

What spelling a word costs depends on word and mark alone, so it is worked out by distinct words: chunks of
documents are reduced to word counts and the texts as sequences of their words, a shuffle in word
order adds counts up over the corpus, each word is spelled once, and a shuffle by chunk takes the costs back.
There, the counts of its pairs and triples of words arrive too, and the decisions are taken along the text.

Counts are of every occurrence; a decision of a byte sees them in 16 bits each, scaled down together where one
is over 65,535. They stay in Spark: words lie in blocks of the word order, which know nearly all whole
beginnings by themselves; of the other contexts a block asks the parts that add up all blocks' counts. No
task and no broadcast holds all contexts. The weights come from sums over all events, whatever the
blocks, so the score does not depend on how the work is parted.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.llm import successors
from acuity.llm.common import forget, release, remainder, ship, table
from acuity.session import stored

_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b"\x20\x09\x0a\x0b\x0c\x0d" else c for c in range(256))
END = b"\n"
#: a factor for each context: one byte, two, three, beginning, beginning with mark
_PRIMES = tuple(np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))
#: the eight decisions of a byte: nodes of a binary tree, and the turns taken
_BITS = (np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1
_NODES = np.array([[(1 << i) | (b >> (8 - i)) for i in range(8)] for b in range(256)], np.uint32)
_GATES = 4 * 4 * 8
_LOW = np.uint64(255)
_STEPS = 33  # of the refinement table, over the mixer's result from -8 to 8
_WIDTH = 48  # bytes; longer words are coded apart
_SOME = 64  # words of a chunk, for the edges of ranges


# ---------------------------------------------------------------- from texts to chunks


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _mark(word: bytes) -> int:
    """The last byte of a word's last non-ASCII letter."""
    return next(b for b in reversed(word) if b >= 128)


def _tokens(texts: pa.LargeBinaryArray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words and the end, number of each token, tokens of each text); a text's tokens follow each other."""
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    raw = data.slice(at[0], at[-1] - at[0]).to_pybytes() if data else b""
    raw, at = np.frombuffer(raw.translate(_FOLD), np.uint8), at - at[0]
    inside = raw != 32
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # a word does not go on from one text to the next
    first, last = at[at < len(raw)], at[at > 0] - 1
    begins[first], ends[last] = inside[first], inside[last]
    start = np.flatnonzero(begins)
    offsets = np.concatenate(([0], np.cumsum(np.flatnonzero(ends) + 1 - start)))
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
    distinct = [*words.dictionary.to_pylist(), END]
    lens = np.diff(np.searchsorted(start, at)) + 1
    sequence = np.full(len(start) + len(lens), len(distinct) - 1, np.int32)
    token = np.ones(len(sequence), bool)
    token[np.cumsum(lens) - 1] = False
    sequence[token] = words.indices.to_numpy()
    return distinct, sequence, lens


def _marked(words: list[bytes], sequence: np.ndarray, lens: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, their marks, sequence) of distinct words and marks; a word has a number for each mark that it stands behind."""
    own = np.array([0 if w.isascii() else _mark(w) for w in words], np.int32)
    token = own[sequence]
    place = np.arange(len(sequence))
    # the latest word with a mark, before this one and in its text
    latest = np.maximum.accumulate(np.where(token > 0, place, -1))
    latest = np.concatenate(([-1], latest[:-1]))
    mark = np.where(latest >= np.repeat(np.cumsum(lens) - lens, lens), token[latest], 0)
    plain = mark == 0
    there = np.flatnonzero(np.bincount(sequence[plain], minlength=len(words)))
    more, at = np.unique(mark[~plain].astype(np.int64) << 32 | sequence[~plain], return_inverse=True)
    number = np.zeros(len(words), np.int32)
    number[there] = np.arange(len(there))
    out = np.empty_like(sequence)
    out[plain], out[~plain] = number[sequence[plain]], len(there) + at
    word = np.concatenate((there, more & 0xFFFFFFFF))
    return [words[i] for i in word.tolist()], np.concatenate((np.zeros(len(there), np.int64), more >> 32)).astype(np.int32), out


def _chunk(ids: pa.Array, held: np.ndarray, texts: pa.LargeBinaryArray) -> dict:
    """Documents as sequences of (mark, word) numbers."""
    words, marks, sequence = _marked(*(found := _tokens(texts)))
    train = np.bincount(sequence[np.repeat(~held, found[2])], minlength=len(words))
    return {
        "docs": ids, "held": pa.array(held), "tokens": pa.array(found[2], pa.int64()), "rows": len(words) + sum(map(len, words)) // 64, "words": joined(words),
        "marks": successors.planes(marks), "train": successors.planes(train.astype(np.int32)), "postings": successors.planes(sequence),
        "some": pa.array([w[:1024] for w in words[:: -(-len(words) // _SOME)] if 0 not in w], pa.binary()),
    }


def joined(words: list[bytes]) -> bytes:
    return zstandard.compress(b" ".join(words), 1)


def parted(data: bytes) -> list[bytes]:
    """The words of ``joined``, one at least."""
    return zstandard.decompress(data).split(b" ")


def chunks(docs: DataFrame, held: F.Column, id_col: str, text_col: str, size: int) -> DataFrame:
    """One row for about ``size`` characters of text: its words with counts, and each document as their sequence."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), held.alias("held"))
    kind = rows.schema["id"].dataType.simpleString()

    def row(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids, held, texts = (pa.concat_arrays([p[c] for p in parts]) for c in ("id", "held", "text"))
        own = {"chunk": number, **_chunk(ids, held.to_numpy(zero_copy_only=False).astype(bool), texts)}
        return pa.RecordBatch.from_pydict(
            {k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) if isinstance(v, pa.Array) else pa.array([v]) for k, v in own.items()}
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        parts: list[pa.RecordBatch] = []
        now = 0
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch["text"]), 0).to_pylist()
            texts = pc.fill_null(batch["text"].cast(pa.large_binary()), b"")
            batch = pa.RecordBatch.from_arrays([batch["id"], texts, batch["held"]], ["id", "text", "held"])
            lo = 0
            for hi, length in enumerate(lengths, 1):
                now += length + 64
                if now >= size:
                    yield row(number, [*parts, batch.slice(lo, hi - lo)])
                    parts, now, lo, number = [], 0, hi, number + 1
                    release()
            if lo < len(lengths):
                parts.append(batch.slice(lo))
        if parts:
            yield row(number, parts)
        del parts
        release()

    return rows.mapInArrow(
        work,
        f"chunk long, docs array<{kind}>, held array<boolean>, tokens array<long>, rows long, words binary, marks binary, train binary, postings binary, some array<binary>",
    )


_BLOCK = "block long, n long, v long, size long, words binary, marks binary, weights binary, rest binary"


def _row_of_block(number: int, word: list[bytes], mark: np.ndarray, weights: np.ndarray, v: int, rest: tuple[np.ndarray, ...]) -> dict:
    """``word``, ``mark`` and ``weights`` are of distinct words and marks; ``rest`` has chunk, count, place and number of each row."""
    return {
        "block": number, "n": int(weights.sum()), "v": v, "size": sum(map(len, word)) + len(word), "words": joined(word),
        "marks": mark.astype(np.int32).tobytes(), "weights": weights.astype(np.int64).tobytes(),
        "rest": zstandard.compress(b"".join(a.astype(t).tobytes() for a, t in zip(rest, (np.int64, np.int64, np.int32, np.int32), strict=True)), 1),
    }


def vocabulary(found: DataFrame, part: int = 1 << 19, size: int = 1 << 18) -> DataFrame:
    """The words of all chunks in blocks, each a stretch of the word order: one row for about ``size`` rows of chunks.

    Chunks deal their words out by ranges of the word order, with about ``part`` rows each (fewer of long words); edges come from some words of each
    chunk. A range adds up its words' counts. A frequent word has a row for each chunk and mark, never one for each document.
    """
    parts = math.ceil((found.agg(F.sum("rows")).first()[0] or 0) / part)
    some = sorted(bytes(r[0]) for r in found.select(F.explode("some")).collect())
    edges = sorted({some[i * len(some) // parts] for i in range(1, parts)}) if some else []

    def ranges(words: list[bytes]) -> np.ndarray:
        """How many edges are not above each word; they hold no zero byte, so one byte more tells a short word from a longer edge."""
        kind = f"S{_WIDTH + 1}"
        to = np.searchsorted(np.array(edges, kind), np.array(words, kind), "right").astype(np.int32)
        long = [i for i, w in enumerate(words) if len(w) > _WIDTH]
        to[long] = [bisect_right(edges, words[i]) for i in long]
        return to

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words = parted(r["words"])
                marks, train = (successors.read_planes(r[c], np.int32) for c in ("marks", "train"))
                to = ranges(words)
                order = np.argsort(to, kind="stable").astype(np.int32)
                ends = [0, *(np.flatnonzero(np.diff(to[order])) + 1).tolist(), len(order)]
                own = [order[a:b] for a, b in itertools.pairwise(ends)]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([int(to[o[0]]) for o in own], pa.int64()), "chunk": [r["chunk"]] * len(own),
                    "words": [joined([words[i] for i in o.tolist()]) for o in own],
                    "rest": [successors.planes(np.concatenate((o, marks[o], train[o]))) for o in own],
                })
                del words, marks, train, to, order, own
        release()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        own = [parted(w) for w in pdf["words"]]
        place, mark, train = np.concatenate([successors.read_planes(r, np.int32).reshape(3, -1) for r in pdf["rest"]], axis=1)
        chunk = np.repeat(pdf["chunk"].to_numpy(), [len(w) for w in own])
        words = pa.array(itertools.chain.from_iterable(own), pa.large_binary()).dictionary_encode()
        del own
        by_word = pc.sort_indices(words.dictionary).to_numpy()
        distinct = words.dictionary.take(pa.array(by_word)).to_pylist()
        rank = np.empty(len(by_word), np.int64)
        rank[by_word] = np.arange(len(by_word))
        key = rank[words.indices.to_numpy()] << 8 | mark
        order = np.argsort(key, kind="stable")
        key, train = key[order], train[order]
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        weights = np.add.reduceat(train, heads, dtype=np.int64)
        of = np.repeat(np.arange(len(heads)), np.diff(heads, append=len(key)))
        word = key >> 8
        c = np.bincount(word, weights=train).astype(np.int64)
        # whole words, of so many rows or so many bytes
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        held = np.cumsum(1 + np.array([len(w) for w in distinct])[word] // 256)
        most = math.ceil(held[-1] / max(1, round(held[-1] / size)))
        out, lo = [], 0
        first = int(pdf["part"].iloc[0]) << 24
        while lo < len(key):
            at = np.searchsorted(held, (held[lo - 1] if lo else 0) + most) + 1
            hi = int(starts[k]) if (k := np.searchsorted(starts, at)) < len(starts) else len(key)
            a, b = of[lo], of[hi - 1] + 1
            own = key[heads[a:b]]
            rest = chunk[order[lo:hi]], c[word[lo:hi]], place[order[lo:hi]], of[lo:hi] - a
            known = int(np.count_nonzero(c[word[lo] : word[hi - 1] + 1]))
            out.append(_row_of_block(first + len(out), [distinct[i] for i in (own >> 8).tolist()], own & 255, weights[a:b], known, rest))
            lo = hi
        del words, distinct, rank, key, order, word, held, of
        release()
        return pd.DataFrame(out)

    sent = found.select("chunk", "words", "marks", "train").mapInArrow(work, "part long, chunk long, words binary, rest binary")
    return sent.groupBy("part").applyInPandas(add, _BLOCK)


# ---------------------------------------------------------------- events of coding words


@dataclass
class _Events:
    """Each distinct step from a beginning to its next byte, over words in order."""

    byte: np.ndarray
    weight: np.ndarray
    before: np.ndarray  # weight of the beginning
    hashes: np.ndarray  # [event, context] 56 bits, the lowest eight are left for the byte
    path: np.ndarray  # [word, position] the event there
    length: np.ndarray

    def keys(self) -> np.ndarray:
        """[event, context] hash and byte."""
        return self.hashes | self.byte[:, None].astype(np.uint64)


def _events(words: list[bytes], marks: np.ndarray, weights: np.ndarray) -> Iterator[tuple[np.ndarray, _Events]]:
    """(places of words, their events); equal beginnings with equal marks share their events."""
    size = np.array([len(w) for w in words])
    for lo, hi in ((0, _WIDTH), (_WIDTH, 256), (256, 4096), (4096, 1 << 62)):
        own = np.flatnonzero((size >= lo) & (size < hi))
        # the longer the words the fewer at a time
        step = max(1, (1 << 20) // (min(hi, int(size[own].max(initial=0)) + 1) + 1))
        # by mark, then in the order given, which is the words' own
        own = own[np.argsort(marks[own], kind="stable")]
        for at in range(0, len(own), step):
            some = own[at : at + step]
            yield some, _steps([words[i] for i in some], marks[some], weights[some])


def _steps(words: list[bytes], marks: np.ndarray, weights: np.ndarray) -> _Events:
    coded = [w if w == END else w + b" " for w in words]
    length = np.array([len(w) for w in coded])
    width = int(length.max())
    grid = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in coded), np.uint8).reshape(len(words), width)
    same = np.zeros((len(words), width), bool)
    same[1:] = (grid[1:] == grid[:-1]) & (marks[1:] == marks[:-1])[:, None]
    shared = np.logical_and.accumulate(same, axis=1)
    real = np.arange(width)[None, :] < length[:, None]
    new = real & ~shared
    row = np.maximum.accumulate(np.where(new, np.arange(len(words))[:, None], 0), axis=0)
    col, at = np.nonzero(new.T)
    number = np.zeros((len(words), width), np.int64)
    number[at, col] = np.arange(len(at))
    path = number[row, np.arange(width)[None, :]]
    weight = np.bincount(path[real], weights=np.broadcast_to(weights[:, None], real.shape)[real], minlength=len(at))
    before = np.full(len(at), weights.sum(), np.float64)
    deeper = col > 0
    before[deeper] = weight[path[at[deeper], col[deeper] - 1]]
    # contexts
    start = np.zeros((len(words), width + 1), np.uint64)
    for i in range(width):
        start[:, i + 1] = (start[:, i] + grid[:, i].astype(np.uint64) + np.uint64(1)) * _PRIMES[0]
    last = [np.where(col > k, grid[at, np.maximum(col - 1 - k, 0)], 0).astype(np.uint64) for k in range(3)]
    mark = marks[at].astype(np.uint64)
    whole = start[at, col]
    one = last[0] | mark << np.uint64(8)
    two = last[0] | last[1] << np.uint64(8) | np.uint64(1 << 32)
    three = two | last[2] << np.uint64(16) | np.uint64(1 << 33)
    keys = (one, two, three, whole, whole + mark * _PRIMES[1] + np.uint64(1))
    hashes = np.empty((len(at), len(_PRIMES)), np.uint64)
    for k, key in enumerate(keys):
        h = (key + np.uint64(k + 1)) * _PRIMES[k]
        h = (h ^ (h >> np.uint64(31))) * _PRIMES[(k + 1) % 5]
        hashes[:, k] = (h ^ (h >> np.uint64(29))) & ~_LOW
    return _Events(grid[at, col], weight, before, hashes, path, length)


def _slots(hashes: np.ndarray, byte: np.ndarray, k: int) -> np.ndarray:
    """[event, decision] place of a decision: its context's hash and its node."""
    return hashes[:, k, None] | _NODES[byte].astype(np.uint64)


def _batches(batches, *names: str, least: int = 1 << 16, size: int = 1 << 23):
    """Columns of Arrow batches put together to at least so many rows or bytes."""
    parts: list[pa.RecordBatch] = []
    rows = held = 0
    for batch in batches:
        parts.append(batch)
        rows += batch.num_rows
        held += batch.nbytes
        if rows >= least or held >= size:
            yield pa.Table.from_batches(parts).select(list(names))
            parts, rows, held = [], 0, 0
    if rows:
        yield pa.Table.from_batches(parts).select(list(names))


# ---------------------------------------------------------------- counts of contexts


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[: len(keys)]
    return keys[first], np.add.reduceat(weights, first) if len(keys) else weights


class Counts:
    """Exact counts of the bytes that follow contexts: distinct keys (context and byte) in order."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray) -> None:
        self.keys = keys
        self.sums = np.concatenate(([0], np.cumsum(weights.astype(np.int64))))

    def at(self, keys: np.ndarray) -> np.ndarray:
        """[key, decision] counts of both turns, of turn 0 in the lower and of turn 1 in the upper 16 bits.

        The bytes below a node of the tree lie side by side, so a count is the difference of two sums.
        """
        byte = keys & _LOW
        context = keys - byte
        out = np.empty((len(keys), 8), np.uint32)
        low = self.sums[np.searchsorted(self.keys, context)]
        high = self.sums[np.searchsorted(self.keys, context | _LOW, "right")]
        for i in range(8):
            half = np.uint64(128 >> i)
            middle = self.sums[np.searchsorted(self.keys, context | byte & ~(half * np.uint64(2) - np.uint64(1)) & _LOW | half)]
            out[:, i] = self._packed(middle - low, high - middle)
            turn = (byte & half) > 0
            low, high = np.where(turn, middle, low), np.where(turn, high, middle)
        return out

    def all(self, piece: int = 1 << 16) -> np.ndarray:
        """``at`` of all keys that are held, without a search: the keys below a node of the tree follow each other."""
        out = np.empty((len(self.keys), 8), np.uint32)
        lo = 0
        while lo < len(self.keys):
            # whole contexts, for about ``piece`` keys at a time
            last = self.keys[min(lo + piece, len(self.keys)) - 1]
            hi = int(np.searchsorted(self.keys, last | _LOW, "right"))
            self._piece(lo, hi, out[lo:hi])
            lo = hi
        return out

    def _piece(self, lo: int, hi: int, out: np.ndarray) -> None:
        keys, sums = self.keys[lo:hi], self.sums[lo : hi + 1]
        differ = keys[1:] ^ keys[:-1]

        def below(shift: int) -> np.ndarray:
            edges = np.concatenate(([0], np.flatnonzero(differ >> np.uint64(shift)) + 1, [len(keys)]))
            return np.repeat(np.diff(sums[edges]), np.diff(edges))

        node = below(8)
        for i in range(8):
            own = below(7 - i)
            turn = (keys & np.uint64(128 >> i)) > 0
            out[:, i] = self._packed(np.where(turn, node - own, own), np.where(turn, own, node - own))
            node = own

    @staticmethod
    def _packed(none: np.ndarray, one: np.ndarray) -> np.ndarray:
        over = np.maximum(none, one)
        if (over > 65535).any():  # scaled down where a count is over 65,535
            none, one = (np.minimum(np.ceil(x * np.minimum(1, 65535 / np.maximum(over, 1))), 65535) for x in (none, one))
        return none.astype(np.uint32) | one.astype(np.uint32) << np.uint32(16)

    def __getitem__(self, slots) -> np.ndarray:
        """Counts at places given by ``_slots``."""
        slots = np.asarray(slots, np.uint64)
        node = slots.ravel() & _LOW
        level = np.log2(node.astype(np.float64)).astype(np.int64)
        byte = node << (8 - level).astype(np.uint64) & _LOW
        return self.at(slots.ravel() - node | byte)[np.arange(len(node)), level].reshape(slots.shape)


def count_contexts(words: DataFrame) -> Counts:
    """The counts of all contexts, from (word, mark, cw), on the driver: for texts outside a corpus.

    ``score`` never gathers them in one place.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches(batches, "word", "mark", "cw"):
            for _, e in _events(rows["word"].to_pylist(), rows["mark"].to_numpy(), rows["cw"].to_numpy().astype(np.float64)):
                keys, n = _summed(e.keys().ravel(), np.repeat(e.weight, len(_PRIMES)))
                yield pa.RecordBatch.from_pydict({"keys": [keys.tobytes()], "n": [n.tobytes()]})

    got = words.mapInArrow(work, "keys binary, n binary").collect()
    keys = np.frombuffer(b"".join(r["keys"] for r in got), np.uint64)
    return Counts(*_summed(keys, np.frombuffer(b"".join(r["n"] for r in got))))


def blocks(rows: DataFrame, least: int = 1 << 15) -> DataFrame:
    """A vocabulary in word order (chunk, place, word, mark, c, cw, head, first) in blocks: one row for at least ``least`` of its rows.

    c counts the word in training tokens, cw with its mark; ``head`` is the first row of a word and mark, ``first`` the first of a word.

    ``words``, ``marks`` and ``weights`` are of distinct words and marks, ``rest`` of the rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        for k, t in enumerate(_batches(batches, "chunk", "place", "word", "mark", "c", "cw", "head", "first", least=least)):
            word, mark = t["word"].to_pylist(), t["mark"].to_numpy().astype(np.int32)
            c, cw, head = t["c"].to_numpy().astype(np.int64), t["cw"].to_numpy().astype(np.int64), t["head"].to_numpy()
            # rows of one word and mark follow each other
            new = np.array([True, *(a != b for a, b in zip(word, word[1:], strict=False))]) | np.concatenate(([True], mark[1:] != mark[:-1]))
            at = np.flatnonzero(new)
            # a word and mark that goes on from the block before is counted there
            weights = np.where(head, cw, 0)[at]
            rest = (t["chunk"].to_numpy().astype(np.int64), c, t["place"].to_numpy().astype(np.int32), (np.cumsum(new) - 1).astype(np.int32))
            row = _row_of_block(first + k, [word[i] for i in at], mark[at], weights, int(np.sum(t["first"].to_numpy() & (c > 0))), rest)
            yield pa.RecordBatch.from_pydict({name: [value] for name, value in row.items()})
        release()

    return rows.mapInArrow(work, _BLOCK)


class _Block:
    """A block's words and the events of coding them."""

    def __init__(self, words: bytes, marks: bytes, weights: bytes) -> None:
        own = parted(words)
        self.size = len(own)
        self.pieces = list(_events(own, np.frombuffer(marks, np.int32), np.frombuffer(weights, np.int64).astype(np.float64)))
        self.byte = np.concatenate([e.byte for _, e in self.pieces])
        self.weight = np.concatenate([e.weight for _, e in self.pieces])
        self.keys = np.concatenate([e.keys() for _, e in self.pieces])
        # Words of one beginning follow each other in the word order. So other blocks have only those
        # beginnings that the first or the last word has too; all else is known here.
        ends = [e.hashes[:, 3] for _, e in _events([own[0], own[-1]], np.zeros(2, np.int32), np.ones(2))]
        self.abroad = np.isin(np.concatenate([e.hashes[:, 3] for _, e in self.pieces]), np.concatenate(ends))

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys that other blocks may have too, with this block's weights."""
        keys = [self.keys[:, k] for k in range(3)] + [self.keys[self.abroad, k] for k in (3, 4)]
        return _summed(np.concatenate(keys), np.concatenate([self.weight] * 3 + [self.weight[self.abroad]] * 2))

    def pairs(self, keys: np.ndarray, found: np.ndarray) -> np.ndarray:
        """[event, context, decision] counts, from what all blocks have of the keys asked for."""
        out = np.empty((*self.keys.shape, 8), np.uint32)
        for k in range(3):
            out[:, k] = found[np.searchsorted(keys, self.keys[:, k])]
        for k in (3, 4):
            # contexts known abroad hold none of the others' events, so they are counted along and then replaced
            distinct, at = np.unique(self.keys[:, k], return_inverse=True)
            out[:, k] = Counts(distinct, np.bincount(at, weights=self.weight, minlength=len(distinct))).all()[at]
            out[self.abroad, k] = found[np.searchsorted(keys, self.keys[self.abroad, k])]
        return out


def exchange(found: DataFrame, size: int) -> DataFrame:
    """(block, part, n, keys, pairs): the counts over all blocks of the keys that each asks for.

    Keys are dealt by their hash into parts, of which there are the more the larger the vocabulary (``size``
    bytes) is. A part adds up what the blocks have and answers each.
    """
    bits = max(6, math.ceil(math.log2(max(1, size) / (1 << 20))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys, n = _Block(r["words"], r["marks"], r["weights"]).asked()
                part = (keys >> np.uint64(64 - bits)).astype(np.int64)
                edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(keys)]
                data = [zstandard.compress(keys[a:b].tobytes() + n[a:b].tobytes(), 1) for a, b in itertools.pairwise(edges)]
                yield pa.RecordBatch.from_pydict({
                    "part": part[edges[:-1]], "block": [r["block"]] * len(data), "n": np.diff(edges), "data": data,
                })
        release()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        own = []
        for n, data in zip(pdf["n"], pdf["data"], strict=True):
            raw = zstandard.decompress(data)
            own.append((np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.float64, n, 8 * n)))
        keys, weights = _summed(np.concatenate([k for k, _ in own]), np.concatenate([w for _, w in own]))
        pairs = Counts(keys, weights).all()
        answer = [zstandard.compress(k.tobytes() + pairs[np.searchsorted(keys, k)].tobytes(), 1) for k, _ in own]
        return pd.DataFrame({"block": pdf["block"], "part": pdf["part"], "n": pdf["n"], "data": answer})

    sent = found.select("block", "words", "marks", "weights").mapInArrow(work, "part long, block long, n long, data binary")
    return sent.groupBy("part").applyInPandas(add, "block long, part long, n long, data binary")


def prepared(words: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with the counts that it asked for in one row, for work that needs no further shuffle."""

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("part")
        return left.assign(ns=[right["n"].to_numpy(np.int64)], data=[right["data"].tolist()])

    shape = "block long, words binary, marks binary, weights binary, rest binary, ns array<long>, data array<binary>"
    own = words.select("block", "words", "marks", "weights", "rest")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(join, shape)


def _counted(row: dict) -> tuple[_Block, np.ndarray]:
    """A prepared row's block and the counts of its events."""
    block = _Block(row["words"], row["marks"], row["weights"])
    return block, block.pairs(*_answered(pd.DataFrame({"part": range(len(row["ns"])), "n": row["ns"], "data": row["data"]})))


def _answered(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a block in order and their counts."""
    pdf = pdf.sort_values("part")
    keys, pairs = [np.empty(0, np.uint64)], [np.empty((0, 8), np.uint32)]
    for n, data in zip(pdf["n"], pdf["data"], strict=True):
        raw = zstandard.decompress(data)
        keys.append(np.frombuffer(raw, np.uint64, n))
        pairs.append(np.frombuffer(raw, np.uint32, 8 * n, 8 * n).reshape(n, 8))
    return np.concatenate(keys), np.concatenate(pairs)


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """Weights of the mixer by gate, the refinement table, and the counts where they are on one machine."""

    weights: np.ndarray  # [gate, context and bias]
    refine: np.ndarray  # [node, step] logistic units
    counts: Counts | None = None

    @staticmethod
    def inputs(pairs: np.ndarray, byte: np.ndarray, leave_out: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(stretched predictions [event x decision, context and bias], gates).

        With ``leave_out``, one occurrence of each event itself is taken out of the counts.
        """
        turn = _BITS[byte].ravel()
        x = np.empty((len(turn), len(_PRIMES) + 1), np.float32)
        x[:, -1] = 0.3
        level = np.zeros(len(turn), np.int64)
        for k in range(len(_PRIMES)):
            pair = pairs[:, k].ravel()
            none, one = (pair & np.uint32(65535)).astype(np.float32), (pair >> np.uint32(16)).astype(np.float32)
            if leave_out:
                one -= (turn == 1) & (one > 0)
                none -= (turn == 0) & (none > 0)
            x[:, k] = np.log((one + np.float32(0.3)) / (none + np.float32(0.3)))
            if k in (2, 4):
                seen = none + one
                level = level * 4 + (seen > 0.5) + (seen > 3) + (seen > 24)
        return x, level * 8 + np.tile(np.arange(8), len(byte))

    def refined(self, stretch: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Probability of turn 1: the mean of the mixer's and the table's, in logistic units."""
        node = _NODES[byte].astype(np.int64).ravel()
        at = np.clip((stretch + 8) * 2, 0, _STEPS - 1.001)
        low = at.astype(np.int64)
        part = at - low
        table = self.refine[node, low] * (1 - part) + self.refine[node, low + 1] * part
        return 1 / (1 + np.exp(-np.clip((stretch + table) / 2, -14, 14)))

    def cost(self, events: _Events, pairs: np.ndarray | None = None, piece: int = 1 << 15) -> np.ndarray:
        """log10 probability of each event, from its counts or else from those held here."""
        out = np.empty(len(events.byte))
        for lo in range(0, len(out), piece):
            byte = events.byte[lo : lo + piece]
            own = pairs[lo : lo + piece] if pairs is not None else self.counts.at(events.keys()[lo : lo + piece].ravel()).reshape(len(byte), -1, 8)
            x, gate = self.inputs(own, byte)
            stretch = np.einsum("ij,ij->i", x, self.weights[gate])
            p = self.refined(stretch, byte)
            p = np.where(_BITS[byte].ravel() == 1, p, 1 - p)
            out[lo : lo + piece] = np.log10(p).reshape(-1, 8).sum(axis=1)
        return out

    def _words(self, pieces, size: int, pairs: np.ndarray | None = None) -> np.ndarray:
        out, at = np.zeros(size), 0
        for some, events in pieces:
            cost = self.cost(events, None if pairs is None else pairs[at : at + len(events.byte)])
            at += len(events.byte)
            real = np.arange(events.path.shape[1])[None, :] < events.length[:, None]
            out[some] = np.where(real, cost[events.path], 0).sum(axis=1)
        return out

    def words(self, words: list[bytes], marks: np.ndarray) -> np.ndarray:
        """log10 probability of each word with its space, or of the end."""
        return self._words(_events(words, marks, np.ones(len(words))), len(words))

    def text(self, text: str | None) -> float:
        """log10 probability of a text, by the way of single words."""
        mark, total = 0, 0.0
        for w in [*_words(text), END]:
            total += float(self.words([w], np.array([mark]))[0])
            if not w.isascii():
                mark = _mark(w)
        return total


def _start_weights() -> np.ndarray:
    return np.full((_GATES, len(_PRIMES) + 1), 0.22, np.float64)


def _start_refine() -> np.ndarray:
    return np.tile(np.linspace(-8, 8, _STEPS), (256, 1))


def _events_of(ready: DataFrame, work, shape: str) -> DataFrame:
    """What ``work`` makes of each block's learned events (byte, weight, pairs), added up in 16 groups."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            for row in pdf.to_dict("records"):
                block, pairs = _counted(row)
                seen = block.weight > 0
                out = work(block.byte[seen], block.weight[seen], pairs[seen])
                total = out if total is None else tuple(x + y for x, y in zip(total, out, strict=True))
                del block, pairs
                release()
        if total is not None:
            yield pd.DataFrame([{name: a.tobytes() for name, a in zip(names, total, strict=True)}])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{name: sum(np.frombuffer(b) for b in pdf[name]).tobytes() for name in names}])

    names = [part.split()[0] for part in shape.split(", ")]
    got = ready.select("words", "marks", "weights", "ns", "data").mapInPandas(each, shape)
    return got.groupBy((F.spark_partition_id() % 16).alias("k")).applyInPandas(add, shape)


def fit(ready: DataFrame) -> Model:
    """The model of all blocks as :func:`prepared`, without the counts.

    An event is predicted without its own last occurrence, and counts by its occurrences. One
    pass adds up the error and the curvature of all events at the first weights, and the mixer
    takes a Newton step against them; a second one adds up what followed the new predictions for the
    refinement table. Sums over all events, so no order of learning and no block matters.
    """
    inputs = len(_PRIMES) + 1
    start = _start_weights()

    def bent(byte: np.ndarray, weight: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step, curve = np.zeros((_GATES, inputs)), np.zeros((_GATES, inputs, inputs))
        for lo in range(0, len(byte), 1 << 14):
            s = slice(lo, lo + (1 << 14))
            x, gate = Model.inputs(pairs[s], byte[s], True)
            w = np.repeat(weight[s], 8)
            p = 1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->i", x, start[gate]), -14, 14)))
            error, bend = (_BITS[byte[s]].ravel() - p) * w, p * (1 - p) * w
            by_gate = np.argsort(gate.astype(np.int16), kind="stable")
            xs, error, bend = x[by_gate].astype(np.float64), error[by_gate], bend[by_gate]
            edges = np.concatenate(([0], np.cumsum(np.bincount(gate, minlength=_GATES))))
            for g in np.flatnonzero(np.diff(edges)):
                own = slice(edges[g], edges[g + 1])
                curve[g] += xs[own].T @ (xs[own] * bend[own, None])
                step[g] += error[own] @ xs[own]
        return step, curve

    step, curve = np.zeros((_GATES, inputs)), np.tile(50 * np.eye(inputs), (_GATES, 1, 1))
    for r in _events_of(ready, bent, "step binary, curve binary").collect():
        step += np.frombuffer(r["step"]).reshape(step.shape)
        curve += np.frombuffer(r["curve"]).reshape(curve.shape)
    weights = start + np.linalg.solve(curve, step[:, :, None])[:, :, 0]

    def followed(byte: np.ndarray, weight: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ones, alls = np.zeros(256 * _STEPS), np.zeros(256 * _STEPS)
        for lo in range(0, len(byte), 1 << 14):
            s = slice(lo, lo + (1 << 14))
            x, gate = Model.inputs(pairs[s], byte[s], True)
            w = np.repeat(weight[s], 8)
            stretch = np.einsum("ij,ij->i", x, weights[gate])
            at = _NODES[byte[s]].astype(np.int64).ravel() * _STEPS + np.rint(np.clip((stretch + 8) * 2, 0, _STEPS - 1)).astype(np.int64)
            alls += np.bincount(at, weights=w, minlength=len(alls))
            ones += np.bincount(at, weights=w * _BITS[byte[s]].ravel(), minlength=len(ones))
        return ones, alls

    ones, alls = np.zeros(256 * _STEPS), np.zeros(256 * _STEPS)
    for r in _events_of(ready, followed, "ones binary, alls binary").collect():
        ones += np.frombuffer(r["ones"])
        alls += np.frombuffer(r["alls"])
    prior = 1 / (1 + np.exp(-_start_refine().ravel()))
    refine = np.clip((ones + 20 * prior) / (alls + 20), 1e-6, 1 - 1e-6)
    return Model(weights, np.log(refine / (1 - refine)).reshape(256, _STEPS))


def train(words: DataFrame, folder: str | None = None) -> Model:
    """The model of all counted words (word, mark, cw > 0) with its counts on the driver, for texts outside a corpus."""
    rows = words.repartitionByRange("word").sortWithinPartitions("word", "mark")
    rows = rows.selectExpr("0L chunk", "0 place", "word", "mark", "cw c", "cw", "true head", "true first")
    found = stored(blocks(rows), "blocks", folder)
    model = fit(stored(prepared(found, exchange(found, found.agg(F.sum("size")).first()[0] or 0)), "ready", folder))
    return Model(model.weights, model.refine, count_contexts(words))


# ---------------------------------------------------------------- scores of documents


def score(docs: DataFrame, held: F.Column, id_col: str = "doc_id", text_col: str = "text", chunk: int = 12_000_000, folder: str | None = None) -> DataFrame:
    """Scores of every whole text: (id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte).

    ``held`` is a boolean column of the documents not learned from. The base score is that
    of single words with one added to every count. ``score`` is the log10 probability of the text, in which the
    order of its words counts; a text that was learned from is scored without its own occurrence of each
    pair and triple of words. ``n_bytes`` is the length of what is coded: the words, a space behind each, and the end.
    NULL counts as the empty text, which is the end alone. Rows are kept one for one, repeated ones too; an
    empty table gives an empty result; other columns are ignored. With nothing to learn from, each decision
    is even.
    """
    spark = ship(docs.sparkSession)
    found = stored(chunks(docs, F.coalesce(held, F.lit(False)), id_col, text_col, chunk), "chunks", folder)
    tokens = found.agg(F.sum(F.aggregate("tokens", F.lit(0).cast("long"), lambda s, t: s + t))).first()[0] or 0
    bits, parts = successors.key_bits(tokens), successors.part_bits(tokens)

    def read(row: dict) -> successors.Text:
        sequence = successors.read_planes(row["postings"], np.int32)
        lens, held = np.asarray(row["tokens"], np.int64), np.asarray(row["held"], bool)
        return successors.Text(parted(row["words"]), sequence, lens, held, bits, END)

    # written first, so that what was asked for is off the disks when the words are counted
    followers = stored(successors.exchange(found, read, parts), "followers", folder)
    forget(spark)
    words = stored(vocabulary(found), "blocks", folder)
    total = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("size").alias("size")).first()
    n, v = total["n"] or 0, total["v"] or 0
    forget(spark)
    ready = stored(prepared(words, exchange(words, total["size"] or 0)), "ready", folder)
    forget(spark)
    model = spark.sparkContext.broadcast(fit(ready))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                block, pairs = _counted(row)
                cost = model.value._words(block.pieces, block.size, pairs).astype(np.float32)
                del block, pairs
                release()
                raw = zstandard.decompress(row["rest"])
                rows = len(raw) // 24
                chunk, c = np.frombuffer(raw, np.int64, 2 * rows).reshape(2, rows)
                place, of = np.frombuffer(raw, np.int32, 2 * rows, 16 * rows).reshape(2, rows)
                order = np.argsort(chunk, kind="stable")
                edges = [0, *(np.flatnonzero(np.diff(chunk[order])) + 1).tolist(), rows]
                own = [order[a:b] for a, b in itertools.pairwise(edges)]
                packed = [[successors.planes(x[o]) for x in (place, c, cost[of])] for o in own]
                yield pd.DataFrame({
                    "chunk": np.repeat([chunk[o[0]] for o in own], 3), "part": [-3, -2, -1] * len(own),
                    "n": np.repeat([row["block"]] * len(own), 3), "data": [d for three in packed for d in three],
                })

    costs = ready.mapInPandas(each, "chunk long, part long, n long, data binary")
    # an end is counted once a text
    ends = found.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    kind = docs.schema[id_col].dataType.simpleString()

    def add(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        row = left.iloc[0].to_dict()
        words, lens = parted(row["words"]), np.asarray(row["tokens"], np.int64)
        c, cost = np.zeros(len(words), np.int64), np.zeros(len(words))
        answered: tuple[list, list] = ([], [])
        three: dict[int, list[bytes]] = defaultdict(list)
        for part, block, data in sorted(zip(right["part"], right["n"], right["data"], strict=True), key=lambda r: r[:2]):
            if part >= 0:
                answered[part >> 40].append(successors.read_planes(data, np.uint32))
            else:
                three[block].append(data)
        for place, counts, costs in three.values():
            at = successors.read_planes(place, np.int32)
            c[at], cost[at] = successors.read_planes(counts, np.int64), successors.read_planes(costs, np.float32)
        text = read(row)
        sequence = successors.read_planes(row["postings"], np.int32)
        seen = c[sequence]
        state, answer, share, spelled = text.decisions(*map(np.concatenate, answered), seen, ends)
        doc = np.repeat(np.arange(len(lens)), lens)
        size = np.array([1 if w == END else len(w) + 1 for w in words], np.int64)

        def sums(x: np.ndarray) -> np.ndarray:
            return np.bincount(doc, weights=x, minlength=len(lens))

        out = pd.DataFrame(
            {
                "id": list(row["docs"]), "held_out": list(row["held"]), "n_tokens": lens, "n_known": sums(seen > 0).astype(np.int64),
                "base_score": sums(np.log10((c + 1) / (n + v + 1))[sequence]), "fixed": sums(share + np.where(spelled, cost[sequence], 0)),
                "n_bytes": sums(size[sequence]).astype(np.int64), "cells": successors.counted(successors.taken(state, answer), doc, len(lens)),
            }
        )
        del text, sequence, seen, state, answer, share, spelled, doc
        release()
        return out

    columns = ["chunk", "docs", "held", "tokens", "words", "postings"]
    both = costs.unionByName(followers)
    shape = f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, fixed double, n_bytes long, cells binary"
    scored = stored(found.select(*columns).groupBy("chunk").cogroup(both.groupBy("chunk")).applyInPandas(add, shape), "scored", folder)
    chosen = spark.sparkContext.broadcast(successors.fit(successors.gather(scored)))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            more = []
            for data in pdf.pop("cells"):
                cell, times = successors.read_counted(data)
                more.append(float(chosen.value[cell] @ times))
            total = pdf.pop("fixed") + np.array(more, np.float64)
            yield pdf.assign(score=total, bits_per_byte=-total * math.log2(10) / pdf["n_bytes"])

    out = scored.mapInPandas(finish, f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, n_bytes long, score double, bits_per_byte double")
    return out.withColumn("train_tokens", F.lit(n).cast("long"))


def op8(spark, folder: str) -> DataFrame:
    held = remainder(F.col("doc_id"), 7) == 2
    found = score(table(spark, folder, "documents"), held).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
