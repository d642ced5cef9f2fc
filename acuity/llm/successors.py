"""Contexts over word bounds: whether a word has followed the last two words, or the last one, before.

A token takes up to two binary decisions before it is spelled out: has it followed the last two
words in the training texts, and if not, has it followed the last one? A yes is paid with the word's share
among all that followed, two noes with the spelling. Each decision is predicted from several
contexts: how often the last two words and the last word occurred, what the decisions before it
said, and for how many tokens in a row the text has kept to known ways. The predictions are
mixed by logistic weights, of which a gate picks a set by that run, and each state of all contexts refines the mix
by what followed it. Counts of a training text leave out one occurrence of each token, its own.

Pairs and triples of words are held by hashes of so many bits as the number of tokens asks for;
their counts are exact sums over the corpus, dealt by hash into parts that grow in number with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.llm.common import release

_MIX = tuple(np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
#: upper ends of the classes of a count
_TWO = np.array([0, 1, 2, 4, 8, 16, 64])
_ONE = np.array([0, 1, 2, 4, 8, 16, 64, 256, 4096, 65536])
_RUN = np.array([0, 1, 3, 15])
#: the class of every count, the last for all above
_CLASS_TWO, _CLASS_ONE, _CLASS_RUN = (np.searchsorted(cuts, np.arange(cuts[-1] + 2)) for cuts in (_TWO, _ONE, _RUN))
SHAPE = (len(_TWO) + 1, len(_ONE) + 1, len(_RUN) + 1, 3)
CELLS = int(np.prod(SHAPE))
#: keys of a part
_PART = 1 << 21


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def keys(h: np.ndarray, first: np.ndarray, end: np.uint64, bits: int, triple: bool) -> np.ndarray:
    """Keys of ``bits`` bits of each token with the last word, or with the last two; those of first tokens have no triple (0).

    ``h`` are hashes of tokens, ``first`` the places of the texts' first tokens. An end stands before a text.
    """
    one = np.empty_like(h)
    one[1:] = h[:-1]
    one[first] = end
    down = np.uint64(64 - bits)
    if not triple:
        return _mixed(h * _MIX[0] + _mixed(one + _MIX[2])) >> down
    two = np.empty_like(h)
    two[1:] = one[:-1]
    key = np.maximum(_mixed(h * _MIX[3] + _mixed(two * _MIX[0] + _mixed(one + _MIX[1]))) >> down, 1)
    key[first] = 0
    return key


def ordered(key: np.ndarray, bits: int) -> np.ndarray:
    """The places of keys of ``bits`` bits in their order, by sorting the numbers made of key and place."""
    down = max(0, bits + len(key).bit_length() - 64)
    low = np.uint64(len(key).bit_length())
    packed = (key >> np.uint64(down)) << low | np.arange(len(key), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    # the few that differ only in bits which did not fit
    if down and ((key := key[order])[1:] < key[:-1]).any():
        order = order[np.argsort(key, kind="stable")]
    return order


def planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, which are mostly small."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 1)


def read_planes(data: bytes, kind: type) -> np.ndarray:
    rows = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


def pack(sorted_keys: np.ndarray) -> bytes:
    """Keys in order, as steps from one to the next."""
    return planes(np.diff(sorted_keys, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(read_planes(data, np.uint64), dtype=np.uint64)


def key_bits(tokens: int) -> int:
    """Bits that keep four thousand places for each token's key: so rarely does a new one pass for known."""
    return min(64, math.ceil(math.log2(max(2, tokens))) + 12)


def part_bits(tokens: int) -> int:
    return max(3, math.ceil(math.log2(max(1, tokens / _PART))))


class Text:
    """The tokens of a chunk's documents one after another."""

    def __init__(self, words: list[bytes], sequence: np.ndarray, lens: np.ndarray, held: np.ndarray, bits: int, end: bytes) -> None:
        self.first = np.cumsum(lens) - lens
        self.own = np.repeat(~held, lens)
        self.bits = bits
        self.h = hashes(words)[sequence]
        (self.end,) = hashes([end])

    def sent(self, parts: int) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(part, number, keys, counts in training texts) of the distinct keys, pairs before triples."""
        for triple in (False, True):
            key = keys(self.h, self.first, self.end, self.bits, triple)
            order = ordered(key, self.bits)
            key, own = key[order], self.own[order]
            start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[: len(key)]
            key, weights = key[start], np.add.reduceat(own, start, dtype=np.uint32) if len(start) else own[:0].astype(np.uint32)
            del order, own, start
            part = (key >> np.uint64(self.bits - parts)).astype(np.int64)
            edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)] if len(part) else []
            for a, b in zip(edges, edges[1:], strict=False):
                yield int(triple) << 40 | int(part[a]), b - a, pack(key[a:b]), planes(weights[a:b])

    def _counts(self, triple: bool, answered: np.ndarray) -> np.ndarray:
        """The count of each token's key, from those of the distinct keys in order."""
        key = keys(self.h, self.first, self.end, self.bits, triple)
        order = ordered(key, self.bits)
        key = key[order]
        number = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))[: len(key)]
        out = np.empty(len(key), np.int64)
        out[order] = answered[number]
        return out

    def decisions(self, pairs: np.ndarray, triples: np.ndarray, c: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(state of each token, its answers, log10 share of a yes, whether it is spelled out).

        ``pairs`` and ``triples`` are counts of the distinct keys over the corpus, ``c`` those of the tokens, ``known``
        that of all ends. The answer is 2 for two words, 1 for one, 0 for none.
        """
        n = len(self.h)
        own = self.own.astype(np.int64)
        pair, triple = self._counts(False, pairs), self._counts(True, triples)
        begins = np.zeros(n, bool)
        begins[self.first] = True
        # the last word's count, and that of the last two, which is the pair before
        one = np.concatenate(([0], c[:-1]))
        one[self.first] = known
        two = np.concatenate(([0], pair[:-1]))
        two[self.first] = 0
        pair, one = pair - own, one - own
        triple, two = np.where(begins, 0, triple - own), np.where(begins, 0, two - own)
        answer = np.where((triple > 0) & (two > 0), 2, np.where((pair > 0) & (one > 0), 1, 0))
        run = _runs(answer == 2, begins)
        before = np.concatenate(([0], answer[:-1]))
        before[self.first] = 0
        state = np.ravel_multi_index(
            (*(classes[np.clip(x, 0, len(classes) - 1)] for classes, x in ((_CLASS_TWO, two), (_CLASS_ONE, one), (_CLASS_RUN, run))), before), SHAPE
        )
        share = np.zeros(n)
        yes = answer == 2
        share[yes] = np.log10(triple[yes] / two[yes])
        yes = answer == 1
        share[yes] = np.log10(pair[yes] / one[yes])
        return state, answer, np.minimum(share, 0), answer == 0


def _runs(yes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How many tokens before this one, in a row and in its text, are so."""
    place = np.arange(len(yes))
    # the last place that breaks a run, before this one; the first token of a text starts anew
    breaks = np.where(~yes, place + 1, 0)
    last = np.maximum.accumulate(np.concatenate(([0], breaks[:-1]))) if len(yes) else breaks
    start = np.maximum.accumulate(np.where(begins, place, 0))
    return place - np.maximum(last, start)


def taken(state: np.ndarray, answer: np.ndarray) -> np.ndarray:
    """[token, decision] number of each decision taken: state, which one, and what was said; -1 if not taken."""
    two, one = np.unravel_index(state, SHAPE)[:2]
    first = np.where(two > 0, 2 * state + (answer == 2), -1)
    second = np.where((answer != 2) & (one > 0), 2 * (CELLS + state) + (answer == 1), -1)
    return np.stack((first, second), axis=1)


def exchange(found: DataFrame, read, parts: int) -> DataFrame:
    """(chunk, part, n, data): the counts over the corpus of the keys of each chunk, in the order of its keys.

    ``read`` makes a :class:`Text` of a chunk's row.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                rows = [(part, row["chunk"], n, k, w) for part, n, k, w in read(row).sent(parts)]
                yield pd.DataFrame(rows, columns=["part", "chunk", "n", "keys", "weights"])
                del rows
                release()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [unpack(k) for k in pdf["keys"]]
        weights = [read_planes(w, np.uint32) for w in pdf["weights"]]
        key = np.concatenate(own)
        key -= key.min()  # so only the bits below those of the part are left
        order = ordered(key, int(key.max()).bit_length())
        key = key[order]
        number = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        sums = np.minimum(np.bincount(number, weights=np.concatenate(weights)[order]), 2**32 - 1).astype(np.uint32)
        total = np.empty(len(key), np.uint32)
        total[order] = sums[number]
        edges = np.cumsum([0, *map(len, own)])
        data = [planes(total[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        return pd.DataFrame({"chunk": pdf["chunk"], "part": pdf["part"], "n": pdf["n"], "data": data})

    columns = ["chunk", "docs", "held", "tokens", "words", "postings"]
    sent = found.select(*columns).mapInPandas(work, "part long, chunk long, n long, keys binary, weights binary")
    return sent.groupBy("part").applyInPandas(add, "chunk long, part long, n long, data binary")


def counted(numbers: np.ndarray, doc: np.ndarray, docs: int) -> list[bytes]:
    """For each document the numbers of its decisions and how often each was taken."""
    token, which = np.nonzero(numbers >= 0)
    each = doc[token].astype(np.int64) * (4 * CELLS) + numbers[token, which]
    distinct, n = np.unique(each, return_counts=True)
    owner = distinct // (4 * CELLS)
    edges = np.searchsorted(owner, np.arange(docs + 1))
    cells = (distinct % (4 * CELLS)).astype(np.uint16)
    return [cells[a:b].tobytes() + n[a:b].astype(np.uint32).tobytes() for a, b in zip(edges, edges[1:], strict=False)]


def read_counted(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = len(data) // 6
    return np.frombuffer(data, np.uint16, k).astype(np.int64), np.frombuffer(data, np.uint32, k, 2 * k)


def gather(scored: DataFrame) -> np.ndarray:
    """[decision, state, said] how often in all training texts; the sums of tasks are added up in 16 groups."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(4 * CELLS)
        for pdf in batches:
            for data in pdf["cells"]:
                cell, n = read_counted(data)
                total[cell] += n
        yield pd.DataFrame({"sums": [total.tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [sum(np.frombuffer(b) for b in pdf["sums"]).tobytes()]})

    rows = scored.where("not held_out").select("cells").mapInPandas(work, "sums binary")
    found = rows.groupBy((F.spark_partition_id() % 16).alias("k")).applyInPandas(add, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"]) for r in found), np.zeros(4 * CELLS))
    return total.reshape(2, CELLS, 2)


def _stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def fit(sums: np.ndarray, rounds: int = 8, prior: float = 20.0) -> np.ndarray:
    """log10 probability of each numbered decision: the mix of its contexts' predictions, refined by its state.

    A context predicts what followed it on average. The weights take Newton steps against the
    error over all decisions; without any, each decision is even.
    """
    two, one, run, before = np.unravel_index(np.arange(CELLS), SHAPE)
    contexts = (two, one, run * 3 + before, two * 3 + before, one * len(_RUN) + np.minimum(run, len(_RUN) - 1))
    gate = run
    out = np.empty((2, CELLS, 2))
    for d in range(2):
        n, yes = sums[d].sum(axis=1), sums[d, :, 1]
        x = np.ones((CELLS, len(contexts) + 1)) * 0.3
        for k, context in enumerate(contexts):
            every = np.bincount(context, weights=n)
            said = np.bincount(context, weights=yes)
            x[:, k] = _stretch((said + 0.5) / (every + 1))[context]
        weights = np.full((len(_RUN) + 1, x.shape[1]), 0.3)
        weights[:, -1] = 0
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->i", x, weights[gate]), -14, 14)))
            for g in range(len(weights)):
                own = gate == g
                bend = x[own].T @ (x[own] * (n[own] * p[own] * (1 - p[own]))[:, None]) + np.eye(x.shape[1])
                weights[g] += np.linalg.solve(bend, x[own].T @ (yes[own] - n[own] * p[own]))
        mixed = 1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->i", x, weights[gate]), -14, 14)))
        refined = np.clip((yes + prior * mixed) / (n + prior), 1e-6, 1 - 1e-6)
        out[d] = np.log10(np.stack((1 - refined, refined), axis=1))
    return out.ravel()
