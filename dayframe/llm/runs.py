"""Periodic runs of words: maximal stretches that repeat with a fixed period.

The method is Kruskal's over the suffixes of a text. Neighbours in suffix order are edges, weighed
by the length of their common prefix (LCP). Edges are taken by decreasing LCP and unite classes of
suffixes, each an ordered set of positions, with union-find. Two positions i < j that become
neighbours in the united set have a common prefix of exactly the edge's LCP l; if j - i <= l, the
words from i up to j + l have the period j - i, which is their smallest one (a smaller period
would have put a position of the same class between i and j). Every run begins with such a pair,
and all pairs with the same end and period belong to one run, so the smallest i is its start.
A run of at least ``min_length`` words has an LCP of at least half of that, so edges below are
never needed, and texts in which no so short sequence occurs twice are left out at once.

Suffix order and LCPs come from prefix doubling over many texts at a time, in numpy. A text is
handled whole in the task that reads it; nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, words_of

# Words handled together; a longer text is handled alone.
BATCH_WORDS = 1 << 19
# Positions in one block of an ordered set.
BLOCK = 2048

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = ("n_words long, runs array<struct<start: long, length: long, period: long>>, "
          "collapsed string")


class Numbers(dict):
    """A number for every word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Positions:
    """An ordered set of positions, in sorted blocks so that adding stays cheap in large sets."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, first: int):
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def around(self, x: int) -> tuple[int, int]:
        """The neighbours of ``x``, which is not in the set; -1 where there is none."""
        at = max(0, bisect_right(self.heads, x) - 1)
        block = self.blocks[at]
        i = bisect_left(block, x)
        before = block[i - 1] if i else -1
        if i < len(block):
            return before, block[i]
        return before, self.blocks[at + 1][0] if at + 1 < len(self.blocks) else -1

    def add(self, x: int) -> None:
        at = max(0, bisect_right(self.heads, x) - 1)
        block = self.blocks[at]
        block.insert(bisect_left(block, x), x)
        self.heads[at] = block[0]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[at:at + 1] = block[:BLOCK], block[BLOCK:]
            self.heads[at:at + 1] = block[0], block[BLOCK]

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def _joined(ids: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' word numbers in one array, each text followed by an end mark of its own, so that
    no common prefix reaches beyond a text; and the places where the texts begin."""
    sizes = np.array([len(x) + 1 for x in ids], np.int64)
    starts = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.int64)
    for x, at in zip(ids, starts, strict=True):
        out[at:at + len(x)] = x
    top = max((int(x.max(initial=-1)) for x in ids), default=-1) + 1
    out[starts + sizes - 1] = top + np.arange(len(ids))
    return out, starts


def _may_repeat(joined: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Which texts hold a sequence of ``n`` words twice. Hashes are compared: a text without one
    may be named by chance, a text with one always is."""
    with np.errstate(over="ignore"):
        x = (joined.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        h = np.zeros(max(0, len(x) - n + 1), np.uint64)
        for i in range(n):
            h = h * np.uint64(0x9FB21C651E98DF25) + x[i:len(x) - n + 1 + i]
        text = np.searchsorted(starts, np.arange(len(h)), "right").astype(np.uint64)
        h += text * np.uint64(0xD6E8FEB86659FD93)  # the same words in another text differ
    order = np.argsort(h)
    ranked = h[order]
    return np.unique(text[order[1:][ranked[1:] == ranked[:-1]]].astype(np.int64) - 1)


def _ranks(joined: np.ndarray) -> list[np.ndarray]:
    """Ranks of the 2^k words at every place, for k = 0, 1, ... until all differ. A rank is the
    number of places that sort before the first of its equals."""
    n = len(joined)
    order = np.argsort(joined, kind="stable")
    new = np.r_[True, joined[order][1:] != joined[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width = [rank], 1
    while True:
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(tied):
            return [x.astype(np.int32) if n < 1 << 31 else x for x in levels]
        # a tied place is followed by its text's end mark within reach, so no index leaves the array
        key = rank[tied] * n + rank[np.minimum(tied + width, n - 1)]
        order = np.argsort(key, kind="stable")
        place, key = tied[order], key[order]
        group = rank[place]
        at = np.arange(len(place))
        first_of_group = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], at, 0))
        first_of_key = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], at, 0))
        rank = rank.copy()
        rank[place] = group + first_of_key - first_of_group
        levels.append(rank)
        width *= 2


def _edges(levels: list[np.ndarray], floor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with a common prefix of at least ``floor`` words, by decreasing
    length of it."""
    order = np.argsort(levels[-1])
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a + lcp] == levels[k][b + lcp]
        lcp[same] += 1 << k
    keep = np.flatnonzero(lcp >= floor)
    keep = keep[np.argsort(-lcp[keep], kind="stable")]
    return a[keep], b[keep], lcp[keep]


def _seeds(a: np.ndarray, b: np.ndarray, lcp: np.ndarray) -> dict[tuple[int, int], int]:
    """The start of the run with each end and period."""
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}
    starts: dict[tuple[int, int], int] = {}

    def root(x: int) -> int:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for i, j, common in zip(a.tolist(), b.tolist(), lcp.tolist(), strict=True):
        ri, rj = root(i), root(j)
        large = members.pop(ri, None) or Positions(ri)
        small = members.pop(rj, None) or Positions(rj)
        if large.size < small.size:
            large, small, ri, rj = small, large, rj, ri
        moved = list(small)
        last = len(moved) - 1
        for k, x in enumerate(moved):
            # neighbours of x in the united set that come from the other class
            before, after = large.around(x)
            if before >= 0 and x - before <= common and (k == 0 or moved[k - 1] < before):
                seed = (x + common, x - before)
                starts[seed] = min(starts.get(seed, before), before)
            if after >= 0 and after - x <= common and (k == last or moved[k + 1] > after):
                seed = (after + common, after - x)
                starts[seed] = min(starts.get(seed, x), x)
        for x in moved:
            large.add(x)
        parent[rj] = ri
        members[ri] = large
    return starts


def find_runs(ids: Sequence[np.ndarray], min_length: int = 12) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start, then period. A text is an array of
    word numbers."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in ids]
    if not ids:
        return out
    floor = max(1, -(-min_length // 2))
    some = _may_repeat(*_joined(ids), floor)
    if not len(some):
        return out
    joined, starts = _joined([ids[t] for t in some])
    for (end, period), start in _seeds(*_edges(_ranks(joined), floor)).items():
        if end - start >= min_length:
            t = int(np.searchsorted(starts, start, "right")) - 1
            out[some[t]].append((start - int(starts[t]), end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    inside = np.cumsum(change)
    return b" ".join(words[i] for i in np.flatnonzero(inside[:-1] == 0))


def detect(docs: DataFrame, min_length: int = 12, batch_words: int = BATCH_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length and period in words, by start, then
    period) and collapsed (the text with each run cut to its first period, words joined by one
    space).

    A run is a stretch with smallest period p and at least max(min_length, 2 p) words that no
    neighbouring word extends. ``docs`` needs doc_id and text; other columns are ignored, whatever
    their names. A NULL text and one without words have no runs and an empty collapsed text; rows
    with a NULL doc_id and repeated rows are kept, each with its own result. An empty table gives
    an empty result. Long texts are handled whole, in memory proportional to their words.
    """
    if min_length < 2:
        raise ValueError("min_length must be at least 2")

    def results(keys: list, texts: list[list[bytes]], numbers: list[np.ndarray], kind: pa.DataType):
        found = find_runs(numbers, min_length)
        return pa.RecordBatch.from_arrays([
            pa.array(keys, kind), pa.array([len(w) for w in texts], pa.int64()),
            pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
                      for runs in found], pa.list_(RUN)),
            pa.array([_collapsed(w, r) for w, r in zip(texts, found, strict=True)],
                     pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches):
        keys, texts, numbers, held, index, kind = [], [], [], 0, Numbers(), pa.null()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for key, text in zip(batch.column("doc_id").to_pylist(),
                                 batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = text.split()  # bytes: at the six ASCII white-space characters
                if held and held + len(words) > batch_words:
                    yield results(keys, texts, numbers, kind)
                    keys, texts, numbers, held, index = [], [], [], 0, Numbers()
                keys.append(key)
                texts.append(words)
                numbers.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                held += len(words)
        if keys:
            yield results(keys, texts, numbers, kind)

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {key}, {RESULT}")


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a periodic tail where crc32(doc_id) % 10 is 0: from word a on, the words
    repeat with period p, a and p being fixed by the same crc32. A NULL doc_id plants nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = words_of(text)
    n = F.size(words)
    a = g % F.greatest(n, F.lit(1))
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    period = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
    every = F.concat(F.slice(words, F.lit(1), a.cast("int")),
                     F.slice(tail, F.lit(1), (n - a).cast("int")))
    return F.when(h % 10 == 0, F.array_join(every, " ")).otherwise(text)


def listed(runs: Column) -> Column:
    """One line ``start,length,period`` for every run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))), "")


def longest(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period), or NULL."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct(
        (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period")))
