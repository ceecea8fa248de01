"""Removal of word windows that start anywhere else, with a count-min prefilter.

Equal texts are joined into one with their number, and dealt into chunks by a hash.

1. Every chunk sends a sketch of its windows: the sorted 32-bit cell values of its distinct window
   hashes with counts, cut into slices of the hash range. The sketches of a slice are merged in one
   task into the counters of a count-min sketch (``ROWS`` rows, each at another function of the
   value). Its estimate for a window is the least of its counters, never below the true count.
   Back to the chunk goes one bit a distinct window: whether the estimate is at least 2.
2. Every chunk looks at its windows again and groups only those estimated repeated, by two
   independent 64-bit rolling hashes (128 bits stand for the words; two given different windows share
   them with a probability of about 2^-110). One row a distinct window of the chunk is sorted by key
   across all chunks, where equal neighbours are the repeats; a chunk knows its own.

Since estimates never fall short, no repeated window is lost; the others cost four to five bytes
of shuffle a window instead of a grouped row. Slices and chunks hold a bounded part of the text,
and a window that occurs in very many documents is one entry a chunk.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, shared_path, stored, text_or_empty

# Odd multipliers of the two rolling hashes.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
ROWS = 2
# Text in a chunk and in a slice of the hash range, as a share of all text between bounds in bytes.
CHUNKS, CHUNK_BYTES = 512, (1 << 18, 1 << 22)
SLICES, SLICE_BYTES = 128, (1 << 19, 1 << 25)
# Counters in a sketch row for each byte of a slice's text (about six bytes make a window).
CELLS_A_BYTE = 1
# Words are hashed by their bytes up to this length, so many bytes at a time.
SHORT = 64
HASH_BYTES = 1 << 20
SPACES = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
# A number for every byte (none for white space) and powers of a base, for each of the two hashes.
BYTES = np.where(SPACES, np.uint64(0), np.random.default_rng(20).integers(
    1, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1))
POWERS = np.cumprod(np.repeat(np.array([[0xA0761D6478BD642F], [0xE7037ED1A0B428DB]], np.uint64),
                              SHORT + 1, axis=1), axis=1)

SKETCH = "slice int, chunk int, cells binary, twice binary"
REPLY = "chunk int, slice int, mask binary"
CANDIDATE = "k1 long, k2 long, chunk int, tid int, pos int, weight int"
FOUND = "chunk int, tid int, pos int"
KEPT = "key binary, n long, n_words long, n_removed long, kept string"


def placed_words(texts: pa.ChunkedArray) -> tuple[np.ndarray, ...]:
    """The texts' UTF-8 bytes in a row, where each word begins and ends in them, and the number of
    words of each text."""
    array = pa.concat_arrays(texts.cast(pa.binary()).chunks) if texts.num_chunks else pa.array(
        [], pa.binary())
    offsets = np.frombuffer(array.buffers()[1], np.int32)[
        array.offset:array.offset + len(array) + 1].astype(np.int64) if len(array) else np.zeros(
        1, np.int64)
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~SPACES[data]
    if not len(data):
        return data, offsets[:0], offsets[:0], np.zeros(len(array), np.int64)
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
    before[cuts], after[cuts - 1] = False, False
    begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return data, begins, ends, np.diff(np.searchsorted(begins, offsets))


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of every word: its bytes' random numbers times powers of a base, added up. Words
    of more than ``SHORT`` bytes have their XXH3 hash instead."""
    out = np.empty(len(begins), np.uint64)
    edges = np.searchsorted(begins, np.arange(0, len(data) + HASH_BYTES, HASH_BYTES))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if a < b:
            span = data[begins[a]:ends[b - 1]]
            at = (begins[a:b] - begins[a]).astype(np.int64)
            place = np.arange(len(span)) - np.repeat(at, np.diff(np.r_[at, len(span)]))
            with np.errstate(over="ignore"):
                out[a:b] = np.add.reduceat(
                    BYTES[which][span] * POWERS[which][np.minimum(place, SHORT)], at)
    with np.errstate(over="ignore"):
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    for i in np.flatnonzero(ends - begins > SHORT).tolist():
        digest = xxhash.xxh3_128_digest(data[begins[i]:ends[i]].tobytes())
        out[i] = int.from_bytes(digest[8 * which:8 * which + 8], "little")
    return out


def rolling(words: np.ndarray, window: int, base: np.uint64) -> np.ndarray:
    """The hash of every ``window`` consecutive words: the sum of word i times base^(window - 1 - i),
    built by doubling, then mixed."""
    n = len(words) - window + 1
    with np.errstate(over="ignore"):
        total, done, part, width, power = None, 0, words, 1, base
        left = window
        while left:
            if left & 1:  # the next ``width`` words, behind the ``done`` first ones
                piece = part[done:done + n]
                total = piece.copy() if total is None else total * power + piece
                done += width
            left >>= 1
            if left:
                part = part[:-width] * power + part[width:]
                width, power = width * 2, power * power
        total ^= total >> np.uint64(32)
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(32)
    return total


class Windows:
    """The windows of a chunk's texts, in the order of the texts' keys, which every pass repeats."""

    def __init__(self, table: pa.Table, window: int, both: bool = True):
        self.table = table.take(pa.compute.sort_indices(table["key"]))
        self.copies = self.table["n"].to_numpy()
        data, begins, ends, self.sizes = placed_words(self.table["text"])
        self.starts = np.cumsum(self.sizes) - self.sizes
        tid = np.repeat(np.arange(len(self.sizes)), self.sizes)
        # windows over all words in a row, without those that cross into the next text
        self.flat = np.flatnonzero(np.arange(len(tid)) + window <= (self.starts + self.sizes)[tid])
        self.tid = tid[self.flat]
        self.pos = self.flat - self.starts[self.tid]
        self.weight = np.minimum(self.copies[self.tid], 2)
        hashed = [rolling(word_hashes(data, begins, ends, i), window, BASES[i])[self.flat]
                  if len(self.flat) else np.empty(0, np.uint64) for i in range(1 + both)]
        self.first, self.second = hashed[0], hashed[-1]
        self.order = np.argsort(self.first)
        ranked = self.first[self.order]
        second = self.second[self.order]
        if ((ranked[1:] == ranked[:-1]) & (second[1:] != second[:-1])).any():
            self.order = np.lexsort((self.second, self.first))
        new = np.r_[True, ranked[1:] != ranked[:-1]][:len(ranked)]
        self.entry = np.cumsum(new) - 1            # the distinct first hash of each ordered window
        self.begins = np.flatnonzero(new)
        self.distinct = ranked[self.begins]        # ascending

    def groups(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows ``among`` (in order): a first window of each distinct one, its number in the
        chunk (copies of a text count up to two), and the place of every window's distinct one."""
        a, b = self.first[among], self.second[among]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(among)]
        begins = np.flatnonzero(new)
        number = np.add.reduceat(self.weight[among], begins) if len(begins) else begins
        return among[begins], number, np.cumsum(new) - 1

    def slices(self, count: int) -> np.ndarray:
        """The slice of the hash range of each distinct hash, ascending."""
        return ((self.distinct >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def _sketches(w: Windows, chunk: int, slices: int) -> pa.Table:
    """The chunk's sketch: one row a slice."""
    if not len(w.distinct):
        return _table(SKETCH, [], [], [], [])
    twice = np.add.reduceat(w.weight[w.order], w.begins) > 1
    where = w.slices(slices)
    cells = (w.distinct & np.uint64(0xFFFFFFFF)).astype("<u4")
    cut = np.r_[np.flatnonzero(np.r_[True, where[1:] != where[:-1]]), len(where)]
    spans = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
    return _table(SKETCH, where[cut[:-1]], np.full(len(spans), chunk),
                  [cells[a:b].tobytes() for a, b in spans],
                  [np.packbits(twice[a:b]).tobytes() for a, b in spans])


def _types(fields: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in fields.split(","))])


def _table(fields: str, *columns) -> pa.Table:
    schema = _types(fields)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                    schema=schema)


def _cells(values: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The counter of every value in each row of the sketch."""
    for r in range(ROWS):
        with np.errstate(over="ignore"):
            mixed = values.astype(np.uint64) * BASES[r] + np.uint64(r)
        yield ((mixed >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)).astype(np.int64)


def _merged(table: pa.Table, width: int) -> pa.Table:
    """The replies to all chunks of one slice: the sketches are added up, and every value is
    looked up. Counters stop at 2, so one bit each is enough."""
    values = [np.frombuffer(c, "<u4") for c in table["cells"].to_pylist()]
    every = np.concatenate(values)
    twice = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(v)).astype(bool)
                            for b, v in zip(table["twice"].to_pylist(), values, strict=True)])
    repeated = np.ones(len(every), bool)
    for cells in _cells(every, width):
        counted = np.sort(cells)
        high = np.zeros(width, bool)  # counters that reach 2
        high[counted[1:][counted[1:] == counted[:-1]]] = True
        high[cells[twice]] = True
        repeated &= high[cells]
    ends = np.cumsum([len(v) for v in values])
    masks = [np.packbits(repeated[e - len(v):e]).tobytes()
             for e, v in zip(ends, values, strict=True)]
    return _table(REPLY, table["chunk"].to_pylist(), table["slice"].to_pylist(), masks)


def _candidates(w: Windows, replies: pa.Table, chunk: int, slices: int) -> pa.Table:
    """One row for each distinct window of the chunk that is estimated repeated, to be compared with
    the other chunks'."""
    if not len(w.distinct):
        return _table(CANDIDATE, *[[]] * 6)
    masks = dict(zip(replies["slice"].to_pylist(), replies["mask"].to_pylist(), strict=True))
    where, sizes = np.unique(w.slices(slices), return_counts=True)
    estimated = np.concatenate([np.unpackbits(np.frombuffer(masks[s], np.uint8), count=n)
                                for s, n in zip(where.tolist(), sizes.tolist(), strict=True)])
    lead, number, _ = w.groups(w.order[estimated.astype(bool)[w.entry]])
    return _table(CANDIDATE, w.first[lead].view(np.int64), w.second[lead].view(np.int64),
                  np.full(len(lead), chunk), w.tid[lead], w.pos[lead], np.minimum(number, 2))


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those of weight 1 whose key comes again or before. (What has a higher
    weight is known to its chunk.) Only the last row is held between batches."""
    held, known = None, False  # known: the held row's key came before
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        a, b, weight = (table[c].to_numpy() for c in ("k1", "k2", "weight"))
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        before = np.r_[known, same]
        repeated = (before | np.r_[same, False]) & (weight == 1)
        last, known = len(a) - 1, bool(before[-1])
        yield from table.slice(0, last).filter(pa.array(repeated[:last])).select(
            ["chunk", "tid", "pos"]).combine_chunks().to_batches()
        held = table.slice(last)
    if held is not None and known and held["weight"][0].as_py() == 1:
        yield from held.select(["chunk", "tid", "pos"]).combine_chunks().to_batches()


def _kept(w: Windows, found: pa.Table, window: int) -> pa.Table:
    """The chunk's texts without the words of windows found repeated among the chunks, or repeated in
    the chunk itself."""
    _, number, place = w.groups(w.order)
    here = w.order[(number > 1)[place]] if len(place) else w.order
    begins = np.concatenate([w.flat[here], w.starts[found["tid"].to_numpy()] + found["pos"].to_numpy()])
    total = int(w.sizes.sum())
    change = np.bincount(begins, minlength=total + 1) - np.bincount(
        begins + window, minlength=total + 1)
    keep = np.cumsum(change)[:total] == 0
    texts, removed = [], []
    for text, at in zip(w.table["text"].cast(pa.binary()).to_pylist(), w.starts.tolist(), strict=True):
        words = text.split()
        mine = keep[at:at + len(words)]
        removed.append(len(words) - int(mine.sum()))
        texts.append(b" ".join(compress(words, mine.tolist()) if removed[-1] else words))
    return pa.table([w.table["key"].cast(pa.binary()), pa.array(w.copies, pa.int64()),
                     pa.array(w.sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(texts, pa.binary()).cast(pa.string())], schema=_types(KEPT))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch as one row with their number, before they are shuffled."""
    for batch in batches:
        keys, first, number = batch.column("key").to_pylist(), {}, Counter()
        for i, k in enumerate(keys):
            first.setdefault(k, i)
            number[k] += 1
        rows = batch.take(pa.array(list(first.values()), pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array([number[k] for k in first], pa.int64())],
            names=[*rows.schema.names, "n"])


def _between(total: int, share: int, bounds: tuple[int, int]) -> int:
    return min(max(total // share, bounds[0]), bounds[1])


def kept_texts(docs: DataFrame, window: int = 35, columns: Sequence = ("key", "n", "n_words", "n_removed",
               "kept")) -> tuple[DataFrame, DataFrame]:
    """Per distinct text: key (16 bytes of its SHA-256), n (documents that have it), n_words,
    n_removed and kept, the text without the words of repeated windows, joined by one space; and
    per document its doc_id and text key.

    A window is ``window`` consecutive words of one document; it is repeated if its words also start
    at any other place, in the same document or another. NULL texts count as empty ones.
    """
    if window < 1:
        raise ValueError("a window has at least one word")
    spark = docs.sparkSession
    text = text_or_empty()
    key = F.substring(F.unhex(F.sha2(text, 256)), 1, 16)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-total // _between(total, CHUNKS, CHUNK_BYTES)))
    slice_bytes = _between(total, SLICES, SLICE_BYTES)
    slices = max(1, -(-total // slice_bytes))
    width = max(1024, int(slice_bytes * CELLS_A_BYTE))
    rows = stored(docs.select("doc_id", key.alias("key")), "repeat-rows")

    # one shuffle by chunk, kept as a bucketed table: no pass over the texts shuffles them again
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"repeat_texts_{uuid.uuid4().hex}"
    (docs.select(key.alias("key"), text.alias("text")).mapInArrow(
        _collapsed, "key binary, text string, n long")
     .withColumn("chunk", F.pmod(F.hash("key"), F.lit(chunks)))
     .repartition(parts, "chunk").groupBy("chunk", "key")
     .agg(F.first("text").alias("text"), F.sum("n").alias("n"))
     .write.bucketBy(parts, "chunk").option("path", shared_path(spark, "repeat-texts"))
     .option("compression", "zstd").saveAsTable(name))
    texts = spark.table(name)

    def sketch(keys: tuple, table: pa.Table) -> pa.Table:
        return _sketches(Windows(table, window, both=False), keys[0].as_py(), slices)

    def merge(keys: tuple, table: pa.Table) -> pa.Table:
        return _merged(table, width)

    def pick(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _candidates(Windows(left, window), right, keys[0].as_py(), slices)

    def keep(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _kept(Windows(left, window), right, window)

    by_chunk = texts.groupBy("chunk")
    replies = stored(by_chunk.applyInArrow(sketch, SKETCH).groupBy("slice")
                     .applyInArrow(merge, REPLY), "repeat-replies")
    found = by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(pick, CANDIDATE).repartition(
        "k1").sortWithinPartitions("k1", "k2").mapInArrow(_repeats, FOUND)
    kept = stored(by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(keep, KEPT).select(
        *columns), "repeat-kept")
    spark.sql(f"DROP TABLE {name}")
    return kept, rows


def remove(docs: DataFrame, window: int = 35) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and kept_sha256, the SHA-256 of the kept words joined
    by one space (``kept_texts`` has the words themselves).

    ``docs`` needs doc_id and text; other columns are ignored, whatever their names. A NULL text and
    one without words keep the empty text; texts shorter than the window keep all words. Repeated
    rows and rows with a NULL doc_id count and are returned. An empty table gives an empty result.
    """
    texts, rows = kept_texts(docs, window, ("key", "n", "n_words", "n_removed", F.sha2(
        "kept", 256).alias("kept_sha256")))
    return join_groups(rows, texts, "key", "n").select("doc_id", "n_words", "n_removed",
                                                      "kept_sha256")


def sql(window: int) -> str:
    """The same as a DuckDB query over ``documents``."""
    return f"""WITH split AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(
        string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    word AS MATERIALIZED (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM split),
    win AS (SELECT r, i, sha256(array_to_string(list_slice(w, i + 1, i + {window}), ' ')) AS k FROM (
        SELECT r, w, unnest(range(len(w) - {window - 1})) AS i FROM split
        WHERE len(w) >= {window})),
    rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM win)
        WHERE n > 1),
    marked AS (SELECT word.r, word.i, x, max(CASE WHEN rep.i IS NULL THEN 0 ELSE 1 END) OVER (
        PARTITION BY word.r ORDER BY word.i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS gone
        FROM word LEFT JOIN rep ON word.r = rep.r AND word.i = rep.i),
    total AS (SELECT r, sum(gone)::BIGINT AS n_removed,
        string_agg(x, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM marked GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
    FROM split LEFT JOIN total USING (r)"""
