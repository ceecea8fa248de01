"""Product codes of vectors, learned and assigned through a trie over distinct parts.

Vectors become integers and are cut into equal consecutive parts; each part position has a small
codebook, and a vector's code is its parts' nearest entries. Codebooks are learned in whole-table
rounds (assign, then replace each entry by the floor of its parts' mean).

The distinct parts of a position, with their number of rows, lie sorted in a stored table; sorted
parts are the leaves of a trie whose levels are the dimensions. It is walked depth first: the
squared distances to all entries are accumulated along the path, so parts with common first
dimensions share them, and at the leaves the argmin picks the entry and the weighted sums are
taken. Subtrees of at most ``LEAVES`` leaves are done at once, one numpy step a level.

Only the codebooks pass through the driver (entries x dimensions numbers a round). Arithmetic is
exact; all floors go down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, stored
from .topk import scaled

LEAVES = 1 << 13
# Components below this size have exact distances in 64-bit integers in up to 256 dimensions.
LARGEST = 1 << 27


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the lower one) and squared distance for each of the
    sorted, distinct ``parts`` (leaves x dimensions)."""
    n, dims = parts.shape
    index, error = np.empty(n, np.int64), np.empty(n, np.int64)
    stack = [(0, n, 0, np.zeros((1, len(book)), np.int64))]  # leaves a to b share the first d dims
    while stack:
        a, b, d, shared = stack.pop()
        if b - a <= LEAVES or d == dims:
            _subtree(parts[a:b], book, d, shared, index[a:b], error[a:b])
            continue
        cuts = np.r_[a, np.flatnonzero(parts[a + 1:b, d] != parts[a:b - 1, d]) + a + 1, b]
        todo, at = [], 0
        while at + 1 < len(cuts):
            # small children are taken together, a large one goes down by itself
            last = max(at + 1, int(np.searchsorted(cuts, cuts[at] + LEAVES, "right")) - 1)
            lo, hi = int(cuts[at]), int(cuts[last])
            if last == at + 1:
                todo.append((lo, hi, d + 1, shared + (parts[lo, d] - book[:, d]) ** 2))
            else:
                todo.append((lo, hi, d, shared))
            at = last
        stack.extend(reversed(todo))
    return index, error


def _subtree(parts, book, depth, shared, index, error) -> None:
    """``nearest`` below a node at ``depth`` with its accumulated distances, a level at a time."""
    n, dims = parts.shape
    node, new = np.zeros(n, np.int64), np.r_[True, np.zeros(max(0, n - 1), bool)]
    for d in range(depth, dims):
        new[1:] |= parts[1:, d] != parts[:-1, d]
        first = np.flatnonzero(new)
        shared = shared[node[first]] + (parts[first, d][:, None] - book[None, :, d]) ** 2
        node = np.cumsum(new) - 1
    best = np.argmin(shared, axis=1)
    index[:] = best[node]
    error[:] = shared[np.arange(len(shared)), best][node]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(
        len(column), dims)


def _sums(parts: DataFrame, books: np.ndarray) -> list:
    """Number and component sums (at: -1 for the number) of the parts nearest to each entry."""
    dims = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((books.shape[0], books.shape[1], dims + 1), np.int64)
        for batch in batches:
            pos = batch.column("pos").to_numpy()
            leaves = _matrix(batch.column("part"), dims)
            weight = batch.column("n").to_numpy()
            for p in np.unique(pos):
                mine = pos == p  # one stretch: the table is sorted
                index, _ = nearest(leaves[mine], books[p])
                weighted = np.c_[weight[mine], leaves[mine] * weight[mine][:, None]]
                for entry in np.unique(index):
                    total[p, entry] += weighted[index == entry].sum(axis=0)
        pos, entry, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.array(pos.astype(np.int32)), pa.array(entry.astype(np.int32)),
            pa.array(at.astype(np.int32) - 1), pa.array(total[pos, entry, at])],
            names=["pos", "entry", "at", "total"])

    return parts.mapInArrow(run, "pos int, entry int, at int, total long").groupBy(
        "pos", "entry", "at").agg(F.sum("total").alias("total")).collect()


def learn(parts: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks (position x entry x dimension) after ``rounds`` rounds over the sorted,
    distinct parts with their number of rows."""
    for _ in range(rounds):
        sums = {(r["pos"], r["entry"], r["at"]): r["total"] for r in _sums(parts, books)}
        after = books.copy()
        for pos, entry in {(p, e) for p, e, at in sums if at < 0}:
            n = sums[pos, entry, -1]
            for d in range(books.shape[2]):
                after[pos, entry, d] = sums.get((pos, entry, d), 0) // n
        books = after
    return books


def _cut(parts: int, dims: int):
    return F.array(*[F.slice("v", i * dims + 1, dims) for i in range(parts)])


def _assigned(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``code`` and ``error`` of every row: each task walks the tries of its batches' parts."""
    parts, _, dims = books.shape

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            v = _matrix(batch.column("v"), parts * dims)
            code, error = np.empty((len(v), parts), np.uint8), np.zeros(len(v), np.int64)
            for p in range(parts):
                part = v[:, p * dims:(p + 1) * dims]
                order = np.lexsort(part.T[::-1]) if dims else np.arange(len(v))
                ranked = part[order]
                new = np.r_[True, (ranked[1:] != ranked[:-1]).any(axis=1)][:len(v)]
                index, distance = nearest(ranked[new], books[p])
                leaf = np.cumsum(new) - 1
                code[order, p] = index[leaf]
                error[order] += distance[leaf]
            keep = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "v"]
            names = [f.name for f in batch.schema if f.name != "v"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error)],
                names=[*names, "code", "error"])

    kept = rows.drop("v").schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{fields}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of the entries' components by position, entry and dimension, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, column: str = "embedding", parts: int = 8, entries: int = 16,
             rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks (position x entry x dimension).

    ``vectors`` needs vec_id, label and the array ``column``; other columns are ignored, whatever
    their names. Rows whose vector is NULL or holds a NULL or non-finite component are dropped.
    The rows returned have vec_id, label, code (entry indexes in part order, two hex digits each),
    error (squared distances summed over the parts) and label_error (error summed over equal
    labels, NULL ones together). Codebooks start as the parts of the ``entries`` smallest vec_ids
    (NULL ones last, equal ones by their components), fewer if there are fewer rows; equal entries
    leave the later one unused. Repeated rows all count. An empty table gives an empty result and
    empty codebooks.

    Vectors of different lengths, or of a length that ``parts`` does not divide, raise ValueError,
    as do components of ``LARGEST`` or more after scaling, whose distances may be inexact.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: entries must be 1 to 256")
    v = scaled(F.col(column), scale)
    rows = stored(vectors.select("vec_id", "label", v.alias("v")).where("v is not null"), "code-rows")
    seen = rows.agg(F.count("*").alias("n"), F.min(F.size("v")).alias("low"),
                    F.max(F.size("v")).alias("high"),
                    F.max(F.array_max(F.transform("v", F.abs))).alias("top")).first()
    size = seen["high"] or 0
    if seen["low"] != seen["high"] or size % parts or size > 256:
        raise ValueError(f"vectors need one length of at most 256 that {parts} divides")
    if (seen["top"] or 0) >= LARGEST or (seen["top"] or 0) * seen["n"] >= 1 << 62:
        raise ValueError("components too large for exact sums")
    dims = size // parts
    first = [r["v"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").take(
        entries)]
    books = np.array(first, np.int64).reshape(len(first), parts, dims).transpose(1, 0, 2).copy()
    if first:
        cut = rows.select(F.posexplode(_cut(parts, dims)).alias("pos", "part"))
        counted = stored(cut.groupBy("pos", "part").agg(F.count("*").alias("n")), "code-parts")
        leaves = stored(counted.repartitionByRange("pos", "part").sortWithinPartitions(
            "pos", "part"), "code-leaves")
        books = learn(leaves, books, rounds)
    coded = stored(_assigned(rows, books), "code-codes") if first else rows.select(
        "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error"),
                                        F.count("*").alias("rows"))
    return join_groups(coded, stored(labels, "code-labels"), "label", "rows").drop("rows"), books


def sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same as a DuckDB query over ``embeddings``."""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x:
        CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""cuts AS MATERIALIZED (SELECT k.vec_id, k.label, p.pos, list_slice(k.v,
        p.pos * (len(k.v) // {parts}) + 1, (p.pos + 1) * (len(k.v) // {parts})) AS part
        FROM kept k, (SELECT unnest(range({parts})) AS pos) p)""",
             f"""book0 AS MATERIALIZED (SELECT c.pos, f.entry, c.part AS entry_part FROM cuts c JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
        ORDER BY vec_id LIMIT {entries}) f USING (vec_id))"""]
    near = """near{r} AS MATERIALIZED (SELECT c.vec_id, c.label, c.pos, c.part,
        min(list_sum(list_transform(list_zip(c.part, b.entry_part),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 256 + b.entry) AS best
        FROM cuts c JOIN book{r} b USING (pos) GROUP BY ALL)"""
    for r in range(rounds):
        steps.append(near.format(r=r))
        steps.append(f"""sums{r} AS (SELECT pos, entry, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT pos, (best % 256)::BIGINT AS entry, unnest(part) AS x,
            unnest(range(len(part))) AS i FROM near{r}) GROUP BY ALL)""")
        steps.append(f"""book{r + 1} AS MATERIALIZED (SELECT b.pos, b.entry,
        coalesce(m.part, b.entry_part) AS entry_part FROM book{r} b LEFT JOIN (
            SELECT pos, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS part
            FROM sums{r} GROUP BY pos, entry) m ON b.pos = m.pos AND b.entry = m.entry)""")
    steps.append(near.format(r=rounds))
    steps.append("""coded AS (SELECT vec_id, any_value(label) AS label,
        string_agg(format('{:02x}', (best % 256)::BIGINT), '' ORDER BY pos) AS code,
        sum(best // 256)::BIGINT AS error FROM near""" + str(rounds) + " GROUP BY vec_id)")
    return "WITH " + ",\n    ".join(steps) + f"""
    SELECT vec_id, code, error,
        (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
        (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY pos, entry, i)) FROM (
            SELECT pos, entry, unnest(entry_part) AS x, unnest(range(len(entry_part))) AS i
            FROM book{rounds})) AS codebooks_sha256
    FROM coded"""
