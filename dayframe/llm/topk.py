"""Exact maximum-inner-product search with norm-sorted buckets.

Vectors are sorted by length and cut into buckets of similar length. The longest vectors give each
query a first threshold (its k-th best score so far). For a bucket whose longest vector has
length l, a candidate can only reach a query's threshold t if its cosine with the query is at
least t / (|q| l), the local threshold. Above 1 the bucket is skipped for the query; a high local
threshold prunes by coordinates (a vector that close to the query must lie in a narrow range on
the query's largest coordinates), a low one by length (only the candidates long enough for any
cosine). What remains is verified by exact integer products.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BUCKET = 4096
QUERY_BLOCK = 512
# Local cosine thresholds from here on prune by coordinates.
COORDINATES_FROM = 0.5
FOCUS = 3
# Products up to here have exact float64 products and sums.
EXACT = float(1 << 52)
NONE = np.iinfo(np.int64).min

PACK = ("part int, bucket long, n int, dim int, longest double, ids binary, nulls binary, "
        "uids binary, flags binary, data binary")
PACK_FIELDS = pa.schema([
    ("part", pa.int32()), ("bucket", pa.int64()), ("n", pa.int32()), ("dim", pa.int32()),
    ("longest", pa.float64()), ("ids", pa.binary()), ("nulls", pa.binary()),
    ("uids", pa.binary()), ("flags", pa.binary()), ("data", pa.binary())])
HITS = "block long, place int, query_id long, vec_id long, score long"


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, or NULL if the vector is NULL or holds a NULL or
    non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(
        vector, lambda x: F.floor(x.cast("double") * scale)))


def _small(m: np.ndarray) -> bytes:
    """The matrix in the narrowest of three integer widths."""
    top = np.abs(m).max(initial=0)
    kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
    return m.astype(kind).tobytes()


def _matrix(row: dict) -> np.ndarray:
    cells = row["n"] * row["dim"]
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(row["data"]) // cells] if cells else np.int64
    return np.frombuffer(row["data"], kind).reshape(row["n"], row["dim"]).astype(np.int64)


def _lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(np.float64) ** 2).sum(axis=1))


def _pack(part: int, number: int, ids: np.ndarray, null: np.ndarray, uids: np.ndarray,
          flags: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{
        "part": part, "bucket": (part << 32) + number, "n": len(m), "dim": m.shape[1],
        "longest": float(_lengths(m).max(initial=0.0)), "ids": ids.tobytes(),
        "nulls": null.tobytes(), "uids": uids.tobytes(), "flags": flags.tobytes(),
        "data": _small(m)}], schema=PACK_FIELDS)


def packed(vectors: DataFrame, rows: int, what: str) -> DataFrame:
    """Buckets of at most ``rows`` vectors of similar length, one row each.

    ``vectors`` has id, v (array of long), norm2 and is_query. Sorted by length, longest first,
    over range partitions (``part``); vectors of equal length are spread by a hash.
    """
    def pack(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        ids, vecs, flags = [], [], []
        number = seen = 0

        def out(n):
            nonlocal number, seen
            m = np.zeros((n, max(len(v) for v in vecs[:n])), np.int64)
            for row, v in zip(m, vecs[:n], strict=True):
                row[:len(v)] = v
            batch = _pack(part, number, np.array([i or 0 for i in ids[:n]], np.int64),
                          np.array([i is None for i in ids[:n]], np.uint8),
                          (part << 40) + seen + np.arange(n, dtype=np.int64),
                          np.array(flags[:n], np.uint8), m)
            number, seen = number + 1, seen + n
            del ids[:n], vecs[:n], flags[:n]
            return batch

        for b in batches:
            ids += b.column("id").to_pylist()
            vecs += b.column("v").to_numpy(zero_copy_only=False).tolist()
            flags += b.column("is_query").to_pylist()
            while len(ids) >= rows:
                yield out(rows)
        if ids:
            yield out(len(ids))

    order = [F.col("norm2").desc(), F.col("tie")]
    ranged = vectors.withColumn("tie", F.xxhash64("id", "v")).repartitionByRange(*order)
    return stored(ranged.sortWithinPartitions(*order).select("id", "v", "is_query")
                  .mapInArrow(pack, PACK), what)


def query_blocks(buckets: DataFrame, rows: int, what: str) -> DataFrame:
    """The flagged vectors of the buckets, packed again in blocks of at most ``rows``."""
    def pack(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        number = 0

        def out(parts):
            dim = max(p[3].shape[1] for p in parts)
            m = np.concatenate([np.pad(p[3], ((0, 0), (0, dim - p[3].shape[1]))) for p in parts])
            ids, null, uids = (np.concatenate([p[i] for p in parts]) for i in range(3))
            return _pack(part, number, ids, null, uids, np.ones(len(m), np.uint8), m)

        for b in batches:
            for row in b.to_pylist():
                at = np.nonzero(np.frombuffer(row["flags"], np.uint8))[0]
                for i in range(0, len(at), rows):
                    pick = at[i:i + rows]
                    one = (np.frombuffer(row["ids"], np.int64)[pick],
                           np.frombuffer(row["nulls"], np.uint8)[pick],
                           np.frombuffer(row["uids"], np.int64)[pick], _matrix(row)[pick])
                    if sum(len(p[0]) for p in held) + len(pick) > rows:
                        yield out(held)
                        held, number = [], number + 1
                    held.append(one)
        if held:
            yield out(held)

    return stored(buckets.mapInArrow(pack, PACK), what)


def _aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with the same number of columns; missing components count as 0."""
    d = max(a.shape[1], b.shape[1])
    pad = lambda m: np.pad(m, ((0, 0), (0, d - m.shape[1])))
    return pad(a), pad(b)


def survivors(q: np.ndarray, q_norm: float, x: np.ndarray, norms: np.ndarray,
              threshold: int) -> np.ndarray:
    """Rows of a bucket (sorted by length, longest first) that may reach the threshold."""
    n = len(norms)
    if threshold == NONE or n == 0:
        return np.arange(n)
    if threshold > 0 and q_norm == 0:
        return np.empty(0, np.int64)
    if threshold <= 0:
        return np.arange(n)
    slack = 1 - 1e-9
    local = threshold / (q_norm * norms[0]) * slack if norms[0] > 0 else math.inf
    if local > 1:
        return np.empty(0, np.int64)
    # length: |x| >= t / |q| whatever the cosine
    keep = int(np.searchsorted(-norms, -(threshold / q_norm * slack), "right"))
    rows = np.arange(keep)
    if local < COORDINATES_FROM:
        return rows
    # coordinates: with cosine c >= local, unit(x)_f lies in q_f c -+ sqrt((1 - q_f^2)(1 - c^2))
    unit = q / q_norm
    for f in np.argsort(-np.abs(unit))[:FOCUS]:
        u = float(abs(unit[f]))
        # the bound is lowest at c = local unless that passes the coordinate's own direction
        low = u * local - math.sqrt(max(0.0, (1 - u * u) * (1 - local * local)))
        if u < local:
            high = u * local + math.sqrt(max(0.0, (1 - u * u) * (1 - local * local)))
        else:
            high = 1.0
        value = x[rows, f] * math.copysign(1.0, unit[f]) / norms[rows]
        rows = rows[(value >= low - 1e-9) & (value <= high + 1e-9)]
    return rows


def _hits(bucket: dict, block: dict, k: int):
    """The best k of a bucket for each query of a block."""
    x, q = _aligned(_matrix(bucket), _matrix(block))
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    xf, qf = (m.astype(np.float64 if bound < EXACT else object) for m in (x, q))
    norms, q_norms = _lengths(x), _lengths(q)
    ids, uid = (np.frombuffer(bucket[c], np.int64) for c in ("ids", "uids"))
    null = np.frombuffer(bucket["nulls"], np.uint8)
    q_ids, q_uid = (np.frombuffer(block[c], np.int64) for c in ("ids", "uids"))
    marks = [NONE] * len(q)
    for m in block["marks"] or ():
        marks[m["place"]] = m["score"]
    kept = [survivors(q[i], q_norms[i], x, norms, marks[i]) for i in range(len(q))]
    whole = [i for i, rows in enumerate(kept) if len(rows) == len(x)]
    full = dict(zip(whole, (xf @ qf[whole].T).T, strict=True)) if whole else {}
    for i, rows in enumerate(kept):
        score = full[i] if i in full else xf[rows] @ qf[i]
        other = uid[rows] != q_uid[i]
        rows, score = rows[other], score[other]
        if len(rows) > k:
            kth = np.partition(score, len(score) - k)[len(score) - k]
            at = score >= kth
            rows, score = rows[at], score[at]
        for j in np.lexsort((ids[rows], null[rows], -score))[:k]:
            yield {"block": block["bucket"], "place": i, "query_id": int(q_ids[i]),
                   "vec_id": None if null[rows[j]] else int(ids[rows[j]]), "score": int(score[j])}


def _joined_hits(pairs: DataFrame, k: int) -> DataFrame:
    """Hits of rows that hold a bucket (columns b_*) and a query block (columns q_*)."""
    fields = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("query_id", pa.int64()),
                        ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                hits = list(_hits(row["b"], row["q"], k))
                if hits:
                    yield pa.RecordBatch.from_pylist(hits, schema=fields)

    return pairs.mapInArrow(run, HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The best k hits of every query. The window's rank limit also runs before the shuffle."""
    w = Window.partitionBy("block", "place").orderBy(F.col("score").desc(),
                                                     F.col("vec_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _rows(df: DataFrame, name: str, marks: bool = False) -> DataFrame:
    cols = ["bucket", "n", "dim", "ids", "nulls", "uids", "data"] + ["marks"] * marks
    return df.select("part", "longest", F.struct(*cols).alias(name))


def _search_packed(valid: DataFrame, k: int, bucket_rows: int, query_rows: int) -> DataFrame:
    buckets = packed(valid, bucket_rows, "topk-buckets")
    blocks = query_blocks(buckets, query_rows, "topk-queries")
    no_marks = F.lit(None).cast("array<struct<place:int,score:bigint>>")
    # the bucket with the longest vectors, one row of at most bucket_rows vectors, sets thresholds
    first = buckets.agg(F.max_by("bucket", F.struct("longest", -F.col("bucket"))).alias("b")).first()
    seed = _rows(buckets.where(F.col("bucket") == F.lit(first["b"])), "b").select(
        "b", F.lit(0).alias("on"))
    seeded = _rows(blocks.withColumn("marks", no_marks), "q", True).select(
        "q", F.lit(0).alias("on")).join(F.broadcast(seed), "on").drop("on")
    seeds = stored(_best(_joined_hits(seeded, k), k), "topk-seeds")
    marks = (seeds.groupBy("block", "place").agg(F.count("*").alias("n"),
                                                 F.min("score").alias("score"))
             .where(F.col("n") == k).groupBy("block")
             .agg(F.collect_list(F.struct("place", "score")).alias("marks"))  # query_rows at most
             .withColumnRenamed("block", "bucket"))
    marked = stored(blocks.join(marks, "bucket", "left"), "topk-marked")
    # partitions hold ever shorter vectors; a block visits those that may reach its lowest mark
    longest = {r["part"]: r["longest"] for r in buckets.groupBy("part").agg(
        F.max("longest").alias("longest")).collect()}  # a row a partition
    visits = _visits(marked)
    order = sorted(longest)
    reach = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(longest[p]).alias("l"))
                      for p in order]) if order else F.array().cast(
        "array<struct<part:int,l:double>>")
    todo = visits.withColumn("part", F.explode(F.transform(
        F.filter(reach, lambda r: r["l"] >= F.col("need")), lambda r: r["part"])))
    pairs = todo.join(_rows(buckets, "b").drop("longest"), "part").select("b", "q")
    return _best(_joined_hits(pairs, k), k).select("query_id", "rank", "vec_id", "score")


def _visits(marked: DataFrame) -> DataFrame:
    """The blocks with ``need``: no vector shorter than this can reach any query's mark."""
    def need(batches):
        for b in batches:
            needs = []
            for row in b.select(["n", "dim", "data", "marks"]).to_pylist():
                lengths = _lengths(_matrix(row))
                marks = {m["place"]: m["score"] for m in row["marks"] or ()}
                low = [marks.get(i, NONE) / lengths[i] if lengths[i] > 0 and marks.get(i, 0) > 0
                       else 0.0 for i in range(len(lengths))]
                needs.append(min(low, default=0.0) * (1 - 1e-9))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(needs, pa.float64())],
                                             names=[*b.schema.names, "need"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields)
    out = marked.mapInArrow(need, fields + ", need double")
    cols = ["bucket", "n", "dim", "ids", "nulls", "uids", "data", "marks"]
    return out.select("need", F.struct(*cols).alias("q"))


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
           vector_col: str = "embedding", bucket_rows: int = BUCKET,
           query_rows: int = QUERY_BLOCK) -> DataFrame:
    """The k highest integer inner products of every query row with all other rows.

    ``vectors`` needs an id and an array column; other columns are ignored. Components x become
    floor(256 x). Returns query_id, rank (from 1), vec_id, score; ties go to the smaller id, NULL
    ids last. Vectors that are NULL or hold NULL or non-finite components take no part; an empty
    vector scores 0 with all, and missing components count as 0 between vectors of different
    lengths. Repeated rows are candidates and queries of their own (a query only skips itself).
    Tables with fewer rows give fewer ranks, empty ones an empty result. Scores beyond 64 bits
    raise an error.
    """
    v = scaled(F.col(vector_col))
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"),
                           F.coalesce(is_query, F.lit(False)).alias("is_query")).where(
        F.col("v").isNotNull())
    valid = valid.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + F.pow(
        x.cast("double"), F.lit(2.0))))
    return _search_packed(valid, k, bucket_rows, query_rows)
