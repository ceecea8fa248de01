"""Periodic runs, repeated windows and vector codes against brute-force versions, with NULLs, empty,
long and repeated texts, extra columns and empty tables."""
import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dayframe.llm import codes, queries, repeats, runs


def split(text):
    return (text or "").encode().split()


# --- periodic runs -----------------------------------------------------------------------------

def brute_runs(words, min_length):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(min_length, 2 * q):
                x = words[start:i + q]
                if all(any(x[j] != x[j + r] for j in range(len(x) - r)) for r in range(1, q)):
                    out.append((start, i + q - start, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


@pytest.mark.parametrize("min_length", [2, 5, 12])
def test_runs_equal_brute_force(min_length):
    rng = random.Random(min_length)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(0, 6)):
            letters, n = rng.choice([1, 2, 3, 20]), rng.randint(0, 70)
            text = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + (n - a) // (3 + rng.randrange(8))
                text = [text[i] if i < a else text[a + (i - a) % p] for i in range(n)]
            texts.append(text)
        found = runs.find_runs([np.array(t, np.int64) for t in texts], min_length)
        assert found == [brute_runs(t, min_length) for t in texts]


def test_ordered_positions_split_into_blocks():
    rng, numbers = random.Random(1), random.Random(2).sample(range(10 ** 6), 20000)
    held = runs.Positions(numbers[0])
    for x in numbers[1:]:
        held.add(x)
    assert list(held) == sorted(numbers) and len(held.blocks) > 2
    ranked = sorted(numbers)
    for x in rng.sample(sorted(set(range(10 ** 6)) - set(numbers)), 500):
        at = np.searchsorted(ranked, x)
        expected = (ranked[at - 1] if at else -1, ranked[at] if at < len(ranked) else -1)
        assert held.around(x) == expected


def test_runs_of_long_texts():
    for words, expected in (([0] * 60000, [(0, 60000, 1)]),
                            ([i % 7 for i in range(60000)], [(0, 60000, 7)]),
                            (list(range(60000)), [])):
        assert runs.find_runs([np.array(words)]) == [expected]


def test_detect(docs, empty):
    rows = docs.withColumn("runs", F.lit("clash"))
    for batch_words in (1, 500, runs.BATCH_WORDS):
        got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed)
                      for r in runs.detect(rows, 4, batch_words).collect())
        expected = Counter()
        for r in docs.collect():
            words = split(r.text)
            found = brute_runs(words, 4)
            expected[r.doc_id, len(words), tuple(found), brute_collapsed(words, found)] += 1
        assert got == expected
    assert runs.detect(empty).count() == 0
    with pytest.raises(ValueError):
        runs.detect(docs, 1)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_runs_query(spark, docs, tmp_path):
    many = docs
    for k in range(1, 5):  # enough ids for planted ones
        many = many.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000 * k))
    many.write.parquet(str(tmp_path / "documents.parquet"))
    got, expected, changed = Counter(map(tuple, queries.op11_runs(spark, str(tmp_path)).collect())), \
        Counter(), 0
    for r in many.collect():
        words = planted(r.doc_id, split(r.text))
        changed += words != split(r.text)
        found = brute_runs(words, 12)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        expected[(r.doc_id, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2])
                                          if best else [None] * 4),
                  hashlib.sha256(lines.encode()).hexdigest(),
                  hashlib.sha256(brute_collapsed(words, found).encode()).hexdigest())] += 1
    assert got == expected and changed > 3


# --- repeated windows ----------------------------------------------------------------------------

def brute_kept(texts, window):
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for w in texts:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1
                for j in range(i, i + window)}
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("window", [1, 3, 35])
def test_repeated_windows(docs, empty, window, monkeypatch):
    source = docs.collect()
    expected = Counter((r.doc_id, n, gone, hashlib.sha256(kept).hexdigest()) for r, (n, gone, kept) in
                       zip(source, brute_kept([split(r.text) for r in source], window), strict=True))
    rows = docs.withColumn("key", F.lit("clash")).withColumn("n", F.lit("clash"))
    assert Counter(map(tuple, repeats.remove(rows, window).collect())) == expected
    # many chunks and slices, and counters so few that estimates are far too high
    monkeypatch.setattr(repeats, "CHUNK_BYTES", (1 << 10, 1 << 10))
    monkeypatch.setattr(repeats, "SLICE_BYTES", (1 << 12, 1 << 12))
    monkeypatch.setattr(repeats, "CELLS_A_BYTE", 0.01)
    assert Counter(map(tuple, repeats.remove(rows, window).collect())) == expected
    assert repeats.remove(empty, window).count() == 0


def test_kept_texts(docs):
    source = docs.collect()
    texts, rows = repeats.kept_texts(docs, 20)
    kept = {bytes(r.key): r for r in texts.collect()}
    assert rows.count() == len(source)
    for r, (n, gone, text) in zip(source, brute_kept([split(r.text) for r in source], 20), strict=True):
        found = kept[hashlib.sha256((r.text or "").encode()).digest()[:16]]
        assert (found.n_words, found.n_removed, found.kept.encode()) == (n, gone, text)


def test_rolling_hash_is_the_polynomial():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    for window in (1, 2, 3, 7, 8, 35):
        got = repeats.rolling(words, window, repeats.BASES[0])
        assert len(got) == 101 - window
        for i in (0, 50, len(got) - 1):
            h = 0
            for w in words[i:i + window]:
                h = (h * int(repeats.BASES[0]) + int(w)) % (1 << 64)
            h ^= h >> 32
            h = h * 0xD6E8FEB86659FD93 % (1 << 64)
            assert int(got[i]) == h ^ (h >> 32)


def test_words_are_placed_and_hashed_alike_everywhere(texts, monkeypatch):
    column = pa.chunked_array([pa.array([t or "" for t in texts[:9]]), pa.array(
        ["", "x" * 64, "x" * 65, "x" * 66, "\x0bend ", *[t or "" for t in texts[9:]]])]).slice(3)
    words = [t.encode().split() for t in column.to_pylist()]
    data, begins, ends, sizes = repeats.placed_words(column)
    assert sizes.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert [data[a:b].tobytes() for a, b in zip(begins, ends, strict=True)] == flat
    both = [repeats.word_hashes(data, begins, ends, i).tolist() for i in (0, 1)]
    monkeypatch.setattr(repeats, "HASH_BYTES", 50)
    assert both == [repeats.word_hashes(data, begins, ends, i).tolist() for i in (0, 1)]
    for hashes in both:
        assert len(set(zip(flat, hashes, strict=True))) == len(set(flat)) == len(set(hashes))


# --- vector codes ------------------------------------------------------------------------------

def brute_codes(rows, parts, entries, rounds, scale):
    kept = [(i, label, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dims = len(kept[0][2]) // parts
    cut = [[v[p * dims:(p + 1) * dims] for p in range(parts)] for _, _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return min(range(len(d)), key=lambda e: (d[e], e)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for c in cut:
                mine.setdefault(nearest(c[p], books[p])[0], []).append(c[p])
            for e, xs in mine.items():
                books[p][e] = [sum(x[d] for x in xs) // len(xs) for d in range(dims)]
    out, by_label = [], Counter()
    for (i, label, _), c in zip(kept, cut, strict=True):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for e, _ in best), sum(d for _, d in best)))
        by_label[label] += out[-1][3]
    flat = ",".join(str(x) for p in books for e in p for x in e)
    return Counter((i, code, error, by_label[label]) for i, label, code, error in out), \
        hashlib.sha256(flat.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int, code string"


def vectors(n, dims, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(dims)]
        rows.append((i * 3 % n, v, rng.choice([None, 1, 2, 3])))
    return rows + [rows[5], rows[7], (None, rows[3][1], 1), (None, rows[4][1], None),
                   (-5, [0.0] * dims, 1), (-6, [0.0] * dims, 2)]


@pytest.mark.parametrize("n,parts,dims,entries,leaves", [
    (200, 4, 8, 6, 8192), (200, 2, 6, 16, 16), (9, 8, 16, 16, 8192), (300, 1, 5, 4, 2)])
def test_codes_equal_brute_force(spark, monkeypatch, n, parts, dims, entries, leaves):
    monkeypatch.setattr(codes, "LEAVES", leaves)
    rows = vectors(n, dims, n + leaves)
    bad = [(900, None, 1), (901, [None] + [0.0] * (dims - 1), 1), (902, [float("nan")] * dims, 2),
           (903, [float("inf")] * dims, None)]
    table = spark.createDataFrame([(*r, "clash") for r in rows + bad], VECTORS).repartition(3)
    coded, books = codes.compress(table, parts=parts, entries=entries, rounds=3, scale=64)
    expected, digest = brute_codes(rows, parts, entries, 3, 64)
    got = coded.select("vec_id", "code", "error", "label_error").collect()
    assert Counter(map(tuple, got)) == expected and codes.digest(books) == digest


def test_codes_of_the_trie_in_any_cut():
    rng = np.random.default_rng(4)
    parts = np.unique(rng.integers(-3, 4, (4000, 5)), axis=0)
    book = rng.integers(-3, 4, (7, 5))
    distance = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    for leaves in (1, 7, 300, 10 ** 6):
        codes.LEAVES, before = leaves, codes.LEAVES
        index, error = codes.nearest(parts, book)
        codes.LEAVES = before
        assert np.array_equal(index, distance.argmin(axis=1))
        assert np.array_equal(error, distance.min(axis=1))


def test_codes_without_rows_and_of_unequal_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    coded, books = codes.compress(empty)
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert coded.count() == 0 and books.size == 0
    nulls = spark.createDataFrame([(1, None, 1, "x")], VECTORS)
    assert codes.compress(nulls)[0].count() == 0
    for v in ([[0.0] * 8, [0.0] * 16], [[0.0] * 7], [[1e30] * 8]):
        rows = spark.createDataFrame([(i, x, 1, "x") for i, x in enumerate(v)], VECTORS)
        with pytest.raises(ValueError):
            codes.compress(rows)


# --- registered SQL ------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    cur = con.execute(queries.SQL[name])
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(d[0] for d in cur.description)
    order = [d[0] for d in cur.description]
    assert Counter(map(tuple, got.select(order).collect())) == Counter(cur.fetchall())
