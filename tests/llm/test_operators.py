"""Each operator against a brute-force version, with NULLs, empty, long and repeated texts, extra
columns and empty tables."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dayframe.llm import (lm, mixing, neardup, pieces, pii, quality, shards, tokens, topk, warc)

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(t):
    return [w for w in SPACE.split(t or "") if w]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_token_ids(docs, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = rows_of(tokens.read_documents(tokens.write_ids(docs, path, 2, block=128)))
    expected = Counter()
    for r in docs.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
        expected[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((d, n, c) for d, _, n, c in got) == expected
    at = 0
    by_start = sorted(got, key=lambda r: r[1])
    for _, start, n, _ in by_start:
        assert start == at
        at += n
    ids = [r[0] for r in by_start]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert rows_of(tokens.read_documents(tokens.write_ids(empty, path, 2))) == []


def test_packing_round_trip_and_random_access(tmp_path):
    rng = np.random.default_rng(1)
    for width in (1, 7, 16, 17, 31):
        ids = rng.integers(0, 1 << width, 1000).astype(np.uint32)
        assert np.array_equal(tokens.unpack_ids(tokens.pack_ids(ids, width), width, 1000), ids)
        path = str(tmp_path / f"{width}.bin")
        out = tokens.Writer(open(path, "wb"), width, block=64)
        for i in range(0, 1000, 100):
            out.add([i], np.array([100]), ids[i:i + 100])
        out.close()
        reader = tokens.Reader(path)
        for a, n in ((0, 1000), (63, 2), (999, 1), (130, 500), (5, 0)):
            assert np.array_equal(reader.ids(a, n), ids[a:a + n])


def test_word_memory_is_bounded_and_right():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    enc, t = tokens.WordEncoder(path), Tokenizer.from_file(path)
    enc.limit = 50
    rng = np.random.default_rng(2)
    for _ in range(40):
        text = " ".join("ab" * int(x) + "é'S," * int(x % 3) for x in rng.integers(1, 40, 30))
        ids, counts = enc.encode([text.encode(), b"", b"don't"])
        expected = [t.encode(x, add_special_tokens=False).ids for x in (text, "", "don't")]
        assert counts.tolist() == [len(e) for e in expected]
        assert ids.tolist() == sum(expected, [])
        assert len(enc.index) <= 50 + 31


def brute_capacity(sizes, n):
    def need(c):
        used = held = 0
        for s in sizes:
            if s > c:
                used, held = used + bool(held) + 1, 0
            elif held + s > c:
                used, held = used + 1, s
            else:
                held += s
        return used + bool(held)
    return next(c for c in range(1, sum(sizes) + 1) if need(c) <= n)


def test_shards(docs, empty):
    got = shards.shard(docs, 5, digest=8).collect()
    source = docs.collect()
    assert len(got) == len(source)
    groups, first = {}, {}
    for r in source:
        t = r.text or ""
        groups[t] = groups.get(t, 0) + len(t.encode()) + 8
        if r.doc_id is not None:
            first[t] = min(first.get(t, r.doc_id), r.doc_id)
    sizes = [groups[t] for t in sorted(groups, key=lambda t: first[t])]
    load, slots = Counter(), {}
    for r in got:
        load[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    capacity = brute_capacity(sizes, 5)
    assert max(load.values()) <= max(capacity, max(sizes))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    where = {}
    for r in got:
        where.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    assert shards.shard(empty, 5).count() == 0


def test_mixing(docs, empty):
    got = mixing.mix(docs, n_slots=1 << 12).collect()
    assert len(got) == docs.count()
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(words(r.text))
    total = sum(size.values())
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = total - sum(3 * size[s] for s in capped)
        free = [s for s in names if s not in capped]
        mass = sum(weight[s] for s in free)
        target = {s: 3.0 * size[s] if s in capped else left * weight[s] / mass for s in names}
        over = {s for s in free if target[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    taken = Counter()
    for r in got:
        assert r.size <= r.source_size == size[r.source] and r.taken <= 3 * r.size
        assert math.isclose(r.target, target[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.02 * total for s in names)
    assert order(rows_of(mixing.mix(docs, n_slots=1 << 12))) == order([tuple(r) for r in got])
    assert mixing.mix(empty).count() == 0
    copies = Counter()
    for r in got:
        copies[r.doc_id] += r.copies
    kept = Counter(r.doc_id for r in mixing.repeated(docs, n_slots=1 << 12).collect())
    assert kept == +copies


def test_mixing_meets_the_targets_of_tiny_sources_beside_a_huge_one(spark):
    big = spark.range(1300).select(F.col("id").alias("doc_id"), F.lit("big").alias("source"),
                                   F.repeat(F.lit("w "), 8000).alias("text"))
    sizes = [1, 7, 10, 25, 39, 41, 60, 130, 1000, 4000]
    tiny = spark.createDataFrame([(5000 + 100 * i + j, f"t{i}", "x " * n) for i, n in enumerate(
        sizes) for j in range(3)], "doc_id long, source string, text string")
    mixed = mixing.mix(big.unionByName(tiny))  # the default number of slots: a block has 40 words
    got = mixed.groupBy("source", "source_size", "target").agg(F.sum("taken").alias("taken"))
    rows = got.collect()
    assert len(rows) == len(sizes) + 1
    for r in rows:
        assert abs(r.taken - r.target) <= max(0.51, 0.01 * r.target), r


def brute_quality(t):
    t, w = t or "", words(t)
    n, seen, cover = len(w), {}, set()
    for i in range(n - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            cover.update(j for i in places for j in range(i, i + 8))
    lines = [x for x in t.split("\n") if words(x)]
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(cover))


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in range(40)],
                                   "doc_id long, quality int, toxic int, text string")
    got = quality.judge(docs, labels)
    counts = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")
    expected = []
    for r in docs.collect():
        f = brute_quality(r.text)
        bad = f[0] < 20 or 100 * f[4] > 30 * f[0]
        expected.append((r.doc_id, *f, bad, not bad))  # too few labels for any cutoff
    assert order(rows_of(counts)) == order(expected)
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(e[-1] for e in expected)
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(docs, labels.where("1 = 0")).where("kept").count() == kept.count()


def test_quality_cutoffs_are_exact_binomial_bounds(spark):
    rows = [(n, e) for n in (0, 5, 200, 1500, 40000) for e in (0.05, 0.001)]
    df = spark.createDataFrame(rows, "n long, e double")
    got = df.select("n", "e", quality.allowed_rejections(F.col("n"), 0.01, F.col("e")).alias("k"))
    for n, e, k in rows_of(got):
        best, cdf = -1, 0.0
        for i in range(n + 1):
            cdf += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                            + i * math.log(0.01) + (n - i) * math.log(0.99))
            if cdf > e or n == 0:
                break
            best = i
        assert k == best, (n, e)


def test_quality_rejects_only_what_the_risk_allows(spark):
    good = [(i, " ".join(f"w{j * (i + 3) % 97}" for j in range(40)), "en") for i in range(3000)]
    junk = [(10_000 + i, " ".join(f"w{j}###" for j in range(40)), "en") for i in range(50)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(3000)], "doc_id long, quality int")
    got = quality.judge(docs, labels)
    assert got.where("doc_id >= 10000 and kept").count() == 0
    clean = got.where("doc_id < 10000 and not base_failed")
    assert clean.where("not kept").count() <= quality.RISK * clean.count()


def test_quality_rules_reach_small_and_unlabelled_strata(spark):
    sizes = {"en": 2000, "de": 480, "es": 320, "it": 30, None: 0}
    rows = [(1000 * k * 10 + i, " ".join(f"w{j * (i % 90 + 3) % 97}" for j in range(40)), s, 1)
            for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [(90_000 + k, " ".join(f"w{j}###" for j in range(40)), s, 0)
             for k, s in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    got = quality.judge(docs, docs.where("quality = 1").select("doc_id", "quality"))
    assert got.where("doc_id >= 90000").count() == len(sizes)
    assert got.where("doc_id >= 90000 and kept").count() == 0
    clean = got.where("doc_id < 90000 and not base_failed")
    assert clean.where("not kept").count() <= quality.RISK * clean.count()
    assert quality.keep(docs, docs.where("quality = 1")).where("quality = 0").count() == 0


def brute_allowed(n, risk, error):
    """The largest k with P(Binomial(n, risk) <= k) <= error, -1 if there is none."""
    k, term, total = -1, (1 - risk) ** n, (1 - risk) ** n
    while n and total <= error and k < n:
        k += 1
        term *= (n - k) / (k + 1) * risk / (1 - risk)
        total += term
    return k


def brute_cutoffs(held, rules, risk, error):
    """Number of cutoffs of each rule by stratum: held maps a stratum to its documents' statistics."""
    groups = (1 + len(held)) * 2
    pool = [f for fs in held.values() for f in fs]
    turns = sorted(((r, i) for r, cuts in rules.items() for i in range(len(cuts))), key=lambda x: x[1])

    def tests(docs, joint_limit, apart_limit):
        joint, latest = 0, {}
        for r, i in turns:
            latest[r] = i
            if sum(any(f[x] > rules[x][j] for x, j in latest.items()) for f in docs) > joint_limit:
                break
            joint += 1
        apart = {}
        for r, cuts in rules.items():
            bad = [sum(f[r] > c for f in docs) > apart_limit for c in cuts] + [True]
            apart[r] = bad.index(True)
        return joint, apart

    def own(docs):
        n = len(docs)
        return tests(docs, brute_allowed(n, risk, error / groups),
                     brute_allowed(n, risk / len(rules), error / groups / len(rules)))

    def chosen(joint, apart, is_apart):
        if is_apart:
            return apart
        return {r: sum(x == r for x, _ in turns[:joint]) for r in rules}

    pj, pa = own(pool)
    out = {None: chosen(pj, pa, sum(pa.values()) > pj)}
    for s, docs in held.items():
        j, a = own(docs)
        is_apart = sum(a.values()) > j
        if j == 0 and sum(a.values()) == 0:
            uj, ua = tests(docs, len(docs) * risk, len(docs) * risk / len(rules))
            j, a = min(pj, uj), {r: min(pa[r], ua[r]) for r in rules}
            is_apart = sum(pa.values()) > pj
        out[s] = chosen(j, a, is_apart)
    return out


def test_quality_cutoffs_equal_brute_force(spark):
    """Jointly, apart and borrowed: the rules' cutoffs of strata of many sizes and kinds."""
    rng = np.random.default_rng(9)
    rules = {"symbols": ("n_symbols / nullif(n_words, 0)", (2.0, 1.0, 0.5, 0.25)),
             "capitals": ("n_capitals / nullif(word_chars, 0)", (0.9, 0.5, 0.3)),
             "long_words": ("word_chars / nullif(n_words, 0)", (30.0, 15.0))}
    kinds = {"a": (3000, 0.001, 0.001), "b": (900, 0.004, 0.0), "c": (400, 0.0, 0.0),
             "d": (250, 1.0, 0.0), "e": (60, 0.0, 0.3), "f": (1500, 0.02, 0.03), "g": (5, 0.0, 0.0)}
    rows, held = [], {}
    for s, (n, p_symbols, p_capitals) in kinds.items():
        for _ in range(n):
            words, symbols = 100, int(rng.integers(20, 260)) if rng.random() < p_symbols else 0
            chars = 100 * int(rng.integers(4, 9))
            capitals = int(chars * rng.random()) if rng.random() < p_capitals else 0
            rows.append((len(rows), s, words, chars, symbols, capitals))
            held.setdefault(s, []).append({"symbols": symbols / words, "capitals": capitals / chars,
                                           "long_words": chars / words})
    feats = spark.createDataFrame(rows, "doc_id long, stratum string, n_words long, word_chars long, "
                                        "n_symbols long, n_capitals long").withColumn(
        "n_repeat_words", F.lit(0).cast("long"))
    labels = feats.select("doc_id", F.lit(1).alias("quality"))
    got = {r.stratum: r for r in quality.cutoffs(feats, labels, rules).collect()}
    expected = brute_cutoffs(held, {r: cuts for r, (_, cuts) in rules.items()}, quality.RISK,
                             quality.ERROR)
    for s, numbers in expected.items():
        assert {r: got[s][f"cut_{r}"] for r in rules} == {
            r: rules[r][1][k - 1] if k else None for r, k in numbers.items()}, s
    assert got["d"].borrowed and got["d"].cut_symbols is None and got["d"].n_labels == 250
    assert got["g"].borrowed and not got["a"].borrowed


def test_quality_does_not_borrow_against_a_stratums_own_labels(spark):
    """Clean code full of symbols stays, whatever the other strata's cutoffs are."""
    rows = [(i, " ".join(f"w{j * (i + 3) % 97}" for j in range(40)), "en", 1) for i in range(4000)]
    rows += [(10_000 + i, " ".join(f"w{j}{'#' * 2}" for j in range(40)), "code", 1) for i in range(200)]
    rows += [(20_000 + i, " ".join(f"w{j}###" for j in range(40)), "en", 0) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    got = quality.judge(docs, docs.where("quality = 1").select("doc_id", "quality"))
    assert got.where("doc_id >= 20000 and kept").count() == 0
    code = got.where("doc_id between 10000 and 19999")
    assert code.where("kept").count() >= 0.98 * code.count() and code.where("borrowed").count() == 200


def test_pieces(docs, empty):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = pieces.encode(docs, path).collect()
    source = Counter((r.doc_id, tuple(sp.encode(r.text or ""))) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == source
    assert all(r.parity and r.round_trip for r in got)
    assert pieces.encode(empty, path).count() == 0


@pytest.mark.parametrize("part", [7, 1 << 14])
def test_pieces_of_chunks_in_groups(texts, part):
    import random

    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = random.Random(part)
    odd = ["".join(rng.choice([" ", "  ", "▁", "ab", "é", "😀", "\n", "the"]) for _ in range(n))
           for n in (40, 500, 90000)] + ["▁", " ▁ a", "a ▁▁ b", "x" * 300]
    every = [t or "" for t in texts] + odd
    enc = pieces.PieceEncoder(path, part)
    ids, counts = enc.encode([t.encode() for t in every])
    want = sentencepiece.SentencePieceProcessor(model_file=path).encode(every)
    assert ids.tolist() == [i for one in want for i in one]
    assert counts.tolist() == [len(one) for one in want]
    assert len(enc._grouped([b" ab", b" ", b" cd", b" efgh", b" i"])) == (4 if part == 7 else 3)
    enc.by_chunk, enc.tokenizer = False, pieces.backend(enc.spec)
    whole = enc.encode([t.encode() for t in every])
    assert whole[0].tolist() == ids.tolist() and whole[1].tolist() == counts.tolist()
    for way in (enc, pieces.PieceEncoder(path)):
        assert [len(x) for x in way.encode([])] == [0, 0]


def test_piece_normaliser_collapses_spaces():
    norm = pieces.normaliser(pieces.Model(collapse_spaces=True)).normalize_str
    assert [norm(t) for t in ("  a  b▁ c ", "", "  ")] == ["▁a▁b▁c", "", ""]
    rest = pieces.normaliser(pieces.Model(collapse_spaces=False), first=False).normalize_str
    assert rest(" a  b") == "▁a▁▁b"


def test_piece_model_of_unigrams(tmp_path):
    # a hand-made unigram model: wire format, scores and byte fallback
    import struct

    def field(n, raw):
        return bytes([n << 3 | 2, len(raw)]) + raw

    pieces_ = [("<unk>", 0.0, 2)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] + [
        ("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ab", -3.5, 1), ("▁ab", -3.0, 1)]
    raw = b"".join(field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + bytes(
        [0x18, k])) for p, s, k in pieces_)
    raw += field(2, bytes([0x18, 1, 0x98, 0x02, 1])) + field(3, bytes([0x18, 1, 0x20, 0]))
    path = tmp_path / "u.model"
    path.write_bytes(raw)
    enc = pieces.PieceEncoder(str(path))
    ids, counts = enc.encode([b"ab b", "é".encode()])
    assert [pieces_[i][0] for i in ids[:counts[0]]] == ["▁ab", "▁", "b"]
    assert enc.decode(ids, counts) == [b"ab b", "é".encode()]


def test_warc(spark):
    big = "<p>ü</p>" * 200
    rows = [(1, "http://a/\r\nX: 1", big, 0), (9, "http://b", big, 0), (5, None, big, 0),
            (2, "http://c", "small", 0), (3, "http://c", "small", 0), (4, "u", None, 0),
            (7, "u", "", 0), (None, "u", big + "!", 0), (None, "u", big, 0), (9, "http://b", big, 0),
            (6, "u", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n" * 90, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, owner int")
    records = warc.read_records(warc.write_archives(pages, file_bytes=3000))
    assert records.count() == 3 * len(rows)
    bad = records.where("type = 'response' and sha1(payload) <> payload_digest")
    assert bad.count() == 0
    found = warc.resolved(warc.captures(records.drop("payload")))
    got = found.select("page_id", "response.payload_length", "response.payload_digest",
                       "response.type", "refers_to")
    expected = []
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        again = html == big and page != 9
        expected.append((page, len(raw), hashlib.sha1(raw).hexdigest(),
                         "revisit" if again else "response", 9 if again else None))
    assert order(rows_of(got)) == order(expected)
    assert found.where("request is null or metadata is null").count() == 0
    # a second metadata record is kept, a second response is an error
    one = records.drop("payload").where("type = 'metadata'").limit(1).withColumn(
        "record_id", F.lit("<urn:uuid:second>")).withColumn("fields", F.array(F.struct(
            F.lit("note").alias("name"), F.lit("later").alias("value"))))
    whole = records.drop("payload")
    more = warc.captures(whole.unionByName(one.select(whole.columns)))
    assert more.where(F.size("metadata") == 2).count() == 1
    assert more.where(F.size("metadata") != 2).count() == whole.where("type = 'metadata'").count() - 1
    twice = whole.unionByName(whole.where("type = 'response'").limit(1).withColumn(
        "record_id", F.lit("<urn:uuid:other>")).select(whole.columns))
    with pytest.raises(Exception, match="two responses"):
        warc.captures(twice).collect()
    none = warc.read_records(warc.write_archives(pages.where("1 = 0")))
    assert warc.resolved(warc.captures(none)).count() == 0


def brute_topk(rows, k):
    vectors = [(i, v, [math.floor(256 * x) for x in e]) for v, (i, e) in enumerate(rows)
               if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, v, q in vectors:
        if i is None or i % 50:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, x, strict=False)), j is None, j or 0)
                         for j, u, x in vectors if u != v))[:k]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored)]
    return out


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1 + 3 * (i % 7 == 0), 6).tolist()) for i in range(400)]
    rows += [(50, [4.0] * 6), (401, [4.0] * 6), (402, [4.0] * 6), (403, None), (404, [1.0, None]),
             (405, [float("nan")] * 6), (406, [float("inf")] * 6), (450, []), (500, [0.0] * 6),
             (None, [4.0] * 6), (407, [1e6] * 3), (550, [-2.0, 1.0])]
    df = spark.createDataFrame([(i, e, 7) for i, e in rows],
                               "vec_id long, embedding array<double>, score int").repartition(4)
    query = F.col("vec_id") % 50 == 0
    for bucket, block in ((37, 3), (4096, 512)):
        got = topk.search(df, query, 5, bucket_rows=bucket, query_rows=block)
        assert order(rows_of(got)) == order(brute_topk(rows, 5))
    assert topk.search(df.where("vec_id = 50").limit(1), query).count() == 0
    assert topk.search(df.where("1 = 0"), query).count() == 0


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
       "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(t):
    out = []
    for rank, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, t or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                luhn = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10))
                           for i, d in enumerate(map(int, reversed(digits))))
                if not 12 <= len(digits) <= 19 or luhn % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_pii_base(spark, docs, empty):
    odd = ["a@b.c@d.e", "a@b.co_x@y.zz", "@a.b x@y", "x@y.z.", "1.2.3.4.5.6.7.8", "256.1.1.1",
           "001.02.3.255", "0000300.1.1.1", "4111 1111 1111 1111 1", "4111-1111-1111-1111",
           "+12 (3).4-567 890+1 234 567 89", "++1 2", "é😀 a@b.cd 😀 1.1.1.1", "a" * 3000 + "@",
           "1" * 3000, "4041894974608795+4041894974608795"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)],
                                 "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    got = pii.find(every).select("doc_id", F.transform("base", lambda s: F.struct(
        s["kind"], s["start"], s["end"])).alias("b"))
    assert order((r.doc_id, [tuple(s) for s in r.b]) for r in got.collect()) == order(
        (r.doc_id, brute_pii(r.text)) for r in every.collect())
    assert pii.find(empty).count() == 0
    cleaned = pii.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    assert cleaned.where("text is null").count() == docs.where("text is null").count()
    assert not [r for r in cleaned.collect() if brute_pii(r.text)]


def test_pii_terms(spark):
    common = "the report of the day was sent to the team "
    rows = [(i, f"{common}{'north south east west'.split()[i % 4]} zebulon's note {i % 5} a@b.org "
             f"for all of the team {i}") for i in range(8)]
    rows += [(100 + i, common + f"nothing here {i} for all") for i in range(60)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    hits = {r.doc_id: [(s.start, s.end) for s in r.terms] for r in found.collect()}
    text = dict(rows)
    said = {text[d][a:b] for d, spans in hits.items() for a, b in spans}
    assert "zebulon's" in said and "the" not in said and "team" not in said
    assert all(not hits[100 + i] for i in range(60))


def test_pii_terms_are_the_same_with_and_without_copies(spark):
    rows = [(i, f"filler word{i} more filler text") for i in range(300)]
    pages = [f"zebulon lives at a@b.org page{'xyz'[i]} it says" for i in range(3)]
    rows += [(1000 + i, p) for i, p in enumerate(pages)]
    copied = rows + [(2000 + i, pages[0]) for i in range(200)]
    for table in (rows, copied):
        found = pii.find(spark.createDataFrame(table, "doc_id long, text string")).collect()
        hits = {r.doc_id: [(dict(table)[r.doc_id][s.start:s.end], s.kind) for s in r.terms]
                for r in found}
        assert len(found) == len(table)
        assert all(("zebulon", "generalised") in hits[d] for d, t in table if "zebulon" in t)


def test_pii_terms_of_rare_entities_anywhere_in_the_text(spark):
    filler = "filler text that goes on and says what all other texts say as well "
    rows = [(i, filler * 4 + f"word{i}") for i in range(3000)]
    rows += [(9000, "zebulon " + filler * 4 + "a@b.org"), (9001, filler + "c@d.org is ottokar")]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    said = {(r.doc_id, dict(rows)[r.doc_id][s.start:s.end]) for r in found for s in r.terms}
    assert said == {(9000, "zebulon"), (9001, "ottokar")}


def brute_entities(t):
    for kind, a, b in brute_pii(t):
        value = t[a:b]
        yield kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower()


def brute_places(t):
    """(term, start, end) of a text's terms, but those that touch a base span or hold \\x01."""
    spans = brute_pii(t)
    for m in re.finditer(r"[^\x20\x09-\x0D]+", t or ""):
        term = re.sub(r"^[\W_]+|[\W_]+$", "", m[0]).lower()
        if "\x01" not in m[0] and len(term) >= 3 and re.search(r"[^\W\d_]", term) and not any(
                a < m.end() and m.start() < b for _, a, b in spans):
            yield term, m.start(), m.end()


def brute_terms(source, share=0.6, generalise_at=0.5, remove_at=0.9):
    """The added spans of every distinct text, from sets of texts alone."""
    every = {t or "" for t in source}
    holds_e, holds_t = {}, {}
    for t in every:
        for e in brute_entities(t):
            holds_e.setdefault(e, set()).add(t)
        for w in SPACE.split(t):
            holds_t.setdefault(re.sub(r"^[\W_]+|[\W_]+$", "", w).lower(), set()).add(t)
    near = {(w, e) for t in every for e in brute_entities(t) for w, _, _ in brute_places(t)}
    again, first = Counter(), Counter()
    for kind, two, with_e in {(e[0], frozenset(holds_t[w]), frozenset(holds_e[e]))
                              for w, e in near if len(holds_t[w]) == 2}:
        joint = len(two & with_e)
        again[kind] += joint * (joint - 1)
        first[kind] += joint
    out = {}
    for t in every:
        kinds = {}
        for w in {w for w, _, _ in brute_places(t)}:
            for e in brute_entities(t):
                m = (again[e[0]] + 1) / (first[e[0]] + 2)
                chance = (len(holds_t[w] & holds_e[e]) - 1 + m) / len(holds_t[w])
                own = math.log2(len(every) / len(holds_e[e]))
                if own and chance >= generalise_at and math.log2(
                        chance * len(every) / len(holds_e[e])) / own >= share:
                    kind = "removed" if chance >= remove_at else "generalised"
                    kinds[w] = max(kind, kinds.get(w, ""))
        out[t] = [(kinds[w], a, b) for w, a, b in brute_places(t) if w in kinds]
    return out


def found_terms(found):
    return order((r.doc_id, [(s.kind, s.start, s.end) for s in r.terms]) for r in found.collect())


def planted_names(n, seed=3):
    """Texts of frequent and of rare words, a fifth with an address. Every address of ``names`` comes
    in several texts and always with its owner's name; the others come once, in any text."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        said = [f"word{x}" for x in rng.integers(0, 60, 12)] + [f"rare{x}" for x in rng.integers(
            0, n, 2)]
        if i % 5 == 0:
            said.insert(int(rng.integers(0, 14)), f"u{i}@mail.org")
        rows.append((i, " ".join(said)))
    names = {"zebulon": 3, "ottokar": 6, "wilhelmina": 14}
    for k, (name, times) in enumerate(names.items()):
        rows += [(10**6 + 100 * k + j, f"{name} of word{j} in word{j + 9}, {name}@home.org; rare{j}")
                 for j in range(times)]
    return rows, names


def test_pii_terms_equal_brute_force(spark, docs):
    rows, _ = planted_names(400)
    rows += [(5000 + (r.doc_id or 900), r.text) for r in docs.collect()]
    rows += [(7000 + i, f"a@b.cd;e@f.gh (Ümlaut{i % 2}) +12 (3)45 67890 x{'y' * i} 1.2.3.4 tail")
             for i in range(4)] + [(7100 + i, "mask\x01ed word 1.2.3.4 tail end") for i in range(2)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({}, {"share": 0.3, "generalise_at": 0.3, "remove_at": 0.6}):
        want = brute_terms([t for _, t in rows], **options)
        assert any(want.values())
        assert found_terms(pii.find(table, **options)) == order((d, want[t or ""]) for d, t in rows)


def test_pii_terms_are_the_planted_ones_in_small_and_large_tables(spark):
    seen = []
    for n in (1000, 12000):
        rows, names = planted_names(n)
        found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        text = dict(rows)
        said = {(text[r.doc_id][s.start:s.end], s.kind) for r in found for s in r.terms}
        assert {w for w, _ in said} >= set(names)
        wrong = [w for w, _ in said if w not in names]
        assert len(wrong) <= 3, wrong
        seen.append({(r.doc_id, s.start, s.kind) for r in found if r.doc_id >= 10**6
                     for s in r.terms if text[r.doc_id][s.start:s.end] in names})
    assert seen[0] == seen[1]


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [(d, len(s), low.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def test_near_duplicates(docs, empty):
    got = neardup.near_duplicates(docs)
    source = [(r.doc_id, r.text) for r in docs.collect()]
    expected = brute_near(source)
    assert order(rows_of(got.select("doc_id", "n_shingles", "component_id"))) == order(expected)
    assert got.where("not (kept <=> (doc_id <=> component_id))").count() == 0
    kept = neardup.deduplicated(docs)
    groups = {c for _, n, c in expected if n}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if words(r.text)) == sorted(groups)
    assert kept.where("trim(coalesce(text, '')) = ''").count() >= 3
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_write_few_tables(spark, docs, monkeypatch):
    """Every work table and shuffle costs each of its tasks; there were 23 tables here."""
    wrote = []
    plain = neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, what: wrote.append(what) or plain(df, what))
    neardup.near_duplicates(docs).count()
    assert len(wrote) <= 18, wrote


def test_deduplicated_leaves_one_work_table(docs, tmp_path, monkeypatch):
    left = lambda: sorted(p.name[:-33] for p in tmp_path.iterdir())
    path = lambda _, *parts: str(tmp_path / parts[-1])
    monkeypatch.setattr("dayframe.sources.sinks.scratch_path", path)
    monkeypatch.setattr("dayframe.llm.common.scratch_path", path)
    assert neardup.deduplicated(docs).count() and left() == ["near-found"]


def test_stars_are_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(501, 560)] + [(559, 2), (2, 600)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    edges = [p if rng.random() < 0.5 else p[::-1] for p in chain + hub + loose + hub[:9]] + [(7, 7)]
    low = {x: x for e in edges for x in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = [tuple(r) for r in neardup.stars(frame).collect()]
    assert sorted(got) == sorted((x, m) for x, m in low.items() if x != m)
    assert neardup.stars(frame.where("a = b")).count() == 0


def test_family_blocks_find_every_link():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 40, 60).astype(np.uint64)
    sets = []
    for _ in range(80):
        s = base.copy()
        s[rng.integers(0, 60, 6)] = rng.integers(0, 1 << 40, 6).astype(np.uint64)
        sets.append(np.unique(s))
    side = rng.random(80) < 0.5
    links = neardup.block_links(list(range(80)), list(range(80)), side, sets, True, 75)
    parent = list(range(80))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    for a in range(80):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                assert root(a) == root(b)
    assert len(links) < 80


def test_lm_scores(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = lm.score(docs, path, frequent=20).collect()
    train = Counter()
    source = docs.collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    text = lambda r: (r.text or "").encode().lower().split() + [None]
    for r in source:
        if not held(r.doc_id):
            train.update(text(r))
    n, v = sum(train.values()), len(train)
    expected = order((r.doc_id, held(r.doc_id), len(text(r)), sum(train[w] > 0 for w in text(r)), n,
                      round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in text(r)), 5))
                     for r in source)
    assert order((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                  round(r.base_score, 5)) for r in got) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.score(empty, path).count() == 0


def test_lm_gradients_and_windows():
    rng = np.random.default_rng(0)
    p = {n: v.astype(np.float64) for n, v in lm.initial(5, 4, 3, 8, np.ones(4) / 4).items()}
    p["D"] += rng.normal(0, 0.1, p["D"].shape)
    x, y = rng.integers(0, 6, (3, 8)), rng.integers(0, 4, (3, 8))
    g, _ = lm.gradients(p, x, y)
    for n in p:
        i = tuple(rng.integers(0, s) for s in p[n].shape)
        at = p[n][i]
        p[n][i] = at + 1e-5
        up = lm.gradients(p, x, y)[1]
        p[n][i] = at - 1e-5
        down = lm.gradients(p, x, y)[1]
        p[n][i] = at
        assert math.isclose((up - down) / 2e-5, g[n][i], abs_tol=1e-7)
    q = {n: v.astype(np.float32) for n, v in p.items()}
    symbols, classes = rng.integers(0, 5, 23), rng.integers(0, 4, 23)
    counts = np.array([0, 5, 0, 1, 17])
    got = lm.Scorer.of(q, 4).texts(symbols, classes, counts, 5, 4)
    edges = np.concatenate([[0], np.cumsum(counts)])
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        total, inputs = 0.0, [5] * 5 + symbols[a:b].tolist() + [5] * 8
        for t in range(b - a):
            j, place = t // 4 * 4, 4 + t % 4
            h = p["E"][inputs[j:j + 8]] + p["P"]
            s = h[place] @ p["Q"] @ (h[:place + 1] @ p["K"]).T / np.sqrt(3)
            att = np.exp(s) / np.exp(s).sum()
            logits = p["D"][inputs[j + place]] + p["b"] + (
                h[place] + att @ (h[:place + 1] @ p["V"]) @ p["O"]) @ p["U"]
            total += logits[classes[a + t]] - np.log(np.exp(logits).sum())
        assert math.isclose(got[k], total, rel_tol=1e-4, abs_tol=1e-5)


def test_lm_learns(spark):
    rng = np.random.default_rng(1)
    parts = ["the", "cat", "sat", "on", "mat", "dog", "ran", "far"]
    rows, at = [], 0
    for i in range(300):
        line = []
        for _ in range(400):
            at = (at + (1 if rng.random() < 0.9 else 3)) % 8
            line.append(parts[at])
        rows.append((i, " ".join(line)))
    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    held = lm.score(df, path, rate=2e-2).where("held_out")
    s = held.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert s.s > 0.75 * s.b  # the order of words helps; word counts cannot see it


def test_most_frequent_takes_whole_frequencies_within_the_limit(spark):
    uses = [0, 1, 1, 1, 2, 2, 500, 70_000]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(uses)], "id long, uses long")
    for limit, want in ((0, []), (1, [7]), (3, [6, 7]), (4, [4, 5, 6, 7]), (6, [4, 5, 6, 7]),
                        (7, [1, 2, 3, 4, 5, 6, 7])):
        assert sorted(r["id"] for r in lm.most_frequent(df, "uses", limit).collect()) == want
    assert lm.most_frequent(df.limit(0), "uses", 5).count() == 0


def test_lm_trains_on_every_token():
    enc = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for sizes in ((3, 0, 700, 40, 5000, 1), (2, 0), (31,), (32, 31), (511,), (512,), (0,)):
        texts = [" ".join(f"w{i * 7 % 400}" for i in range(n)).encode() for n in sizes]
        ids, counts = enc.encode(texts)
        stream = [enc.vocabulary, *tokens.with_end(ids, counts, enc.vocabulary).tolist()]
        want = list(zip(stream, stream[1:], strict=False))
        ends = np.cumsum(counts + 1)
        whole = np.array(stream[1:])
        streams = [whole[e - n - 1:e] for e, n in zip(ends, counts, strict=True)]
        packed = pa.array([x.astype("<u4").tobytes() for x in streams], pa.binary())
        for limit in (1, 700, lm.STEP_TOKENS):
            back = list(lm.unpacked(packed, limit))
            assert np.concatenate([x for x, _ in back]).tolist() == stream[1:]
            assert np.concatenate([n for _, n in back]).tolist() == (counts + 1).tolist()
        for windows in (16, lm.WINDOWS):
            parts = [(a.ravel().tolist(), b.ravel().tolist()) for a, b in lm.training_windows(
                streams, 32, enc.vocabulary, windows)]
            got = [x for a, b in parts for x in zip(a, b, strict=True)]
            assert not Counter(want) - Counter(got) and len(got) < len(want) + 32


def test_lm_probabilities_are_exact_beyond_the_limit():
    """Large attention scores and logits, up and down: the scorer gives the softmax, not a cut one."""
    rng = np.random.default_rng(3)
    for bias, size in (([70.0, 90.0, -300.0, 0.0], 1.0), ([-500.0, -520.0, -510.0, -505.0], 1.0),
                       ([0.0] * 4, 40.0)):
        p = {n: v.astype(np.float64) for n, v in lm.initial(5, 4, 3, 8, np.ones(4) / 4).items()}
        p["b"], p["Q"], p["K"] = np.array(bias), p["Q"] * size, p["K"] * size
        q = {n: v.astype(np.float32) for n, v in p.items()}
        symbols, classes = rng.integers(0, 5, 20), rng.integers(0, 4, 20)
        got = lm.Scorer.of(q, 4).texts(symbols, classes, np.array([20]), 5, 4)[0]
        total, inputs = 0.0, [5] * 5 + symbols.tolist() + [5] * 8
        for t in range(20):
            j, place = t // 4 * 4, 4 + t % 4
            h = p["E"][inputs[j:j + 8]] + p["P"]
            x = h[place] @ p["Q"] @ (h[:place + 1] @ p["K"]).T / np.sqrt(3)
            att = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
            logits = p["D"][inputs[j + place]] + p["b"] + (
                h[place] + att @ (h[:place + 1] @ p["V"]) @ p["O"]) @ p["U"]
            total += logits[classes[t]] - logits.max() - np.log(np.exp(logits - logits.max()).sum())
        assert math.isclose(got, total, rel_tol=1e-4, abs_tol=1e-4)


def test_lm_learns_from_short_documents_by_default(spark):
    parts = ["the", "cat", "sat", "on", "mat", "dog", "ran", "far"]
    rows = [(i, " ".join(parts[(i + j) % 8] for j in range(60))) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = lm.score(df, public_tokenizers.path("word_bpe_49k.json")).where("held_out")
    s = got.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert s.s > 0.5 * s.b


def test_direct_words_equal_the_whole_tokenizer():
    enc = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    words = [w.encode() for w in ["plain", "comma,", "naïve!?", "straße...", "ªº", "l'eau",
                                  "«mot»", "a­b", "<|endoftext|>", "a<|endoftext|>", "ÀB",
                                  "éa", "x9", "...", "a" * 300 + "!" * 300]]
    assert enc.direct is not None
    got = enc.distinct(words)
    enc.direct = None
    want = enc.distinct(words)
    assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
