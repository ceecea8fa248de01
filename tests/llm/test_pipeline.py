"""The pipeline's stages on a small table, each against a brute-force version on its own input."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_operators import (brute_cutoffs, brute_near, brute_pii, brute_quality, brute_terms, order,
                            rows_of, words)

import corpus_pipeline as pipeline
from dayframe.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int"


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    current, counts = docs, []
    for _, stage in pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns
        counts.append(current.count())
    assert counts[0] < docs.count() and counts[1] < counts[0] and counts[2] == counts[1]
    out = pipeline.run(spark, str(tmp_path))
    assert out.count() == counts[-1]
    assert out.where("not parity or not round_trip").count() == 0


def test_empty_table(spark, empty, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def corpus():
    """Rows of three languages with copies, near copies, junk and personal data, and their labels:
    enough in one language, too few in another, none in the third."""
    rng = random.Random(11)
    vocabulary = [a + b + c for a in ("ta", "re", "mi", "so", "lu") for b in ("n", "r", "st", "é")
                  for c in ("a", "o", "ing", "um", "el", "is")]
    rows, labels = [], []
    for i in range(700):
        said = [rng.choice(vocabulary) for _ in range(rng.randint(40, 60))]
        junk = i % 13 == 5
        if junk:
            said = [w + "###" for w in said]
        elif i % 17 == 6:
            said = rows[-1][1].split(" ")
            said[len(said) // 2] = f"changed{i}"
        elif i % 19 == 7:
            said = rows[-2][1].split(" ")
        elif i % 9 == 0:
            said.insert(rng.randint(0, 40), f"zebulon z@home.org and 1.2.3.{i % 300}" if i % 45 == 0
                        else f"u{i}@mail.org")
        lang = ("en" if i % 10 < 6 else "de") if i % 10 < 9 else "fr"
        source = rng.choice(["big", "big", "big", "b", "c", None]) if i % 50 else "tiny"
        text = " ".join(said)
        rows.append((i, text, lang, source, len(text), i))
        if lang != "fr":
            labels.append((i, 0 if junk else 1))
    rows += [(900, None, "en", "b", 0, 0), (901, "", "de", None, 0, 1), (902, "few words", "en", "b", 9, 2)]
    return rows, labels


def brute_quality_stage(rows, labels):
    clean = {i for i, q in labels if q == 1}
    stats, failed = {}, set()
    for i, text, *_ in rows:
        n, chars, symbols, twice, again = brute_quality(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        if n < 20 or 100 * again > 30 * n:
            failed.add(i)
        else:
            stats[i] = {"symbols": symbols / n, "dup_lines": twice / len(lines),
                        "capitals": len(re.findall("[A-Z]", text)) / chars, "long_words": chars / n}
    held = {}
    for i, _, lang, *_ in rows:
        if i in stats and i in clean:
            held.setdefault(lang, []).append(stats[i])
    cuts = {r: c for r, (_, c) in quality.RULES.items()}
    numbers = brute_cutoffs(held, cuts, quality.RISK, quality.ERROR)
    pooled = numbers[None]
    assert pooled["symbols"] and numbers["en"]["symbols"]

    def rejected(i, lang):
        own = numbers.get(lang, pooled)
        return any(k and stats[i][r] > cuts[r][k - 1] for r, k in own.items())

    return [r for r in rows if r[0] not in failed and not rejected(r[0], r[2])]


def brute_near_stage(rows, _):
    component = {d: c for d, _, c in brute_near([r[:2] for r in rows])}
    return [r for r in rows if component[r[0]] == r[0]]


def brute_personal_stage(rows, _):
    added, out = brute_terms([r[1] for r in rows]), []
    for doc_id, text, lang, source, n_chars, size in rows:
        at, said = 0, []
        spans = [(a, -b, k) for k, a, b in brute_pii(text) + added[text]]
        for a, b, kind in sorted(spans):
            if a >= at:
                said += [text[at:a], {"removed": "", "generalised": "<TERM>"}.get(
                    kind, f"<{kind.upper()}>")]
            at = max(at, -b)
        new = "".join(said) + text[at:]
        out.append((doc_id, new, lang, source, len(new) if spans else n_chars, size))
    return out


def brute_mixing_stage(rows, _):
    size = Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight, capped = {s: i % 3 + 1 for i, s in enumerate(names)}, set()
    while True:
        mass = sum(weight[s] for s in names if s not in capped)
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        target = {s: 3 * size[s] if s in capped else left * weight[s] / mass for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    assert capped

    def key(r):
        text = hashlib.md5(r[1].encode()).hexdigest()
        return hashlib.md5(f"{r[0]}/{text}/mix".encode()).hexdigest()

    out = []
    for s in names:
        # with so few words a block is a word: the source's words are used in turn
        turns, more = divmod(math.floor(target[s] + 0.5), size[s])
        at = 0
        for r in sorted((r for r in rows if r[3] == s), key=key):
            n = len(words(r[1]))
            taken = turns * n + min(n, max(0, more - at))
            out += [r] * math.floor(taken / n + 0.5)
            at += n
    return out


def brute_encoding_stage(rows, _):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, out = sentencepiece.SentencePieceProcessor(model_file=path), []
    for doc_id, text, *_ in rows:
        ids = model.encode(text)
        out.append((doc_id, ids, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True,
                    model.decode(ids) == text))
    return out


BRUTE = [brute_quality_stage, brute_near_stage, brute_personal_stage, brute_mixing_stage,
         brute_encoding_stage]


@pytest.fixture(scope="module")
def stored_corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    rows, labels = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int") \
        .write.parquet(str(folder / "labels.parquet"))
    return str(folder), rows, labels


def test_every_stage_equals_brute_force(spark, stored_corpus):
    folder, rows, labels = stored_corpus
    sizes = [len(rows)]
    for (name, stage), brute in zip(pipeline.STAGES, BRUTE, strict=True):
        got = rows_of(stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), folder))
        want = brute(rows, labels)
        assert order(got) == order(want), name
        sizes.append(len(want))
        rows = want
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] != sizes[4] == sizes[5]
    assert order(rows_of(pipeline.run(spark, folder))) == order(rows)
