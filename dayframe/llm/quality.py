"""Quality rules with risk-controlled thresholds.

Each rule rejects documents whose statistic exceeds a cutoff. The cutoffs are not set by hand: on
labelled clean documents, per stratum, they are accepted only if the exact (Clopper-Pearson) upper
bound of a false-rejection rate stays below ``risk``. Cutoffs are tested from the most lenient to
the strictest and the first failure stops the sequence, so that tests in sequence need no
correction among each other. There are two ways, with half of the error each, and a stratum uses
the one that accepted more cutoffs:

* jointly: one sequence over all rules in turn; what is bounded is the rate at which the rules so
  far reject together, so that neither risk nor error is split. A few hundred documents do;
* apart: a sequence of each rule, with equal shares of ``risk`` and error, so that no rule stops
  another.

All rules together then reject at most ``risk`` of a stratum's clean documents, with probability
``1 - error`` over all strata (each gets an equal share). All strata pooled are tested like one
more. A stratum in which nothing was accepted, or without labels, borrows the pooled cutoffs; for it
the bound holds on the pooled documents only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_groups, stored, text_or_empty, words_of

WINDOW = 8
MIN_WORDS = 20
SYMBOLS = r"[#*$%&|<>]"

# Rules: statistic per word or character, and the cutoffs to try, most lenient first.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / nullif(n_words, 0)", (4.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25)),
    "dup_lines": ("n_dup_lines / nullif(n_lines, 0)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4)),
    "capitals": ("n_capitals / nullif(word_chars, 0)", (0.9, 0.7, 0.5, 0.4, 0.3)),
    "long_words": ("word_chars / nullif(n_words, 0)", (40.0, 30.0, 20.0, 15.0)),
}
RISK = 0.02
ERROR = 0.05


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of ``window`` consecutive words that the array holds twice or
    more (the first one included).

    Windows are compared by a 64-bit hash. Only arrays with an equal pair sort (hash, place)
    pairs; the covered words are the union of the repeated windows' ranges, added up in order.
    """
    n = F.size(words)
    places = F.sequence(F.lit(1), F.greatest(n - (window - 1), F.lit(1)))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, window)))

    def covered(ranked: Column) -> Column:
        def twice(e: Column, k: Column) -> Column:
            same = lambda at: F.coalesce(F.get(ranked, at)["h"] == e["h"], F.lit(False))
            return same(k - 1) | same(k + 1)

        starts = F.array_sort(F.transform(F.filter(ranked, twice), lambda e: e["i"]))
        first = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(starts, first, lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"])

    def ranks(h: Column) -> Column:
        return F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    return F.when(n < window + 1, F.lit(0)).otherwise(_let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(ranks(h), covered))))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a transform over a one-element array)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def measured(docs: DataFrame, stratum: str | None = "lang") -> DataFrame:
    """The documents with a struct ``__f``: stratum, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_capitals (counts as long).

    Whole texts, one pass, no shuffle. NULL text counts as no words.
    """
    text = text_or_empty()
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    name = F.col(stratum).cast("string") if stratum else F.lit("")
    counts = F.struct(
        name.alias("stratum"), F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words")).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.regexp_count("__text", F.lit("[A-Z]")).cast("long").alias("n_capitals"))
    return docs.select("*", text.alias("__text"), words.alias("__words"),
                       lines.alias("__lines")).select(*docs.columns, counts.alias("__f"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def allowed_rejections(n: Column, risk: float, error: Column) -> Column:
    """The most rejections k among n clean documents for which the exact upper confidence bound of
    the rejection rate is at most ``risk``: the largest k with P(Binomial(n, risk) <= k) <= error.
    -1 if even k = 0 is too many (too few documents).

    The binomial terms are added up in logarithms, so that large n do not underflow.
    """
    q = math.log1p(-risk)
    ratio = math.log(risk) - q
    start = F.struct((n * q).alias("term"), (n * q).alias("total"), F.lit(-1).alias("k"))

    def step(acc: Column, i: Column) -> Column:
        ok = acc["total"] <= F.log(error)
        term = acc["term"] + F.log((n - i) / (i + 1)) + F.lit(ratio)
        top = F.greatest(acc["total"], term)
        total = top + F.log(F.exp(acc["total"] - top) + F.exp(term - top))
        return F.struct(F.when(ok, term).otherwise(acc["term"]).alias("term"),
                        F.when(ok, total).otherwise(acc["total"]).alias("total"),
                        F.when(ok, i.cast("int")).otherwise(acc["k"]).alias("k"))

    # beyond n * risk the distribution function exceeds one half, more than any error allowed
    steps = F.sequence(F.lit(0).cast("long"), F.ceil(n * risk))
    return F.aggregate(F.when(n > 0, steps).otherwise(F.array(F.lit(0).cast("long"))), start,
                       step, lambda acc: F.when(n > 0, acc["k"]).otherwise(-1))


def cutoffs(feats: DataFrame, labels: DataFrame, rules: Mapping = RULES, risk: float = RISK,
            error: float = ERROR) -> DataFrame:
    """The cutoff of every (stratum, rule), one column ``cut_<rule>`` each (NULL: the rule rejects
    nothing in the stratum), with n_labels and borrowed; strata without labelled clean documents
    are absent. One more row, with ``pooled``, is for all strata together.

    The holdout is every document with a label quality = 1 that passes the base rules; a doc_id
    labelled more than once counts as clean if all its labels say so. Counts are exact, over all
    labelled documents.
    """
    clean = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("__q")).where("__q = 1").select(F.col("doc_id").alias("__id"))
    held = feats.where(~base_failed()).join(clean, F.col("doc_id") == F.col("__id"), "left_semi")
    above = {(name, i): F.coalesce(F.expr(stat) > cut, F.lit(False))
             for name, (stat, cuts) in rules.items() for i, cut in enumerate(cuts)}
    # cutoffs of a rule nest: the latest of each rule rejects what its earlier ones do
    turns = sorted(above, key=lambda x: x[1])
    joint = [dict(turns[:j + 1]) for j in range(len(turns))]
    counts = [F.count_if(hit).alias(f"{name}_{i}") for (name, i), hit in above.items()]
    counts += [F.count_if(reduce(or_, [above[x] for x in latest.items()])).alias(f"__joint_{j}")
               for j, latest in enumerate(joint)]
    per = stored(held.groupBy("stratum").agg(F.count("*").alias("n"), *counts), "quality-counts")
    names = [c for c in per.columns if c != "stratum"]
    groups = (1 + per.count()) * 2
    every = per.withColumn("pooled", F.lit(False)).unionByName(per.agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in names]).select(
        F.lit(None).cast("string").alias("stratum"), *names, F.lit(True).alias("pooled")))
    out = every.withColumn("__k", allowed_rejections(
        F.col("n"), risk / len(rules), F.lit(error / groups / len(rules)))).withColumn(
        "__k_joint", allowed_rejections(F.col("n"), risk, F.lit(error / groups)))

    def accepted(columns: list[str], limit: Column) -> Column:
        """How many of the tests, in order, come before the first failure."""
        ok = F.array(*[F.col(c) <= limit for c in columns], F.lit(False))
        return (F.array_position(ok, False) - 1).cast("int")

    def numbers(joint_limit: Column, apart_limit: Column) -> list[Column]:
        return [accepted([f"__joint_{j}" for j in range(len(joint))], joint_limit).alias("joint"),
                *[accepted([f"{name}_{i}" for i in range(len(cuts))], apart_limit).alias(name)
                  for name, (_, cuts) in rules.items()]]

    # few rows: written, so that no plan repeats the bounds in every cutoff's expression
    risk_of = F.col("n") * F.lit(risk)
    out = stored(stored(out, "quality-allowed").select(
        "stratum", "pooled", F.col("n").alias("n_labels"),
        F.struct(*numbers(F.col("__k_joint"), F.col("__k"))).alias("own"),
        F.struct(*numbers(risk_of, risk_of / len(rules))).alias("unrefuted")), "quality-accepted")

    def in_all(x: str) -> Column:
        return reduce(add, [F.col(f"{x}.{name}") for name in rules], F.lit(0))

    pool = out.where("pooled").select(F.col("own").alias("pool"))  # one row
    out = out.crossJoin(F.broadcast(pool))
    borrowed = ~F.col("pooled") & (F.col("own.joint") == 0) & (in_all("own") == 0)

    def taken(field: str) -> Column:
        return F.when(borrowed, F.least(f"pool.{field}", f"unrefuted.{field}")).otherwise(
            F.col(f"own.{field}"))

    def apart(x: str) -> Column:
        return in_all(x) > F.col(f"{x}.joint")

    is_apart = F.when(borrowed, apart("pool")).otherwise(apart("own"))
    chosen = []
    for name, (_, cuts) in rules.items():
        places = [j + 1 for j, x in enumerate(turns) if x[0] == name]
        jointly = reduce(add, [(taken("joint") >= j).cast("int") for j in places], F.lit(0))
        number = F.when(is_apart, taken(name)).otherwise(jointly)
        chosen.append(F.get(F.array(*[F.lit(float(c)) for c in cuts]), number - 1)
                      .alias(f"cut_{name}"))
    return out.select("stratum", "pooled", "n_labels", borrowed.alias("borrowed"), *chosen)


def strata(feats: DataFrame, labels: DataFrame, rules: Mapping = RULES, risk: float = RISK,
           error: float = ERROR) -> DataFrame:
    """Every stratum with its number of documents (``__n``), its labelled clean ones (n_labels) and
    its cutoffs, ``borrowed`` or its own."""
    cuts = stored(cutoffs(feats, labels, rules, risk, error), "quality-cutoffs")
    sizes = feats.groupBy(F.col("stratum").alias("__s")).agg(F.count("*").alias("__n"))
    names = [f"cut_{name}" for name in rules]
    pooled = cuts.where("pooled").select(*[F.col(c).alias(f"__{c}") for c in names])  # one row
    own = sizes.join(cuts.where("not pooled").drop("pooled"),
                     F.col("__s").eqNullSafe(F.col("stratum")), "left").crossJoin(F.broadcast(pooled))
    unlabelled = F.col("n_labels").isNull()
    return stored(own.select(
        F.col("__s").alias("stratum"), "__n", F.coalesce("n_labels", F.lit(0)).alias("n_labels"),
        (unlabelled | F.col("borrowed")).alias("borrowed"),
        *[F.when(unlabelled, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in names]),
        "quality-strata")


def rejected_by(rules: Mapping = RULES) -> Column:
    """The rules whose cutoff a document exceeds; none for documents that fail the base rules."""
    hits = [F.when(F.expr(stat) > F.col(f"cut_{name}"), F.lit(name))
            for name, (stat, _) in rules.items()]
    return F.when(~base_failed(), F.filter(F.array(*hits), lambda x: x.isNotNull())).otherwise(
        F.array().cast("array<string>"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang",
          rules: Mapping = RULES, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The verdict on every document: the counts of ``measured``, base_failed, kept, rejected_by (the
    rules that reject it), and its stratum's n_labels and whether it ``borrowed`` its cutoffs.

    ``docs`` needs doc_id, text and the stratum's column, ``labels`` doc_id and quality (1: clean);
    other columns are ignored, whatever their names. NULL strata form a stratum; a stratum whose
    labels do not suffice for a cutoff borrows those of all strata together that they do not
    contradict. NULL and empty texts fail the base rules
    (no words). Rows with a repeated doc_id are judged one by one. Without documents the result is
    empty; without labels it holds the base verdicts.
    """
    needed = docs.select("doc_id", "text", *([stratum] if stratum else []))
    feats = stored(measured(needed, stratum).select("doc_id", "__f.*"), "quality-features")
    table = strata(feats, labels, rules, risk, error)
    joined = join_groups(feats, table, "stratum", "__n").drop("__n")
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "rejected_by", rejected_by(rules)).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def keep(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", rules: Mapping = RULES,
         risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns.

    The documents are written once with their counts, which decide the cutoffs and then the
    verdicts, so no text is measured twice or shuffled.
    """
    rows = stored(measured(docs, stratum), "quality-documents")
    feats = rows.select("doc_id", "__f.*")
    table = strata(feats, labels, rules, risk, error)
    cut = F.struct(*[F.col(f"cut_{name}") for name in rules])
    joined = join_groups(rows.withColumn("__stratum", F.col("__f.stratum")), table.select(
        F.col("stratum").alias("__stratum"), "__n", cut.alias("__cut")), "__stratum", "__n")
    # the verdict's expressions name plain columns: evaluate them on the structs' fields
    def field(expression: str) -> str:
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "n_lines", "n_capitals"):
            expression = re.sub(rf"\b{name}\b", f"__f.{name}", expression)
        return expression

    failed = F.expr(field(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 30 * n_words"))
    ok = F.lit(True)
    for name, (stat, _) in rules.items():
        ok = ok & ~F.coalesce(F.expr(field(stat)) > F.col(f"__cut.cut_{name}"), F.lit(False))
    return joined.where(~failed & ok).select(*docs.columns)
