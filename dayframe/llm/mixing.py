"""Mixing sources to target weights with a low-discrepancy schedule.

Every source's documents are shuffled and laid end to end, and the stream of words is cut into
blocks of equal size (to a word). Large sources share one block size; smaller sources have blocks
small enough that their size and their target hold at least ``BLOCKS``, or a word. A schedule of
slots takes one block each: the points of the golden-ratio sequence, mapped through the sources'
cumulative shares of all slots, say from which source, and the slot's rank among that source's
slots says which block (starting over after the last). Any stretch of the schedule is close to the
target shares in words. Every source ends with the slots that its target asks for, rounded: the
sequence is off by a few, which are left out or added behind it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_groups, running_total, stored, text_or_empty, words_of

# The points' numerators are n * GOLDEN modulo POINT_RANGE: 2**32 divided by the golden ratio.
GOLDEN = 2654435769
POINT_RANGE = 1 << 32
# Points and cumulative shares meet in this many equal cells (an equi-join).
CELL_BITS = 12
SLOTS = 1 << 18
BLOCKS = 64


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0,
                   max_repeats: int = 3) -> DataFrame:
    """Words to take from each source.

    ``sizes``: (source, n_rows, source_size), one row a source. The sources in code-point order,
    NULL last, get ``weights`` in turn and share ``share`` of all words by weight. No target
    exceeds ``max_repeats`` times its source's size; the excess goes to the others by weight
    until none is above. Adds ``source_no`` (from 0), ``weight``, ``target`` and ``target_before``
    (the targets of earlier sources). Without words every target is 0.

    Works on one row per source: in the order of size/weight, a source is capped if its cap is at
    most what the weights give it once all earlier ones are capped.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (number % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("source_no", number.cast("long")).withColumn("weight", weight)
         .withColumn("__cap", F.col("source_size") * max_repeats)
         .withColumn("__ratio", F.col("__cap") / F.col("weight")))
    by_ratio = Window.orderBy("__ratio", "source_no")
    caps = F.coalesce(F.sum("__cap").over(
        by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heavier = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    goal = F.sum("source_size").over(everything) * share
    s = s.withColumn("__level", (goal - caps) / heavier)
    s = s.withColumn("__capped", F.col("__ratio") <= F.col("__level"))
    level = F.max(F.when(~F.col("__capped"), F.col("__level"))).over(everything)
    s = s.withColumn("target", F.when(F.col("__capped"), F.col("__cap").cast("double"))
                     .otherwise(F.col("weight") * level))
    before = F.coalesce(F.sum("target").over(Window.orderBy("source_no").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0.0))
    return s.withColumn("target_before", before).drop("__cap", "__ratio", "__level", "__capped")


def with_blocks(targets: DataFrame, block: int) -> DataFrame:
    """Adds ``n_blocks`` of each source, of ``block`` words at most, the slots its target asks for
    (``wanted``, a fraction) and those of earlier sources (``wanted_before``).

    Block b of n holds the words from floor(b * size / n) on, so none is part-filled.
    """
    size = F.col("source_size")
    own = F.floor(F.least(size, F.col("target")) / BLOCKS)
    words = F.greatest(F.lit(1).cast("long"), F.least(F.lit(block).cast("long"), own))
    t = targets.withColumn("n_blocks", F.ceil(size / words))
    t = t.withColumn("wanted", F.when(size > 0, F.col("target") * F.col("n_blocks") / size)
                     .otherwise(0.0))
    return t.withColumn("wanted_before", F.coalesce(F.sum("wanted").over(Window.orderBy(
        "source_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))


def schedule(targets: DataFrame, n_slots: int, goal: float) -> DataFrame:
    """The slots (slot, source_no, rank): ``rank`` counts the slots of the source from 0.

    ``targets`` has each source's share of ``goal`` in target and those before it in target_before.
    """
    spark = targets.sparkSession
    bits = min(32, max(CELL_BITS, targets.count().bit_length()))
    scale = POINT_RANGE / goal if goal > 0 else 0.0
    edge = lambda c: F.floor(c * scale).cast("long")
    spans = (targets.select("source_no", edge(F.col("target_before")).alias("lo"),
                            edge(F.col("target_before") + F.col("target")).alias("hi"))
             .where("hi > lo"))
    shift = 32 - bits
    spans = spans.select("source_no", "lo", "hi", F.explode(F.sequence(
        F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))).alias("cell"))
    points = (spark.range(n_slots).withColumnRenamed("id", "slot")
              .withColumn("point", F.col("slot") * GOLDEN % POINT_RANGE)
              .withColumn("cell", F.shiftright("point", shift)))
    hits = points.join(spans, "cell").where("point >= lo and point < hi").select(
        "slot", "source_no", F.floor(F.col("slot") / 1024).alias("__chunk"))
    return running_total(hits, ["source_no"], "__chunk", [F.col("slot")], F.lit(1),
                         "rank").drop("__chunk")


def shuffle_key(seed: str = "mix"):
    """What orders a source's documents: a digest of ``seed``, doc_id and text."""
    return F.md5(F.concat_ws("/", F.col("doc_id").cast("string"), F.md5(text_or_empty()),
                             F.lit(seed)))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0,
        max_repeats: int = 3, n_slots: int = SLOTS, seed: str = "mix") -> DataFrame:
    """What the mix takes of each document.

    ``docs`` needs doc_id, text and source; other columns are ignored, whatever their names. Row by
    row returns doc_id, size (words of the text; NULL text: 0), source, source_size, target,
    taken (words taken, repeats counted, at most ``max_repeats`` times the size), key (see
    ``shuffle_key``) and copies (``taken / size`` rounded to the nearest whole number, 0 for a
    text without words).

    Rows with equal doc_id and text are separate documents (their order among each other does not
    matter); NULL doc_id is an ordinary value; NULL is a source of its own, the last one. An empty
    table gives an empty result. The shuffle is the order of an MD5 digest of ``seed``, doc_id and
    text, so reruns agree. A block has at most ceil(words / n_slots) words, and fewer in
    sources whose size or target has less than ``BLOCKS`` such blocks. Every source's words taken
    are within half a block and a word of its target.
    """
    rows = stored(docs.select(
        F.col("doc_id"), F.col("source"),
        F.size(words_of(text_or_empty())).cast("long").alias("size"),
        shuffle_key(seed).alias("key")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.count("*").alias("n_rows"),
                                       F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, max_repeats), "mix-targets")
    t = targets.agg(F.sum("source_size").alias("words"), F.sum("n_rows").alias("n")).first()
    words, n = t["words"] or 0, t["n"] or 0
    block = max(1, math.ceil(words / n_slots))
    plan = stored(with_blocks(targets, block), "mix-blocks")
    buckets = max(1, math.isqrt(n))
    # the leading 32 bits of the digest choose the bucket, so buckets follow the digest's order
    placed = join_groups(rows, plan.select("source", "n_rows", "source_size", "source_no", "target",
                                           "n_blocks"), "source", "n_rows")
    placed = placed.withColumn("__bucket", F.floor(
        F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / POINT_RANGE))
    placed = stored(running_total(
        placed, ["source_no"], "__bucket", [F.col("key"), F.col("size"), F.col("doc_id")],
        F.col("size"), "start").drop("__bucket", "n_rows"), "mix-places")

    wanted = plan.agg(F.sum("wanted")).first()[0] or 0.0
    few = plan.select("source_no", "n_blocks", F.floor(F.col("wanted") + 0.5).alias("n_slots"))
    slots = stored(schedule(plan.select(
        "source_no", F.col("wanted").alias("target"), F.col("wanted_before").alias("target_before")),
        math.ceil(wanted), wanted).select("source_no", "rank"), "mix-slots")
    got = F.coalesce("got", F.lit(0).cast("long"))
    late = few.join(slots.groupBy("source_no").agg(F.count("*").alias("got")), "source_no", "left") \
        .where(F.col("n_slots") > got).select("source_no", F.explode(F.sequence(
            got, F.col("n_slots") - 1)).alias("rank"))
    uses = (slots.unionByName(late).join(few, "source_no").where("rank < n_slots")
            .groupBy("source_no", (F.col("rank") % F.col("n_blocks")).alias("block"))
            .agg(F.count("*").alias("uses")))
    # the block of a word, and the word that a block begins with
    block_of = lambda w: F.expr(f"(({w}) * n_blocks + n_blocks - 1) div source_size")
    begin = lambda b: F.expr(f"({b}) * source_size div n_blocks")
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(
        block_of("start"), block_of("start + size - 1"))))
    part = (F.least(F.col("start") + F.col("size"), begin("block + 1"))
            - F.greatest(F.col("start"), begin("block")))
    taken = (pieces.withColumn("part", part).join(uses, ["source_no", "block"], "left")
             .groupBy(*placed.columns)
             .agg(F.sum(F.col("part") * F.coalesce("uses", F.lit(0))).alias("taken")))
    none = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    out = taken.unionByName(none)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    return out.select("doc_id", "size", "source", "source_size", "target", "taken", "key",
                      copies.cast("int").alias("copies"))


def repeated(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The documents with all their columns, each as often as ``copies`` of ``mix`` says.

    Rows equal in doc_id, text and source share the copies out among them, in the order of a hash
    of all their columns, so that reruns agree.
    """
    got = mix(docs, seed=seed, **options)
    taken = stored(got.groupBy(F.col("key").alias("__key"), F.col("source").alias("__source"))
                   .agg(F.sort_array(F.collect_list("copies")).alias("__copies")), "mix-copies")
    on = (F.col("__h") == F.col("__key")) & F.col("source").eqNullSafe(F.col("__source"))
    rows = docs.withColumn("__h", shuffle_key(seed)).join(taken, on)
    if taken.where(F.size("__copies") > 1).limit(1).count():
        number = F.row_number().over(Window.partitionBy("__h", "__source").orderBy(
            F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in docs.columns])))))
        times = F.element_at("__copies", number)
    else:
        times = F.element_at("__copies", 1)
    out = rows.withColumn("__times", times).where("__times > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return out.select(*docs.columns)
