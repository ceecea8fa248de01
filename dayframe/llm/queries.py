"""The registered queries: each applies its operator, with production parameters, to a whole table
and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (codes, common, lm, mixing, neardup, pieces, pii, quality, repeats, runs, shards,
               sql, tokens, topk, warc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokens.write_ids(table(spark, sf_dir, "documents"),
                                tokenizer_path("word_bpe_49k.json"), end_id=2)
    return tokens.read_documents(manifest)


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept",
                         F.array_join("rejected_by", ",").alias("rejected_by"), "borrowed",
                         "n_labels")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"),
                         tokenizer_path("piece_bpe_32k.model")).drop("ids")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_records(warc.write_archives(table(spark, sf_dir, "pages")))
    # what was read decides: payloads are measured before they leave the reading task
    measured = records.select(
        "record_id", "type", "target_uri", "concurrent_to", "refers_to", "fields",
        F.coalesce(F.octet_length("payload").cast("long"), "payload_length").alias("payload_bytes"),
        F.when(F.col("payload").isNotNull(), F.sha1("payload")).otherwise(
            F.col("payload_digest")).alias("payload_digest"))
    found = warc.resolved(warc.captures(measured))
    return found.select("page_id", "response.payload_bytes", "response.payload_digest",
                        F.col("response.type").alias("record_type"), "refers_to",
                        F.col("request.target_uri").alias("target_uri"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(k).alias(f"n_{k}") for k in pii.KINDS]
    def rank(s):
        order = [*pii.KINDS, "generalised", "removed"]
        return F.array_position(F.array(*[F.lit(k) for k in order]), s["kind"]).cast("int")

    every = F.array_sort(F.concat("base", "terms"), lambda a, b: F.when(
        a["start"] != b["start"], a["start"] - b["start"]).otherwise(rank(a) - rank(b)))
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias(
        "base_sha256"), pii.listed(every).alias("spans"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("thash", "head")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = runs.detect(docs.select("doc_id", runs.planted(
        F.col("doc_id"), common.text_or_empty()).alias("text")))
    best = found.select("doc_id", "runs", runs.longest(F.col("runs")).alias("best"), "collapsed")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents"), window=35)


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error",
                        F.lit(codes.digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_ids": op1_token_ids,
    "op2_shards": op2_shards,
    "op3_lm_scores": op3_lm_scores,
    "op4_mix": op4_mix,
    "op5_quality": op5_quality,
    "op6_pieces": op6_pieces,
    "op7_warc": op7_warc,
    "op8_topk": op8_topk,
    "op9_pii": op9_pii,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_runs": op11_runs,
    "op12_repeats": op12_repeats,
    "op13_codes": op13_codes,
}

SQL: dict[str, str] = {
    "op7_warc": sql.OP7,
    "op8_topk": sql.OP8,
    "op10_near_duplicates": sql.OP10,
    "op12_repeats": repeats.sql(35),
    "op13_codes": codes.sql(),
}
