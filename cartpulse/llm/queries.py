"""Registered queries of the training-data operators, and DuckDB SQL where SQL can express them.

Each query applies its operator to the whole table and derives the digest columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cartpulse.llm import (decontaminate, packing, pieces, pii, quality_rules, secrets, sharding, simhash, spelling, token_files, url_filter, warc,
                           whitening)
from cartpulse.llm.common import table


def op1_secret_scan(spark, sf):
    return secrets.scan_secrets(table(spark, sf, "documents"))


def op2_simhash(spark, sf):
    near = simhash.near_duplicates(table(spark, sf, "documents"), shingle_words=3, max_bits=3)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_decontaminate(spark, sf):
    return decontaminate.contamination_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)


def op4_pii(spark, sf):
    return pii.pii_report(table(spark, sf, "documents"))


def op5_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), buckets=16, budget=16_384)


def op6_quality_rules(spark, sf):
    return quality_rules.quality_report(table(spark, sf, "documents"))


def op7_url_filter(spark, sf):
    labels = table(spark, sf, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
    return url_filter.judge_urls(table(spark, sf, "pages"), outcomes)


def op8_token_files(spark, sf):
    return token_files.tokenize(table(spark, sf, "documents"))


def op9_warc(spark, sf):
    return warc.archive_pages(table(spark, sf, "pages"))


def op10_sharding(spark, sf):
    placed = sharding.shard_documents(table(spark, sf, "documents"), shards=40, overhead=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_whitening(spark, sf):
    rows = whitening.per_component(whitening.whiten(table(spark, sf, "embeddings"), components=32))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))  # a table so large that it is no long: NULL


def op12_spelling(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_pieces(spark, sf):
    coded = pieces.encode_pieces(table(spark, sf, "documents"), decode=True)
    return coded.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


LLM_QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_simhash, op3_decontaminate, op4_pii, op5_packing, op6_quality_rules,
                                       op7_url_filter, op8_token_files, op9_warc, op10_sharding, op11_whitening, op12_spelling, op13_pieces)}
LLM_ORACLE = {"op3_decontaminate": decontaminate.SQL, "op6_quality_rules": quality_rules.SQL, "op7_url_filter": url_filter.SQL, "op9_warc": warc.SQL}
