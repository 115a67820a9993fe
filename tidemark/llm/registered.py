"""The queries of this subpackage and the SQL that checks them, by key."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_cnn, byte_repeats, collocations, host_rules, main_text, packing, passages, periodic, pieces, rp_forest, simhash, slots, token_orc,
)
from tidemark.llm.staging import stage, stage_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digests(table(spark, sf_dir, "documents"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_cnn.classify(docs, byte_cnn.train(docs, table(spark, sf_dir, "labels")))


def op7_minimum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = stage(host_rules.judge(table(spark, sf_dir, "documents")), "host-rules")
    return host_rules.host_verdicts(judged, "source", "base_failed")


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(simhash.fingerprinted(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "token-orc")
    token_orc.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return token_orc.digests(token_orc.read_tokens(spark, path)).drop("shard")


def op10_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    return packing.with_checksums(packed).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_weighted_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_column_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeats.digests(table(spark, sf_dir, "documents"))


def op13_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_token_orc": op1_token_orc,
    "op2_pieces": op2_pieces,
    "op3_passages": op3_passages,
    "op4_rp_forest": op4_rp_forest,
    "op5_byte_cnn": op5_byte_cnn,
    "op6_simhash": op6_simhash,
    "op7_minimum_cut": op7_minimum_cut,
    "op8_host_rules": op8_host_rules,
    "op9_virtual_slots": op9_virtual_slots,
    "op10_bin_slack": op10_bin_slack,
    "op11_weighted_automata": op11_weighted_automata,
    "op12_column_suffixes": op12_column_suffixes,
    "op13_recompression": op13_recompression,
}
