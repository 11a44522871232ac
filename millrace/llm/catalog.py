"""The subpackage's queries, each with production parameters on its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from public_tokenizers import path as tokenizer_path

from millrace.llm import blockjoin, collocations, decontam, fmindex, langid, mixing, oracles, quality, repair, sharding, simhash, urls, warc, whitening
from millrace.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op6_entropy_mix": oracles.MIX, "op11_bwt_collocations": oracles.COLLOCATIONS, "op12_block_matrix_join": oracles.NEAREST}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


@query
def op3_pigeonhole_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


@query
def op6_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("copies", "rate", "source")


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(documents(spark, sf_dir)).drop("row_number")


@query
def op2_rank_order_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


@query
def op9_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(documents(spark, sf_dir, "pages")).drop("url", "payload_crc32")


@query
def op10_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(documents(spark, sf_dir, "pages"))


@query
def op4_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.encoded(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


@query
def op5_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.deduplicated(documents(spark, sf_dir)).drop("kept_text")


@query
def op11_bwt_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir)).drop("lefts", "rights")


@query
def op12_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockjoin.nearest(documents(spark, sf_dir, "embeddings"))


@query
def op13_rank_one_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(documents(spark, sf_dir, "embeddings"))
