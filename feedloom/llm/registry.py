"""Queries of this folder with production parameters, and SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import oracles
from feedloom.llm.bagminhash import near_classes
from feedloom.llm.common import table
from feedloom.llm.license_scan import scan_licenses
from feedloom.llm.license_texts import LICENSE_TEXTS
from feedloom.llm.line_dedup import line_digest
from feedloom.llm.mixing import mix_documents
from feedloom.llm.neighbours import nearest
from feedloom.llm.packing import pack_documents
from feedloom.llm.prefix_trie import prefix_trie, shared_head
from feedloom.llm.sharding import shard_documents
from feedloom.llm.structure_repair import damaged, repair_report
from feedloom.llm.subspace_join import near_embeddings
from feedloom.llm.suffix_dedup import removal_digest
from feedloom.llm.toxicity import toxicity
from feedloom.llm.url_filter import filter_urls, labelled_urls

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), LICENSE_TEXTS)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digest(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, URL_RULES, labelled_urls(pages, URL_RULES))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_classes(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest"))
    return classes.select("doc_id", "class_id", kept.alias("kept"))


def op6_subspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), added_tokens=True)


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_documents(table(spark, sf_dir, "documents"))
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors["vec_id"] % 50 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv_id = F.col("conv_id")
    return prefix_trie(table(spark, sf_dir, "conversations"), shared_head(conv_id), conv_id - conv_id % 20, most=3)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(table(spark, sf_dir, "documents"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(conversations, damaged(conversations))


_ALL = (
    op1_licenses,
    op2_suffix_dedup,
    op3_url_filter,
    op4_mix_sources,
    op5_bagminhash,
    op6_subspace,
    op7_toxicity,
    op8_pack,
    op9_shard,
    op10_neighbours,
    op11_prefix_trie,
    op12_line_dedup,
    op13_structure_repair,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES: dict[str, str] = {
    "op11_prefix_trie": oracles.PREFIX_TRIE,
    "op12_line_dedup": oracles.LINE_DEDUP,
    "op13_structure_repair": oracles.STRUCTURE_REPAIR,
}
