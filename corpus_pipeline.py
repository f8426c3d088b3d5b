"""From raw documents to packed sequences: five stages, each a table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.bagminhash import drop_near_duplicates
from feedloom.llm.common import staged, table
from feedloom.llm.mixing import mix_documents
from feedloom.llm.packing import pack_documents
from feedloom.llm.registry import tokenizer_path
from feedloom.llm.suffix_dedup import remove_repeats
from feedloom.llm.toxicity import score_texts, train_on

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model of the labelled ones."""
    model = train_on(docs, table(spark, sf_dir, "labels"))
    scored = score_texts(docs.select(*COLUMNS), model, COLUMNS)
    return scored.where(F.col("_score") < 0.5).select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest id."""
    return drop_near_duplicates(docs.select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that start twice; ``n_chars`` follows the text."""
    return remove_repeats(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their weights: a document comes as often as the mix takes it."""
    taken = mix_documents(docs, carry=COLUMNS[1:]).where("copies > 0")
    return taken.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path(), added_tokens=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("suffix_dedup", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = staged(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)


#: No stage but the joins around them can be put in SQL; tests compare run() with plain versions.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
