"""The corpus pipeline: five stages, each over all that the one before has kept.

Each stage is (spark, docs, sf_dir) -> DataFrame. ``run`` writes every stage's result to
the shared folder as Parquet and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farthing.llm import contamination, minhash, mixing, token_files, toxicity
from farthing.llm.common import stored, table
from farthing.llm.queries import TOXIC_AT, held_out, tokenizer


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity models reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity.without_toxic(docs, model, TOXIC_AT)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group of ``op8``: five words, Jaccard 0.85."""
    dropped = minhash.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(stored(dropped, "dropped"), "doc_id", "left_anti").select(*docs.columns)


def without_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that repeat benchmark passages."""
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents, whole and repeated, until every source meets its target."""
    return mixing.mixed(docs).drop("mix_shard")


def token_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the ids of all drawn documents to coded files, and read them back."""
    files, book = token_files.write(docs, tokenizer())
    return token_files.read(files, book).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_contaminated),
    ("mixing", mixed_sources),
    ("token_ids", token_rows),
]

#: Models, random draws and the tokenizer are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
