"""Corpus pipeline: the training-data stages in order, each over all its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that the caller writes as Parquet and rereads as the next one's ``docs``. All but the last return
the columns of ``documents``.

toxicity       documents scored 0.5 or more go
near_dedup     one document of each near-duplicate group (0.8 on sets of five-word shingles) stays
decontaminate  documents that hold a benchmark item go
mix            documents are repeated to the target weights of their sources and shuffled
shard          every row gets a shard and a slot (uniform shuffle, exact shard sizes)

Every stage carries extra columns along, and gives an empty result for empty documents. Null, empty and
very long texts: toxicity scores them (no text: the score of a text without windows), near_dedup keeps all
rows without words, decontaminate keeps what matches nothing, mix gives them size 0, shard size 1. Rows with
a null id pass every stage as rows of their own. Repeated rows: one stays of those with words (near_dedup);
where extra columns differ, any one of them. Ties: the smallest id, then the smallest row hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portstar.llm import decontamination, mixing, near_dedup, sharding, toxicity
from portstar.llm.common import stored, table

N_SHARDS = 8
TOXIC_FROM = 0.5
STAGE_SHINGLE = 5          # words of a shingle in near_dedup, the rule for stages without a contract


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC_FROM).select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, words=STAGE_SHINGLE)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shuffle_into_shards(docs, N_SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("mix", mix_sources),
    ("shard", shard),
]

# A fitted classifier, MinHash and random draws are not expressible in SQL; the pipeline is tested
# stage by stage against brute-force versions (tests/llm/test_pipeline_stages.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written below spark.checkpoint.dir."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
