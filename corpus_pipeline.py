"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.llm import decontamination, mixing, sharding, simhash, toxicity
from lakejobs.llm.common import stored, table
from lakejobs.session import ship_package

#: Five-word shingles and a similarity of 0.8 for the near-duplicate stage.
SHINGLE, SIMILARITY = 5, 0.8
SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; null and empty texts stay."""
    ship_package(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    ship_package(spark)
    return simhash.keep_one(docs, shingle=SHINGLE, scheme=simhash.similar(SIMILARITY))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document is there as many times as the mix takes it.

    Texts of mostly letters have the higher quality weight.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}\x20\n]", "")) / F.greatest(F.length(text), F.lit(1))
    mixed = mixing.mix(docs, weight=F.lit(0.25) + letters)
    taken = mixed.where(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix with its shard and its slot in the shuffled shard."""
    ship_package(spark)
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]
#: Model scores and fingerprints are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
