"""Helpers shared by the operators: table reading, stored intermediate results, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.session import ensure_checkpoint_dir

#: A word of the contracts: a run of characters that are neither blank nor ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """New path for an intermediate table below the folder the session shares."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: short lineage, known size."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words: one more than the gaps between them, without building an array of words."""
    words = F.regexp_count(text, F.lit(WORD))
    return F.coalesce(words, F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without its own columns of these names, so that the operator's may take their place."""
    lowered = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in lowered])
