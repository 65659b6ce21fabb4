"""Small helpers on DataFrames and sessions shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.session import ensure_checkpoint_dir, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; other columns are left behind."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of a text column; sizes bucket counts so that a bucket stays the same at every scale."""
    return int(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def buckets_for(spark: SparkSession, total: int, each: int) -> int:
    return max(shuffle_partitions(spark), math.ceil(total / each), 1)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder (reliable, survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
