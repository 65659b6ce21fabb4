"""Writers: TSV, chromosome-partitioned Parquet, id lists, compute-or-load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.functions.recode import chrom_ordinal


def write_tsv(df: DataFrame, path: str, null: str = "NA") -> str:
    """SNK-1: tab-separated with header, NULL written as 'NA' (one part file per task)."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", null) \
        .option("emptyValue", "").csv(path)
    return path


def write_partitioned(df: DataFrame, path: str, col: str = "chrom", pos: str = "pos") -> str:
    """SNK-3: one folder per chromosome.

    Rows are range-partitioned on (chromosome ordinal, position) first, so a large
    chromosome is written by several tasks instead of one.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumn("_cn", chrom_ordinal(col))
    order = ["_cn", pos] if pos in df.columns else ["_cn"]
    (d.repartitionByRange(n, *order).sortWithinPartitions(col, *order[1:]).drop("_cn")
     .write.mode("overwrite").partitionBy(col).parquet(path))
    return path


def write_ids(df: DataFrame, path: str, col: str = "sample_id") -> str:
    """SNK-4: one id per line, no header."""
    df.select(F.col(col).cast("string")).write.mode("overwrite").text(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS"))


def cached(spark: SparkSession, path: str, thunk: Callable[[], DataFrame]) -> DataFrame:
    """SNK-5: load a materialised result if present, else compute, write and re-read it.

    The written table also cuts the lineage of an expensive computation.
    """
    if not path_exists(spark, path):
        thunk().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
