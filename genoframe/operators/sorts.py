"""Sorted layouts of variant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.functions.recode import chrom_ordinal


def sort_variants(variants: DataFrame, partitions: int | None = None) -> DataFrame:
    """SO-1: genome order (chromosome ordinal, position).

    Range partitioning (sampled boundaries) then a per-partition sort gives a
    globally ordered layout without a single-task sort; the output is what a
    position-sorted file set would hold, one ordered run per partition.
    """
    v = variants.withColumn("chrom_num", chrom_ordinal("chrom").cast("int"))
    n = partitions or int(variants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return v.repartitionByRange(n, "chrom_num", "pos").sortWithinPartitions("chrom_num", "pos")
