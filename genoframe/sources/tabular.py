"""Delimited-text and table sources (registries, sample sheets, score shards)."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.operators.columns import normalize_names, registry_name


def read_tsv(spark: SparkSession, path, schema=None, header: bool = True, null: str = "NA") -> DataFrame:
    """SRC-2 / SRC-3: tab-separated text; ``schema`` gives names (and types) when there is no header."""
    r = spark.read.option("sep", "\t").option("header", header).option("nullValue", null)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_ids(spark: SparkSession, path, col: str = "sample_id") -> DataFrame:
    """SRC-4: one id per line."""
    return spark.read.text(path).select(F.col("value").alias(col)).where(F.col(col) != "")


def read_registry_tsv(spark: SparkSession, path, nulls=("", "?"), encoding: str = "UTF-16",
                      schema=None) -> DataFrame:
    """SRC-5: registry export: UTF-16 TSV, several null tokens, registry-style names.

    Read as text (no type guessing from a sample of rows); callers cast with the
    safe casts of ``functions.recode``.
    """
    r = (spark.read.option("sep", "\t").option("header", True).option("encoding", encoding)
         .option("multiLine", True))
    if schema is not None:
        r = r.schema(schema)
    df = normalize_names(r.csv(path), registry_name)
    toks = [t for t in nulls]
    return df.withColumns({c: F.when(~F.col(c).isin(toks), F.col(c)) for c, t in df.dtypes if t == "string"})


def read_csv(spark: SparkSession, path, cols: dict[str, str], header: bool = True) -> DataFrame:
    """SRC-6: CSV with a projection and renames ({source: alias}); pruned at the scan."""
    df = spark.read.option("header", header).csv(path)
    return df.select(*[F.col(f"`{c}`").alias(a) for c, a in cols.items()])


def read_table(spark: SparkSession, source: str, name: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """SRC-7: a named table of a relational source: JDBC when ``fmt='jdbc'``, else files
    ``<source>/<name>`` in ``fmt`` (or a catalog table when ``source`` is empty)."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(url=source, dbtable=name, **(options or {})).load()
    if not source:
        return spark.table(name)
    return spark.read.format(fmt).options(**(options or {})).load(f"{source.rstrip('/')}/{name}")


def read_sheet_export(spark: SparkSession, path: str, skip: int = 0, names: list[str] | None = None,
                      sep: str = ",") -> DataFrame:
    """SRC-8: a worksheet exported as text: drop ``skip`` leading lines, then header (or ``names``).

    An ingest row number ``_row`` (file order, taken at the scan, before any
    shuffle) is kept so that order-dependent fills can use it.
    """
    lines = spark.read.text(path).withColumn("_row", F.monotonically_increasing_id())
    if skip:
        cut = [r[0] for r in lines.orderBy("_row").limit(skip).select("_row").collect()]
        lines = lines.where(~F.col("_row").isin(cut))
    if names is None:
        first = lines.orderBy("_row").first()
        names = next(csv.reader([first["value"]], delimiter=sep))
        lines = lines.where(F.col("_row") != first["_row"])
    # quoted fields may hold the separator
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    got = F.from_csv("value", schema, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return lines.select(got.alias("r"), "_row").select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)], "_row")


def read_ws(spark: SparkSession, path, names: list[str]) -> DataFrame:
    """SRC-9: headerless whitespace-separated table."""
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "") \
        .select(*[F.get(f, i).alias(n) for i, n in enumerate(names)])


def read_sharded_scores(spark: SparkSession, paths, sep: str = "\t") -> DataFrame:
    """SRC-12: per-chromosome score files, each with its own '#chr' header line, as one table.

    One multi-path read: each file's first line is its header, so repeated
    headers never become rows.
    """
    df = spark.read.option("sep", sep).option("header", True).csv(paths)
    return df.toDF(*[c.lstrip("#") for c in df.columns])
