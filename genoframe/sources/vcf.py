"""VCF text as DataFrames: a distributed reader and writer.

``read_vcf`` scans any number of (optionally gzipped) VCF files with
``spark.read.text``: data lines are split on tabs, sample columns are
``posexplode``d and named from the ``#CHROM`` header of the same file (or the
one header of the folder when data and header live in separate files, as
``write_vcf`` lays them out).  Genotypes come out sparse: hom-ref calls are
dropped, missing calls are kept with a NULL dosage.  Gzip members are not
splittable, so parallelism is one task per compressed file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.functions.recode import chrom_ordinal, dosage

CORE = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info"]


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def _dir(c):
    return F.regexp_replace(c, "/[^/]*$", "")


def _headers(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    hdr = lines.where(F.col("value").startswith("#CHROM")).select(
        F.col("file").alias("_hfile"), F.split("value", "\t").alias("_hcols"))
    by_dir = (hdr.groupBy(_dir(F.col("_hfile")).alias("_hdir"))
              .agg(F.count(F.lit(1)).alias("_nh"), F.first("_hcols").alias("_dcols"))
              .where(F.col("_nh") == 1).drop("_nh"))
    return hdr, by_dir


def _fields(lines: DataFrame) -> DataFrame:
    body = lines.where(~F.col("value").startswith("#") & (F.length("value") > 0))
    f = F.split("value", "\t")
    return body.select(
        "file", f.alias("_f"),
        F.get(f, 0).alias("chrom"), F.get(f, 1).cast("bigint").alias("pos"), F.get(f, 2).alias("id"),
        F.get(f, 3).alias("ref"), F.get(f, 4).alias("alt"), F.get(f, 5).try_cast("double").alias("qual"),
        F.get(f, 6).alias("filter"),
        F.when(F.get(f, 7).isin(".", ""), F.create_map().cast("map<string,string>"))
         .otherwise(F.str_to_map(F.get(f, 7), F.lit(";"), F.lit("="))).alias("info"))


def read_vcf(spark: SparkSession, path, sample_from_path: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC-1: (variants, genotypes) from VCF text files.

    variants : chrom, pos, id, ref, alt, qual, filter, info MAP<STRING,STRING>
    genotypes: chrom, pos, ref, alt, sample_id, gt, dosage (non-ref and missing calls only)
    """
    lines = _lines(spark, path)
    rows = _fields(lines)
    variants = rows.select(*CORE)

    hdr, by_dir = _headers(lines)
    g = (rows.where(F.size("_f") > 9)
         .join(F.broadcast(hdr), F.col("file") == F.col("_hfile"), "left")
         .join(F.broadcast(by_dir), _dir(F.col("file")) == F.col("_hdir"), "left")
         .withColumn("_hcols", F.coalesce("_hcols", "_dcols")))
    fmt = F.split(F.get(F.col("_f"), 8), ":")
    g = g.select("file", "chrom", "pos", "ref", "alt", "_hcols",
                 F.array_position(fmt, "GT").alias("_gti"),
                 F.posexplode(F.slice("_f", 10, 1 << 30)).alias("_i", "_sf"))
    sample = (with_sample_from_path_col("file") if sample_from_path
              else F.get(F.col("_hcols"), F.col("_i") + 9))
    gt = F.when(F.col("_gti") > 0, F.get(F.split("_sf", ":"), (F.col("_gti") - 1).cast("int")))
    g = g.select("chrom", "pos", "ref", "alt", sample.alias("sample_id"), gt.alias("gt"))
    g = g.withColumn("dosage", dosage("gt"))
    genotypes = g.where(F.col("dosage").isNull() | (F.col("dosage") > 0))
    return variants, genotypes


def with_sample_from_path_col(file_col: str = "file"):
    """SRC-10: sample name captured from a file path ('.../<sample>.vcf[.gz]' or '.../sample=<x>/...')."""
    f = F.col(file_col)
    part = F.regexp_extract(f, r"sample=([^/]+)/", 1)
    base = F.regexp_extract(f, r"([^/]+?)\.vcf(\.gz|\.bgz)?$", 1)
    return F.when(part != "", part).otherwise(base)


def with_sample_from_path(df: DataFrame, out: str = "sample_id") -> DataFrame:
    """SRC-10 on any file-based DataFrame (uses the hidden ``_metadata`` column)."""
    return df.withColumn(out, with_sample_from_path_col("_metadata.file_path"))


def read_sites(spark: SparkSession, path, fields: list[str], names: list[str]) -> DataFrame:
    """SRC-11: sites-only VCF with INFO/ID/FILTER fields projected and renamed.

    A record gives one row per ALT allele; a field that the header declares with one value
    per allele (Number=A) or per allele and reference (Number=R) gives that allele's own value.
    """
    per = info_numbers(spark, path, fields)
    v = _fields(_lines(spark, path)).select("*", F.posexplode(F.split("alt", ",")).alias("_i", "_alt"))
    cols = []
    for f, n in zip(fields, names):
        src = {"ID": F.col("id"), "FILTER": F.col("filter"), "QUAL": F.col("qual")}.get(f, F.col("info")[f])
        if per.get(f) in ("A", "R"):
            src = F.get(F.split(src, ","), F.col("_i") + (1 if per[f] == "R" else 0))
        cols.append(src.alias(n))
    return v.select("chrom", "pos", "ref", F.col("_alt").alias("alt"), *cols)


def info_numbers(spark: SparkSession, path, fields: list[str]) -> dict[str, str]:
    """Number of the given INFO fields, from the header lines (at most one value per field is collected)."""
    head = spark.read.text(path).where(F.col("value").startswith("##INFO=<"))
    ident, number = (F.regexp_extract("value", rf"[<,]{k}=([^,>]+)", 1) for k in ("ID", "Number"))
    rows = head.select(ident.alias("f"), number.alias("n")).where(F.col("f").isin(list(fields))).groupBy("f").agg(F.max("n").alias("n")).collect()
    return {r["f"]: r["n"] for r in rows}


def _gt_text(d):
    return (F.when(d.isNull(), F.lit("./.")).when(d == 1, F.lit("0/1")).when(d == 2, F.lit("1/1"))
            .otherwise(F.lit("0/0")))


def vcf_lines(variants: DataFrame, genotypes: DataFrame, sample_ids: list[str],
              key: str = "v", sample: str = "sample_id") -> DataFrame:
    """SNK-2 core: one text line per variant, genotype columns in ``sample_ids`` order.

    Each variant's calls are gathered into a map (at most one entry per
    sample, i.e. bounded by the cohort size); absent samples are hom-ref.
    """
    spark = genotypes.sparkSession
    index = spark.createDataFrame([(s, i) for i, s in enumerate(sample_ids)], f"{sample} string, _si int")
    from genoframe.operators.joins import broadcast_if_small
    calls = (genotypes.join(broadcast_if_small(index), sample)
             .select(key, "_si", _gt_text(F.col("dosage")).alias("_gt"))
             .groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_si", "_gt"))).alias("_calls")))
    n = len(sample_ids)
    j = variants.join(calls, key, "left")
    gts = F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                      lambda i: F.coalesce(F.col("_calls")[i], F.lit("0/0")))
    info = F.coalesce(F.col("info_text"), F.lit(".")) if "info_text" in variants.columns else F.lit(".")
    line = F.concat_ws("\t", F.col("chrom"), F.col("pos").cast("string"),
                       F.coalesce(F.col("id"), F.lit(".")) if "id" in variants.columns else F.lit("."),
                       F.col("ref"), F.col("alt"), F.lit("."), F.col("filter"), info, F.lit("GT"),
                       F.array_join(gts, "\t"))
    return j.select(chrom_ordinal("chrom").alias("_cn"), F.col("pos").alias("_pos"), line.alias("value"))


def header_lines(sample_ids: list[str]) -> list[str]:
    return ["##fileformat=VCFv4.2",
            '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
            "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *sample_ids])]


def write_vcf(spark: SparkSession, variants: DataFrame, genotypes: DataFrame, path: str,
              samples: DataFrame, key: str = "v", sample: str = "sample_id") -> str:
    """SNK-2: multi-sample VCF text: data parts in genome order plus one header file.

    Sample names come from the (bounded) sample table, sorted by id.
    """
    ids = sorted(r[0] for r in samples.select(sample).distinct().collect())
    lines = vcf_lines(variants, genotypes, ids, key, sample)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame([(x,) for x in header_lines(ids)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    (lines.repartitionByRange(n, "_cn", "_pos").sortWithinPartitions("_cn", "_pos")
     .select("value").write.mode("append").text(path))
    return path


def write_vcf_per_sample(variants: DataFrame, genotypes: DataFrame, path: str, key: str = "v",
                         sample: str = "sample_id") -> str:
    """One VCF per sample (``<path>/sample=<id>/part-*.txt``), each starting with its header.

    Header and data rows are ordered inside each sample's partition, so every
    file is self-describing, as per-sample call files are.
    """
    d = genotypes.where(F.col("dosage").isNull() | (F.col("dosage") > 0)).join(
        variants.select(key, "chrom", "pos", "ref", "alt", "filter"), key)
    data = d.select(F.col(sample).alias("sample"), F.lit(2).alias("_h"), chrom_ordinal("chrom").alias("_cn"),
                    F.col("pos").alias("_pos"),
                    F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."),
                                "filter", F.lit("."), F.lit("GT"), _gt_text(F.col("dosage"))).alias("value"))
    return write_lines_per_sample(data, genotypes.select(F.col(sample).alias("sample")).distinct(), path)


def write_lines_per_sample(data: DataFrame, names: DataFrame, path: str) -> str:
    """Record lines (sample, _h = 2, _cn, _pos, value) as one folder of text a sample, each with a header."""
    hdr = names.select("sample", F.lit(1).alias("_h"), F.lit(0).alias("_cn"), F.lit(0).cast("bigint").alias("_pos"),
                       F.concat_ws("\t", F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"),
                                   F.col("sample")).alias("value"))
    meta = names.select("sample", F.lit(0).alias("_h"), F.lit(0).alias("_cn"), F.lit(0).cast("bigint").alias("_pos"),
                        F.lit("##fileformat=VCFv4.2").alias("value"))
    allr = data.unionByName(hdr).unionByName(meta)
    n = int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range partitioning splits a very large sample over several files; files after
    # the first take the header of their folder when read back
    (allr.repartitionByRange(n, "sample", "_h", "_cn", "_pos").sortWithinPartitions("sample", "_h", "_cn", "_pos")
     .select("sample", "value").write.mode("overwrite").partitionBy("sample").text(path))
    return path
