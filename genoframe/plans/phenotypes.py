"""Sample-level phenotype tables: PLINK-style coding, covariates, output schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.functions.recode import recode, sex_code

# Phenotype label -> 1 (control) / 2 (case) per derived trait.
PSAM_CODES = {
    "ALS": ("pheno", {"CONTROL": 1, "ALS": 2}),
    "MS": ("pheno", {"CONTROL": 1, "MS": 2}),
    "ALS_MS": ("pheno", {"CONTROL": 1, ("ALS", "MS"): 2}),
    "ALS_UMN": ("als_pheno", {("ALS-S", "ALS-B", "ALS-R", "PLS"): 2, "PMA": 1}),
    "ALS_LMN": ("als_pheno", {("ALS-S", "ALS-B", "ALS-R", "PMA"): 2, "PLS": 1}),
    "ALS_RESTRICTED": ("als_pheno", {("ALS-S", "ALS-B", "ALS-R"): 1, ("PBP", "FAS", "FLS"): 2}),
    "ALS_DFS_SP": ("dfs_pc", {"SP": 2, ("NP", "FP"): 1}),
    "ALS_DFS_FP": ("dfs_pc", {("SP", "NP"): 1, "FP": 2}),
    "ALS_D50_SP": ("d50_pc", {"SP": 2, ("NP", "FP"): 1}),
    "ALS_D50_FP": ("d50_pc", {("SP", "NP"): 1, "FP": 2}),
    "MS_SP": ("ms_pheno", {("RR", "PP"): 1, "SP": 2}),
    "MS_PP": ("ms_pheno", {("RR", "SP"): 1, "PP": 2}),
}


def make_psam(samples: DataFrame, continuous: dict[str, str] | None = None,
              id_col: str = "sample_id") -> DataFrame:
    """PRJ-19: 1/2 case-control coding of every derived trait (row-local recodes)."""
    continuous = continuous if continuous is not None else {"ALS_ONSET": "quant"}
    cols = [F.col(id_col), sex_code("sex").alias("SEX")]
    cols += [recode(src, m).alias(name) for name, (src, m) in PSAM_CODES.items()]
    cols += [F.round(F.col(src), 6).alias(name) for name, src in continuous.items()]
    return samples.select(*cols)


def covariates(samples: DataFrame, pcs: DataFrame, n_pc: int = 10, id_col: str = "sample_id",
               pc_id: str = "sample_id") -> DataFrame:
    """PRJ-24: IID, SEX (M=1, F=2, else 0), PC1..PCk for samples present in both tables."""
    p = pcs.withColumnRenamed(pc_id, "_iid")
    j = samples.select(F.col(id_col).alias("_iid"), "sex").join(p, "_iid")
    return j.select(F.col("_iid").alias("IID"), sex_code("sex", 0).alias("SEX"),
                    *[F.col(f"PC{i}") for i in range(1, n_pc + 1)])


def long_phenotypes(psam: DataFrame, id_col: str = "sample_id") -> DataFrame:
    """Wide phenotype table -> (sample_id, pheno, value, kind) for one-job association.

    Kind is derived from the data: a trait coded only with 1/2 is binary.
    """
    traits = [c for c in psam.columns if c not in (id_col, "SEX")]
    long = psam.unpivot([id_col], traits, "pheno", "value").withColumn("value", F.col("value").cast("double"))
    return long.where(F.col("value").isNotNull())


def output_schema(df: DataFrame, mapping: dict[str, object]) -> DataFrame:
    """PRJ-3: transmute into an output schema (name -> source column or expression)."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])
