"""Association analyses on sparse genotypes.

* ST-3 ``standardize``: covariate z-scores (one global aggregate, literals).
* ST-6 ``null_model``: phenotype ~ covariates per phenotype, by iterated aggregates (``nullmodel``).
* ST-4 ``glm_linear``: per-variant OLS from *sufficient statistics*.  Hom-ref
  samples never materialise: C'C, C'y, y'y are per-phenotype totals minus the
  variant's missing-call rows; g'C, g'g, g'y are sums over carrier rows.  One
  ``groupBy(pheno, v)`` aggregation, then a batched 8x8 solve per row.
* ST-5 ``glm_logistic``: per-variant logistic regression with Firth fallback, in blocks of samples and variants (``logistic``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.operators.joins import broadcast_if_small
from genoframe.plans import nullmodel as nl
from genoframe.plans import numerics as nm


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ST-3: (x - mean) / sample sd over the whole table."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                 *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()    # 2 x len(cols) numbers
    return df.withColumns({c: (F.col(c) - F.lit(row[f"m_{c}"])) / F.lit(row[f"s_{c}"]) for c in cols})


def model_frame_long(pheno_long: DataFrame, covars: DataFrame, cov_names: Sequence[str],
                     key: str = "sample_id") -> DataFrame:
    """(pheno, sample_id, y, covariates...) rows with every model input non-null."""
    mf = pheno_long.select("pheno", key, F.col("value").cast("double").alias("y")).join(
        covars.select(key, *cov_names), key)
    return mf.dropna(subset=["y", *cov_names])


def valid_phenotypes(mf: DataFrame) -> DataFrame:
    """FLT-25: phenotypes with at least two distinct values (others are skipped)."""
    return mf.groupBy("pheno").agg(F.countDistinct("y").alias("_k")).where(F.col("_k") >= 2).select("pheno")


def binary_kind(mf: DataFrame) -> DataFrame:
    """Kind per phenotype from the data: exactly the values {0, 1} -> binary."""
    k = mf.groupBy("pheno").agg(F.countDistinct("y").alias("_k"), F.min("y").alias("_lo"), F.max("y").alias("_hi"))
    return k.select("pheno", F.when((F.col("_k") == 2) & (F.col("_lo") == 0) & (F.col("_hi") == 1), "binary")
                    .otherwise("continuous").alias("kind"))


# ------------------------------------------------------------------ ST-6 null model
def null_model(mf: DataFrame, cov_names: Sequence[str], key: str = "sample_id") -> DataFrame:
    """ST-6: fit y ~ 1 + covariates per phenotype, by sums over the whole frame (see ``nullmodel``).

    Returns (pheno, sample_id, kind, mu, resid, var_w): for a continuous trait the
    residual is scaled by 1/sigma and var_w = 1; for a binary trait resid = y - mu
    and var_w = mu(1 - mu).  Score statistics G'resid then have covariance G'PG
    with P built from v, with no further division by sigma^2. A phenotype whose model cannot be fitted
    gives one row with nulls.
    """
    cov = list(cov_names)
    mf = nl.prepared(mf.select("pheno", key, "y", *cov))
    return nl.null_frame(mf, nl.fit_null(mf, cov), cov, [key])


# ------------------------------------------------------------------ ST-4 linear, sufficient statistics
def _pairs(k: int):
    return [(a, b) for a in range(k) for b in range(a, k)]


def linear_sufficient_stats(genotypes: DataFrame, mf: DataFrame, cov_names: Sequence[str],
                            key: str = "sample_id", vkey: str = "v") -> tuple[DataFrame, DataFrame]:
    """Per-phenotype totals and per-(pheno, variant) carrier / missing-row sums."""
    cov = list(cov_names)
    cols = ["_one"] + cov                      # design columns except the genotype
    mfx = mf.withColumn("_one", F.lit(1.0))
    k = len(cols)
    tot = mfx.groupBy("pheno").agg(
        *[F.sum(F.col(cols[a]) * F.col(cols[b])).alias(f"T_{a}_{b}") for a, b in _pairs(k)],
        *[F.sum(F.col(c) * F.col("y")).alias(f"Ty_{i}") for i, c in enumerate(cols)],
        F.sum(F.col("y") * F.col("y")).alias("Tyy"))
    side = broadcast_if_small(mfx.select("pheno", key, "y", *cols))
    j = genotypes.select(vkey, key, "dosage").join(side, key)
    g = F.col("dosage").cast("double")
    miss = F.col("dosage").isNull()

    def m(c):
        return F.sum(F.when(miss, c).otherwise(F.lit(0.0)))

    per = j.groupBy("pheno", vkey).agg(
        F.sum(g).alias("Sg"), F.sum(g * g).alias("Sgg"), F.sum(g * F.col("y")).alias("Sgy"),
        *[F.sum(g * F.col(c)).alias(f"Sgc_{i}") for i, c in enumerate(cols)],
        *[m(F.col(cols[a]) * F.col(cols[b])).alias(f"M_{a}_{b}") for a, b in _pairs(k)],
        *[m(F.col(c) * F.col("y")).alias(f"My_{i}") for i, c in enumerate(cols)],
        m(F.col("y") * F.col("y")).alias("Myy"))
    return tot, per


def glm_linear(genotypes: DataFrame, mf: DataFrame, cov_names: Sequence[str],
               key: str = "sample_id", vkey: str = "v") -> DataFrame:
    """ST-4: y ~ 1 + g + covariates per (phenotype, variant); the genotype (ALT dosage) row only.

    Samples with a missing call for the variant are left out of that variant's fit.
    Output: pheno, v, n, beta, se, t_stat, p.
    """
    cov = list(cov_names)
    k = len(cov) + 1
    tot, per = linear_sufficient_stats(genotypes, mf, cov, key, vkey)
    rows = per.join(F.broadcast(tot), "pheno")
    pairs = _pairs(k)

    def solve(it):
        for pdf in it:
            b = len(pdf)
            if b == 0:
                continue
            A = np.zeros((b, k + 1, k + 1))
            for a, c in pairs:
                val = pdf[f"T_{a}_{c}"].to_numpy(float) - pdf[f"M_{a}_{c}"].to_numpy(float)
                A[:, a, c] = A[:, c, a] = val
            for i in range(k):
                A[:, i, k] = A[:, k, i] = pdf[f"Sgc_{i}"].to_numpy(float)
            A[:, k, k] = pdf["Sgg"].to_numpy(float)
            rhs = np.zeros((b, k + 1))
            for i in range(k):
                rhs[:, i] = pdf[f"Ty_{i}"].to_numpy(float) - pdf[f"My_{i}"].to_numpy(float)
            rhs[:, k] = pdf["Sgy"].to_numpy(float)
            yy = pdf["Tyy"].to_numpy(float) - pdf["Myy"].to_numpy(float)
            n = A[:, 0, 0]
            beta = np.full(b, np.nan)
            se = np.full(b, np.nan)
            # batched inverse; rank-deficient rows (a monomorphic site, a genotype the covariates explain) stay NaN
            good = nm.full_rank(A)
            if good.any():
                inv = np.linalg.inv(A[good])
                coef = np.einsum("bij,bj->bi", inv, rhs[good])
                rss = yy[good] - np.einsum("bi,bi->b", coef, rhs[good])
                df = n[good] - (k + 1)
                v_kk = inv[:, k, k]
                ok = (df > 0) & np.isfinite(v_kk) & (v_kk > 0)
                bb = np.where(ok, coef[:, k], np.nan)
                ss = np.where(ok, np.sqrt(np.maximum(rss, 0.0) / np.where(df > 0, df, 1) * np.abs(v_kk)), np.nan)
                beta[good], se[good] = bb, ss
            t = beta / se
            p = nm.t_two_sided_p_vec(t, n - (k + 1))
            yield pd.DataFrame({"pheno": pdf["pheno"], vkey: pdf[vkey], "n": n.astype("int64"),
                                "beta": beta, "se": se, "t_stat": t, "p": p})

    schema = f"pheno string, {vkey} bigint, n bigint, beta double, se double, t_stat double, p double"
    return rows.mapInPandas(solve, schema)


# ------------------------------------------------------------------ ST-5 logistic + Firth
def glm_logistic(genotypes: DataFrame, mf: DataFrame, cov_names: Sequence[str],
                 key: str = "sample_id", vkey: str = "v") -> DataFrame:
    """ST-5: logistic regression per (binary phenotype, variant) with Firth fallback (see ``logistic``).

    Phenotypes that are not 0/1 and variants without variation among a phenotype's samples give no row.
    Output: pheno, v, n, firth, beta (log OR), or, se, z_stat, p.
    """
    from genoframe.plans.logistic import fit_blocks
    return fit_blocks(genotypes, mf, cov_names, key, vkey)
