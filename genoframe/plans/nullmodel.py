"""ST-6: null models fitted by iterated aggregates.

No task ever holds a cohort: a pass over the model frame sums, per phenotype, the score X'(y - mu) and the information
X'WX (one ``groupBy`` with map-side partial sums); the driver, which sees only k + k(k+1)/2 numbers a phenotype, takes
the Newton step and sends the coefficients back as constants of the next pass. Where the plain logistic fit
fails or a coefficient runs away the phenotype goes on with Firth's penalty, two passes a step.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.plans import numerics as nm
from genoframe.session import ensure_checkpoint_dir

MAX_PASSES = 25
FIRTH_PASSES = 100
TOL = 1e-8
RUNAWAY = 15.0


@dataclass
class NullFit:
    """Coefficients of one phenotype's model; ``ok`` is false where none could be fitted."""
    kind: str
    n: int
    beta: np.ndarray
    info: np.ndarray
    ok: bool = False
    firth: bool = False
    sigma2: float = 1.0
    passes: int = 0
    done: bool = False
    inverse: np.ndarray | None = field(default=None, repr=False)


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(k) for b in range(a, k)]


def _symmetric(row, name: str, k: int) -> np.ndarray:
    out = np.zeros((k, k))
    for a, b in _pairs(k):
        out[a, b] = out[b, a] = row[f"{name}_{a}_{b}"]
    return out


def _dot(coef: str, cols: Sequence[Column]) -> Column:
    return sum((F.col(f"{coef}_{i}") * c for i, c in enumerate(cols)), F.lit(0.0))


def design_columns(cov_names: Sequence[str]) -> list[Column]:
    return [F.lit(1.0), *[F.col(c) for c in cov_names]]


def _with_state(mf: DataFrame, fits: dict[str, NullFit], k: int) -> DataFrame:
    """The rows of the phenotypes in ``fits`` with their kind, coefficients b_i and residual variance, as constant maps
    by phenotype (a few numbers each): no join."""
    if not fits:
        return mf.where(F.lit(False)).select(*mf.columns, F.lit("").alias("kind"), F.lit(1.0).alias("sigma2"), *[F.lit(0.0).alias(f"b_{i}") for i in range(k)])
    numbers = F.create_map(*[x for ph, f in fits.items() for x in (F.lit(ph), F.array(*[F.lit(float(x)) for x in (f.sigma2, *f.beta)]))])
    kinds = F.create_map(*[F.lit(x) for ph, f in fits.items() for x in (ph, f.kind)])
    d = mf.where(F.col("pheno").isin(*fits)).withColumn("_s", numbers[F.col("pheno")])
    return d.select(*mf.columns, kinds[F.col("pheno")].alias("kind"), F.col("_s")[0].alias("sigma2"), *[F.col("_s")[1 + i].alias(f"b_{i}") for i in range(k)])


def linear_predictor(cov_names: Sequence[str]) -> Column:
    return _dot("b", design_columns(cov_names))


def _mean(kind: Column, eta: Column) -> Column:
    clipped = F.greatest(F.least(eta, F.lit(30.0)), F.lit(-30.0))
    return F.when(kind == "binary", 1.0 / (1.0 + F.exp(-clipped))).otherwise(eta)


def _sums(mf: DataFrame, fits: dict[str, NullFit], cov_names: Sequence[str], what: str) -> dict[str, tuple[np.ndarray, np.ndarray, float]]:
    """Per phenotype of ``fits``: X'r, X'WX and r'Wr over all samples. ``what``: ``start`` (r = y, W = 1), ``linear`` (r = y - X beta, W = 1)
    or ``logistic`` (r = y - mu, with Firth's addition where it holds, W = mu (1 - mu)). Every Arrow batch gives one row of
    partial sums a phenotype, added up by ``groupBy``."""
    cov = list(cov_names)
    k = len(cov) + 1
    pairs = _pairs(k)
    cols = [*[f"s_{a}" for a in range(k)], *[f"i_{a}_{b}" for a, b in pairs], "rr"]
    model = {ph: (f.beta, f.inverse if f.firth else None) for ph, f in fits.items()}

    def partial(batches):
        for rb in batches:
            ph, y = rb.column(0).dictionary_encode(), np.asarray(rb.column(1))
            code = np.asarray(ph.indices)
            X = np.column_stack([np.ones(rb.num_rows), *(np.asarray(rb.column(2 + i)) for i in range(k - 1))])
            out: list[list] = []
            for c, name in enumerate(ph.dictionary.to_pylist()):
                rows = np.flatnonzero(code == c)
                if name not in model:
                    continue
                beta, inv = model[name]
                x, r, w = X[rows], y[rows], np.ones(len(rows))
                if what == "linear":
                    r = r - x @ beta
                elif what == "logistic":
                    mu = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
                    r, w = r - mu, mu * (1 - mu)
                    if inv is not None:
                        r = r + w * np.einsum("ni,ij,nj->n", x, inv, x) * (0.5 - mu)
                info = x.T @ (x * w[:, None])
                out.append([name, *(r @ x).tolist(), *(float(info[i, j]) for i, j in pairs), float(w @ (r * r))])
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), *(pa.array([o[1 + i] for o in out], pa.float64()) for i in range(len(cols)))],
                                             ["pheno", *cols])

    rows = (mf.select("pheno", F.col("y").cast("double"), *[F.col(c).cast("double") for c in cov])
            .mapInArrow(partial, "pheno string, " + ", ".join(f"{c} double" for c in cols)).groupBy("pheno").agg(*[F.sum(c).alias(c) for c in cols]).collect())
    return {r["pheno"]: (np.array([r[f"s_{a}"] for a in range(k)]), _symmetric(r, "i", k), r["rr"]) for r in rows}


def _newton(f: NullFit, score: np.ndarray, info: np.ndarray) -> None:
    """One pass of a phenotype. A plain fit that fails starts again with the penalty, a penalised one that fails is given up.

    A penalised step takes two passes: the first gives the information at the present coefficients, the second the
    score with the leverages that come from it."""
    f.passes += 1
    failed = not nm.full_rank(info[None])[0]
    if not failed and f.firth and f.inverse is None:
        f.inverse = np.linalg.inv(info)
    elif not failed:
        step = np.linalg.solve(info, score)
        most = float(np.max(np.abs(step)))
        if f.firth and most > 5:
            step *= 5 / most
        f.beta, f.info, f.inverse = f.beta + step, info, None
        if most < TOL:
            f.done = f.ok = f.firth or bool(np.all(np.abs(f.beta) < RUNAWAY))
            failed = not f.ok
    if failed or (not f.done and f.passes >= (FIRTH_PASSES if f.firth else MAX_PASSES)):
        if f.firth:
            f.done = True
        else:
            f.firth, f.passes, f.beta, f.inverse = True, 0, np.zeros_like(f.beta), None


def fit_null(mf: DataFrame, cov_names: Sequence[str]) -> dict[str, NullFit]:
    """Fit y ~ 1 + covariates for every phenotype with at least two values.

    ``mf`` = (pheno, key, y, covariates); it is read once per pass, so hand in a checkpointed frame. Phenotypes whose
    values are exactly 0 and 1 get logistic fits, all together in every pass; the others are solved from one pass.
    """
    k = len(cov_names) + 1
    y = F.col("y")
    # one row a phenotype: those with one value are left out, those of 0 and 1 alone are binary
    fits = {r["pheno"]: NullFit("binary" if r["kinds"] == 2 and (r["lo"], r["hi"]) == (0.0, 1.0) else "continuous", r["n"], np.zeros(k), np.zeros((k, k)))
            for r in sorted(mf.groupBy("pheno").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(y).alias("kinds"), F.min(y).alias("lo"), F.max(y).alias("hi"))
                            .where("kinds >= 2").collect(), key=lambda r: r["pheno"])}
    linear = {ph: f for ph, f in fits.items() if f.kind == "continuous"}
    if linear:
        start = _sums(mf, linear, cov_names, "start")
        for ph, f in linear.items():
            xy, f.info, _ = start[ph]
            f.done = True
            if f.n > k and nm.full_rank(f.info[None])[0]:
                f.beta, f.ok = np.linalg.solve(f.info, xy), True
    solved = {ph: f for ph, f in linear.items() if f.ok}
    if solved:
        # the residual sum of squares from residuals, and one refinement of the coefficients from their score
        for ph, (score, _, rss) in _sums(mf, solved, cov_names, "linear").items():
            f = fits[ph]
            step = np.linalg.solve(f.info, score)
            f.beta = f.beta + step
            f.sigma2 = max(rss - float(score @ step), 0.0) / (f.n - k)
            f.ok = f.sigma2 > 0
    while open_ := {ph: f for ph, f in fits.items() if not f.done}:
        for ph, (score, info, _) in _sums(mf, open_, cov_names, "logistic").items():
            _newton(open_[ph], score, info)
    return fits


def null_frame(mf: DataFrame, fits: dict[str, NullFit], cov_names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``pheno, keep..., kind, mu, resid, var_w`` of every sample of the fitted phenotypes, and a row with nulls
    for each phenotype whose model failed.

    For a continuous trait the residual is divided by sigma and var_w = 1; for a binary one resid = y - mu and var_w = mu (1 - mu).
    """
    good = {ph: f for ph, f in fits.items() if f.ok}
    k = len(cov_names) + 1
    binary = F.col("kind") == "binary"
    d = (_with_state(mf, good, k).withColumn("mu", _mean(F.col("kind"), linear_predictor(cov_names)))
         .select("pheno", *keep, "kind", "mu", F.when(binary, F.col("y") - F.col("mu")).otherwise((F.col("y") - F.col("mu")) / F.sqrt("sigma2")).alias("resid"),
                 F.when(binary, F.col("mu") * (1 - F.col("mu"))).otherwise(F.lit(1.0)).alias("var_w")))
    failed = [(ph, f.kind) for ph, f in fits.items() if not f.ok]
    if not failed:
        return d
    return d.unionByName(mf.sparkSession.createDataFrame(failed, "pheno string, kind string"), allowMissingColumns=True)


def score_equations(mf: DataFrame, fits: dict[str, NullFit], cov_names: Sequence[str]) -> DataFrame:
    """``pheno, term, n, sum_y, sum_mu, score``: the sums X'(y - mu), which a maximum of the likelihood makes zero.

    Penalised and failed fits are left out: their scores are not zero by design."""
    plain = {ph: f for ph, f in fits.items() if f.ok and not f.firth}
    x = design_columns(cov_names)
    d = (_with_state(mf, plain, len(x)).withColumn("mu", _mean(F.col("kind"), linear_predictor(cov_names))))
    sums = d.groupBy("pheno").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sum_y"), F.sum("mu").alias("sum_mu"),
                                  *[F.sum((F.col("y") - F.col("mu")) * c).alias(name) for c, name in zip(x, ["(intercept)", *cov_names])])
    return sums.unpivot(["pheno", "n", "sum_y", "sum_mu"], ["(intercept)", *cov_names], "term", "score")


def prepared(mf: DataFrame) -> DataFrame:
    """The model frame written once to the checkpoint folder; every pass reads it."""
    ensure_checkpoint_dir(mf.sparkSession)
    return mf.checkpoint()
