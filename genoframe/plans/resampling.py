"""ST-9: set tests of 0/1 traits by case assignments among a set's carriers.

Where few samples carry a set's alleles the chi-square mixtures behind the asymptotic p-values do not hold. Only
carriers move the scores, so the null distribution is that of their case states: independent, each with its fitted
probability mu. Up to ``EXACT_CARRIERS`` carriers all 2**c states are listed with their probabilities; up to
``SAMPLED_CARRIERS`` ``RESAMPLES`` states are drawn (by a seed that the caller derives from the set); above that the asymptotic p stands.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

EXACT_CARRIERS, SAMPLED_CARRIERS, RESAMPLES = 12, 60, 20_000
#: Scores held at a time.
BLOCK = 1 << 20


def assignments(mu: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Case states of carriers (states x carriers) and their probabilities."""
    c = len(mu)
    if c <= EXACT_CARRIERS:
        y = ((np.arange(1 << c)[:, None] >> np.arange(c)) & 1).astype(float)
        return y, np.exp(y @ np.log(mu) + (1 - y) @ np.log1p(-mu))
    y = (np.random.default_rng(seed).random((RESAMPLES, c)) < mu).astype(float)
    return y, np.full(RESAMPLES, 1.0 / (RESAMPLES + 1))


def _tail(q: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """P(Q >= q) of every state; values equal but for rounding are ties."""
    step = 1e-9 * max(float(np.abs(q).max(initial=0.0)), 1e-300)
    level, which = np.unique(np.round(q / step), return_inverse=True)
    mass = np.bincount(which, weights=weight, minlength=len(level))
    return np.cumsum(mass[::-1])[::-1][which]


def _statistics(off: np.ndarray, G: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of squared scores and squared sum of every state, a block of states at a time: scores are states by variants."""
    skat, burden = np.empty(len(off)), np.empty(len(off))
    step = max(1, BLOCK // max(1, G.shape[1]))
    for at in range(0, len(off), step):
        S = (off[at: at + step] @ G) * weight
        skat[at: at + step], burden[at: at + step] = (S * S).sum(axis=1), S.sum(axis=1) ** 2
    return skat, burden


def resampled_p(G: np.ndarray, weight: np.ndarray, mu: np.ndarray, y: np.ndarray, method: str, rhos: Sequence[float],
                seed: int = 0) -> float | None:
    """p-value of a set from its carriers: coded genotypes ``G`` (carriers x variants), variant weights, fitted and observed case
    states; ``None`` where there are too many carriers.

    ``method``: ``SKAT`` (sum of squared scores), ``burden`` (squared sum) or ``SKATO``: each mixture rho of the two gets its tail
    probability from the same states, and the least of them its own distribution over the states.
    """
    if not 0 < len(mu) <= SAMPLED_CARRIERS or not ((mu > 0) & (mu < 1)).all():
        return None
    states, prob = assignments(mu, seed)
    exact = len(mu) <= EXACT_CARRIERS
    # the observed state comes last; among drawn states it counts as one of them
    states = np.vstack([states, y])
    prob = np.append(prob, 0.0 if exact else prob[0])
    skat, burden = _statistics(states - mu, G, weight)
    if method == "SKAT":
        return min(1.0, float(_tail(skat, prob)[-1]))
    if method == "burden":
        return min(1.0, float(_tail(burden, prob)[-1]))
    least = np.min([_tail((1 - r) * skat + r * burden, prob) for r in rhos], axis=0)
    return min(1.0, float(prob[least <= least[-1] * (1 + 1e-9)].sum()))
