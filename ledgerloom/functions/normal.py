"""Numeric helper behind phi_k: the correlation of a binned bivariate normal."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

PHIK_SCHEMA = "feature string, chi2 double, phik double"
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(24)


def _normal_quantile(p: float) -> float:
    """Inverse of the standard normal distribution by bisection on erf."""
    if p <= 0 or p >= 1:
        return math.copysign(8.5, p - 0.5)
    low, high = -8.5, 8.5
    for _ in range(80):
        mid = (low + high) / 2
        if 0.5 * math.erfc(-mid / math.sqrt(2)) < p:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def _joint_cdf(a: np.ndarray, b: np.ndarray, rho: float) -> np.ndarray:
    """P(X <= a, Y <= b): independence plus the integral of the density over rho."""
    x, y = np.meshgrid(a, b, indexing="ij")
    base = np.outer([0.5 * math.erfc(-v / math.sqrt(2)) for v in a], [0.5 * math.erfc(-v / math.sqrt(2)) for v in b])
    theta = math.asin(rho)
    total = np.zeros_like(base)
    for node, weight in zip(_NODES, _WEIGHTS):
        s = math.sin(theta * (node + 1) / 2)
        total += weight * np.exp(-(x * x + y * y - 2 * s * x * y) / (2 * (1 - s * s)))
    return base + theta / 2 * total / (2 * math.pi)


def _chi2_of_rho(rho: float, rows: np.ndarray, cols: np.ndarray) -> float:
    """Chi-square per row of data that correlation ``rho`` gives on these margins."""
    a = np.array([-8.5, *[_normal_quantile(p) for p in np.cumsum(rows)[:-1]], 8.5])
    b = np.array([-8.5, *[_normal_quantile(p) for p in np.cumsum(cols)[:-1]], 8.5])
    cdf = _joint_cdf(a, b, rho)
    cells = cdf[1:, 1:] - cdf[:-1, 1:] - cdf[1:, :-1] + cdf[:-1, :-1]
    expected = np.outer(rows, cols)
    return float(((cells - expected) ** 2 / expected).sum())


def phik_of_table(table: np.ndarray) -> tuple[float, float]:
    """(chi2, phi_k) of a contingency table, with the noise pedestal removed."""
    table = table[table.sum(axis=1) > 0][:, table.sum(axis=0) > 0]
    total = table.sum()
    if min(table.shape) < 2:
        return 0.0, 0.0
    rows, cols = table.sum(axis=1) / total, table.sum(axis=0) / total
    expected = np.outer(rows, cols) * total
    chi2 = float(((table - expected) ** 2 / expected).sum())
    degrees = (table.shape[0] - 1) * (table.shape[1] - 1)
    empty = int((table == 0).sum())
    pedestal = degrees - empty
    if chi2 <= pedestal:
        return chi2, 0.0
    top = total * (min(table.shape) - 1)
    full = _chi2_of_rho(0.999999, rows, cols)
    scale = (top - pedestal) / full if full > 0 else total
    scale = scale if scale > 0 else total
    target = chi2 - pedestal
    low, high = 0.0, 0.999999
    for _ in range(60):
        mid = (low + high) / 2
        if _chi2_of_rho(mid, rows, cols) * scale < target:
            low = mid
        else:
            high = mid
    return chi2, (low + high) / 2


def phik_of_cells(pdf: pd.DataFrame) -> pd.DataFrame:
    table = pdf.pivot_table(index="bin", columns="class", values="n", fill_value=0.0, aggfunc="sum").to_numpy(float)
    chi2, value = phik_of_table(table)
    return pd.DataFrame({"feature": [pdf["feature"].iloc[0]], "chi2": [chi2], "phik": [value]})
