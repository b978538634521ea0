"""p-values of the two-sample Kolmogorov-Smirnov statistic, for one result row per feature."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.session import carry_to_workers

carry_to_workers(__name__)

def series_p(d: Column, n: Column, m: Column, terms: int = 8) -> Column:
    """The limiting distribution at ``x = d * sqrt(nm/(n+m))``.

    It has two series: ``2 * sum((-1)^(k-1) * exp(-2 k^2 x^2))``, quick for large ``x``, and
    ``1 - sqrt(2 pi)/x * sum(exp(-(2k-1)^2 pi^2 / (8 x^2)))``, quick for small ``x``. Each is used on its side of 1, where
    the terms left out are below 1e-30.
    """
    x = d * F.sqrt(n.cast("double") * m / (n + m))

    def total(term) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda acc, k: acc + term(k))

    far = 2 * total(lambda k: F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x))
    inner = total(lambda k: F.exp(-F.pow(2 * k - 1, F.lit(2)) * (math.pi**2 / 8) / (x * x)))
    near = 1.0 - F.try_divide(F.lit(math.sqrt(2 * math.pi)), x) * inner
    p = F.when(d == 0, F.lit(1.0)).when(x < 1, near).otherwise(far)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))


def exact_p_value(d: float, n: int, m: int) -> float:
    """P(D >= d) from the lattice paths that stay strictly inside the band around the diagonal.

    A path merges the two samples; at (i, j) it has taken i and j of them. Let stay(i, j) be the chance that a random
    path to (i, j) never left the band. Its last step came from (i-1, j) with chance i/(i+j), else from (i, j-1), so
    one diagonal i+j gives the next, and all numbers stay between 0 and 1.
    """
    if d <= 0:
        return 1.0
    n, m = int(n), int(m)
    limit = (0.5 + np.floor(d * n * m - 1e-7)) / (n * m)  # between two possible values of the statistic
    took = np.arange(n + 1)
    stay = np.zeros(n + 2)  # shifted by one: stay[i + 1] belongs to i
    stay[1] = 1.0
    for step in range(1, n + m + 1):
        low = max(0, step - m, int((step / m - limit) / (1 / n + 1 / m)) - 1)
        high = min(n, step, int((step / m + limit) / (1 / n + 1 / m)) + 1)
        i = took[low : high + 1]
        inside = np.abs(i / n - (step - i) / m) <= limit
        moved = (stay[low : high + 1] * i + stay[low + 1 : high + 2] * (step - i)) / step
        stay[:] = 0.0
        stay[low + 1 : high + 2] = moved * inside
    return float(min(1.0, max(0.0, 1.0 - stay[n + 1])))


@F.pandas_udf(T.DoubleType())
def exact_p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """NULL where a sample is empty."""
    there = (n > 0) & (m > 0) & d.notna()
    return pd.Series([exact_p_value(*row) if ok else None for ok, *row in zip(there, d, n, m)], dtype="float64")
