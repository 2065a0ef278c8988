"""Tail probabilities, applied to one-row results only."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _two_sided_t(t: float, df: float) -> float:
    """Regularised incomplete beta at df/(df+t^2) by numerical integration."""
    # with s = sin(angle) the density is cos^(df-1), smooth on a finite interval
    top = math.atan(abs(t) / math.sqrt(df))
    norm = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
    steps = 2000
    h = top / steps
    f = lambda a: math.cos(a) ** (df - 1)
    area = f(0) + f(top) + sum((4 if i % 2 else 2) * f(i * h) for i in range(1, steps))
    return max(0.0, 1 - 2 * norm * area * h / 3)


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda x: None if x is None or math.isnan(x) else math.erfc(abs(x) / math.sqrt(2)))


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    ok = lambda x: x is not None and not math.isnan(x)
    return pd.Series([_two_sided_t(a, b) if ok(a) and ok(b) and b > 0 else None for a, b in zip(t, df)], dtype="float64")


def kolmogorov_tail(statistic: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic p-value of the two-sample statistic; small samples have an exact one elsewhere."""
    lam = F.sqrt(n * m / (n + m)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda s, k: s + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))
