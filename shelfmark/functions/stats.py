"""Statistical column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Coefficients of the rational approximation of erf (Abramowitz and Stegun
# 7.1.26), highest power last.
_ERF_P = 0.3275911
_ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(x: Column) -> Column:
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_ERF_P) * F.abs(x))
    series = F.lit(_ERF_A[-1])
    for a in reversed(_ERF_A[:-1]):
        series = series * t + F.lit(a)
    value = F.lit(1.0) - series * t * F.exp(-x * x)
    return F.when(x < 0, -value).otherwise(value)


def normal_cdf(x: Column) -> Column:
    return F.lit(0.5) * (F.lit(1.0) + erf(x / F.lit(math.sqrt(2.0))))
