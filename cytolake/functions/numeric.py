"""Column expressions that Spark lacks, with the text of their DuckDB twins."""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Chebyshev fit of erfc (public numerical-methods formula, relative error 1.2e-7), highest degree first.
ERFC = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)


def erfc(z: Column) -> Column:
    """Complementary error function of z >= 0."""
    t = 1 / (1 + 0.5 * z)
    poly = F.lit(ERFC[0])
    for c in ERFC[1:]:
        poly = poly * t + F.lit(c)
    return t * F.exp(-z * z + poly)


def two_sided(z: Column) -> Column:
    """Two-sided normal tail of a z score."""
    return F.least(F.lit(1.0), erfc(F.abs(z) / math.sqrt(2)))


def erfc_sql(z: str) -> str:
    t = f"(1 / (1 + 0.5 * {z}))"
    poly = str(ERFC[0])
    for c in ERFC[1:]:
        poly = f"({poly} * {t} + ({c}))"
    return f"({t} * exp(-({z}) * ({z}) + {poly}))"


def two_sided_sql(z: str) -> str:
    return f"least(1.0, {erfc_sql(f'(abs({z}) / {math.sqrt(2)!r}::DOUBLE)')})"


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("ns")


def digitize(x: Column, cuts: list) -> Column:
    """1 + the number of cuts at or below x."""
    out = F.lit(1)
    for c in cuts:
        out = out + F.when(x >= c, 1).otherwise(0)
    return out


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Half-even rounded percentage, 0 where the whole is 0."""
    return F.coalesce(F.bround(F.try_divide(part * 100.0, whole), digits), F.lit(0.0))


def cyt(a: Column, b: Column) -> Column:
    """Geometric mean of two values, negative ones as 0."""
    return F.sqrt(F.greatest(a, F.lit(0.0)) * F.greatest(b, F.lit(0.0)))


def neg_log10(p: Column, floor: float = 1e-300) -> Column:
    return -F.log10(F.greatest(p, F.lit(floor)))


def log2_ratio(a: Column, b: Column, pseudo: float = 1.0) -> Column:
    return F.log2((a + pseudo) / (b + pseudo))


def norm2(*parts: Column) -> Column:
    out = parts[0] * parts[0]
    for p in parts[1:]:
        out = out + p * p
    return F.sqrt(out)


def natural_key(label: Column) -> tuple[Column, Column]:
    """Sort keys that put numeric labels in numeric order, before the others."""
    return label.try_cast("int").asc_nulls_last(), label.asc()


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def gtf_attribute(attributes: Column, key: str) -> Column:
    """The first quoted value of the first attribute that starts with the key; null if there is none."""
    return F.nullif(F.regexp_extract(attributes, rf'(?:^|;)\s*{key}[^;"]*"([^"]*)"', 1), F.lit(""))


def has_skip(cigar: Column) -> Column:
    """Does a CIGAR string skip reference bases (operation N)?"""
    return F.coalesce(F.contains(cigar, F.lit("N")), F.lit(False))


def _beta_tail(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_tail(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    c, d, f, tiny = 1.0, 0.0, 1.0, 1e-300
    for i in range(400):
        m = i // 2
        if i == 0:
            n = 1.0
        elif i % 2 == 0:
            n = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            n = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + n * d or tiny)
        c = 1 + n / (c or tiny)
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1)


def student_two_sided(t: float, df: float) -> float:
    if t != t or df != df or df <= 0:
        return float("nan")
    return _beta_tail(df / (df + t * t), df / 2, 0.5)


def chi2_tail(x: float, df: float) -> float:
    """Upper tail, by the series or the continued fraction of the incomplete gamma function."""
    a, x = df / 2, x / 2
    if x <= 0:
        return 1.0
    head = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * head)
    b, c = x + 1 - a, 1e300
    d = h = 1 / b
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return head * h


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided Student tail; for result-sized tables."""
    return pd.Series([student_two_sided(a, b) if a == a and b == b and a is not None else np.nan for a, b in zip(t, df, strict=True)], dtype=float)


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    """Upper chi-square tail; for result-sized tables."""
    return pd.Series([chi2_tail(a, b) if a == a else np.nan for a, b in zip(x, df, strict=True)], dtype=float)


def exact_mann_whitney(n1: int, n2: int) -> list[float]:
    """Two-sided exact p of each U = 0..n1*n2 for untied samples."""
    ways = np.zeros(n1 * n2 + 1)
    table = {}

    def count(a: int, b: int) -> np.ndarray:
        if (a, b) not in table:
            out = np.zeros(a * b + 1)
            if a == 0 or b == 0:
                out[0] = 1
            else:
                x, y = count(a - 1, b), count(a, b - 1)
                out[b : b + len(x)] += x
                out[: len(y)] += y
            table[a, b] = out
        return table[a, b]

    ways = count(n1, n2) / math.comb(n1 + n2, n1)
    lower = np.cumsum(ways)
    upper = np.cumsum(ways[::-1])[::-1]
    return np.minimum(1, 2 * np.minimum(lower, upper)).tolist()


def version_parts(version):
    """The numbers of a version text, as array<int>."""
    return F.transform(F.regexp_extract_all(version, F.lit(r"([0-9]+)"), 1), lambda x: x.cast("int"))


def version_at_least(version, least: str):
    """Is a version as high as another, missing numbers being 0? null without numbers."""
    want = F.array(*[F.lit(int(x)) for x in re.findall(r"[0-9]+", least)])
    have = version_parts(version)
    n = F.greatest(F.size(have), F.size(want))
    padded = lambda a: F.concat(a, F.array_repeat(F.lit(0), n - F.size(a)))
    return F.when(F.size(have) > 0, padded(have) >= padded(want))
