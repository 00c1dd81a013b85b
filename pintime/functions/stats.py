"""Distribution-test p-values as SQL expressions (no Python in the rows).

* Kolmogorov: ``p = 2 * sum_{k=1..100} (-1)^(k-1) exp(-2 k^2 lambda^2)``, set to
  1 when lambda < 0.2 (the truncated series is wrong there), clamped to [0, 1].
* Chi-square survival ``Q(k/2, x/2)``. ``ln Gamma`` is Stirling's series, shifted by
  seven (constant time). Each series starts at its largest term's side and
  multiplies by a ratio, so its length is about the square root of the degrees of
  freedom: below the mean, and for few degrees, the ascending series of the lower
  function; above it the descending one of the upper function.

A null statistic gives a null p-value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ks_pvalue(lam: str) -> Column:
    series = (f"aggregate(sequence(1, 100), 0D, (acc, k) -> acc + 2D * power(-1D, k - 1) "
              f"* exp(-2D * k * k * ({lam}) * ({lam})))")
    return F.expr(f"CASE WHEN ({lam}) IS NULL THEN NULL WHEN ({lam}) < 0.2D THEN 1D "
                  f"ELSE least(1D, greatest(0D, {series})) END")


def ln_gamma(x: str) -> str:
    """SQL of ln Gamma(x) for x > 0."""
    y = f"(({x}) + 7D)"
    shift = " + ".join(f"ln(({x}) + {i}D)" for i in range(7))
    series = (f"1D / (12D * {y}) - 1D / (360D * power({y}, 3)) + 1D / (1260D * power({y}, 5)) "
              f"- 1D / (1680D * power({y}, 7))")
    return f"(({y} - 0.5D) * ln({y}) - {y} + 0.5D * ln(2D * pi()) + {series} - ({shift}))"


def chi2_sf(x: str, dof: str) -> Column:
    a = f"(({dof}) / 2D)"
    z = f"(({x}) / 2D)"

    def total(terms: str, ratio: str) -> str:
        """1 + r(1) + r(1) r(2) + ... with so many terms."""
        return (f"aggregate(sequence(1, CAST({terms} AS INT)), named_struct('s', 1D, 't', 1D), "
                f"(acc, n) -> named_struct('s', acc.s + acc.t * ({ratio}), "
                f"'t', acc.t * ({ratio}))).s")

    up = total(f"greatest({z} - {a}, 0D) + 12D * sqrt({z} + {a}) + 80D", f"{z} / ({a} + n)")
    down = total(f"12D * sqrt({z}) + 80D", f"({a} - n) / {z}")
    lower = f"exp({a} * ln({z}) - {z} - {ln_gamma(f'{a} + 1D')}) * {up}"
    upper = f"exp(({a} - 1D) * ln({z}) - {z} - {ln_gamma(a)}) * {down}"
    # beyond 50 standard deviations above the mean the tail is far below 1e-50
    return F.expr(f"CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) <= 0D OR ({dof}) <= 0 THEN 1D "
                  f"WHEN {z} > {a} + 50D * sqrt({a}) + 60D THEN 0D "
                  f"WHEN {a} >= 200D AND {z} >= {a} + 1D "
                  f"THEN least(1D, greatest(0D, {upper})) "
                  f"ELSE least(1D, greatest(0D, 1D - {lower})) END")


def round_p(c: Column, digits: int = 6) -> Column:
    """Round a p-value for display; values under half the last digit become exactly 0."""
    return F.when(c < F.lit(0.5 * 10 ** -digits), F.lit(0.0)).otherwise(F.round(c, digits))
