"""Tail probabilities for test statistics (chi-square, Student t) as column expressions.

Spark SQL has no distribution functions.  The regularized incomplete gamma and beta functions are written with ``aggregate``
over a sequence of steps: a power series where it converges fast, a continued fraction elsewhere.  The number of steps follows the
parameters (both need about the square root of the larger one).  A null, NaN or impossible argument gives null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of the Lanczos approximation of the gamma function (g = 7, nine terms).
LANCZOS_G = 7.0
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
_TINY = 1e-300


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0."""
    z = x - 1
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        series = series + F.lit(c) / (z + i)
    t = z + F.lit(LANCZOS_G + 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(series)


def _steps(largest: Column) -> Column:
    """Step numbers 1..n, enough for parameters up to ``largest``."""
    return F.sequence(F.lit(1), (F.lit(60) + F.ceil(12 * F.sqrt(largest))).cast("int"))


def _bounded(x: Column) -> Column:
    """Away from zero, as a divisor."""
    return F.when(F.abs(x) < _TINY, F.lit(_TINY)).otherwise(x)


def _state(**fields: Column) -> Column:
    return F.struct(*[c.cast("double").alias(k) for k, c in fields.items()])


def gamma_q(a: Column, x: Column) -> Column:
    """Regularized upper incomplete gamma function Q(a, x), for a > 0 and x > 0."""
    front = F.exp(a * F.log(x) - x - log_gamma(a))

    def grow(s, i):
        term = s["term"] * x / (a + i)
        return _state(term=term, total=s["total"] + term)

    series = F.aggregate(_steps(a), _state(term=1 / a, total=1 / a), grow, lambda s: s["total"])

    def lentz(s, i):
        an = i * (a - i)
        b = s["b"] + 2
        d = 1 / _bounded(an * s["d"] + b)
        c = _bounded(b + an / s["c"])
        return _state(b=b, c=c, d=d, h=s["h"] * d * c)

    b0 = _bounded(x + 1 - a)
    fraction = F.aggregate(_steps(a), _state(b=x + 1 - a, c=F.lit(1 / _TINY), d=1 / b0, h=1 / b0), lentz, lambda s: s["h"])
    return F.greatest(F.lit(0.0), F.when(x < a + 1, 1 - series * front).otherwise(fraction * front))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function."""
    def lentz(s, i):
        even = i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i))
        d = 1 / _bounded(1 + even * s["d"])
        c = _bounded(1 + even / s["c"])
        odd = -(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1))
        d2 = 1 / _bounded(1 + odd * d)
        c2 = _bounded(1 + odd / c)
        return _state(c=c2, d=d2, h=s["h"] * d * c * d2 * c2)

    d0 = 1 / _bounded(1 - (a + b) * x / (a + 1))
    return F.aggregate(_steps(F.greatest(a, b)), _state(c=F.lit(1.0), d=d0, h=d0), lentz, lambda s: s["h"])


def beta_inc(a: Column, b: Column, x: Column, rest: Column) -> Column:
    """Regularized incomplete beta function I_x(a, b) for 0 < x < 1; ``rest`` is 1 - x, given apart so that nothing is lost near 1."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(rest))
    return (F.when(x < (a + 1) / (a + b + 2), front * _beta_fraction(a, b, x) / a)
            .otherwise(1 - front * _beta_fraction(b, a, rest) / b))


def _real(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def chi2_pvalue(stat: Column, dof: Column) -> Column:
    """P(X >= stat) for a chi-square variable with ``dof`` degrees of freedom."""
    stat, dof = stat.cast("double"), dof.cast("double")
    return (F.when(~_real(stat) | ~_real(dof) | (dof <= 0) | (stat < 0), F.lit(None).cast("double"))
            .when(stat == 0, F.lit(1.0)).when(stat == F.lit(float("inf")), F.lit(0.0))
            .otherwise(gamma_q(dof / 2, stat / 2)))


def t_pvalue(t: Column, df: Column) -> Column:
    """Two-sided p-value of a Student t statistic."""
    t, df = t.cast("double"), df.cast("double")
    square = t * t
    return (F.when(~_real(t) | ~_real(df) | (df <= 0), F.lit(None).cast("double"))
            .when(t == 0, F.lit(1.0)).when(square == F.lit(float("inf")), F.lit(0.0))
            .otherwise(beta_inc(df / 2, F.lit(0.5), df / (df + square), square / (df + square))))


def correlation_pvalue(r: Column, n: Column) -> Column:
    """Two-sided p-value of a Pearson / point-biserial r on ``n`` rows."""
    df = n.cast("double") - 2
    t = r * F.sqrt(F.greatest(df, F.lit(0.0)) / F.greatest(F.lit(1e-300), 1 - r * r))
    return t_pvalue(t, df)
