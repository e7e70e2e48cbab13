"""Beta-binomial smoothing of click rates.

The prior (alpha, beta) is the beta distribution under which the clicks are likeliest. Each sum of a round runs over the
distinct counts of one precomputed histogram, as a Spark aggregate; only a few numbers per round reach the driver.

Rates that differ no more than by chance have no such prior: the likelihood grows towards the binomial limit, where all rates are
the pooled one. The slope of the likelihood in the spread of the rates at that limit tells this case before any round.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digamma by its asymptotic series after shifting the argument up by SERIES_SHIFT.
# The coefficients -B(2k) / 2k of x^-2k, k = 1..6.
SERIES = (-1 / 12, 1 / 120, -1 / 252, 1 / 240, -1 / 132, 691 / 32760)
# The Bernoulli numbers B(2k) of x^-(2k+1) in the series of trigamma, k = 1..6.
BERNOULLI = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730)
SERIES_SHIFT = 10
# Second-order steps nearly always end within ten rounds.
ROUNDS = 50
# A step changes a parameter at most by this power of e.
LONGEST_STEP = 3.0


def digamma(x: Column) -> Column:
    """Digamma of a positive column."""
    high = x + SERIES_SHIFT
    square = 1.0 / (high * high)
    tail = F.lit(0.0)
    for coefficient in reversed(SERIES):
        tail = (tail + F.lit(coefficient)) * square
    below = F.aggregate(
        F.sequence(F.lit(0), F.lit(SERIES_SHIFT - 1)), F.lit(0.0), lambda total, j: total + 1.0 / (x + j)
    )
    return F.ln(high) - 0.5 / high + tail - below


def trigamma(x: Column) -> Column:
    """Trigamma of a positive column."""
    high = x + SERIES_SHIFT
    square = 1.0 / (high * high)
    tail = F.lit(0.0)
    for coefficient in reversed(BERNOULLI):
        tail = (tail + F.lit(coefficient)) * square
    below = F.aggregate(
        F.sequence(F.lit(0), F.lit(SERIES_SHIFT - 1)), F.lit(0.0), lambda total, j: total + 1.0 / ((x + j) * (x + j))
    )
    return (1.0 + tail) / high + 0.5 * square + below


@dataclass(frozen=True)
class BetaPrior:
    """A fitted prior. ``pooled`` is the common rate where the rates differ no more than by chance; ``ended`` tells whether the
    fit came to rest within its rounds."""

    alpha: float
    beta: float
    rounds: int = 0
    pooled: float | None = None
    ended: bool = True

    def rate(self, impressions: str | Column, clicks: str | Column) -> Column:
        """Smoothed click rate."""
        if self.pooled is not None:
            return F.lit(self.pooled)
        i = F.col(impressions) if isinstance(impressions, str) else impressions
        c = F.col(clicks) if isinstance(clicks, str) else clicks
        return (c + self.alpha) / (i + self.alpha + self.beta)


def count_histogram(df: DataFrame, impressions: str, clicks: str) -> DataFrame:
    """Distinct values of clicks, non-clicks and impressions with their number of rows."""
    c, i = F.col(clicks), F.col(impressions)
    values = {"clicked": c, "skipped": i - c, "shown": i}
    entries = [F.struct(F.lit(k).alias("kind"), v.cast("double").alias("value")) for k, v in values.items()]
    return (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.kind", "e.value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _sums(histogram: DataFrame, alpha: float, beta: float) -> dict[str, tuple[float, float]]:
    """Per kind of count the sums of the digamma and trigamma differences between start and end."""
    start = {"clicked": alpha, "skipped": beta, "shown": alpha + beta}
    starts = F.create_map(*[F.lit(v) for pair in start.items() for v in pair])
    rows = histogram.withColumn("start", F.element_at(starts, F.col("kind")))
    rows = rows.withColumns({f"_{f.__name__}": F.col("rows") * (f(F.col("value") + F.col("start")) - f(F.col("start"))) for f in (digamma, trigamma)})
    found = rows.groupBy("kind").agg(F.sum("_digamma").alias("first"), F.sum("_trigamma").alias("second")).collect()
    return {r["kind"]: (r["first"] or 0.0, r["second"] or 0.0) for r in found}


def pooled_rate(histogram: DataFrame) -> tuple[float | None, bool]:
    """The rate of all rows together, and whether the rates of the rows differ by more than chance makes them.

    With p and q the pooled rates, c, s, n the clicked, skipped and shown counts of a row, the likelihood's slope in the spread
    at no spread is half the sum of c(c-1)/p + s(s-1)/q - n(n-1); the prior is finite where that is positive.
    """
    value = F.col("value")
    sums = {"all": F.sum(F.col("rows") * value), "pairs": F.sum(F.col("rows") * value * (value - 1))}
    found = {r["kind"]: r for r in histogram.where(value.isNotNull()).groupBy("kind").agg(*[c.alias(n) for n, c in sums.items()]).collect()}
    shown = found["shown"]["all"] if "shown" in found else 0.0
    if not shown:
        return None, False
    p = found["clicked"]["all"] / shown
    if p in (0.0, 1.0):
        return p, False
    return p, found["clicked"]["pairs"] / p + found["skipped"]["pairs"] / (1 - p) - found["shown"]["pairs"] > 0


def _step(sums: dict[str, tuple[float, float]], alpha: float, beta: float) -> tuple[float, float]:
    """A step of Newton's method in the logarithms of the parameters; of the fixed-point iteration where the likelihood is not
    curved downward."""
    (c1, c2), (s1, s2), (n1, n2) = (sums[k] for k in ("clicked", "skipped", "shown"))
    ga, gb = alpha * (c1 - n1), beta * (s1 - n1)
    haa, hbb, hab = alpha * alpha * (c2 - n2) + ga, beta * beta * (s2 - n2) + gb, -alpha * beta * n2
    determinant = haa * hbb - hab * hab
    if haa < 0 and determinant > 0:
        steps = (-(hbb * ga - hab * gb) / determinant, -(haa * gb - hab * ga) / determinant)
    else:
        steps = (math.log(c1 / n1), math.log(s1 / n1))
    return tuple(max(-LONGEST_STEP, min(LONGEST_STEP, x)) for x in steps)


def fit_beta_prior(
    df: DataFrame, impressions: str, clicks: str, alpha: float = 1.0, beta: float = 1.0, max_rounds: int = ROUNDS, epsilon: float = 1e-10
) -> BetaPrior:
    """Fit the prior by second-order steps from ``alpha`` and ``beta``; stops when both parameters move less than ``epsilon`` (of
    their size, where they are large), or after ``max_rounds``.

    Rates that differ no more than by chance, or that are all 0 or all 1, give the pooled rate without any round; so does an
    empty table, with no rate at all. Rows with a NULL count take no part.
    """
    known = df.where(F.col(impressions).isNotNull() & F.col(clicks).isNotNull())
    histogram = count_histogram(known, impressions, clicks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rate, spread = pooled_rate(histogram)
        if not spread:
            return BetaPrior(math.inf, math.inf, 0, math.nan if rate is None else rate)
        for done in range(max_rounds):
            steps = _step(_sums(histogram, alpha, beta), alpha, beta)
            new_alpha, new_beta = alpha * math.exp(steps[0]), beta * math.exp(steps[1])
            still = abs(new_alpha - alpha) < epsilon * max(1.0, alpha) and abs(new_beta - beta) < epsilon * max(1.0, beta)
            alpha, beta = new_alpha, new_beta
            if still:
                return BetaPrior(alpha, beta, done + 1)
        return BetaPrior(alpha, beta, max_rounds, None, False)
    finally:
        histogram.unpersist()


def iterate_beta_prior(
    df: DataFrame, impressions: str, clicks: str, rounds: int, alpha: float = 1.0, beta: float = 1.0, epsilon: float = 1e-10
) -> BetaPrior:
    """The prior after at most ``rounds`` of the plain fixed-point iteration; it stops before a step that moves both parameters
    less than ``epsilon``. First-order: it nears the fitted prior slowly, and at the binomial limit only grows."""
    histogram = count_histogram(df, impressions, clicks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for done in range(rounds):
            sums = _sums(histogram, alpha, beta)
            new_alpha = alpha * sums["clicked"][0] / sums["shown"][0]
            new_beta = beta * sums["skipped"][0] / sums["shown"][0]
            if abs(new_alpha - alpha) < epsilon and abs(new_beta - beta) < epsilon:
                return BetaPrior(alpha, beta, done)
            alpha, beta = new_alpha, new_beta
        return BetaPrior(alpha, beta, rounds, None, False)
    finally:
        histogram.unpersist()
