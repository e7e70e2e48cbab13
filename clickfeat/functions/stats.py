"""Group statistics by name, as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def skew(column: str | Column) -> Column:
    """Bias-corrected skewness; NULL below three values, 0 without spread."""
    x = F.col(column) if isinstance(column, str) else column
    n = F.count(x)
    corrected = F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n >= 3, F.when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(corrected))


# Every entry works as a plain aggregate and as a window aggregate.
STATS = {
    "count": F.count,
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "var": F.var_samp,
    "std": F.stddev_samp,
    "skew": skew,
    "size": lambda _column: F.count(F.lit(1)),
}


def stat(name: str, column: str | Column) -> Column:
    if name not in STATS:
        raise ValueError(f"unknown statistic {name!r}; choose from {sorted([*STATS, 'median', 'nunique'])}")
    return STATS[name](column)
