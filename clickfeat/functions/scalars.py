"""Row-wise expressions and column-list helpers."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BUCKETS = 2**26
MISSING_GAP = 99_999
# Columns that never serve as model inputs.
NOT_PREDICTORS = (
    "click_time", "is_attributed", "click_id", "ip", "day", "attributed_time", "minute", "3min", "15min", "30min",
)
BASE_CATEGORICALS = ("app", "channel", "device", "os", "hour")


def interactions(left: str, right: str, tag: str) -> dict[str, Column]:
    """Product, quotient, sum and difference of two columns; division by zero gives NULL."""
    a, b = F.col(left), F.col(right)
    return {
        f"inter_{tag}*": a * b,
        f"inter_{tag}/": F.try_divide(a, b),
        f"inter_{tag}+": a + b,
        f"inter_{tag}-": a - b,
    }


def add_interactions(df: DataFrame, left: str, right: str, tag: str | None = None) -> DataFrame:
    return df.withColumns(interactions(left, right, tag or f"{left}_{right}"))


def add_all_interactions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Interactions of every pair of ``columns``, numbered in pair order."""
    made: dict[str, Column] = {}
    for number, (left, right) in enumerate(combinations(columns, 2)):
        made.update(interactions(left, right, f"{number}_{left}_{right}"))
    return df.withColumns(made)


def text_key(columns: Sequence[str]) -> Column:
    """One text key from several columns."""
    return F.concat_ws("_", *[F.col(c).cast("string") for c in columns])


def hash_bucket(columns: Sequence[str], buckets: int = HASH_BUCKETS) -> Column:
    """Bucket of the columns' text key, from the first 15 hex digits of its md5 so that other engines find the same."""
    digits = F.substring(F.md5(text_key(columns).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long") % buckets


def log_count(column: str | Column) -> Column:
    return F.log1p(column)


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = MISSING_GAP) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def null_where(condition: Column, column: str | Column) -> Column:
    """The column, emptied where the condition holds."""
    return F.when(~F.coalesce(condition, F.lit(False)), column)


def predictors(df: DataFrame, exclude: Sequence[str] = NOT_PREDICTORS) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def categoricals(df: DataFrame) -> list[str]:
    """Columns taken as categories: the listed ones and all group numbers."""
    return [c for c in BASE_CATEGORICALS if c in df.columns] + [c for c in df.columns if c.endswith("ngroup")]


def has_columns(df: DataFrame, columns: Sequence[str]) -> bool:
    return set(columns) <= set(df.columns)
