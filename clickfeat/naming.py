"""Column names shared by the whole package."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

# Every log carries these two: event time in microseconds and a unique row id.
TIME = "t"
ROW_ID = "rid"

MICROS = 1_000_000


def feature_name(keys: Sequence[str], suffix: str) -> str:
    """``['ip', 'app'], 'count'`` -> ``ip_app_count``."""
    return "_".join([*keys, suffix])


def as_list(columns: str | Iterable[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)
