"""Bounded samples that no single task has to gather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPAN = 1 << 31


def hashed_share(df: DataFrame, id_col: str, rows: int, total: int | None = None) -> DataFrame:
    """All rows if they are at most ``rows``, else those whose hashed id lies below the share that leaves ``rows`` on average.

    Each row decides for itself, so the choice is the same however the rows are dealt.
    """
    total = df.count() if total is None else total
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(_SPAN)) < int(_SPAN * rows / total))
