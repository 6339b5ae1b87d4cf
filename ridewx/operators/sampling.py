"""The exploration's sample: the first ``k`` rows in time order.

Spark plans ``orderBy().limit(k)`` as a top-k: every task keeps its own
``k`` rows and one task merges them, so ``k`` must fit one task. NULL times
sort first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def first_rows_by_time(df: DataFrame, time_col: str, k: int,
                       order: list[str | Column] | None = None) -> DataFrame:
    """The ``k`` earliest rows of ``df`` by ``time_col`` (ties broken by
    ``order``, which should start with ``time_col``)."""
    return df.orderBy(*(order or [time_col])).limit(k)
