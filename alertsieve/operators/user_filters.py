"""User-supplied filters.

A filter is preferably a function ``DataFrame -> Column`` built from
``pyspark.sql.functions`` (``filters.register_filter``): Catalyst can push it
down and code-generate it.  Logic that has no column expression can be given
as a vectorised pandas function ``(pd.Series, ...) -> pd.Series[bool]``; it
runs as an Arrow-batched pandas UDF over the named columns.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import resolve
from .filters import FilterSpec, register_filter


def pandas_builder(fn: Callable, columns: list[str]) -> Callable[[DataFrame], Column]:
    """Filter builder of a vectorised pandas function over the named columns."""
    def call(*series: pd.Series) -> pd.Series:
        return fn(*series)

    def builder(df: DataFrame) -> Column:
        return F.pandas_udf(call, returnType=T.BooleanType())(*[resolve(df, c) for c in columns])
    return builder


def register_pandas_filter(name: str, fn: Callable, columns: list[str],
                           topic: str | None = None) -> FilterSpec:
    return register_filter(name, pandas_builder(fn, columns), topic)
