"""Assertions on relations, evaluated with the query that uses them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(AssertionError):
    """A relation isn't what an operator needs."""


def exactly_one(df: DataFrame, what: str = "row") -> DataFrame:
    """The relation's only row; two are looked at, at most."""
    n = len(df.take(2))
    if n != 1:
        raise CheckFailed(f"{'no' if n == 0 else 'more than one'} {what}")
    return df


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fails if a key has more than one row (AGG-10)."""
    twice = df.groupBy(*keys).count().filter("count > 1").take(1)
    if twice:
        raise CheckFailed(f"more than one row for {twice[0].asDict()}")
    return df


def one_each(df: DataFrame, key: str, value: str) -> DataFrame:
    """Fails if a key belongs to more than one value."""
    twice = df.groupBy(key).agg(F.countDistinct(value).alias("n")).filter("n > 1").take(1)
    if twice:
        raise CheckFailed(f"{key} {twice[0][key]} has {twice[0]['n']} of {value}")
    return df


def not_empty(df: DataFrame, what: str = "rows") -> DataFrame:
    if not df.take(1):
        raise CheckFailed(f"no {what}")
    return df
