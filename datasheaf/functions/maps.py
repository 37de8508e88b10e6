"""Maps with patterns for keys, and lists stripped by a predicate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_keys(m: Column, pattern: str) -> Column:
    """Keys that the pattern, whatever its case, is found in (FLT-05)."""
    return F.filter(F.map_keys(m), lambda k: k.rlike(f"(?i){pattern}"))


def match_key(m: Column, pattern: str) -> Column:
    """The only such key; fails if there is none or more than one."""
    keys = match_keys(m, pattern)
    return F.when(F.size(keys) == 1, F.element_at(keys, 1)).otherwise(F.raise_error(F.concat(F.lit(f"not one key matches {pattern}: "), F.array_join(keys, ", "))))


def match_values(m: Column, pattern: str) -> Column:
    return F.map_values(F.map_filter(m, lambda k, _: k.rlike(f"(?i){pattern}")))


def match_value(m: Column, pattern: str) -> Column:
    return F.element_at(m, match_key(m, pattern))


def overlay(left: Column, right: Column) -> Column:
    """Union of two maps; the right one wins (ARR-02). No session setting is needed."""
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k)), right)


def lstrip(values: Column, drop: Callable[[Column], Column]) -> Column:
    """Without the leading elements that ``drop`` holds for (FLT-19)."""
    keep = F.array_position(F.transform(values, lambda x: F.coalesce(~drop(x), F.lit(True))), F.lit(True))
    return F.when(keep == 0, F.slice(values, 1, 0)).otherwise(F.slice(values, F.greatest(keep, F.lit(1)).cast("int"), F.size(values)))


def rstrip(values: Column, drop: Callable[[Column], Column]) -> Column:
    return F.reverse(lstrip(F.reverse(values), drop))


def strip(values: Column, drop: Callable[[Column], Column]) -> Column:
    return rstrip(lstrip(values, drop), drop)


def any_filter(filters: Column, values: Column) -> Column:
    """Resolve map(key, patterns) against map(key, value): true if any pattern of any key present matches, or no filter key is present (FLT-07)."""
    present = F.map_filter(filters, lambda k, _: F.array_contains(F.map_keys(values), k))
    hit = F.exists(F.map_entries(present), lambda e: F.exists(e["value"], lambda p: F.regexp_like(F.element_at(values, e["key"]), p)))
    return (F.size(present) == 0) | hit
