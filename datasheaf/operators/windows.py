"""Scans over ordered rows: carried headings, islands, gaps, intervals, offsets.

Each takes the partition and a full order. The partition bounds what one task
sorts; a relation with one huge partition needs a finer key first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordered(partition: Sequence[str], order: Sequence[Column | str]):
    return Window.partitionBy(*partition).orderBy(*order)


def carry_forward(value: Column, partition: Sequence[str], order: Sequence[Column | str]) -> Column:
    """The latest value that isn't null, the row's own included (WIN-01, TAB-08)."""
    return F.last(value, ignorenulls=True).over(_ordered(partition, order).rowsBetween(Window.unboundedPreceding, 0))


def islands(value: Column, partition: Sequence[str], order: Sequence[Column | str]) -> Column:
    """Number of the run of equal values, from 0 (WIN-02, WIN-12, WIN-13)."""
    w = _ordered(partition, order)
    changed = (~value.eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1)).cast("int")
    return changed


def numbered_islands(df: DataFrame, value: Column, partition: Sequence[str], order: Sequence[Column | str], name: str = "island") -> DataFrame:
    w = _ordered(partition, order)
    return df.withColumn("__changed", islands(value, partition, order)).withColumn(name, F.sum("__changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__changed")


def gap_clusters(df: DataFrame, value: Column, gap: Column | float, partition: Sequence[str], order: Sequence[Column | str], name: str = "cluster") -> DataFrame:
    """Number of the cluster, from 0: a new one starts where a value is more than ``gap`` beyond the one before (WIN-03)."""
    w = _ordered(partition, order)
    far = F.coalesce((value - F.lag(value).over(w) > gap).cast("int"), F.lit(0))
    return df.withColumn("__far", far).withColumn(name, F.sum("__far").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__far")


def merged_intervals(df: DataFrame, low: str, high: str, partition: Sequence[str]) -> DataFrame:
    """Unions of intervals that overlap or touch: partition, low, high, n (WIN-05, LAY-02)."""
    w = Window.partitionBy(*partition).orderBy(low, high)
    reach = F.max(high).over(w.rowsBetween(Window.unboundedPreceding, -1))
    started = df.withColumn("__new", F.coalesce((F.col(low) > reach).cast("int"), F.lit(0)))
    run = started.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(*partition, "__run").agg(F.min(low).alias(low), F.max(high).alias(high), F.count("*").alias("n")).drop("__run")


def complement(merged: DataFrame, low: str, high: str, partition: Sequence[str], least: Column | None = None) -> DataFrame:
    """Gaps between merged intervals, if at least so wide (WIN-06): partition, low, high."""
    w = Window.partitionBy(*partition).orderBy(low)
    gaps = merged.select(*partition, F.col(high).alias("__from"), F.lead(low).over(w).alias("__to")).filter(F.col("__to").isNotNull())
    gaps = gaps if least is None else gaps.filter(F.col("__to") - F.col("__from") > least)
    return gaps.select(*partition, F.col("__from").alias(low), F.col("__to").alias(high))


def offsets(size: Column, partition: Sequence[str], order: Sequence[Column | str]) -> Column:
    """Sum of the sizes before the row (WIN-07)."""
    return F.sum(size).over(_ordered(partition, order).rowsBetween(Window.unboundedPreceding, 0)) - size


def latest(df: DataFrame, partition: Sequence[str], rank: Sequence[Column | str]) -> DataFrame:
    """The last row of each partition, by columns in falling order (WIN-08, SRT-05): an aggregation, so nothing is sorted."""
    rank_cols = [F.col(c) if isinstance(c, str) else c for c in rank]
    row = F.max_by(F.struct("*"), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(rank_cols)]))
    return df.groupBy(*partition).agg(row.alias("__row")).select("__row.*")


def version_key(version: Column) -> Column:
    """Numbers of a version in order, so that v10 is above v9 (SRC-07)."""
    return F.transform(F.regexp_extract_all(version, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("int"))


def place(partition: Sequence[str], order: Sequence[Column | str]) -> Column:
    """Number of the row in its partition, from 0 (WIN-09)."""
    return F.row_number().over(_ordered(partition, order)) - 1


def with_next(value: Column, partition: Sequence[str], order: Sequence[Column | str]) -> Column:
    """struct(this, next) of neighbouring rows; next is null at the end (WIN-10)."""
    return F.struct(value.alias("this"), F.lead(value).over(_ordered(partition, order)).alias("next"))


def newlines(position: Column, height: Column, line_height: float, partition: Sequence[str], order: Sequence[Column | str]) -> Column:
    """Line breaks between a line and the one before it (WIN-11)."""
    before = F.lag(position).over(_ordered(partition, order))
    return F.coalesce(F.round((before - position) / (line_height * height)).cast("int"), F.lit(0))


def fill_boxes(box: Column, sound: Column, key: Sequence[str], order: Sequence[Column | str]) -> Column:
    """A glyph's box, or, if it is unsound, that of the first sound glyph of the same key before or after it (MTH-12)."""
    w = Window.partitionBy(*key).orderBy(*order)
    good = F.when(sound, box)
    before = F.last(good, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(good, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return F.coalesce(good, before, after, box)
