"""The table model: cells on a grid with spans, columns and rows addressed by their headers.

A table is known by ``table_id``. ``cells`` are the cells in scan order;
``grid`` has one row for each place that a cell covers. Everything after the grid is
declarative.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datasheaf.functions.text import replace_subs

GRID = pa.schema([("table_id", pa.string()), *((n, pa.int32()) for n in ("cell_id", "gx", "gy", "width", "height", "header_rows")), ("is_header", pa.bool_()), ("html", pa.string())])
GRID_DDL = "table_id string, cell_id int, gx int, gy int, width int, height int, header_rows int, is_header boolean, html string"


def _tables(items: DataFrame) -> DataFrame:
    return items.filter("kind = 'table'").select(F.concat_ws("#", "doc", "chapter", F.col("item_no").cast("string")).alias("table_id"), "cells")


def cells(items: DataFrame) -> DataFrame:
    """(table_id, cell_id, row, xspan, yspan, is_header, html) of the tables among scanned items."""
    return _tables(items).select("table_id", F.posexplode("cells").alias("cell_id", "c")).select("table_id", "cell_id", "c.*")


def places(cells: list[dict]) -> tuple[int, int, int, dict[tuple[int, int], int]]:
    """Width, height, header rows, and the cell at each place (TAB-01).

    The first row's spans make the width, the lowest end of a cell the height,
    and all rows down to the last header cell are header rows. A cell goes to
    the first column that no cell covers any longer, or on where the one before
    ended if there is none; spans end at the edge, and a later cell lies on top.
    """
    first = [c["xspan"] for c in cells if c["row"] == 0]
    ends = [c["row"] + c["yspan"] for c in cells]
    headers = [c["row"] for c in cells if c["is_header"]]
    covered = np.zeros(sum(first), np.int64)  # by column, the row at which it is free again
    owner = np.full((max(ends), len(covered)), -1)
    after = 0
    for number, (cell, end) in enumerate(zip(cells, ends, strict=True)):
        free = np.flatnonzero(covered <= cell["row"])
        left = int(free[0]) if len(free) else after
        after = left + cell["xspan"]
        covered[left:after] = np.maximum(covered[left:after], end)
        owner[cell["row"] : end, left:after] = number
    ys, xs = np.nonzero(owner >= 0)
    at = dict(zip(zip(xs.tolist(), ys.tolist(), strict=True), owner[ys, xs].tolist(), strict=True))
    return len(covered), len(owner), headers[-1] + 1 if headers else 0, at


def grid(items: DataFrame) -> DataFrame:
    """One row for each place of each table: table_id, cell_id, gx, gy, width, height, header_rows, is_header, html.

    A scanned table holds its cells, so this needs no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for table_id, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not found:
                    continue
                width, height, header_rows, at = places(found)
                out += [(table_id, i, gx, gy, width, height, header_rows, found[i]["is_header"], found[i]["html"]) for (gx, gy), i in at.items()]
            columns = list(zip(*out, strict=True)) if out else [()] * len(GRID)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, GRID, strict=True)], names=GRID.names)

    return _tables(items).mapInArrow(run, GRID_DDL)


def _plain(subs: Sequence[tuple[str, str]]) -> Column:
    return F.replace(replace_subs("html", subs), F.lit(":"))


def _path(places: DataFrame, by: str, along: str, subs: Sequence[tuple[str, str]]) -> DataFrame:
    """Texts along a line of the grid, a cell that covers several places counted once where they adjoin, joined by colons."""
    w = Window.partitionBy("table_id", by).orderBy(along)
    new = places.withColumn("__text", _plain(subs)).withColumn("__before", F.lag("cell_id").over(w)).filter(~F.col("cell_id").eqNullSafe(F.col("__before")))
    return new.groupBy("table_id", by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(along, "__text"))), lambda x: x["__text"]), ":").alias("domain"))


def domains_x(grid: DataFrame, pattern: str | None = None, subs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(table_id, gx, domain): the header path of each column; equal paths are one domain (TAB-02, TAB-05, FLT-06). Without header rows the path is empty."""
    columns = grid.select("table_id", "gx").distinct()
    paths = _path(grid.filter("gy < header_rows"), "gx", "gy", subs)
    out = columns.join(paths, ["table_id", "gx"], "left").withColumn("domain", F.coalesce("domain", F.lit("")))
    return out if pattern is None else out.filter(F.col("domain").rlike(f"(?i){pattern}"))


def domains_y(grid: DataFrame, keys: DataFrame, subs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(table_id, gy, domain): the row key of each body row along the key columns (TAB-03)."""
    body = grid.filter("gy >= header_rows").join(keys.select("table_id", "gx").distinct(), ["table_id", "gx"])
    return _path(body, "gy", "gx", subs)


def cell_rows(grid: DataFrame, domains: DataFrame, subs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(table_id, gy, domain, texts): for each body row and domain the texts of its places, from left (TAB-04)."""
    body = grid.filter("gy >= header_rows").withColumn("__text", replace_subs("html", subs)).join(domains, ["table_id", "gx"])
    return body.groupBy("table_id", "gy", "domain").agg(F.transform(F.array_sort(F.collect_list(F.struct("gx", "__text"))), lambda x: x["__text"]).alias("texts"))


def row_maps(rows: DataFrame) -> DataFrame:
    """(table_id, gy, cells map(domain, texts)) of cell_rows()."""
    return rows.groupBy("table_id", "gy").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("domain", "texts")))).alias("cells"))


def cross_lookup(grid: DataFrame, x: DataFrame, y: DataFrame) -> DataFrame:
    """(table_id, row_key, column_key, cells): distinct cells where a row key meets a column (TAB-06)."""
    at = grid.join(x.withColumnRenamed("domain", "column_key"), ["table_id", "gx"]).join(y.withColumnRenamed("domain", "row_key"), ["table_id", "gy"])
    return at.groupBy("table_id", "row_key", "column_key").agg(F.array_sort(F.collect_set(F.struct("cell_id", "html"))).alias("cells"))


def cell_at(grid: DataFrame, x: int, y: int) -> DataFrame:
    """The cell at a place; a negative row counts from the end; outside it fails (TAB-07)."""
    row = F.lit(y) if y >= 0 else F.col("height") + y
    inside = (F.lit(x) < F.col("width")) & (row < F.col("height")) & (row >= 0)
    return grid.filter(F.when(inside, (F.col("gx") == x) & (F.col("gy") == row)).otherwise(F.raise_error(F.lit("outside the table")).cast("boolean")))


def sections(items: DataFrame, pattern: str | None = None) -> DataFrame:
    """Items under their headings (TAB-08): texts and tables, with a heading like the pattern."""
    out = items.filter("kind <> 'heading'")
    return out if pattern is None else out.filter(F.col("heading").rlike(f"(?i){pattern}"))


def append_rows(rows: DataFrame, by: Sequence[str], part: str, row: str) -> DataFrame:
    """Parts of a table below one another: ``y`` is the row after all rows of the parts before (TAB-13)."""
    sizes = rows.groupBy(*by, part).agg((F.max(row) + 1).alias("__size"))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    skip = sizes.select(*by, part, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__skip"))
    return rows.join(skip, [*by, part]).withColumn("y", F.col(row) + F.col("__skip")).drop("__skip")


def append_bottom(upper: DataFrame, lower: DataFrame, merge_headers: bool = True) -> DataFrame:
    """Grids of one table cut by a page break (TAB-13): the lower body follows the upper; its header rows are dropped if they are to be merged.

    Columns are aligned by their header paths where the widths differ, if both
    sides have the same paths in the same order; else the tables stay apart and
    the lower one isn't appended.
    """
    heights = upper.groupBy("table_id").agg(F.max("height").alias("__h"), F.max("width").alias("__w"))
    below = lower.filter("gy >= header_rows") if merge_headers else lower
    skip = F.col("header_rows") if merge_headers else F.lit(0)
    numbered = below.join(heights, "table_id")
    same = numbered.filter("width = __w").withColumn("__x", F.col("gx"))

    def ranked(g: DataFrame, name: str) -> DataFrame:
        d = domains_x(g)
        w = Window.partitionBy("table_id", "domain")
        return d.withColumn("__first", F.min("gx").over(w)).withColumn("__last", F.max("gx").over(w)).select("table_id", "domain", F.col("gx").alias(name), "__first", "__last")

    wide = ranked(upper, "__x")
    narrow = ranked(lower, "gx").select("table_id", "domain", "gx", F.col("__first").alias("__f"), F.col("__last").alias("__l"))
    # a column group is widened to the upper one: its last column fills what is left
    place = (F.col("__x") - F.col("__first") == F.col("gx") - F.col("__f")) | ((F.col("gx") == F.col("__l")) & (F.col("__x") - F.col("__first") > F.col("__l") - F.col("__f")))
    aligned = narrow.join(wide, ["table_id", "domain"]).filter(place).select("table_id", "gx", "__x")
    equal = domains_x(upper).groupBy("table_id").agg(F.array_sort(F.collect_set("domain")).alias("__a")).join(domains_x(lower).groupBy("table_id").agg(F.array_sort(F.collect_set("domain")).alias("__b")), "table_id").filter("__a = __b").select("table_id")
    moved = same.unionByName(numbered.filter("width <> __w").join(aligned, ["table_id", "gx"]).join(equal, "table_id", "left_semi"))
    shifted = moved.select("table_id", (F.col("cell_id") + 1_000_000).alias("cell_id"), F.col("__x").alias("gx"), (F.col("gy") - skip + F.col("__h")).alias("gy"), F.col("__w").alias("width"), "height", F.lit(0).alias("header_rows"), F.lit(False).alias("is_header"), "html")
    both = upper.unionByName(shifted)
    w = Window.partitionBy("table_id")
    return both.withColumn("height", F.max("gy").over(w) + 1).withColumn("header_rows", F.max("header_rows").over(w))


def append_side(left: DataFrame, right: DataFrame, expand: bool = True) -> DataFrame:
    """Grids side by side (TAB-14); the lower edge of the shorter one is drawn down if ``expand``."""
    size = left.groupBy("table_id").agg(F.max("width").alias("__w"), F.max("height").alias("__h"))
    other = right.groupBy("table_id").agg(F.max("width").alias("__rw"), F.max("height").alias("__rh"))
    sizes = size.join(other, "table_id")
    moved = right.join(sizes, "table_id").withColumn("gx", F.col("gx") + F.col("__w")).withColumn("cell_id", F.col("cell_id") + 1_000_000)
    both = left.join(sizes, "table_id").unionByName(moved).withColumn("__own", F.col("height")).withColumn("height", F.greatest("__h", "__rh")).withColumn("width", F.col("__w") + F.col("__rw"))
    if expand:
        lowest = (F.col("gy") == F.col("__own") - 1) & (F.col("height") > F.col("__own"))
        both = both.withColumn("gy", F.explode(F.when(lowest, F.sequence(F.col("gy"), F.col("height") - 1)).otherwise(F.array("gy"))))
    return both.drop("__w", "__h", "__rw", "__rh", "__own")


def captioned(items: DataFrame, subs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Items with plain caption and heading (TXT-04)."""
    return items.withColumns({"caption": replace_subs("caption", subs), "heading": replace_subs("heading", subs)})


def sizes(grid: DataFrame) -> DataFrame:
    """(table_id, width, height, header_rows, cells) (TAB-15)."""
    return grid.groupBy("table_id").agg(F.max("width").alias("width"), F.max("height").alias("height"), F.max("header_rows").alias("header_rows"), F.countDistinct("cell_id").alias("cells"))


def virtual(rows: DataFrame, table_id: Column, texts: Sequence[Column], headers: Sequence[str], order: str) -> DataFrame:
    """A grid made of columns (TAB-16): one header row, then a row for each row in order."""
    y = F.row_number().over(Window.partitionBy(table_id).orderBy(order))
    # numbered before the explode, which would be counted too
    numbered = rows.withColumn("__y", y)
    body = numbered.select(table_id.alias("table_id"), F.col("__y").alias("gy"), F.posexplode(F.array(*[t.cast("string") for t in texts])).alias("gx", "html"))
    head = rows.select(table_id.alias("table_id")).distinct().select("table_id", F.lit(0).alias("gy"), F.posexplode(F.array(*[F.lit(h) for h in headers])).alias("gx", "html"))
    n = len(headers)
    w = Window.partitionBy("table_id")
    return head.unionByName(body).select("table_id", (F.col("gy") * n + F.col("gx")).cast("int").alias("cell_id"), "gx", "gy", F.lit(n).alias("width"), (F.max("gy").over(w) + 1).alias("height"), F.lit(1).alias("header_rows"), (F.col("gy") == 0).alias("is_header"), "html")
