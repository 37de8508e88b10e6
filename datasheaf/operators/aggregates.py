"""Grouping: bit fields, register maps, equal structures, cross tables, constrained products."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bit_fields(bits: DataFrame, by: Sequence[str], bit: str) -> DataFrame:
    """Bits of one name as a field: its lowest bit, and the span up to its highest (AGG-01)."""
    return bits.groupBy(*by).agg(F.min(bit).alias("position"), (F.max(bit) + 1 - F.min(bit)).alias("width"))


def last_wins(df: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
    """Of rows with the same key the last (AGG-05, AGG-07)."""
    return df.groupBy(*by).agg(F.max_by(F.struct("*"), order).alias("__row")).select("__row.*")


def register_map(rows: DataFrame, by: Sequence[str], register: str, offset: str, bit: str, field: str, order: str) -> DataFrame:
    """One row a register: offset and map(bit, field); a register that comes again replaces the earlier one (AGG-05)."""
    # what belongs to the last appearance of the register
    last = rows.groupBy(*by, register).agg(F.max(order).alias(order), F.max_by(offset, order).alias(offset))
    own = rows.drop(offset).join(last, [*by, register, order])
    return own.groupBy(*by, register, offset).agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(bit, field)))).alias("fields"))


def structural_groups(df: DataFrame, by: str, part: Column, separator: str = "|") -> DataFrame:
    """Things made of the same distinct parts (AGG-02): signature, members, first member. Compared as written out, not by a hash.

    Only each group's size and first member are kept, so a group may be of any size.
    """
    made = df.groupBy(by).agg(F.array_join(F.array_sort(F.collect_set(part)), separator).alias("signature"))
    return made.groupBy("signature").agg(F.count("*").alias("members"), F.min(by).alias("first"))


def tree_signature(columns: Sequence[Column]) -> Column:
    """Canonical digest of a node's content, equal on any cluster and in any session (AGG-02, TRE-03)."""
    return F.sha2(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"}), 256)


def cross_table(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """Distinct values for each row and column key (TAB-06): their number."""
    return df.groupBy(rows, columns).agg(F.countDistinct(value).alias("n"))


def sets_by(df: DataFrame, by: Sequence[str], value: Column | str, name: str = "values") -> DataFrame:
    """Sorted distinct values of a key (AGG-03, AGG-04, SET-04)."""
    return df.groupBy(*by).agg(F.array_sort(F.collect_set(value)).alias(name))


def lists_by(df: DataFrame, by: Sequence[str], order: str, value: Column, name: str = "values") -> DataFrame:
    """Values of a key in order (AGG-06, AGG-11, AGG-17)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v"))))
    return df.groupBy(*by).agg(F.transform(pairs, lambda x: x["v"]).alias(name))


def codes_by_section(df: DataFrame, section: str, code: str, description: str) -> DataFrame:
    """map(code, description) of each section (AGG-08)."""
    first = df.groupBy(section, code).agg(F.min(description).alias(description))
    return first.groupBy(section).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(code, description)))).alias("codes"))


def expand_codes(parts: Sequence[DataFrame], template: Column | None = None) -> DataFrame:
    """All combinations of small code lists that the template allows (AGG-09). The lists are those of one ordering table, tens of codes each."""
    out = reduce(lambda a, b: a.crossJoin(b), parts)
    return out if template is None else out.filter(template)


def bounding_box(df: DataFrame, by: Sequence[str], box: str = "bbox") -> DataFrame:
    """Smallest box around the boxes of a group (AGG-12)."""
    b = F.col(box)
    edges = F.struct(F.min(b["x0"]).alias("x0"), F.min(b["y0"]).alias("y0"), F.max(b["x1"]).alias("x1"), F.max(b["y1"]).alias("y1"))
    return df.groupBy(*by).agg(edges.alias(box), F.count("*").alias("n"))


def line_figures(chars: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean origin, share of bold glyphs, most frequent rotation of a line (AGG-13); of equally frequent rotations the least."""
    return chars.groupBy(*by).agg(F.avg("origin").alias("origin"), F.avg(F.col("bold").cast("double")).alias("bold_share"), F.mode("rotation", True).alias("rotation"))


def content(chars: DataFrame, by: Sequence[str], order: str = "x0", char: str = "ch") -> DataFrame:
    """Text of a line, cluster or cell: its glyphs from the left (TXT-24)."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, char))), lambda g: g[char]), "")
    return chars.groupBy(*by).agg(joined.alias("text"))


def keep_last_duplicate(df: DataFrame, by: Sequence[str], value: str, order: str) -> DataFrame:
    """Each value of a key once, at its last place (AGG-14)."""
    return df.groupBy(*by, value).agg(F.max(order).alias(order))


def memory_sizes(defines: DataFrame, name: str = "name", expr: str = "expr") -> DataFrame:
    """(memory, bytes) of defines such as FLASH_SIZE (0x2000UL) (AGG-16)."""
    pattern = r"(?i)^\(?\s*\(?(?:uint32_t\)?)?\s*0x([0-9a-f]+)u?l*\s*\)?$"
    return defines.filter(F.col(name).rlike(r"_SIZE$") & F.col(expr).rlike(pattern)).select(F.regexp_replace(name, "_SIZE$", "").alias("memory"), F.conv(F.regexp_extract(expr, pattern, 1), 16, 10).cast("bigint").alias("bytes"))


def defined_names(files: DataFrame, text: str, by: str, pattern: str = r"defined\s*\(?\s*(\w+)\s*\)?") -> DataFrame:
    """(by, name) of all names tested in a header (AGG-15)."""
    return files.select(by, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))).alias("name"))


def double_pinout(pins: DataFrame, by: Sequence[str], position: str, pin: str, variant: str, mark: str = "PINREMAP") -> DataFrame:
    """Positions with several pins of which one is a remap (AGG-18)."""
    return pins.groupBy(*by, position).agg(F.countDistinct(pin).alias("pins"), F.bool_or(F.contains(F.coalesce(F.col(variant), F.lit("")), F.lit(mark))).alias("remapped")).filter("pins > 1 and remapped").drop("remapped")
