"""Selectors of documents, chapters, tables and defines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datasheaf.checks import exactly_one


def by_pattern(df: DataFrame, column: str, pattern: str | None) -> DataFrame:
    """Rows whose value the pattern is found in, whatever its case; no pattern keeps all (FLT-01, FLT-03, FLT-06)."""
    return df if pattern is None else df.filter(F.col(column).rlike(f"(?i){pattern}"))


def the_one(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """The only such row (FLT-02)."""
    return exactly_one(by_pattern(df, column, pattern), f"{column} like {pattern}")


def of_kind(items: DataFrame, *kinds: str) -> DataFrame:
    """FLT-04, FLT-20."""
    return items.filter(F.col("kind").isin(*kinds))


def glob_pattern(glob: str) -> str:
    """A file glob as a pattern."""
    import fnmatch

    return fnmatch.translate(glob).replace(r"\Z", "$").replace(r"\z", "$")


def search_tables(tables: DataFrame, doc: str = "*", chapter: str | None = None, caption: str | None = None) -> DataFrame:
    """Document glob, chapter pattern, caption pattern (FLT-18)."""
    return by_pattern(by_pattern(tables.filter(F.col("doc").rlike(glob_pattern(doc))), "chapter", chapter), "caption", caption)


def chars_in_area(chars: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Glyphs whose midpoint lies in the area (FLT-12). On a table sorted by y, row groups outside aren't read."""
    b = F.col("bbox")
    return chars.filter(((b["y0"] + b["y1"]) / 2).between(y0, y1) & ((b["x0"] + b["x1"]) / 2).between(x0, x1))


def find_words(lines: DataFrame, text: str, word: str, case_sensitive: bool = True) -> DataFrame:
    """Places (from 0) of a whole word in each line (FLT-13)."""
    pattern = ("" if case_sensitive else "(?i)") + rf"(?<!\w){word}(?!\w)"
    # the pieces between matches give their places
    pieces = F.split(F.col(text), pattern)
    starts = F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda n: F.aggregate(F.slice(pieces, 1, n), F.lit(0), lambda a, p: a + F.length(p)) + (n - 1) * len(word))
    return lines.filter(F.col(text).rlike(pattern)).withColumn("at", F.explode(starts))


def has_font(fonts: Column, *fragments: str) -> Column:
    """FLT-14."""
    return F.exists(fonts, lambda f: F.greatest(*[F.contains(f, F.lit(x)) for x in (*fragments, fragments[0])]))


def relevant_pages(pages: DataFrame, top: str = "top") -> DataFrame:
    """Without pages of contents, lists and index (FLT-15)."""
    return pages.filter(~F.coalesce(F.col(top).rlike(r"(?i)^\s*(contents|list of|index)"), F.lit(False)))


def usable_defines(defines: DataFrame, name: str = "name", excluded_suffixes: Sequence[str] = ("_Msk", "_Pos"), excluded_prefixes: Sequence[str] = ("IS_", "_"), excluded: Sequence[str] = ()) -> DataFrame:
    """Without macros with arguments, legacy marks and excluded names (FLT-16)."""
    c = F.col(name)
    bad = c.rlike(r"\(") | c.rlike(r"(?i)legacy") | c.isin(*excluded)
    for s in excluded_suffixes:
        bad = bad | F.endswith(c, F.lit(s))
    for p in excluded_prefixes:
        bad = bad | F.startswith(c, F.lit(p))
    return defines.filter(~bad)


def without_prefixes(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    """FLT-17, SRC-28: drop rows that start with a listed prefix."""
    bad = F.lit(False)
    for p in prefixes:
        bad = bad | F.startswith(F.col(column), F.lit(p))
    return df.filter(~F.coalesce(bad, F.lit(False)))


def chapters_of(chapters: DataFrame, sections: DataFrame, name: str = "chapter", number: str = "section") -> DataFrame:
    """Chapters whose number is the first part of some section's (JOI-23)."""
    wanted = sections.select(F.regexp_extract(number, r"^(\d+)", 1).alias("__n")).filter("__n <> ''").distinct()
    return chapters.join(wanted, F.regexp_extract(name, r"(?i)^(?:chapter )?(\d+)\b", 1) == F.col("__n"), "left_semi")


def specificity(pattern: str) -> Column:
    """Sort key of patterns: the longest first, then fewest wildcards, then the later the first one, then the name (SRT-02)."""
    p = F.col(pattern)
    return F.struct((-F.length(p)).alias("a"), F.length(F.regexp_replace(p, "[^x.]", "")).alias("b"), (-F.locate("x", p)).alias("c"), p.alias("d"))


def reading_order(y: str = "y1", x: str = "x0") -> list[Column]:
    """From the top, then from the left (SRT-03)."""
    return [F.col(y).desc(), F.col(x).asc()]


def new_only(remote: DataFrame, local: DataFrame, on: str) -> DataFrame:
    """Remote rows whose key isn't local (SET-01)."""
    return remote.join(local.select(on).distinct(), on, "left_anti")
