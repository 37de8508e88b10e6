"""Points, boxes, intervals and bits as Columns (MTH-01 to MTH-13, FLT-10). A box is struct(x0, y0, x1, y1), a point struct(x, y)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = 1e-6


def isclose(a: Column, b: Column, atol: float = TOLERANCE) -> Column:
    return F.abs(a - b) <= atol


def squared_distance(p: Column, q: Column) -> Column:
    return F.pow(p["x"] - q["x"], 2) + F.pow(p["y"] - q["y"], 2)


def distance(p: Column, q: Column) -> Column:
    return F.sqrt(squared_distance(p, q))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Corners in either order."""
    return F.struct(F.least(x0, x1).alias("x0"), F.least(y0, y1).alias("y0"), F.greatest(x0, x1).alias("x1"), F.greatest(y0, y1).alias("y1"))


def contains_point(b: Column, p: Column) -> Column:
    return p["x"].between(b["x0"], b["x1"]) & p["y"].between(b["y0"], b["y1"])


def contains_box(b: Column, inner: Column) -> Column:
    return (inner["x0"] >= b["x0"]) & (inner["x1"] <= b["x1"]) & (inner["y0"] >= b["y0"]) & (inner["y1"] <= b["y1"])


def overlaps(a: Column, b: Column) -> Column:
    """The boxes share an area or an edge."""
    return (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])


def overlaps_compat(a: Column, b: Column) -> Column:
    """One of the other box's two defining corners lies in this one: not symmetric."""
    return contains_point(a, F.struct(b["x0"].alias("x"), b["y0"].alias("y"))) | contains_point(a, F.struct(b["x1"].alias("x"), b["y1"].alias("y")))


def boxes_close(a: Column, b: Column, atol: float = TOLERANCE) -> Column:
    return isclose(a["x0"], b["x0"], atol) & isclose(a["y0"], b["y0"], atol) & isclose(a["x1"], b["x1"], atol) & isclose(a["y1"], b["y1"], atol)


def joined(a: Column, b: Column) -> Column:
    return F.struct(F.least(a["x0"], b["x0"]).alias("x0"), F.least(a["y0"], b["y0"]).alias("y0"), F.greatest(a["x1"], b["x1"]).alias("x1"), F.greatest(a["y1"], b["y1"]).alias("y1"))


def offset(b: Column, dx: Column | float, dy: Column | float) -> Column:
    """Grow (or shrink) a box on all sides."""
    return F.struct((b["x0"] - dx).alias("x0"), (b["y0"] - dy).alias("y0"), (b["x1"] + dx).alias("x1"), (b["y1"] + dy).alias("y1"))


def translated(b: Column, dx: Column | float, dy: Column | float) -> Column:
    return F.struct((b["x0"] + dx).alias("x0"), (b["y0"] + dy).alias("y0"), (b["x1"] + dx).alias("x1"), (b["y1"] + dy).alias("y1"))


def midpoint(b: Column) -> Column:
    return F.struct(((b["x0"] + b["x1"]) / 2).alias("x"), ((b["y0"] + b["y1"]) / 2).alias("y"))


def rotated(p: Column, degrees: Column | float) -> Column:
    """A point turned about the origin."""
    a = F.radians(F.lit(degrees) if not isinstance(degrees, Column) else degrees)
    return F.struct((p["x"] * F.cos(a) - p["y"] * F.sin(a)).alias("x"), (p["x"] * F.sin(a) + p["y"] * F.cos(a)).alias("y"))


def rounded(b: Column, digits: int = 1) -> Column:
    """Half to even, as binning by origin wants it (MTH-13)."""
    return F.struct(*[F.bround(b[k], digits).alias(k) for k in ("x0", "y0", "x1", "y1")])


def direction(p: Column, q: Column, atol: float = TOLERANCE) -> Column:
    """horizontal, vertical or angle, of the line between two points (MTH-03)."""
    return F.when(isclose(p["y"], q["y"], atol), "horizontal").when(isclose(p["x"], q["x"], atol), "vertical").otherwise("angle")


def interval_overlaps(v0: Column, v1: Column, o0: Column, o1: Column, atol: float = 0.0) -> Column:
    """Strict overlap of [v0, v1] and [o0, o1], with tolerance (FLT-11)."""
    return (v1 + atol > o0) & (o1 > v0 - atol)


def length(v0: Column, v1: Column) -> Column:
    """MTH-04."""
    return v1 - v0


def scaled_area(area: Column, width: Column, height: Column) -> Column:
    """A template's area, given as shares of the page, on a page of that size (MTH-11)."""
    return F.struct((area["x0"] * width).alias("x0"), (area["y0"] * height).alias("y0"), (area["x1"] * width).alias("x1"), (area["y1"] * height).alias("y1"))


def mask_width(mask: Column, position: Column) -> Column:
    """Bits of a mask from its position up (MTH-05): the length of the shifted number, not the number of ones."""
    shifted = F.call_function("shiftright", mask, position)
    return F.when(shifted == 0, 0).otherwise(F.length(F.bin(shifted)))


def bit_address(byte_offset: Column, position: Column) -> Column:
    return byte_offset * 8 + position


def byte_range(address: Column, width: Column) -> Column:
    """Addresses of a register's bytes (MTH-06)."""
    return F.sequence(address, address + width - 1)


def heading_level(height: Column, ladder: Mapping[float, int], otherwise: int = 0) -> Column:
    """Level of a heading by its line height: the first rung that is reached, from the top (MTH-08)."""
    out = F.lit(otherwise)
    for rung in sorted(ladder):
        out = F.when(height >= rung, ladder[rung]).otherwise(out)
    return out


def named_colour(colour: Column, names: Mapping[int, str], otherwise: str = "other") -> Column:
    """Name of a packed RGBA colour (MTH-09)."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, colour), F.lit(otherwise))


def script_of(origin: Column, line_origin: Column, height: Column, up: float = 0.25, down: float = 0.15) -> Column:
    """sup, sub or null, by how far a glyph stands off its line (MTH-10)."""
    return F.when(origin > line_origin + up * height, "sup").when(origin < line_origin - down * height, "sub")
