"""C headers: defines, enumerations and register structures, and constant expressions without a compiler.

Text functions find the declarations. Expressions are read by a small parser
that knows numbers, names, casts and C's integer operators; a name stands for
its own define, so all defines of one header are solved together, in the group
of that header.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from datasheaf.checks import unique


def read_headers(spark: SparkSession, path: str, substitutions: Mapping[str, str] | None = None) -> DataFrame:
    """(header, text) of whole files after regular substitutions (SRC-20)."""
    text = F.col("value")
    for pattern, value in (substitutions or {}).items():
        text = F.regexp_replace(text, pattern, value)
    return spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("header"), text.alias("text"))


def without_comments(text: str = "text"):
    """Comments out, continued lines joined."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"(?s)/\*.*?\*/", " "), r"//[^\n]*", ""), r"\\\r?\n", " ")


def defines(headers: DataFrame) -> DataFrame:
    """(header, line_no, name, expr) of object-like macros, in order."""
    lines = headers.select("header", F.posexplode(F.split(without_comments(), r"\r?\n")).alias("line_no", "line"))
    pattern = r"^\s*#\s*define\s+(\w++)(?!\()\s*(.*?)\s*$"
    return lines.filter(F.col("line").rlike(pattern)).select("header", "line_no", F.regexp_extract("line", pattern, 1).alias("name"), F.regexp_extract("line", pattern, 2).alias("expr"))


def read_map(spark: SparkSession, path: str, pattern: str, ignore_duplicates: bool = False) -> DataFrame:
    """(name, value) of lines the pattern (two groups) is found in (SRC-21). A name that comes twice fails, or else its last line counts."""
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id()).filter(F.col("value").rlike(pattern))
    found = lines.select(F.regexp_extract("value", pattern, 1).alias("name"), F.regexp_extract("value", pattern, 2).alias("id"), "line_no")
    if not ignore_duplicates:
        unique(found, "name")
    return found.groupBy("name").agg(F.max_by("id", "line_no").alias("value"))


def enumerations(headers: DataFrame) -> DataFrame:
    """(header, enum, position, name, value): enumerators, counted on from the last explicit number (DOM-06)."""
    body = r"(?s)typedef\s+enum\s*\w*\s*\{([^}]*)\}\s*(\w+)\s*;"
    text = without_comments()
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(body), F.lit(1)).alias("b"), F.regexp_extract_all(text, F.lit(body), F.lit(2)).alias("n"))
    e = headers.select("header", F.explode(both).alias("e")).select("header", F.col("e.n").alias("enum"), F.posexplode(F.filter(F.split("e.b", ","), lambda x: F.trim(x) != "")).alias("position", "item"))
    item = r"(?s)^\s*(\w+)\s*(?:=\s*(-?\w+))?\s*$"
    e = e.select("header", "enum", "position", F.regexp_extract("item", item, 1).alias("name"), F.regexp_extract("item", item, 2).alias("given"))
    value = F.when(F.col("given").rlike("^0x"), F.conv(F.substring("given", 3, 20), 16, 10).try_cast("bigint")).otherwise(F.col("given").try_cast("bigint"))
    w = Window.partitionBy("header", "enum").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("given") != "", F.struct(value.alias("v"), F.col("position").alias("p"))), ignorenulls=True).over(w)
    return e.withColumn("__l", last).select("header", "enum", "position", "name", F.coalesce(F.col("__l.v") + F.col("position") - F.col("__l.p"), F.col("position").cast("bigint")).alias("value"))


def interrupts(enums: DataFrame) -> DataFrame:
    """(header, position, name) of the interrupt enumeration, exceptions left out (DOM-06)."""
    return enums.filter(F.col("enum").rlike("^IRQn") & (F.col("value") >= 0)).select("header", F.col("value").cast("smallint").alias("position"), F.regexp_replace("name", "_IRQn$", "").alias("name"))


TYPES = {"uint8_t": 1, "int8_t": 1, "uint16_t": 2, "int16_t": 2, "uint32_t": 4, "int32_t": 4, "uint64_t": 8}


def struct_members(headers: DataFrame) -> DataFrame:
    """(header, struct, position, name, size, count, reserved, offset) of register structures: offsets are the sizes before (WIN-07), arrays count as often (ARR-03)."""
    body = r"(?s)typedef\s+struct\s*\w*\s*\{([^{}]*)\}\s*(\w+)\s*;"
    text = without_comments()
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(body), F.lit(1)).alias("b"), F.regexp_extract_all(text, F.lit(body), F.lit(2)).alias("n"))
    s = headers.select("header", F.explode(both).alias("e")).select("header", F.col("e.n").alias("struct"), F.posexplode(F.filter(F.split("e.b", ";"), lambda x: F.trim(x) != "")).alias("position", "line"))
    line = r"(?s)^\s*(?:__IOM?|__IM?|__OM?|volatile|const|\s)*(\w+)\s+(\w+)\s*(?:\[\s*(\w+)\s*\])?\s*$"
    sizes = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    n = F.regexp_extract("line", line, 3)
    count = F.when(n == "", F.lit(1)).when(F.startswith(n, F.lit("0x")), F.conv(F.regexp_extract(n, "^0x([0-9a-fA-F]+)", 1), 16, 10).try_cast("int")).otherwise(F.regexp_extract(n, r"^(\d+)", 1).try_cast("int"))
    m = s.filter(F.col("line").rlike(line)).select("header", "struct", "position", F.regexp_extract("line", line, 2).alias("name"), F.coalesce(F.try_element_at(sizes, F.regexp_extract("line", line, 1)), F.lit(4)).alias("size"), F.coalesce(count, F.lit(1)).alias("count"))
    w = Window.partitionBy("header", "struct").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return m.withColumn("reserved", F.lower("name").rlike("^_?(?:reserved|res)")).withColumn("offset", F.sum(F.col("size") * F.col("count")).over(w) - F.col("size") * F.col("count"))


def expanded_members(members: DataFrame) -> DataFrame:
    """A row for each register: array members as name.0, name.1 and so on, reserved ones left out (ARR-03)."""
    i = F.explode(F.sequence(F.lit(0), F.col("count") - 1))
    out = members.filter("not reserved and count > 0").withColumn("i", i)
    name = F.when(F.col("count") > 1, F.concat("name", F.lit("."), F.col("i").cast("string"))).otherwise(F.col("name"))
    return out.withColumn("name", name).withColumn("offset", F.col("offset") + F.col("i") * F.col("size")).drop("i", "count", "reserved", "position")


def fields_of(registers: DataFrame, values: DataFrame) -> DataFrame:
    """Bit fields of registers from ``PERI_REG_FIELD_Pos`` and ``_Msk`` defines (JOI-13): both must be there; the width is the mask's length from its position (MTH-05)."""
    pos = values.filter(F.endswith(F.col("name"), F.lit("_Pos"))).select("header", F.regexp_replace("name", "_Pos$", "").alias("full"), F.col("value").alias("position"))
    msk = values.filter(F.endswith(F.col("name"), F.lit("_Msk"))).select("header", F.regexp_replace("name", "_Msk$", "").alias("full"), F.col("value").alias("mask"))
    both = pos.join(msk, ["header", "full"])
    prefix = F.concat(F.regexp_replace("struct", "_TypeDef$", ""), F.lit("_"), F.regexp_replace("name", r"\.\d+$", ""), F.lit("_"))
    keyed = registers.withColumn("prefix", prefix)
    lengths = [r[0] for r in keyed.select(F.length("prefix").alias("n")).distinct().orderBy("n").collect()]
    if not lengths:
        lengths = [1]
    tried = F.array_compact(F.array(*[F.when(F.length("full") > k, F.left(F.col("full"), F.lit(k))) for k in lengths]))
    found = both.withColumn("prefix", F.explode(tried)).join(keyed, ["header", "prefix"])
    shifted = F.call_function("shiftright", F.col("mask"), F.col("position").cast("int"))
    return found.select("header", "struct", F.col("name").alias("register"), "offset", F.expr("substr(full, length(prefix) + 1)").alias("field"), F.col("position").cast("int").alias("position"), F.length(F.bin(shifted)).alias("width"))


# ---- constant expressions ----------------------------------------------------

_TOKEN = re.compile(r"\s*(?:(0[xX][0-9a-fA-F]+|0[bB][01]+|\d+)([uUlL]*)|(\w+)|(<<|>>|<=|>=|==|!=|&&|\|\||[-+*/%&|^~!()<>?:]))")
_LEVELS = (("||",), ("&&",), ("|",), ("^",), ("&",), ("==", "!="), ("<", ">", "<=", ">="), ("<<", ">>"), ("+", "-"), ("*", "/", "%"))
_CASTS = frozenset((*TYPES, "int", "unsigned", "long", "char", "short", "signed"))
DEEPEST = 100


class NotConstant(ValueError):
    """The text is no constant integer expression."""


def evaluate(text: str, names: Mapping[str, str], known: dict[str, int | None] | None = None, depth: int = 0) -> int:
    """Value of a C integer expression; a name stands for the expression that ``names`` has for it (DOM-07)."""
    known = {} if known is None else known
    tokens, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise NotConstant(text)
        tokens.append(("n", m[1]) if m[1] else ("w", m[3]) if m[3] else ("o", m[4]))
        at = m.end()
        while at < len(text) and text[at].isspace():
            at += 1
    if not tokens or depth > DEEPEST:
        raise NotConstant(text)
    place = 0

    def peek() -> tuple[str, str] | None:
        return tokens[place] if place < len(tokens) else None

    def take() -> tuple[str, str]:
        nonlocal place
        if place >= len(tokens):
            raise NotConstant(text)
        place += 1
        return tokens[place - 1]

    def name(word: str) -> int:
        if word not in known:
            if word not in names:
                raise NotConstant(word)
            known[word] = None  # while it is being solved: a circle is no constant
            known[word] = evaluate(names[word], names, known, depth + 1)
        value = known[word]
        if value is None:
            raise NotConstant(word)
        return value

    def unary() -> int:
        kind, t = take()
        if kind == "n":
            return int(t, 0) if not (t.startswith("0") and t.isdigit() and len(t) > 1) else int(t, 8)
        if kind == "w":
            return name(t)
        if t in "+-~!":
            v = unary()
            return {"+": v, "-": -v, "~": ~v & 0xFFFFFFFF, "!": int(not v)}[t]
        if t != "(":
            raise NotConstant(text)
        words = []
        while peek() and peek()[0] == "w" and peek()[1] in _CASTS:
            words.append(take()[1])
        if words:
            if take()[1] != ")":
                raise NotConstant(text)
            size = TYPES.get(words[0], 4)
            return unary() & ((1 << 8 * size) - 1)
        v = conditional()
        if take()[1] != ")":
            raise NotConstant(text)
        return v

    def binary(level: int) -> int:
        if level == len(_LEVELS):
            return unary()
        v = binary(level + 1)
        while peek() and peek()[0] == "o" and peek()[1] in _LEVELS[level]:
            op, w = take()[1], binary(level + 1)
            if op in "/%" and w == 0 or op in ("<<", ">>") and not 0 <= w < 64:
                raise NotConstant(text)
            v = {
                "||": lambda: int(bool(v or w)), "&&": lambda: int(bool(v and w)), "|": lambda: v | w, "^": lambda: v ^ w, "&": lambda: v & w, "==": lambda: int(v == w), "!=": lambda: int(v != w),
                "<": lambda: int(v < w), ">": lambda: int(v > w), "<=": lambda: int(v <= w), ">=": lambda: int(v >= w), "<<": lambda: v << w, ">>": lambda: v >> w, "+": lambda: v + w, "-": lambda: v - w,
                "*": lambda: v * w, "/": lambda: int(v / w) if abs(v) < 1 << 53 else v // w, "%": lambda: v % w,
            }[op]()
        return v

    def conditional() -> int:
        v = binary(0)
        if peek() == ("o", "?"):
            take()
            a = conditional()
            if take()[1] != ":":
                raise NotConstant(text)
            b = conditional()
            return a if v else b
        return v

    out = conditional()
    if place != len(tokens):
        raise NotConstant(text)
    return out


def evaluated(rows: DataFrame) -> DataFrame:
    """(header, line_no, name, value) of the defines that are constant (DOM-07); of a name that is defined twice the last counts. A group is one header."""

    def header(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("line_no")
        names, known, out = dict(zip(group["name"], group["expr"], strict=True)), {}, []
        for r in group.drop_duplicates("name", keep="last").itertuples(index=False):
            try:
                value = evaluate(r.expr, names, known)
            except (NotConstant, RecursionError):
                continue
            if -(1 << 63) <= value < 1 << 63:
                out.append((r.header, r.line_no, r.name, value))
        return pd.DataFrame(out, columns=["header", "line_no", "name", "value"])

    return rows.groupBy("header").applyInPandas(header, "header string, line_no int, name string, value bigint")
