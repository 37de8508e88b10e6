"""Trees and graphs as relations: nodes with materialised paths or parent keys, edges as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- graph ------------------------------------------------------------------


def merge_edges(edges: DataFrame, key: Sequence[str]) -> DataFrame:
    """Edges, each once (KG-02, JOI-17)."""
    return edges.select(*key).filter(" and ".join(f"{k} is not null" for k in key)).distinct()


def merge_nodes(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing nodes, and the new ones whose key is none of theirs (MERGE)."""
    return existing.unionByName(new.join(existing.select(*key), list(key), "left_anti").dropDuplicates(list(key)), allowMissingColumns=True)


#: Tables of the device graph, as DDL (KG-01).
GRAPH_SCHEMA = {
    "Device": "did string",
    "Package": "did string, name string",
    "Peripheral": "did string, name string, type string",
    "Signal": "did string, name string",
    "Pin": "did string, name string, port string, number smallint",
    "InterruptVector": "did string, position smallint, name string",
    "hasPin": "did string, package string, location string, pin string, type string, variant string",
    "hasSignal": "did string, peripheral string, signal string",
    "hasAlternateFunction": "did string, signal string, pin string, af_index smallint",
    "hasInterruptVector": "did string, peripheral string, position smallint",
}


def graph_of(device: DataFrame) -> dict[str, DataFrame]:
    """Graph tables of device rows (KG-02): did, packages array<struct<name, pins array<struct<location, pin, type, variant>>>>, signals array<struct<pin, peripheral, type, name, af>>."""
    pins = device.select("did", F.explode("packages").alias("p")).select("did", F.col("p.name").alias("package"), F.explode("p.pins").alias("x")).select("did", "package", "x.*")
    signals = device.select("did", F.explode("signals").alias("s")).select("did", "s.*")
    number = F.regexp_extract("pin", r"^P([A-K])(\d{1,2})", 2).try_cast("smallint")
    out = {
        "Device": device.select("did"),
        "Package": pins.select("did", F.col("package").alias("name")),
        "Peripheral": signals.select("did", F.col("peripheral").alias("name"), "type"),
        "Signal": signals.select("did", "name"),
        "Pin": pins.select("did", F.col("pin").alias("name"), F.lower(F.regexp_extract("pin", r"^P([A-K])\d", 1)).alias("port"), number.alias("number")),
        "hasPin": pins.select("did", "package", "location", "pin", "type", "variant"),
        "hasSignal": signals.select("did", "peripheral", F.col("name").alias("signal")),
        "hasAlternateFunction": signals.select("did", F.col("name").alias("signal"), "pin", F.coalesce("af", F.lit(-1)).cast("smallint").alias("af_index")),
    }
    return {k: v.distinct() for k, v in out.items()}


def interrupts_of(vectors: DataFrame, peripherals: DataFrame) -> DataFrame:
    """Edges from peripherals to the vectors whose name contains theirs (KG-03)."""
    return vectors.alias("v").join(peripherals.alias("p"), (F.col("v.did") == F.col("p.did")) & F.contains(F.col("v.name"), F.col("p.name"))).select("v.did", F.col("p.name").alias("peripheral"), "v.position").distinct()


def reachable(edges: DataFrame, start: DataFrame, src: str, dst: str, most: int) -> DataFrame:
    """(node, steps) within ``most`` steps of the start nodes (KG-04): one join and one aggregation a step."""
    known = start.select(F.col(start.columns[0]).alias("node")).distinct().withColumn("steps", F.lit(0))
    for n in range(1, most + 1):
        step = known.filter(F.col("steps") == n - 1).join(edges, F.col("node") == F.col(src)).select(F.col(dst).alias("node"), F.lit(n).alias("steps"))
        known = known.unionByName(step).groupBy("node").agg(F.min("steps").alias("steps"))
    return known


# ---- trees ------------------------------------------------------------------


def reverse_preorder(path: str, by: Sequence[str]) -> Column:
    """Place of a node when children come last to first, from 1 (TRE-01)."""
    return F.row_number().over(Window.partitionBy(*by).orderBy(F.col(path).desc()))


def find(nodes: DataFrame, condition: Column, depth: int | None = None, path: str = "path") -> DataFrame:
    """Nodes by a condition, to a depth (TRE-02)."""
    return nodes.filter(condition if depth is None else condition & (F.size(F.split(path, "/")) <= depth))


def same_tree(a: DataFrame, b: DataFrame) -> bool:
    """Both relations have the same rows as often (TRE-03)."""
    return not a.exceptAll(b).take(1) and not b.exceptAll(a).take(1)


def ordered_tree(registers: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows in emission order (SRT-01)."""
    return registers.orderBy(*by)


#: a, a+b*x, b*x+a, a-b*x, x: numbers in decimal or 0x notation.
_TERM = r"(?:0x[0-9a-fA-F]+|\d+)"


def affine(formula: Column) -> Column:
    """struct(a, b) of an affine formula a + b*x; null if it is none. Nothing is evaluated (MTH-07)."""
    text = F.regexp_replace(F.lower(formula), r"\s+", "")
    whole = text.rlike(rf"(?i)^[+-]?(?:{_TERM}|(?:{_TERM}\*)?x|x\*{_TERM})(?:[+-](?:{_TERM}|(?:{_TERM}\*)?x|x\*{_TERM}))*$")
    terms = F.regexp_extract_all(text, F.lit(rf"(?i)[+-]?(?:(?:{_TERM}\*)?x(?:\*{_TERM})?|{_TERM})"), F.lit(0))

    def number(t: Column) -> Column:
        digits = F.regexp_replace(t, r"[+*-]|x(?![0-9a-f])|(?<!0)x", "")
        plain = F.when(digits == "", F.lit(1)).when(F.startswith(digits, F.lit("0x")), F.conv(F.substring(digits, 3, 20), 16, 10).try_cast("bigint")).otherwise(digits.try_cast("bigint"))
        return F.when(F.startswith(t, F.lit("-")), -plain).otherwise(plain)

    has_x = lambda t: t.rlike(r"(?i)(?:^|[+*-])x(?:$|\*)")
    zero = F.lit(0).cast("bigint")
    a = F.aggregate(F.filter(terms, lambda t: ~has_x(t)), zero, lambda s, t: s + number(t))
    b = F.aggregate(F.filter(terms, has_x), zero, lambda s, t: s + number(t))
    return F.when(whole, F.struct(a.alias("a"), b.alias("b")))


def expand_registers(registers: DataFrame, formula: str, lo: str, hi: str, step: Column | int = 1) -> DataFrame:
    """A row for each x from lo to hi, with its offset (MTH-07)."""
    coefficients = affine(F.col(formula))
    out = registers.withColumn("__f", coefficients).filter(F.col("__f").isNotNull() & (F.col(lo) <= F.col(hi)))
    out = out.withColumn("x", F.explode(F.sequence(F.col(lo).cast("bigint"), F.col(hi).cast("bigint"), F.lit(step).cast("bigint") if not isinstance(step, Column) else step)))
    return out.withColumn("offset", F.col("__f.a") + F.col("__f.b") * F.col("x")).drop("__f")


def offset_list(text: Column) -> Column:
    """Offsets of ``0x10``, ``0x10-0x1C`` (every fourth byte) or ``0x10 or 0x20`` (MTH-07)."""
    clean = F.regexp_replace(F.lower(text), r"[–—]", "-")
    value = lambda t: F.conv(F.regexp_replace(F.trim(t), "^0x", ""), 16, 10).try_cast("bigint")
    ends = F.split(clean, "-")
    return (
        F.when(clean.rlike(r"^\s*0x[0-9a-f]+\s*-\s*0x[0-9a-f]+\s*$"), F.sequence(value(ends[0]), value(F.get(ends, F.lit(1))), F.lit(4).cast("bigint")))
        .when(clean.rlike(r"0x[0-9a-f]+"), F.transform(F.regexp_extract_all(clean, F.lit("0x[0-9a-f]+"), F.lit(0)), value))
        .otherwise(F.array().cast("array<bigint>"))
    )


def template_name(name: Column, i: Column) -> Column:
    """Name of the i-th register of an array: ``{i}`` or a lone x replaced, else .i added (MTH-07)."""
    return F.when(F.contains(name, F.lit("{i}")), F.replace(name, F.lit("{i}"), i.cast("string"))).when(name.rlike(r"(?<![a-zA-Z])x|x(?![a-zA-Z])"), F.regexp_replace(name, r"(?<![a-zA-Z])x|x(?![a-zA-Z])", i.cast("string"))).otherwise(F.concat(name, F.lit("."), i.cast("string")))


def instantiate(instances: DataFrame, types: DataFrame, type_column: str = "type") -> DataFrame:
    """Registers and fields of its type for each instance; instances of unknown types are dropped (TRE-08)."""
    return instances.join(types, type_column)


def inline_children(registers: DataFrame, parents: DataFrame, child: str, parent: str, address: str) -> DataFrame:
    """Registers of sub-peripherals as those of the peripheral before them (TRE-04, TRE-05): named by the child's last character, moved by the difference of the addresses.

    ``parents`` has child, parent and both addresses; each offset moves by its own
    child's difference, which doesn't add up over registers.
    """
    moved = registers.join(parents, F.col("peripheral") == F.col(child))
    return moved.select(F.col(parent).alias("peripheral"), F.concat(F.col("register"), F.right(F.col(child), F.lit(1))).alias("register"), (F.col("offset") + F.col(f"child_{address}") - F.col(f"parent_{address}")).alias("offset"))


def parent_by_address(peripherals: DataFrame, is_child: Column, name: str = "name", address: str = "address", by: Sequence[str] = ("did",)) -> DataFrame:
    """(by, child, parent, child_address, parent_address): the last peripheral at or below a child's address that is no child itself (WIN-01)."""
    w = Window.partitionBy(*by).orderBy(address, name).rowsBetween(Window.unboundedPreceding, 0)
    before = F.last(F.when(~is_child, F.struct(F.col(name).alias("n"), F.col(address).alias("a"))), ignorenulls=True).over(w)
    return peripherals.withColumn("__p", before).filter(is_child & F.col("__p").isNotNull()).select(*by, F.col(name).alias("child"), F.col("__p.n").alias("parent"), F.col(address).alias(f"child_{address}"), F.col("__p.a").alias(f"parent_{address}"))


def without_aliases(peripherals: DataFrame, suffix: str = "ext", name: str = "name") -> DataFrame:
    """Without peripherals that are another one with a suffix (TRE-06)."""
    bases = peripherals.select(F.concat(F.col(name), F.lit(suffix)).alias(name)).distinct()
    return peripherals.join(bases, name, "left_anti")


def without_duplicates(common: DataFrame, others: DataFrame, keys: Sequence[str] = ("name", "address")) -> DataFrame:
    """Common peripherals that aren't listed by name and address elsewhere (TRE-06, SET-05)."""
    return common.join(others.select(*keys).distinct(), list(keys), "left_anti")


def normalised(peripherals: DataFrame, registers: DataFrame, is_child: Column, suffix: str = "ext") -> DataFrame:
    """Registers of a header's peripherals in emission order (TRE-09): aliases out, sub-peripherals inlined into the ones before them, then by address, offset and name."""
    bases = without_aliases(peripherals, suffix)
    inner = parent_by_address(bases, is_child)
    moved = inline_children(registers, inner, "child", "parent", "address")
    own = registers.join(inner.select(F.col("child").alias("peripheral")), "peripheral", "left_anti").select("peripheral", "register", "offset")
    placed = own.unionByName(moved).join(bases.select(F.col("name").alias("peripheral"), "address"), "peripheral")
    return ordered_tree(placed, ["address", "offset", "register"])


def outline(nodes: DataFrame, path: str = "path", label: str = "name") -> DataFrame:
    """(line) of a tree, indented by depth, in path order (SNK-12)."""
    depth = F.size(F.split(path, "/")) - 1
    return nodes.orderBy(path).select(F.concat(F.repeat(F.lit("  "), depth), F.col(label)).alias("line"))


def synthesized(registers: DataFrame, channels: int, name: str, width: int = 4) -> DataFrame:
    """A type with one register a channel (TRE-07), added to the types."""
    spark = registers.sparkSession
    made = spark.range(channels).select(F.lit(name).alias("type"), F.format_string("C%dCR", F.col("id")).alias("register"), (F.col("id") * width).alias("offset"))
    return registers.unionByName(made, allowMissingColumns=True)
