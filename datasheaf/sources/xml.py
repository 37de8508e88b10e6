"""XML scans: files as rows of elements, XPath queries, register descriptions in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datasheaf.functions.text import number_of


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, xml) of whole files, the default namespace taken off the root (SRC-18)."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), strip_namespace(F.col("value")).alias("xml"))


def strip_namespace(xml: Column) -> Column:
    """Without the first default xmlns, which would hide every name from a query."""
    return F.regexp_replace(xml, r"""(?s)^(.*?)\sxmlns\s*=\s*(?:"[^"]*"|'[^']*')""", "$1")


def query(xml: Column, path: str) -> Column:
    """Strings an XPath finds, each once, in order; a null document has none (SRC-19)."""
    return F.coalesce(F.array_distinct(F.xpath(xml, F.lit(path))), F.array().cast("array<string>"))


def read_rows(spark: SparkSession, path: str, row: str, schema: str | None = None) -> DataFrame:
    """Elements of a name as rows, by the built-in reader, which splits large files."""
    reader = spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", True)
    return (reader.schema(schema) if schema else reader).load(path)


def devices(families: DataFrame, family: str | None = None, prefix: str | None = None, ignored: tuple[str, ...] = ()) -> DataFrame:
    """Sorted distinct devices of a family list (family, device), by exact family or by prefix, without ignored prefixes (SRC-28)."""
    out = families if family is None else families.filter(F.col("family") == family)
    out = out if prefix is None else out.filter(F.startswith(F.col("device"), F.lit(prefix)))
    for p in ignored:
        out = out.filter(~F.startswith(F.col("device"), F.lit(p)))
    return out.select("device").distinct().orderBy("device")


PERIPHERAL = (
    "_derivedFrom string, name string, description string, baseAddress string, "
    "interrupt array<struct<name: string, value: string>>, "
    "registers struct<register: array<struct<name: string, description: string, addressOffset: string, size: string, "
    "fields: struct<field: array<struct<name: string, bitOffset: string, bitWidth: string>>>>>>"
)


def read_registers(spark: SparkSession, path: str) -> DataFrame:
    """(peripheral, type, address, register, offset, width_bytes, field, position, width_bits) of a register description (SRC-22). A derived peripheral names its type; sizes in bits become bytes."""
    p = read_rows(spark, path, "peripheral", PERIPHERAL)
    p = p.select(F.col("name").alias("peripheral"), F.col("_derivedFrom").alias("type"), number_of("baseAddress").alias("address"), F.explode_outer("registers.register").alias("r"))
    p = p.select("peripheral", "type", "address", F.col("r.name").alias("register"), number_of("r.addressOffset").alias("offset"), (number_of("r.size") / 8).cast("int").alias("width_bytes"), F.explode_outer("r.fields.field").alias("f"))
    return p.select("peripheral", "type", "address", "register", "offset", "width_bytes", F.col("f.name").alias("field"), number_of("f.bitOffset").cast("int").alias("position"), number_of("f.bitWidth").cast("int").alias("width_bits"))


def _hex(value: Column, digits: int = 0) -> Column:
    return F.concat(F.lit("0x"), F.lpad(F.hex(value), digits, "0") if digits else F.hex(value))


def _element(name: str, *content: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), *content, F.lit(f"</{name}>"))


def _text(name: str, value: Column) -> Column:
    safe = F.replace(F.replace(F.replace(value.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.when(value.isNull(), F.lit("")).otherwise(_element(name, safe))


def format_registers(rows: DataFrame, device: str = "device") -> DataFrame:
    """(device, xml): the register description of each device (SNK-01), elements ordered by address, offset, position; sizes in bits, addresses in hex."""
    field = F.when(F.col("field").isNotNull(), _element("field", _text("name", F.col("field")), _text("bitOffset", F.col("position")), _text("bitWidth", F.col("width_bits")))).otherwise("")

    def ordered(key: Column, xml: str | Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), (F.col(xml) if isinstance(xml, str) else xml).alias("x")))), lambda e: e["x"]), "")

    regs = rows.groupBy(device, "peripheral", "type", "address", "register", "offset", "width_bytes").agg(ordered(F.col("position"), field).alias("fields"))
    inner = F.when(F.col("fields") != "", _element("fields", F.col("fields"))).otherwise("")
    register = F.when(F.col("register").isNotNull(), _element("register", _text("name", F.col("register")), _text("addressOffset", _hex(F.col("offset"))), _text("size", F.col("width_bytes") * 8), inner)).otherwise("")
    periph = regs.groupBy(device, "peripheral", "type", "address").agg(ordered(F.struct("offset", "register"), register).alias("regs"))
    start = F.when(F.col("type").isNotNull(), F.concat(F.lit('<peripheral derivedFrom="'), "type", F.lit('">'))).otherwise("<peripheral>")
    body = F.when(F.col("regs") != "", _element("registers", F.col("regs"))).otherwise("")
    one = F.concat(start, _text("name", F.col("peripheral")), _text("baseAddress", _hex(F.col("address"), 8)), body, F.lit("</peripheral>"))
    all_ = periph.groupBy(device).agg(ordered(F.struct("address", "peripheral"), one).alias("peripherals"))
    return all_.select(device, F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?>'), _element("device", _text("name", F.col(device)), _element("peripherals", F.col("peripherals")))).alias("xml"))


def write_registers(rows: DataFrame, path: str, device: str = "device") -> None:
    """One folder a device, one file in it (SNK-01)."""
    format_registers(rows, device).repartition(device).write.mode("overwrite").partitionBy(device).text(path)


def file_devices(files: DataFrame) -> DataFrame:
    """(path, device, kind) of description files (SRC-23): the devices named in the description, and the file's class, given by its name's prefix."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    kind = F.when(F.startswith(name, F.lit("header_")), "hd").when(F.startswith(name, F.lit("cube_")), "cm").otherwise("rm")
    found = F.regexp_extract_all(F.regexp_extract("xml", r"(?s)<description>(.*?)</description>", 1), F.lit(r"(?i)stm32\w+"), F.lit(0))
    return files.select("path", F.explode(F.array_distinct(F.transform(found, F.lower))).alias("device"), kind.alias("kind"))


def device_files(pairs: DataFrame) -> DataFrame:
    """The same by device: one column a class."""
    return pairs.groupBy("device").pivot("kind", ["hd", "cm", "rm"]).agg(F.array_sort(F.collect_set("path")))
