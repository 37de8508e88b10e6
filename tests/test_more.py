import pytest
from pyspark.sql import functions as F

from datasheaf.functions import geometry
from datasheaf.operators import aggregates, filters, joins, layout, tables, trees
from datasheaf.plans import devices
from datasheaf.sources import catalogue, html, pdf


def test_lookups(spark):
    left = spark.createDataFrame([("ADC1", 16), ("TIM", 0)], "name string, address int")
    offsets = spark.createDataFrame([(1, "ADC[12]", 256), (2, "ADC", 512)], "ord int, pattern string, offset int")
    assert {r["name"]: r.address for r in joins.offset_lookup(left, offsets, "name", "pattern", ["name"]).collect()} == {"ADC1": 272, "TIM": 0}
    chapters = spark.createDataFrame([("chapter 12 timers",), ("1 intro",)], "chapter string")
    assert [r.chapter for r in filters.chapters_of(chapters, spark.createDataFrame([("12.3",)], "section string")).collect()] == ["chapter 12 timers"]
    p = spark.createDataFrame([("f4x",), ("f40x",), ("f405",)], "p string")
    assert [r.p for r in p.orderBy(filters.specificity("p")).collect()] == ["f405", "f40x", "f4x"]


def test_contents_and_text(spark):
    e = spark.createDataFrame([("d", 1, 5, 1, "A"), ("d", 2, 0, 2, "B"), ("d", 3, 5, 1, "A"), ("d", 4, 9, 1, "C")], "doc string, ord int, page int, level int, title string")
    assert [(r.page, r.title) for r in layout.contents(e).collect()] == [(5, "A"), (5, "B"), (9, "C")]
    g = spark.createDataFrame([(1, 2.0, "b"), (1, 1.0, "a")], "line int, x0 double, ch string")
    assert aggregates.content(g, ["line"]).first().text == "ab"
    boxes = spark.createDataFrame([(1.0, 0.0), (5.0, 9.0), (5.0, 1.0)], "y1 double, x0 double")
    assert [tuple(r) for r in boxes.orderBy(*filters.reading_order()).collect()] == [(5.0, 1.0), (5.0, 9.0), (1.0, 0.0)]
    r = spark.range(1).select(layout.page_template(F.lit("Acrobat 9"), [("Acrobat", "blue")], "plain").alias("t"), geometry.length(F.lit(1), F.lit(4)).alias("n")).first()
    assert r.t == "blue" and r.n == 3


def test_normalised_tree(spark):
    p = spark.createDataFrame([("d", "DMA1", 0x100), ("d", "DMA1_S0", 0x110), ("d", "I2S", 0x10), ("d", "I2Sext", 0x20)], "did string, name string, address bigint")
    regs = spark.createDataFrame([("DMA1", "ISR", 0), ("DMA1_S0", "CR", 0), ("I2S", "CR", 0), ("I2Sext", "CR", 0)], "peripheral string, register string, offset bigint")
    got = trees.normalised(p, regs, F.contains("name", F.lit("_S")))
    assert [(r.peripheral, r.register, r.offset) for r in got.collect()] == [("I2S", "CR", 0), ("DMA1", "ISR", 0), ("DMA1", "CR0", 16)]
    lines = trees.outline(spark.createDataFrame([("a", "a"), ("a/b", "b")], "path string, name string"))
    assert [r.line for r in lines.collect()] == ["a", "  b"]


def test_datasheets(spark, tmp_path):
    page = "<h1>P</h1><table><caption><b>Table 2</b> Alternate functions</caption><tr><td>1</td></tr></table>"
    items = html.items(spark.createDataFrame([("d", "c", page)], "doc string, chapter string, html string"))
    assert [(r.role, r.item_no) for r in devices.datasheet_tables(items).collect()] == [("alternate_functions", 1)]
    assert tables.captioned(items).filter("kind = 'table'").first().caption == "Table 2 Alternate functions"
    rows = spark.createDataFrame([("d", "WHO_AM_I", "0Fh", "R"), ("d", "Reserved", "10", ""), ("d", "CTRL", "0x20", "RW")], "doc string, name string, address string, access string")
    assert {(r.register, r.address) for r in devices.sensor_registers(rows).collect()} == {("WHO_AM_I", 15), ("CTRL", 32)}
    x = "<r><Parameter Name='Mode'><PossibleValue>A</PossibleValue></Parameter></r>"
    r = spark.createDataFrame([(x,)], "x string").select(devices.parameter(F.col("x"), "Mode").alias("a"), devices.parameter(F.col("x"), "No", "z").alias("b")).first()
    assert (r.a, r.b) == ("A", "z")
    made = []
    for _ in range(2):
        assert catalogue.cached(spark, f"{tmp_path}/c", lambda: made.append(1) or spark.range(3)).count() == 3
    assert len(made) == 1 and catalogue.roots("/x/")["html"] == "/x/html"


@pytest.mark.skipif(pdf.available(), reason="a PDF library is installed")
def test_pdf_is_optional(spark):
    with pytest.raises(ModuleNotFoundError):
        pdf.read_glyphs(spark, "none")
