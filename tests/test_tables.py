from pyspark.sql import functions as F

from datasheaf.operators import tables
from datasheaf.sources import html, sinks

PAGE = """<html><body><p>lost</p><h2>Pins</h2><p>A <b class="x">bold</b> <span>word</span><br/></p>
<table><caption><b>Table 1.</b> Functions</caption>
<tr><th rowspan="2">Port</th><th>AF0</th><th colspan="2">AF1</th></tr><tr><th>SYS</th><th>TIM1</th><th>TIM2</th></tr>
<tr><td>PA0</td><td>-</td><td>CH1</td><td>CH2</td></tr><tr><td rowspan="2">PA1</td><td>x</td><td colspan="2">both</td></tr><tr><td>y</td><td>a</td><td>b</td></tr>
</table><table><tr><td>(omitted)</td></tr></table><h2>End</h2></body></html>"""


def items(spark, page=PAGE):
    return html.items(spark.createDataFrame([("d", "c", page)], "doc string, chapter string, html string"))


def test_scan(spark):
    rows = items(spark).orderBy("item_no").collect()
    assert [(r.kind, r.html, r.heading) for r in rows] == [("heading", "Pins", None), ("text", "A <b>bold</b> word<br></br>", "Pins"), ("table", "", "Pins"), ("heading", "End", None)]
    assert rows[2].caption == "<b>Table 1.</b> Functions"
    assert html.scan("") == [] and [i[0] for i in html.scan("<p>a<br>b</p>")] == ["text"]
    assert html.scan("</td></p>stray<table><tr><td>1</table>")[0][0] == "table"


def test_grid_and_domains(spark):
    grid = tables.grid(items(spark)).cache()
    assert grid.count() == 4 * 5
    x = tables.domains_x(grid)
    assert [r.domain for r in x.orderBy("gx").collect()] == ["Port", "AF0:SYS", "AF1:TIM1", "AF1:TIM2"]
    y = tables.domains_y(grid, tables.domains_x(grid, "^port"))
    assert {(r.gy, r.domain) for r in y.collect()} == {(2, "PA0"), (3, "PA1"), (4, "PA1")}
    found = {(r.row_key, r.column_key): [c.html for c in r.cells] for r in tables.cross_lookup(grid, x, y).collect()}
    assert found["PA0", "AF1:TIM1"] == ["CH1"] and found["PA1", "AF1:TIM2"] == ["both", "b"] and found["PA1", "Port"] == ["PA1"]
    rows = tables.row_maps(tables.cell_rows(grid, x)).orderBy("gy").collect()
    assert rows[0].cells["AF0:SYS"] == ["-"]
    assert tables.cell_at(grid, 0, -1).first().html == "PA1"
    s = tables.sizes(grid).first()
    assert (s.width, s.height, s.header_rows, s.cells) == (4, 5, 2, 16)


def test_append(spark):
    top = tables.grid(items(spark)).cache()
    narrow = "<table><tr><th>Port</th><th>AF0</th></tr><tr><th></th><th>SYS</th></tr><tr><td>PA2</td><td>z</td></tr></table>"
    same = tables.grid(items(spark, PAGE)).cache()
    both = tables.append_bottom(top, same)
    assert both.agg(F.max("height")).first()[0] == 8 and both.count() == 4 * 8
    side = tables.append_side(top, same)
    assert side.count() == 8 * 5 and side.first().width == 8
    apart = tables.append_bottom(top, tables.grid(items(spark, narrow)).withColumn("table_id", F.lit(top.first().table_id)))
    assert apart.count() == top.count()


def test_written_table_reads_back(spark):
    grid = tables.grid(items(spark)).cache()
    again = tables.grid(html.items(sinks.table_html(grid).select(F.lit("d").alias("doc"), F.lit("c").alias("chapter"), "html")))
    columns = ["gx", "gy", "html", "is_header", "header_rows"]
    assert sorted(map(tuple, grid.select(columns).collect())) == sorted(map(tuple, again.select(columns).collect()))


def test_virtual(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    grid = tables.virtual(rows, F.lit("t"), [F.col("n"), F.col("s")], ["N", "S"], "n")
    assert {(r.gx, r.gy): r.html for r in grid.collect()} == {(0, 0): "N", (1, 0): "S", (0, 1): "1", (1, 1): "a", (0, 2): "2", (1, 2): "b"}
