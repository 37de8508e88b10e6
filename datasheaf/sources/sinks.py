"""Writers: HTML tables and documents, graph tables, search reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datasheaf.operators.trees import GRAPH_SCHEMA


def _in_order(key: Column, value: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), value.alias("v")))), lambda x: x["v"]), "")


def table_html(grid: DataFrame) -> DataFrame:
    """(table_id, html) of grids (SNK-03): spans, header cells, the last header row and left-aligned cells marked by class."""
    own = grid.groupBy("table_id", "cell_id", "is_header", "html", "header_rows").agg(F.min("gx").alias("x"), F.min("gy").alias("y"), (F.max("gx") - F.min("gx") + 1).alias("w"), (F.max("gy") - F.min("gy") + 1).alias("h"))
    tag = F.when(F.col("is_header"), "th").otherwise("td")
    spans = F.concat(F.when(F.col("w") > 1, F.concat(F.lit(' colspan="'), F.col("w").cast("string"), F.lit('"'))).otherwise(""), F.when(F.col("h") > 1, F.concat(F.lit(' rowspan="'), F.col("h").cast("string"), F.lit('"'))).otherwise(""))
    last = F.when(F.col("is_header") & (F.col("y") + F.col("h") == F.col("header_rows")), ' class="thb"').otherwise("")
    cell = F.concat(F.lit("<"), tag, spans, last, F.lit(">"), F.coalesce("html", F.lit("")), F.lit("</"), tag, F.lit(">"))
    rows = own.groupBy("table_id", "y").agg(_in_order(F.col("x"), cell).alias("cells"))
    return rows.groupBy("table_id").agg(F.concat(F.lit("<table>"), _in_order(F.col("y"), F.concat(F.lit("<tr>"), "cells", F.lit("</tr>"))), F.lit("</table>")).alias("html"))


#: Tag of each kind of block; levels of headings are added.
TAGS = {"paragraph": "p", "note": "div", "caption": "p", "bit": "p", "list_bullet": "li", "list_number": "li", "list_letter": "li"}


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def document_html(blocks: DataFrame) -> DataFrame:
    """(doc, html) of blocks in order (SNK-02). A figure is only a placeholder (SNK-04)."""
    table = F.create_map(*[F.lit(x) for kv in TAGS.items() for x in kv])
    tag = F.when(F.col("kind") == "heading", F.concat(F.lit("h"), F.least(F.greatest("level", F.lit(1)), F.lit(6)).cast("string"))).otherwise(F.coalesce(F.try_element_at(table, F.col("kind")), F.lit("p")))
    one = F.when(F.col("kind") == "figure", F.lit("<table><tr><td>(omitted)</td></tr></table>")).otherwise(F.concat(F.lit("<"), tag, F.lit(">"), escaped(F.coalesce("text", F.lit(""))), F.lit("</"), tag, F.lit(">")))
    return blocks.groupBy("doc").agg(F.concat(F.lit("<!DOCTYPE html><html><body>"), _in_order(F.col("position"), one), F.lit("</body></html>")).alias("html"))


def rich_text(chars: DataFrame, by: list[str], order: str = "char") -> DataFrame:
    """(by, html) of glyphs with flags bold, italic, underline and script (SNK-05): runs of equal format, tags nested in fixed order."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(order)
    key = F.struct("bold", "italic", "underline", "script")
    runs = chars.withColumn("__c", (~key.eqNullSafe(F.lag(key).over(w))).cast("int")).withColumn("run", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    text = escaped(_in_order(F.col(order), F.col("ch")))
    run = runs.groupBy(*by, "run", "bold", "italic", "underline", "script").agg(text.alias("text"))
    out = F.col("text")
    out = F.when(F.col("script").isNotNull(), F.concat(F.lit("<"), "script", F.lit(">"), out, F.lit("</"), "script", F.lit(">"))).otherwise(out)
    for flag, tag in (("underline", "u"), ("italic", "i"), ("bold", "b")):
        out = F.when(F.col(flag), F.concat(F.lit(f"<{tag}>"), out, F.lit(f"</{tag}>"))).otherwise(out)
    return run.groupBy(*by).agg(F.replace(_in_order(F.col("run"), out), F.lit("\n"), F.lit("<br>")).alias("html"))


def write_graph(tables: dict[str, DataFrame], path: str, overwrite: bool = True) -> None:
    """A folder of CSV files for each node and edge table, rows in fixed order (SNK-06, SRT-06)."""
    for name, df in tables.items():
        df.sortWithinPartitions(*df.columns).write.mode("overwrite" if overwrite else "errorifexists").csv(f"{path}/{name}", header=True)


def read_graph(spark: SparkSession, path: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The same back, with fixed types (SRC-24)."""
    return {n: spark.read.schema(GRAPH_SCHEMA[n]).csv(f"{path}/{n}", header=True) for n in names or GRAPH_SCHEMA}


def search_report(found: DataFrame, query: str) -> DataFrame:
    """(doc, html) of tables found, under their chapters (SNK-11). ``found``: doc, chapter, item_no, caption, html."""
    one = F.concat(F.lit("<h3>"), escaped(F.coalesce("caption", F.lit(""))), F.lit("</h3>"), "html")
    chapters = found.groupBy("doc", "chapter").agg(F.concat(F.lit("<h2>"), escaped(F.first("chapter")), F.lit("</h2>"), _in_order(F.col("item_no"), one)).alias("part"))
    return chapters.groupBy("doc").agg(F.concat(F.lit("<h1>"), escaped(F.first("doc")), F.lit("</h1><p>"), escaped(F.lit(query)), F.lit("</p>"), _in_order(F.col("chapter"), F.col("part"))).alias("html"))
