"""Jobs: python -m datasheaf JOB ... (CLI-01 to CLI-07)

    tables   HTML_FOLDER OUT              scanned tables as grids (Parquet)
    search   HTML_FOLDER OUT [--doc --chapter --caption]   tables found, as HTML by document
    headers  HEADERS OUT                  memory maps of C headers (Parquet), and register descriptions (XML)
    registers XML OUT                     register descriptions as rows (Parquet)
    sync     REMOTE_JSON LOCAL OUT        catalogue rows that aren't stored yet
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from datasheaf.functions.text import replace_subs
from datasheaf.operators import filters, tables
from datasheaf.plans import devices
from datasheaf.sources import catalogue, cheader, html, sinks, xml


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "tables":
        tables.grid(html.items(html.read_folder(spark, args.source))).write.mode("overwrite").parquet(args.out)
    elif args.job == "search":
        items = html.items(html.read_folder(spark, args.source)).filter("kind = 'table'").withColumn("caption", replace_subs("caption"))
        found = filters.search_tables(items, args.doc, args.chapter, args.caption)
        named = found.select(F.concat_ws("#", "doc", "chapter", F.col("item_no").cast("string")).alias("table_id"), "doc", "chapter", "item_no", "caption")
        report = sinks.search_report(named.join(sinks.table_html(tables.grid(found)), "table_id"), f"{args.doc} {args.chapter or ''} {args.caption or ''}")
        report.repartition("doc").write.mode("overwrite").partitionBy("doc").text(args.out)
    elif args.job == "headers":
        maps = devices.header_map(cheader.read_headers(spark, args.source))
        maps.write.mode("overwrite").parquet(f"{args.out}/maps")
        rows = spark.read.parquet(f"{args.out}/maps").select(F.col("header").alias("device"), "peripheral", F.lit(None).cast("string").alias("type"), "address", "register", "offset", F.lit(4).alias("width_bytes"), "field", "position", F.col("width").alias("width_bits"))
        xml.write_registers(rows, f"{args.out}/xml")
    elif args.job == "registers":
        xml.read_registers(spark, args.source).write.mode("overwrite").parquet(args.out)
    else:
        catalogue.write(catalogue.to_fetch(catalogue.read_remote(spark, [args.source]), catalogue.read_local(spark, args.local)), args.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="datasheaf", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = p.add_subparsers(dest="job", required=True)
    for name in ("tables", "search", "headers", "registers", "sync"):
        j = jobs.add_parser(name)
        j.add_argument("source")
        if name == "sync":
            j.add_argument("local")
        j.add_argument("out")
        if name == "search":
            j.add_argument("--doc", default="*")
            j.add_argument("--chapter")
            j.add_argument("--caption")
    return p


if __name__ == "__main__":
    run(SparkSession.builder.appName("datasheaf").getOrCreate(), parser().parse_args())
