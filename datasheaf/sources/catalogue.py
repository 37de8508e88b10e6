"""Document catalogues as JSON, and their synchronisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datasheaf.operators.filters import new_only

CATALOGUE = "title string, localizedDescriptions struct<en: string>, localizedLinks struct<en: string>, version string, latestUpdate string, resourceType string"
DOCUMENTS = "type string, name string, short_type string, description string, link string, version string, updated string, filename string"


def _documents(rows: DataFrame, base_url: str) -> DataFrame:
    """Projection of catalogue rows (SRC-05): short type is the name's first two characters; a version's ``.0`` parts are dropped wherever they stand, as the archive's file names have it."""
    version = F.replace(F.coalesce("version", F.lit("")), F.lit(".0"))
    link = F.col("localizedLinks.en")
    return rows.select(
        F.col("resourceType").alias("type"), F.col("title").alias("name"), F.left("title", F.lit(2)).alias("short_type"), F.col("localizedDescriptions.en").alias("description"),
        F.when(link.rlike("^https?://"), link).otherwise(F.concat(F.lit(base_url), link)).alias("link"), version.alias("version"), F.col("latestUpdate").alias("updated"), F.concat("title", F.lit("-v"), version, F.lit(".pdf")).alias("filename"),
    )


def read_remote(spark: SparkSession, paths: list[str], base_url: str = "") -> DataFrame:
    """All rows of the categories' catalogue files, each an object with ``rows`` (SRC-03)."""
    found = spark.read.schema(_rows_schema()).json(paths, multiLine=True)
    return _documents(found.select(F.explode("rows").alias("r")).select("r.*"), base_url)


def _rows_schema():
    from pyspark.sql.types import ArrayType, StructField, StructType, _parse_datatype_string

    return StructType([StructField("rows", ArrayType(_parse_datatype_string(CATALOGUE)))])


def read_local(spark: SparkSession, path: str) -> DataFrame:
    """A stored catalogue; a missing one is empty (SRC-04)."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], DOCUMENTS)
    return spark.read.schema(DOCUMENTS).json(path)


def write(documents: DataFrame, path: str) -> None:
    """One file, by title and version (SNK-07). A catalogue has some thousands of rows."""
    documents.orderBy("name", "version").coalesce(1).write.mode("overwrite").json(path)


def to_fetch(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Documents that aren't stored yet, by file name (SET-01)."""
    return new_only(remote, local, "filename")


def all_known(remote: DataFrame, local: DataFrame) -> DataFrame:
    """Both catalogues, each document once (SET-03)."""
    return remote.unionByName(local).dropDuplicates(["filename"])


def cached(spark: SparkSession, path: str, make) -> DataFrame:
    """A table made once (SRC-26): read if it is there, else made, written and read."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def roots(base: str) -> dict[str, str]:
    """Folders of a library, all under one root (SRC-27)."""
    return {name: f"{base.rstrip('/')}/{name}" for name in ("archive", "html", "cache", "patches", "registers", "graph")}


def classified(headings: DataFrame) -> DataFrame:
    """(doc, class) of a document library (SRC-25): datasheet, sensor or manual by the name and the first heading; others are left out."""
    name, head = F.col("doc"), F.coalesce(F.col("heading"), F.lit(""))
    kind = F.when(F.startswith(name, F.lit("DS")) & F.contains(head, F.lit("STM32")), "datasheet").when(F.startswith(name, F.lit("DS")), "sensor").when(F.startswith(name, F.lit("RM")), "manual")
    return headings.select("doc", kind.alias("class")).filter("class is not null")


def quarantined(files: DataFrame, sound: Column) -> tuple[DataFrame, DataFrame]:
    """Sound files, and those to set aside (SNK-10)."""
    ok = F.coalesce(sound, F.lit(False))
    return files.filter(ok), files.filter(~ok)


def patched(cells: DataFrame, patches: DataFrame, doc: str = "doc", version: str = "version", key: str = "cell", value: str = "html") -> DataFrame:
    """Values with overrides: one for the document's version beats one for the document, which beats the original (SNK-09). ``patches``: doc, version or null, key, patch."""
    exact = patches.filter(F.col(version).isNotNull()).withColumnRenamed("patch", "__exact")
    general = patches.filter(F.col(version).isNull()).drop(version).withColumnRenamed("patch", "__general")
    out = cells.join(exact, [doc, version, key], "left").join(general, [doc, key], "left")
    return out.withColumn(value, F.coalesce("__exact", "__general", value)).drop("__exact", "__general")
