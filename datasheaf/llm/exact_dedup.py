"""Exact deduplication by deterministic block naming.

The normalised text of a document is cut into blocks of a fixed number of
bytes. Distinct blocks are sorted and named by integers; then adjacent pairs of
names are named in the same way, level by level, until one name is left of each
document. Two documents have the same (number of blocks, name) exactly if their
texts are equal: no step trusts a hash to be free of collisions.

Shuffles: whole blocks are moved once, after a map-side combine, to be named;
from then on only fixed-width rows move. Occurrences find their block's name by
a 64-bit fingerprint. That is safe where the fingerprint belongs to one named
block only, which is counted; should two blocks ever share one, their
occurrences join on the block itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datasheaf.llm._common import SPACE, staged

#: Bytes in a block. Most documents are one block; a level halves the rest.
BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Integer names for distinct keys: their place in the sort of the partition that hashing gave them."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _block_names(blocks: DataFrame) -> tuple[DataFrame, bool]:
    """(fp, first and last name) of each fingerprint, and whether some fingerprint has two blocks."""
    names = _named(blocks.select("fp", "block").distinct(), ["fp", "block"])
    by_fp = staged(names.groupBy("fp").agg(F.min("name").alias("name"), F.max("name").alias("last")), "block-names")
    return by_fp, bool(by_fp.filter("name <> last").take(1))


def name_texts(rows: DataFrame, block_bytes: int = BLOCK_BYTES, fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Name the texts of ``rows`` (id, sha, body binary).

    Returns (id, sha, copies, blocks, name), one row for each distinct (id, sha);
    copies counts the rows that share them. (blocks, name) identifies the text.
    """
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / F.lit(block_bytes))).cast("int")
    cut = (
        rows.withColumn("blocks", count)
        .withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("block", F.expr(f"substring(body, pos * {block_bytes} + 1, {block_bytes})"))
        .withColumn("fp", fingerprint(F.col("block")))
    )
    by_fp, shared = _block_names(cut)
    if shared:
        full = staged(_named(cut.select("fp", "block").distinct(), ["fp", "block"]), "blocks")
        found = cut.join(full, ["fp", "block"])
    else:
        found = cut.drop("block").join(by_fp.drop("last"), "fp")
    level = staged(found.groupBy("id", "sha", "blocks", "pos").agg(F.max("name").alias("name"), F.count("*").alias("copies")), "level")

    width, done = F.col("blocks"), []
    most = level.agg(F.max("blocks")).first()[0] or 1
    while True:
        done.append(level.filter(width == 1))
        if most == 1:
            break
        half = F.floor(F.col("pos") / 2).cast("int")
        pairs = (
            level.filter(width > 1)
            .groupBy("id", "sha", "blocks", half.alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
                F.max("copies").alias("copies"),
            )
        )
        # a pair is named within its number of blocks: names of one level are only compared there
        pairs = staged(pairs, "pairs")
        names = staged(_named(pairs.select("left", "right").distinct(), ["left", "right"]), "pair-names")
        level = staged(pairs.join(names, ["left", "right"]).select("id", "sha", "blocks", "pos", "name", "copies"), "level")
        width, most = F.ceil(width / 2), (most + 1) // 2
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("id", "sha", "copies", "blocks", "name")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, fingerprint: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised texts the one with the smallest id is kept.
    Null texts are empty texts. A null id comes after all others; of repeated
    rows (same id and text) exactly one has ``kept``. Other columns of ``docs``
    aren't read, whatever their names. An empty table gives an empty result.
    """
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t")).select("id", F.unhex(F.sha2(F.col("t"), 256)).alias("sha"), F.col("t").cast("binary").alias("body"))
    named = staged(name_texts(rows, block_bytes, fingerprint), "identities")
    first = F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id")))
    # written before it is joined: AQE splits a hot group only where no aggregation stands in between
    groups = staged(named.groupBy("blocks", "name").agg(first.alias("first"), F.sum("copies").alias("group_size")), "groups")
    return (
        named.join(groups, ["blocks", "name"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(
            F.col("id").alias("doc_id"),
            F.col("first.id").alias("keep_id"),
            "group_size",
            (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact_groups keeps, with all their columns, whatever their names.

    Null texts are empty texts; a null id comes after all others; of repeated
    rows one stays; no rows give no rows. Documents to drop are fewer than those
    to keep, so they are what is joined; texts cross the network only if even
    those are too many to broadcast.
    """
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    found = staged(exact_groups(docs, id_col, text_col).select(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("sha"), "kept"), "verdicts")
    kept, dropped = found.filter("kept").drop("kept"), found.filter("not kept").drop("kept").distinct()
    again = dropped.join(kept, dropped["id"].eqNullSafe(kept["id"]) & (dropped["sha"] == kept["sha"]), "left_semi")
    # rows that repeat one that stays
    repeated = staged(again.select(F.col("id").alias("other"), F.col("sha").alias("other_sha")), "repeated")
    gone = dropped.join(repeated, dropped["id"].eqNullSafe(repeated["other"]) & (dropped["sha"] == repeated["other_sha"]), "left_anti")
    out = numbered.withColumn("own", F.unhex(F.sha2(normalised(F.col(text)), 256)))
    out = out.join(gone, out[own_id].eqNullSafe(gone["id"]) & (out["own"] == gone["sha"]), "left_anti")
    return (out.dropDuplicates([own_id, "own"]) if repeated.take(1) else out).drop("own").toDF(*docs.columns)
