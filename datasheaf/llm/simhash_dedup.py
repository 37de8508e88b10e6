"""Near-duplicates by SimHash with deletion-variant signatures.

Fingerprints of 64 bits link if they differ in at most ``distance`` bits. A
fingerprint is cut into so few segments that of two linked ones some segment
differs by one bit at most (2 segments of 32 for distance 2). Each segment is
indexed under its one-wildcard variants: one bit left out, its place kept in the
key. Segments that are equal or differ in one bit share a variant, so an
equality join finds all links; each candidate is verified on all 64 bits, and
counted only under the first key its two sides share.

Only distinct fingerprints take part: copies meet before the join. Keys that
hold very many fingerprints are divided again in the same way, by the half
segments of what the key leaves open, so no bucket is compared as a whole and
none is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datasheaf.llm._common import pack, pack_steps, per_row, staged, unpack, unpack_steps

SEED = 42
SHINGLE_WORDS = 3
#: Fingerprints under one key beyond which the key is divided.
HOT_KEY = 128


def shingle_hashes(words: list[bytes], size: int = SHINGLE_WORDS) -> Iterator[int]:
    """XXH64 of the space-joined shingles; fewer words than ``size`` are one shingle."""
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        if words:
            yield digest(b" ".join(words), SEED)
        return
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-size])).tolist()
    for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True):
        yield digest(line[a:b], SEED)


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTES = np.arange(8) * 256


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set: the values of each byte are counted, then their bits."""
    seen = np.zeros(8 * 256, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        seen += np.bincount((hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8) + _BYTES).ravel(), minlength=8 * 256)
    return (seen.reshape(8, 256) @ _BITS).ravel()


def simhash(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half of the shingle hashes; 0 without words."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    n = max(len(words) - size + 1, min(len(words), 1))
    if not n:
        return 0
    hashes = np.fromiter(shingle_hashes(words, size), np.uint64, n)
    return int(np.packbits(2 * set_bits(hashes) > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(texts: list[bytes]) -> list[pa.Array]:
    # bytes.split() also takes 0x0B and 0x0C, and no byte beyond ASCII
    return [pa.array(np.array([simhash(t) for t in texts], np.uint64).view(np.int64))]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of each row, fp as a signed long."""
    return per_row(docs, [F.col(id_col).alias("doc_id")], F.col(text_col), _fingerprints, "fp bigint")


def _segment(fp: Column, at: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << bits) - 1))


def _variants(fp: Column, places: list[tuple[int, int]]) -> Column:
    """Keys of the one-wildcard variants of the segments (first bit, bits): (segment, wildcard) and the other bits."""
    every = F.lit(1).cast("bigint")

    def of(s: int, at: int, bits: int) -> Column:
        value = _segment(fp, at, bits)
        # a lambda, not one expression for each variant: plans stay small
        return F.transform(
            F.sequence(F.lit(0), F.lit(bits - 1)),
            lambda j: F.struct((j + s * 64).alias("place"), value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", every, j))).alias("rest")),
        )

    return F.concat(*[of(s, at, bits) for s, (at, bits) in enumerate(places)])


def _first_place(diff: Column, places: list[tuple[int, int]]) -> Column:
    """The first (segment, wildcard) of one bit under which two fingerprints with these differing bits share a variant."""
    chosen = F.lit(None).cast("int")
    for s, (at, bits) in reversed(list(enumerate(places))):
        part = _segment(diff, at, bits)
        # the differing bit's number is how many bits lie below it; 0 if the segments are equal
        bit = F.when(part == 0, 0).otherwise(F.bit_count(part - 1))
        chosen = F.when(F.bit_count(part) <= 1, F.lit(s * 64) + bit).otherwise(chosen)
    return chosen.cast("int")


def cut(distance: int) -> list[tuple[int, int]]:
    """The fewest segments of which one has at most one of ``distance`` differing bits."""
    n = max(2, distance // 2 + 1)  # 64 bits in one would not fit an unsigned mask
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Over as many tasks as a shuffle has: a few bytes a row here become many rows, which sizes of files don't tell."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def links(distinct: DataFrame, distance: int = 2, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, b) with a < b for all pairs of the distinct fingerprints ``fp`` that differ in at most ``distance`` bits, each once."""
    places = cut(distance)
    keyed = _spread(distinct, "fp").select("fp", F.explode(_variants(F.col("fp"), places)).alias("k")).select("fp", "k.*")
    # written before it is joined, so AQE can split a hot key; merged, whatever Catalyst thinks of the size
    counts = staged(keyed.groupBy("place", "rest").agg(F.count("*").alias("n")).filter("n > 1"), "keys")
    shared = staged(keyed.join(counts.hint("merge"), ["place", "rest"]), "variants")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.bit_count(apart) <= distance) & (_first_place(apart, places) == F.col("place"))

    cool = shared.filter(F.col("n") <= hot_key)
    left, right = cool.select("place", "rest", F.col("fp").alias("a")), cool.select("place", "rest", F.col("fp").alias("b"))
    found = left.join(right, ["place", "rest"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")

    # Within a key, all bits outside its segment are open: up to ``distance`` of them differ, so pieces of them divide it anew.
    # 2 * distance pieces at most are cut, each inside one segment, and one of the other segments' pieces differs by one bit at most.
    hot = shared.filter(F.col("n") > hot_key)
    parts = []
    for s, (at, bits) in enumerate(places):
        pieces = [(a + h * b // 2, b // 2 + h * (b % 2)) for i, (a, b) in enumerate(places) if i != s for h in (0, 1)]
        n_pieces = distance // 2 + 1
        pieces = pieces[: max(n_pieces, 1)] if len(pieces) >= n_pieces else [(a, b) for i, (a, b) in enumerate(places) if i != s]
        own = hot.filter((F.col("place") >= s * 64) & (F.col("place") < s * 64 + bits))
        sub = own.select("place", "rest", "fp", F.explode(_variants(F.col("fp"), pieces)).alias("k")).select("place", "rest", "fp", F.col("k.place").alias("sub"), F.col("k.rest").alias("subrest"))
        on = ["place", "rest", "sub", "subrest"]
        la, rb = sub.select(*on, F.col("fp").alias("a")), sub.select(*on, F.col("fp").alias("b"))
        parts.append(la.join(rb, on).filter((F.col("a") < F.col("b")) & near & (_first_place(apart, pieces) == F.col("sub"))).select("a", "b"))
    return reduce(DataFrame.unionByName, parts, found)


def _are_stars(edges: DataFrame) -> bool:
    """Whether the links (a, b), a > b, join each node to its smallest one directly: a node has one link, or only links to it."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").agg(F.count("*")).first()[0]


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) of the nodes of ``edges`` (a, b): alternating large-star and small-star contraction.

    Each round replaces the links of a node by links to the smallest node it
    knows; rounds grow as the logarithm of the longest chain. Rounds are written
    to the shared folder, so a lost executor costs one of them at most. Raises
    RuntimeError if that many rounds don't suffice.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    for _ in range(most_rounds):
        if _are_stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written before they are joined: AQE splits a hot node only where no aggregation stands in between
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
        large = staged(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct(), "large")
        # every link now goes from the larger node to a smaller one
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("x"), F.col("m")).filter("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
    else:
        if not _are_stars(edges):
            raise RuntimeError(f"components aren't done after {most_rounds} rounds")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, distance: int = 2, hot_key: int = HOT_KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links reach, the row's own
    included. Null and empty texts have fingerprint 0 and link like any other;
    repeated rows stay; a null id is never a component_id unless all ids of the
    component are null. Other columns aren't read; no rows give no rows.
    """
    printed = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = staged(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), distance, hot_key))
    placed = staged(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "placed")
    # written before they are joined: AQE splits a hot component or fingerprint only where no aggregation stands in between
    least = staged(placed.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = staged(placed.drop("first").join(least, "root").select("fp", "component_id"), "named")
    return printed.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---- similarity beyond a few bits --------------------------------------------

#: Words in a shingle and Jaccard similarity from which two texts are near copies.
SIMILAR_WORDS, SIMILARITY = 5, 0.8
#: Shingles of more texts than this are common, and at most so many of those are told apart: it decides the cost of the index, never what it finds.
COMMON_OVER, COMMON_MOST = 32, 1 << 17
#: Shingles that a task counts at a time, and bytes of text for each.
COUNTED, SHINGLE_BYTES = 1 << 21, 6
#: Chance, over the hash of the shingles, that the index misses a pair of the least similarity.
MISS = 1e-9
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shingle_set(text: bytes, size: int = SIMILAR_WORDS) -> np.ndarray:
    """The distinct shingles as rising 64-bit hashes. Fewer words than ``size`` are one shingle, and so is a text without words."""
    words = text.lower().split()
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(len(words) - size + 1, 1)
    out = np.full(n, min(len(words), size), np.uint64)
    for j in range(min(len(words), size)):
        out = out * _FACTOR + hashed[j : j + n]
    for shift, by in zip((30, 27), _MIX, strict=True):
        out = (out ^ (out >> np.uint64(shift))) * by
    return np.unique(out ^ (out >> np.uint64(31)))


def parities(shingles: np.ndarray) -> np.ndarray:
    """Bit i: whether an odd number of the shingles fall on i. There are 2 to 4 bits a shingle, 64 at least, a power of two.

    The bits in which two texts differ are never more than the shingles that
    only one of them has. The longer of two is folded to the shorter's length.
    """
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def prefix_size(n: int, similarity: float) -> int:
    """Two sets of at least that similarity share an element among so many first ones of each, whatever the common order."""
    return n - math.ceil(similarity * n - 1e-9) + 1


def index_keys(shingles: np.ndarray, common: np.ndarray, ranks: np.ndarray, similarity: float = SIMILARITY, miss: float = MISS) -> np.ndarray:
    """The shingles that a text is indexed under: the first ones in an order that all texts share.

    Shingles that aren't ``common`` come first, by their hash, then the common
    ones, the commonest last. The first prefix_size() would do for any order. Of
    the u that aren't common, prefix_size() - 1 at most are missing in a text of
    that similarity, and a hash's order is as good as random: k of them are all
    missing with a chance of ((prefix_size() - 1) / u) ** k, so k that make it
    ``miss`` are enough where that is fewer.
    """
    n, h = len(shingles), shingles.view(np.int64)
    rank = np.zeros(n, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        rank = np.where(common[at] == h, ranks[at], 0)
    k, rare = prefix_size(n, similarity), int((rank == 0).sum())
    if 1 < k <= rare:
        k = min(k, math.ceil(math.log(miss) / math.log((k - 1) / rare))) if k - 1 < rare else k
    return h[np.lexsort((shingles, rank))[:k]]


def _sets(texts: list[bytes]) -> list[pa.Array]:
    return [pa.array([shingle_set(t).view(np.int64) for t in texts], pa.list_(pa.int64()))]


def common_shingles(texts: DataFrame, text: Column) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of all texts, rising as signed numbers, and their ranks, the commonest last. Each is counted once a text."""
    bodies = texts.select(F.coalesce(text, F.lit("")).cast("binary").alias("body"))
    n_buckets = max(1, -(-(bodies.agg(F.sum(F.octet_length("body"))).first()[0] or 0) // (COUNTED * SHINGLE_BYTES)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(sets), return_counts=True)
            buckets = (((h >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)).astype(np.int64)
            parts = np.split(np.arange(len(h)), np.flatnonzero(np.diff(buckets)) + 1)
            return pa.RecordBatch.from_arrays([pa.array([buckets[p[0]] for p in parts], pa.int32()), *(pa.array(x, pa.binary()) for x in ([pack_steps(h[p]) for p in parts], [pack(n[p]) for p in parts]))], names=["bucket", "shingles", "counts"])

        for batch in batches:
            for body in batch.column(0):
                sets.append(shingle_set(body.as_py()))
                size += len(sets[-1])
                if size >= COUNTED:
                    yield flush()
                    sets, size = [], 0
        if sets:
            yield flush()

    def summed(table: pa.Table) -> pa.Table:
        parts, counts = (np.concatenate([f(x) for x in table.column(n).to_pylist()]) for n, f in (("shingles", unpack_steps), ("counts", unpack)))
        h, at = np.unique(parts, return_inverse=True)
        n = np.bincount(at, counts, len(h)).astype(np.int64)
        return pa.table([pa.array(h[n > COMMON_OVER], pa.int64()), pa.array(n[n > COMMON_OVER], pa.int64())], names=["h", "n"])

    counted = bodies.mapInArrow(count, "bucket int, shingles binary, counts binary").repartition(2 * n_buckets, "bucket").groupBy("bucket").applyInArrow(summed, "h bigint, n bigint")
    found = counted.orderBy(F.desc("n"), "h").limit(COMMON_MOST).toArrow()
    h = found.column("h").to_numpy()
    order = np.argsort(h)
    return h[order], len(h) - order


def signatures(docs: DataFrame, keep: list[Column], text: Column, similarity: float = SIMILARITY) -> DataFrame:
    """``keep``, then fp, size (distinct shingles), keys (see index_keys) and parity (see parities), in one pass over the texts."""
    common, ranks = common_shingles(docs, text)

    def of(texts: list[bytes]) -> list[pa.Array]:
        sets = [shingle_set(t) for t in texts]
        longs = pa.list_(pa.int64())
        return [*_fingerprints(texts), pa.array([len(x) for x in sets], pa.int64()), pa.array([index_keys(x, common, ranks, similarity) for x in sets], longs), pa.array([parities(x) for x in sets], longs)]

    return per_row(docs, keep, text, of, "fp bigint, size bigint, keys array<bigint>, parity array<bigint>")


def _possible(similarity: float) -> str:
    """SQL: whether sizes s and t and parities p and q leave the similarity possible. It is never false for a pair that has it."""
    few = f"{(1 - similarity) / (1 + similarity)} * (s + t) + 1e-6"
    folded = "({0}[i] ^ if(size({0}) > size({1}), {0}[i + size({1})], 0L))"
    apart = f"aggregate(sequence(0, least(size(p), size(q)) - 1), 0, (n, i) -> n + bit_count({folded.format('p', 'q')} ^ {folded.format('q', 'p')}))"
    return f"least(s, t) >= {similarity} * greatest(s, t) - 1e-6 and {apart} <= {few}"


class _Comparison:
    """Compares pairs of nodes. ``nodes`` has node, digest, size and parity, ``texts`` digest and text. The shingles of a text are made once, when a pair first needs them."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, similarity: float) -> None:
        self.nodes, self.texts, self.similarity = nodes, texts, similarity
        self.sets: DataFrame | None = None

    def similar(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar."""
        x, y = (self.nodes.select(F.col("node").alias(n), F.col("size").alias(s), F.col("parity").alias(p)).hint("merge") for n, s, p in (("a", "s", "p"), ("b", "t", "q")))
        pairs = staged(pairs.filter("a <> b").distinct().join(x, "a").join(y, "b").filter(_possible(self.similarity)).select("a", "b"), "pairs")
        sets = self._shingles(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        x, y = (sets.select(F.col("node").alias(n), F.col("shingles").alias(s)).hint("merge") for n, s in (("a", "x"), ("b", "y")))
        common = F.size(F.array_intersect("x", "y"))
        near = pairs.join(x, "a").join(y, "b").filter(common >= self.similarity * (F.size("x") + F.size("y") - common)).select("a", "b")
        return staged(near, "near")

    def _shingles(self, wanted: DataFrame) -> DataFrame:
        new = wanted if self.sets is None else wanted.join(self.sets.select("node"), "node", "left_anti")
        named = staged(new.join(self.nodes.select("node", "digest"), "node"), "wanted")
        if self.sets is None or named.take(1):
            some = self.texts.join(named, "digest").dropDuplicates(["node"]).select("node", "text")
            made = staged(per_row(some, [F.col("node")], F.col("text"), _sets, "shingles array<bigint>"), "shingles")
            self.sets = made if self.sets is None else self.sets.unionByName(made)
        return self.sets


def _open(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(key, node, root) of the keys whose nodes the links don't join yet."""
    roots = staged(components(found), "roots")
    placed = staged(shared.join(roots.hint("merge"), "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "rooted")
    several = staged(placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("key"), "several")
    return staged(placed.join(several.hint("merge"), "key"), "open")


def _rest(rows: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """All possible pairs (a, b) of nodes that share a key in ``rows`` (key, node, root) and have different roots, each once.

    A key's nodes of the root that most of them have are met by the others
    only, so what is compared is little more than the pairs to be told apart.
    """
    sizes = staged(rows.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("main")), "mains")
    placed = rows.join(sizes.hint("merge"), "key").withColumn("main", F.col("root") == F.col("main"))
    placed = staged(placed.join(nodes.select("node", "size", "keys", "parity").hint("merge"), "node"), "placed-keys")
    a = placed.filter("not main").select("key", F.col("node").alias("a"), F.col("root").alias("x"), F.col("size").alias("s"), F.col("parity").alias("p"), F.col("keys").alias("k"))
    b = placed.select("key", F.col("node").alias("b"), F.col("root").alias("y"), F.col("main").alias("of_main"), F.col("size").alias("t"), F.col("parity").alias("q"), F.col("keys").alias("l"))
    once = "x <> y and (of_main or a < b) and " + _possible(similarity) + " and array_intersect(k, l)[0] = key"
    return a.join(b.hint("merge"), "key").filter(once).select("a", "b")


def similar_links(nodes: DataFrame, texts: DataFrame, first: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) that join the nodes into groups of near copies; ``first`` are pairs to compare before all others.

    Texts of that similarity share a key of the index. Each node meets the
    smallest leader of its keys, then one node of each key drawn by a hash: in
    proportion to the index, whatever the size of a group. That joins the
    copies; every possible pair that shares a key and isn't joined is compared
    last, so none is missed.
    """
    compare = _Comparison(nodes, texts, similarity)
    index = nodes.select("node", F.explode("keys").alias("key"))
    leaders = staged(index.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1").select("key", "first"), "leaders")
    shared = staged(index.join(leaders.hint("merge"), "key"), "shared")
    led = shared.filter("node <> first").groupBy("node").agg(F.min("first").alias("first")).select(F.col("first").alias("a"), F.col("node").alias("b"))
    found = compare.similar(led.unionByName(first))

    rows = _open(shared, found)
    drawn = staged(rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node", "root")).alias("d")).select("key", F.col("d.node").alias("a"), F.col("d.root").alias("x")), "drawn")
    found = found.unionByName(compare.similar(rows.join(drawn.hint("merge"), "key").filter("x <> root").select("a", F.col("node").alias("b"))))

    return found.unionByName(compare.similar(_rest(_open(rows.select("key", "node"), found), nodes, similarity)))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group of near copies, with all their columns.

    Two texts are near copies if their sets of 5-word shingles (A-Z lower-cased)
    have at least that Jaccard similarity; a group is what such pairs join.
    Candidates are the pairs whose fingerprints are within ``distance`` bits, as
    in near_duplicates(), and those that share a key of the shingle index.

    The row with the smallest id stays; of equal ids the one whose text has the
    smallest digest; of repeated rows one. Null ids come last. Null texts are
    empty texts; texts without words are copies of each other. No rows give no
    rows; names of other columns may clash with any used here.
    """
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    id_, text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(body, 256))
    printed = staged(signatures(numbered, [F.col(id_).alias("id"), digest.alias("digest"), F.monotonically_increasing_id().alias("row")], body, similarity), "signatures")
    rank = F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id"), F.col("digest").alias("digest")))
    # a text is a node; its number is that of one of its rows, and no two texts share one
    texts = staged(printed.groupBy("digest").agg(rank.alias("first"), F.min("row").alias("node")), "texts")
    nodes = staged(texts.join(printed.select(F.col("row").alias("node"), "fp", "size", "keys", "parity").hint("merge"), "node"), "nodes")

    # all texts of a fingerprint meet its first one, and first ones those of near fingerprints
    own = nodes.select("node", "fp")
    heads = staged(own.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    same = own.join(heads, "fp").select(F.col("head").alias("a"), F.col("node").alias("b"))
    x, y = heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), heads.select(F.col("fp").alias("b"), F.col("head").alias("y"))
    few = links(heads.select("fp"), distance).join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    whole = numbered.select(digest.alias("digest"), body.alias("text"))
    roots = components(similar_links(nodes, whole, same.union(few), similarity))

    placed = staged(nodes.select("node", "digest", "first").join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root")), "placed")
    kept = staged(placed.groupBy("root").agg(F.min("first").alias("kept")), "kept")
    stays = placed.join(kept, "root").select("digest", "kept")
    judged = printed.select("id", "digest").join(stays, "digest").select("id", "digest", F.struct(F.col("id").isNull().alias("n"), "id", "digest").eqNullSafe(F.col("kept")).alias("kept"))
    judged = staged(judged, "judged")
    gone = judged.filter("not kept").select("id", "digest").distinct()
    repeated = judged.filter("kept").groupBy("id", "digest").count().filter("count > 1").take(1)
    out = numbered.withColumn("digest", digest)
    out = out.join(gone, out[id_].eqNullSafe(gone["id"]) & (out["digest"] == gone["digest"]), "left_anti")
    out = (out.dropDuplicates([id_, "digest"]) if repeated else out).drop("digest")
    return out.toDF(*docs.columns)
