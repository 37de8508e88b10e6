import pytest
from pyspark.sql import functions as F

from datasheaf import checks
from datasheaf.operators import aggregates, filters, joins, layout, trees, windows


def test_range_join_equals_nested_loop(spark):
    points = spark.range(200).select((F.col("id") * 37 % 101).alias("v"))
    spans = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 13 % 90).alias("lo"), (F.col("id") * 13 % 90 + F.col("id") % 17).alias("hi"))
    plain = points.crossJoin(spans).filter("v between lo and hi")
    for width in (1, 7, 1000):
        got = joins.range_join(points, spans, F.col("v"), F.col("lo"), F.col("hi"), width)
        assert sorted(map(tuple, got.select("v", "k").collect())) == sorted(map(tuple, plain.select("v", "k").collect()))


def test_fallback_and_prefix(spark):
    left = spark.createDataFrame([("a7",), ("b7",), ("c7",)], "did string")
    right = spark.createDataFrame([("a7", 1), ("a6", 2), ("b6", 3)], "key string, doc int")
    got = joins.fallback(left, right, [F.col("did"), F.replace("did", F.lit("7"), F.lit("6"))], "key", ["did"])
    assert sorted((r.did, r.doc, r.tier) for r in got.collect() if r.doc) == [("a7", 1, 0), ("b7", 3, 1)] and got.count() == 3
    got = joins.prefix_join(spark.createDataFrame([("tim1_ch1",), ("x",)], "af string"), spark.createDataFrame([("tim1_",), ("tim",)], "p string"), "af", "p")
    assert {r.p for r in got.collect()} == {"tim1_", "tim"}


def test_rules(spark):
    df = spark.createDataFrame([("f405", "r"), ("l4", "k")], "did string, pin string")
    rules = spark.createDataFrame([(2, None, None, "rest"), (1, ["f405"], None, "fast")], "priority int, did array<string>, pin array<string>, value string")
    got = joins.first_match_rules(df, rules, ["did", "pin"], ["did", "pin"])
    assert {r.did: r.value for r in got.collect()} == {"f405": "fast", "l4": "rest"}
    assert [r[0] for r in df.select(joins.claim("did", ["f4", "f40.", ""])).collect()] == ["f40.", ""]
    with pytest.raises(Exception, match="unresolved"):
        joins.resolve(df, df.limit(0).select("did"), ["did"]).collect()


def test_unambiguous_and_alias(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 1, "z")], "k string, r int, v string")
    assert [(r.k, r.v) for r in joins.unambiguous(df, ["k"], F.col("r")).collect()] == [("a", "x")]
    rules = spark.createDataFrame([("dma1", None, "m"), ("dma2", "dma1", None)], "key string, alias string, mask string")
    got = joins.alias_lookup(spark.createDataFrame([("dma2",)], "key string"), rules, "key", "alias")
    assert [(r.key, r["mask"]) for r in got.collect()] == [("dma2", "m")]


def test_intervals(spark):
    df = spark.createDataFrame([("a", 0, 2), ("a", 1, 5), ("a", 5, 6), ("a", 9, 10), ("b", 1, 1)], "k string, lo int, hi int")
    merged = windows.merged_intervals(df, "lo", "hi", ["k"])
    assert sorted((r.k, r.lo, r.hi, r.n) for r in merged.collect()) == [("a", 0, 6, 3), ("a", 9, 10, 1), ("b", 1, 1, 1)]
    assert [(r.lo, r.hi) for r in windows.complement(merged, "lo", "hi", ["k"]).collect()] == [(6, 9)]


def test_latest_is_numeric(spark):
    df = spark.createDataFrame([("d", "v9"), ("d", "v10")], "doc string, version string")
    assert windows.latest(df, ["doc"], [windows.version_key(F.col("version"))]).first().version == "v10"


def test_register_map_last_wins(spark):
    rows = spark.createDataFrame([("P", "CR", 0, 0, "EN", 1), ("P", "CR", 4, 1, "GO", 2), ("P", "CR", 4, 2, "ON", 2)], "p string, reg string, off int, bit int, field string, n int")
    r = aggregates.register_map(rows, ["p"], "reg", "off", "bit", "field", "n").collect()
    assert len(r) == 1 and r[0].off == 4 and r[0].fields == {1: "GO", 2: "ON"}


def test_filters(spark):
    lines = spark.createDataFrame([("a cat sat, cat.",), ("concat",)], "text string")
    assert [r["at"] for r in filters.find_words(lines, "text", "cat").orderBy("at").collect()] == [2, 11]
    defines = spark.createDataFrame([("A_Msk",), ("B",), ("IS_C",), ("D(x)",)], "name string")
    assert [r.name for r in filters.usable_defines(defines).collect()] == ["B"]
    docs = spark.createDataFrame([("RM1-x", "1 Intro", "Table 1"), ("DS1", "2 Pins", "Table 2")], "doc string, chapter string, caption string")
    assert filters.search_tables(docs, "RM*", "intro", None).count() == 1
    with pytest.raises(checks.CheckFailed):
        filters.the_one(docs, "caption", "table")


def test_affine(spark):
    df = spark.createDataFrame([("0x10 + 4*x",), ("x",), ("8 - 2*x",), ("import os",), ("x*0x10+1",), ("12",)], "f string")
    got = {r.f: (tuple(r.c) if r.c else None) for r in df.select("f", trees.affine(F.col("f")).alias("c")).collect()}
    assert got == {"0x10 + 4*x": (16, 4), "x": (0, 1), "8 - 2*x": (8, -2), "import os": None, "x*0x10+1": (1, 16), "12": (12, 0)}
    r = spark.range(1).select(trees.offset_list(F.lit("0x10-0x18")).alias("a"), trees.offset_list(F.lit("0x10 or 0x20")).alias("b"), trees.template_name(F.lit("CCRx"), F.lit(3)).alias("n")).first()
    assert r.a == [16, 20, 24] and r.b == [16, 32] and r.n == "CCR3"


def test_trees(spark):
    p = spark.createDataFrame([("d", "DMA1", 0x100), ("d", "DMA1_S0", 0x110), ("d", "DMA1_S1", 0x128), ("d", "TIM1", 0x200)], "did string, name string, address bigint")
    parents = trees.parent_by_address(p, F.contains("name", F.lit("_S")))
    regs = spark.createDataFrame([("DMA1_S0", "CR", 0), ("DMA1_S1", "CR", 0), ("DMA1_S1", "PAR", 8)], "peripheral string, register string, offset bigint")
    got = trees.inline_children(regs, parents, "child", "parent", "address")
    assert sorted(map(tuple, got.collect())) == [("DMA1", "CR0", 16), ("DMA1", "CR1", 40), ("DMA1", "PAR1", 48)]
    assert trees.same_tree(p, p) and not trees.same_tree(p, p.limit(2))
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a int, b int")
    assert sorted(map(tuple, trees.reachable(edges, spark.createDataFrame([(1,)], "n int"), "a", "b", 2).collect())) == [(1, 0), (2, 1), (3, 2)]
    assert trees.without_aliases(spark.createDataFrame([("I2S2",), ("I2S2ext",)], "name string")).count() == 1


def test_layout(spark):
    boxes = spark.createDataFrame([("d", 1, 0.0, 0.0, 2.0, 2.0), ("d", 1, 1.0, 1.0, 3.0, 3.0), ("d", 1, 10.0, 0.0, 11.0, 1.0), ("d", 1, 0.0, 50.0, 5.0, 55.0)], "doc string, page int, x0 double, y0 double, x1 double, y1 double")
    got = layout.graphic_clusters(boxes, 0.1).orderBy("cluster").collect()
    assert [(r.x0, r.y1, r.paths) for r in got] == [(0.0, 55.0, 1), (0.0, 3.0, 2), (10.0, 1.0, 1)]
    chars = spark.createDataFrame([("d", 1, float(i), 0.0, i + 1.0, 10.0, 0.0, c) for i, c in enumerate("ab")] + [("d", 1, 3.0, 2.0, 4.0, 6.0, 2.0, "2"), ("d", 1, 0.0, 30.0, 1.0, 40.0, 30.0, "T")], "doc string, page int, x0 double, y0 double, x1 double, y1 double, origin double, ch string")
    assert [r.text for r in layout.merge_lines(chars).orderBy("line").collect()] == ["T", "ab2"]
    borders = spark.createDataFrame([("t", 0, 0, True, False), ("t", 1, 0, False, False), ("t", 0, 1, False, False), ("t", 1, 1, False, False)], "table_id string, x int, y int, open_right boolean, open_bottom boolean")
    assert sorted((r.x, r.y, r.xspan, r.yspan) for r in layout.merge_open_cells(borders).collect()) == [(0, 0, 2, 1), (0, 1, 1, 1), (1, 1, 1, 1)]
    lines = spark.createDataFrame(
        [("d", 1, 0, "1 Intro", 0.0, True, 1, 2), ("d", 1, 1, "Some text", 0.0, False, 0, 2), ("d", 1, 2, "goes on", 0.0, False, 0, 1), ("d", 1, 3, "• first", 20.0, False, 0, 1), ("d", 1, 4, "• second", 20.0, False, 0, 1), ("d", 1, 5, "Note: care", 0.0, False, 0, 2)],
        "doc string, page int, line int, text string, x0 double, bold boolean, heading_level int, newlines int",
    )
    blocks = layout.merge_pages(layout.blocks(lines, 10.0))
    assert [(r.kind, r.text) for r in blocks.orderBy("position").collect()] == [("heading", "1 Intro"), ("paragraph", "Some text goes on"), ("list_bullet", "• first"), ("list_bullet", "• second"), ("note", "Note: care")]
    assert layout.grouped_lists(blocks).first()["items"] == ["• first", "• second"]


def test_rules_by_key(spark):
    df = spark.createDataFrame([("f4", 1), ("f4", 2), ("l4", 1), (None, 1), ("l4", None)], "did string, pin int").withColumn("n", F.monotonically_increasing_id())
    rules = spark.createDataFrame([(3, ["f4"], None, "f"), (2, ["f4", "l4"], [2], "two"), (1, None, [2], "any two"), (4, ["l4"], [1], "l1")], "priority int, did array<string>, pin array<int>, value string")
    got = joins.first_match_rules(df, rules, ["n"], ["did", "pin"])
    assert {(r.did, r.pin): r.value for r in got.collect()} == {("f4", 1): "f", ("f4", 2): "any two", ("l4", 1): "l1", (None, 1): None, ("l4", None): None}
    assert [r.value for r in joins.first_match_rules(df, rules.limit(0), ["n"], ["did", "pin"]).collect()] == [None] * 5


def test_pattern_join(spark):
    values = spark.createDataFrame([("stm32f405",), ("stm32f407",), ("stm32l4",), (None,)], "v string")
    patterns = spark.createDataFrame([("stm32f40[5]",), ("stm32f4?0",), ("stm32l4|x",), (".*7",), (None,)], "p string")
    got = sorted((r.v, r.p) for r in joins.pattern_join(values, patterns, "v", "p").collect())
    assert got == [("stm32f405", "stm32f40[5]"), ("stm32f405", "stm32f4?0"), ("stm32f407", ".*7"), ("stm32f407", "stm32f4?0"), ("stm32l4", "stm32l4|x")]
    assert sorted(r.v for r in joins.matches_any(values, "v", patterns.filter("p like 'stm32f%'"), "p").collect()) == ["stm32f405", "stm32f407"]
