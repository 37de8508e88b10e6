"""Registered queries of the table operators on the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datasheaf.functions import geometry, maps, text
from datasheaf.operators import aggregates, filters, joins, layout, tables, trees, windows
from datasheaf.plans import devices
from datasheaf.sources import cheader, html, xml

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


#: All columns of lineitem that order its rows fully; (l_orderkey, l_linenumber) alone isn't unique.
LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


@query(r"SELECT doc_id, regexp_replace(text, '([A-Za-z]+)ion', '<\1>', 'g') AS replaced FROM documents")
def text_replace_backref(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.fold("text", [(r"([A-Za-z]+)ion", r"<$1>")]).alias("replaced"))


@query("""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '</?u>', '', 'g'), '</?i>', '', 'g'), '</?b>', '', 'g'), '</?sub>', '', 'g'), '</?sup>', '', 'g'), '</?br>', '', 'g'), '</?p>', '', 'g') AS stripped FROM pages""")
def text_strip_inline_tags(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", text.replace_subs("html").alias("stripped"))


@query("""SELECT doc_id, CAST(len(list_filter(list_transform(string_split_regex(text, ' |,|/|<br>'), lambda x: trim(x)), lambda x: x <> '')) AS INTEGER) AS parts FROM documents""")
def text_listify_count(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.size(text.listify("text")).alias("parts"))


@query("SELECT p_partkey, '0' || p_size || '|' || p_brand || '|' || replace(p_name, ' ', '|') || '|10' AS parts FROM part")
def text_listify(spark, sf_dir):
    cell = F.concat(F.lit("0"), F.col("p_size").cast("string"), F.lit(",, "), "p_brand", F.lit("<br>"), "p_name", F.lit("/10"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(text.listify(cell), "|").alias("parts"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9_]+')) AS INTEGER) AS words FROM documents")
def text_word_counts(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.size(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9_]+"), F.lit(0))).alias("words"))


@query("""SELECT p_partkey, regexp_extract(p_brand, '([A-Za-z]+)#(\\d+)', 1) AS family, CAST(regexp_extract(p_brand, '([A-Za-z]+)#(\\d+)', 2) AS INTEGER) AS pins FROM part""")
def text_split_package(spark, sf_dir):
    found = text.split_package(F.replace("p_brand", F.lit("#")))
    return _t(spark, sf_dir, "part").select("p_partkey", found["family"].alias("family"), found["pins"].alias("pins"))


@query("""SELECT o_orderkey, concat('stm32', left(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 2)) AS family FROM orders""")
def text_device_names(spark, sf_dir):
    name = F.concat(F.lit("STM32"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    d = text.parse_device(name)
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.concat(d["platform"], d["family"]).alias("family"))


@query("""SELECT page_id, CAST(i - 1 AS INTEGER) AS n, p AS paragraph FROM (
    SELECT page_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '<p>([^<]*)</p>', 1) AS ps FROM pages))""")
def html_paragraphs(spark, sf_dir):
    found = F.posexplode(F.regexp_extract_all("html", F.lit("<p>([^<]*)</p>"), F.lit(1))).alias("n", "paragraph")
    return _t(spark, sf_dir, "pages").select("page_id", found)


@query()
def html_items(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("doc"), F.col("url").alias("chapter"), "html")
    return html.items(pages)


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus, CAST(1 + row_number() OVER (PARTITION BY o_custkey
        ORDER BY '<tr><td>' || o_orderkey || '</td><td>' || o_orderpriority || '</td><td>' || o_orderstatus || '</td></tr>') AS INTEGER) AS gy FROM orders WHERE o_custkey IS NOT NULL)
    SELECT o_custkey || '#orders#0' AS table_id, gy, 'Order:Key' AS domain, CAST(o_orderkey AS VARCHAR) AS texts FROM r
    UNION ALL SELECT o_custkey || '#orders#0', gy, 'State:Priority', o_orderpriority FROM r UNION ALL SELECT o_custkey || '#orders#0', gy, 'State:Status', o_orderstatus FROM r""")
def html_table_grid(spark, sf_dir):
    """Orders of a customer as an HTML table, scanned, placed on its grid and read back by column."""
    orders = _t(spark, sf_dir, "orders").filter("o_custkey is not null")
    row = F.concat(F.lit("<tr><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td>"), "o_orderpriority", F.lit("</td><td>"), "o_orderstatus", F.lit("</td></tr>"))
    lines = orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    head = F.lit("<tr><th>Order</th><th colspan='2'>State</th></tr><tr><th>Key</th><th>Priority</th><th>Status</th></tr>")
    page = F.concat(F.lit("<table><caption>Orders</caption>"), head, "rows", F.lit("</table>"))
    docs = lines.select(F.col("o_custkey").cast("string").alias("doc"), F.lit("orders").alias("chapter"), page.alias("html"))
    # few bytes, much scanning: spread them over the cores before AQE packs them into one task
    grid = tables.grid(html.items(docs.repartition(spark.sparkContext.defaultParallelism)))
    return tables.cell_rows(grid, tables.domains_x(grid)).select("table_id", "gy", "domain", F.array_join("texts", "|").alias("texts"))


@query("SELECT event_id, CAST(props->>'$.k' AS VARCHAR) AS k FROM events")
def json_field(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("""SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def latest_version(spark, sf_dir):
    return windows.latest(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def doc_sync_except(spark, sf_dir):
    return filters.new_only(_t(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), _t(spark, sf_dir, "labels"), "doc_id")


PART_RULES = (("^small|ring$", "S"), ("^red", "R"), ("widget$", "W"), ("bolt", "B"))


@query("SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(p_name, '{p}') THEN '{v}'" for p, v in PART_RULES) + " ELSE '-' END AS class FROM part")
def devices_first_match(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", joins.first_match(F.col("p_name"), PART_RULES, "-").alias("class"))


@query("""WITH r(priority, types, sizes, value) AS (VALUES (1, ['ECONOMY'], CAST(NULL AS INTEGER[]), 'a'), (2, NULL, [1, 2, 3, 4, 5], 'b'), (3, NULL, NULL, 'c'))
    SELECT p_partkey, arg_min(value, priority) AS value FROM part JOIN r ON (types IS NULL OR list_contains(types, p_type)) AND (sizes IS NULL OR list_contains(sizes, p_size)) GROUP BY p_partkey""")
def rules_first_match(spark, sf_dir):
    rules = spark.createDataFrame([(1, ["ECONOMY"], None, "a"), (2, None, [1, 2, 3, 4, 5], "b"), (3, None, None, "c")], "priority int, p_type array<string>, p_size array<int>, value string")
    return joins.first_match_rules(_t(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size"), rules, ["p_partkey"], ["p_type", "p_size"]).select("p_partkey", "value")


@query("""SELECT o_orderkey, coalesce(a.c_name, b.c_name, d.c_name) AS c_name, CAST(CASE WHEN a.c_custkey IS NOT NULL THEN 0 WHEN b.c_custkey IS NOT NULL THEN 1 WHEN d.c_custkey IS NOT NULL THEN 2 END AS INTEGER) AS tier
    FROM orders LEFT JOIN customer a ON a.c_custkey = o_orderkey LEFT JOIN customer b ON b.c_custkey = o_orderkey // 10 LEFT JOIN customer d ON d.c_custkey = o_custkey""")
def fallback_key_join(spark, sf_dir):
    orders, customers = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    keys = [F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 10), F.col("o_custkey")]
    return joins.fallback(orders, customers, keys, "c_custkey", ["o_orderkey"]).select("o_orderkey", "c_name", "tier")


@query("SELECT p_partkey, p_brand FROM part WHERE regexp_matches(p_brand, '^(?:Brand#1|Brand#2.)')")
def regex_semi_filter(spark, sf_dir):
    patterns = spark.createDataFrame([("Brand#1",), ("Brand#2.",)], "pattern string")
    return joins.matches_any(_t(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", patterns)


@query("""WITH p AS (SELECT p_partkey, s_suppkey, CASE WHEN p_size = s_nationkey THEN 0 WHEN p_partkey % 7 = s_nationkey % 7 AND p_size > 45 THEN 1 END AS tier FROM part JOIN supplier ON p_partkey % 25 = s_suppkey % 25)
    SELECT p_partkey, s_suppkey, CAST(tier AS INTEGER) AS tier FROM p WHERE tier IS NOT NULL AND tier = (SELECT min(tier) FROM p q WHERE q.p_partkey = p.p_partkey)""")
def cascading_match(spark, sf_dir):
    parts, suppliers = _t(spark, sf_dir, "part").select("p_partkey", "p_size"), _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    tiers = [F.col("p_size") == F.col("s_nationkey"), (F.col("p_partkey") % 7 == F.col("s_nationkey") % 7) & (F.col("p_size") > 45)]
    return joins.cascade(parts, suppliers, tiers, ["p_partkey"], F.col("p_partkey") % 25 == F.col("s_suppkey") % 25).select("p_partkey", "s_suppkey", "tier")


CLAIMS = ("Brand#1", "Brand#1.", "Brand#2[0-4]", "")


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '^(?:Brand#2[0-4])') THEN 'Brand#2[0-4]' WHEN regexp_matches(p_brand, '^(?:Brand#1.)') THEN 'Brand#1.' WHEN regexp_matches(p_brand, '^(?:Brand#1)') THEN 'Brand#1' ELSE '' END AS pattern FROM part""")
def claiming_match(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", joins.claim("p_brand", CLAIMS).alias("pattern"))


@query("""WITH f(pattern, file) AS (VALUES ('Brand#1', 'one'), ('Brand#1.', 'teens'), ('Brand#2.', 'twenties')),
    h AS (SELECT p_partkey, file, row_number() OVER (PARTITION BY p_partkey ORDER BY length(pattern) DESC, file) AS n FROM part JOIN f ON regexp_matches(p_brand, '^(?:' || pattern || ')'))
    SELECT p_partkey, file FROM h WHERE n = 1""")
def claiming_files(spark, sf_dir):
    files = spark.createDataFrame([("Brand#1", "one"), ("Brand#1.", "teens"), ("Brand#2.", "twenties")], "pattern string, file string")
    return joins.claim_rows(_t(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", files, ["p_partkey"])


@query("""SELECT l_orderkey, l_returnflag, min(l_linenumber) AS position, max(l_linenumber) + 1 - min(l_linenumber) AS width FROM lineitem GROUP BY l_orderkey, l_returnflag""")
def bitfield_coalesce(spark, sf_dir):
    return aggregates.bit_fields(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"], "l_linenumber")


@query("""WITH s AS (SELECT o_custkey, string_agg(DISTINCT o_orderpriority || o_orderstatus, '|' ORDER BY o_orderpriority || o_orderstatus) AS signature FROM orders GROUP BY o_custkey)
    SELECT signature, count(*) AS members, min(o_custkey) AS first FROM s GROUP BY signature""")
def structural_group(spark, sf_dir):
    return aggregates.structural_groups(_t(spark, sf_dir, "orders"), "o_custkey", F.concat("o_orderpriority", "o_orderstatus"))


@query("SELECT o_orderstatus, o_orderpriority, count(DISTINCT o_custkey) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority")
def set_valued_crosstab(spark, sf_dir):
    return aggregates.cross_table(_t(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", "o_custkey")


@query("SELECT r_name || '/' || n_name AS code FROM region, nation WHERE regexp_matches(r_name || '/' || n_name, '^A.*[02468]$')")
def cartesian_codes(spark, sf_dir):
    code = F.concat("r_name", F.lit("/"), "n_name")
    parts = [_t(spark, sf_dir, "region").select("r_name"), _t(spark, sf_dir, "nation").select("n_name")]
    return aggregates.expand_codes(parts, code.rlike("^A.*[02468]$")).select(code.alias("code"))


@query("""SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS signup FROM events""")
def carry_forward(spark, sf_dir):
    value = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return _t(spark, sf_dir, "events").select("event_id", F.coalesce(windows.carry_forward(value, ["user_id"], ["ts", "event_id"]), F.lit(-1)).alias("signup"))


@query("""SELECT event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS island FROM (
    SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) <> event_type THEN 1 ELSE 0 END AS c FROM events)""")
def value_islands(spark, sf_dir):
    return windows.numbered_islands(_t(spark, sf_dir, "events"), F.col("event_type"), ["user_id"], ["ts", "event_id"]).select("event_id", "island")


@query("""SELECT event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cluster FROM (
    SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 7200000000 THEN 1 ELSE 0 END AS c FROM events)""")
def gap_clusters(spark, sf_dir):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return windows.gap_clusters(_t(spark, sf_dir, "events"), micros, 7_200_000_000, ["user_id"], ["ts", "event_id"]).select("event_id", "cluster")


def _spans(spark, sf_dir):
    low = F.unix_micros(F.col("ts").cast("timestamp"))
    return _t(spark, sf_dir, "events").select("user_id", low.alias("low"), (low + F.ceil("value") * 60_000_000).alias("high"))


_MERGED = """s AS (SELECT user_id, epoch_us(ts) AS low, epoch_us(ts) + CAST(ceil(value) AS BIGINT) * 60000000 AS high FROM events),
    m AS (SELECT *, CASE WHEN low > max(high) OVER (PARTITION BY user_id ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM s),
    r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY low, high ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM m),
    g AS (SELECT user_id, min(low) AS low, max(high) AS high, count(*) AS n FROM r GROUP BY user_id, run)"""


@query(f"WITH {_MERGED} SELECT * FROM g")
def interval_merge(spark, sf_dir):
    return windows.merged_intervals(_spans(spark, sf_dir), "low", "high", ["user_id"])


@query(f"WITH {_MERGED}, c AS (SELECT user_id, high AS low, lead(low) OVER (PARTITION BY user_id ORDER BY low) AS high FROM g) SELECT * FROM c WHERE high IS NOT NULL AND high - low > 3600000000")
def interval_complement(spark, sf_dir):
    return windows.complement(windows.merged_intervals(_spans(spark, sf_dir), "low", "high", ["user_id"]), "low", "high", ["user_id"], F.lit(3_600_000_000))


@query(f"SELECT l_orderkey, {', '.join(LINE)}, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - l_quantity AS start FROM lineitem")
def prefix_sum_offsets(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", *LINE, windows.offsets(F.col("l_quantity"), ["l_orderkey"], LINE).alias("start"))


@query("""SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn), -1) AS next_turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations""")
def adjacent_pairs(spark, sf_dir):
    pair = windows.with_next(F.col("turn"), ["conv_id"], ["turn"])
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(pair["next"], F.lit(-1)).alias("next_turn"), windows.place(["conv_id"], ["turn"]).cast("bigint").alias("place"))


@query("""SELECT conv_id, turn, coalesce(first_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), -1) AS answer FROM conversations""")
def caption_within_5(spark, sf_dir):
    conversations = _t(spark, sf_dir, "conversations")
    return conversations.select("conv_id", "turn", F.coalesce(joins.next_within(["conv_id"], ["turn"], F.col("role") == "assistant", F.col("turn")), F.lit(-1)).alias("answer"))


@query("SELECT n_name, r_name FROM nation JOIN region ON contains(r_name, chr(CAST(65 + n_nationkey AS INTEGER)))")
def contains_join(spark, sf_dir):
    nations = _t(spark, sf_dir, "nation").select("n_name", F.chr(F.lit(65) + F.col("n_nationkey")).alias("part"))
    return joins.contains_join(_t(spark, sf_dir, "region").select("r_name"), nations, "r_name", "part").select("n_name", "r_name")


@query("SELECT p_partkey, prefix FROM part JOIN (VALUES ('small'), ('red w'), ('big'), ('blue')) t(prefix) ON starts_with(p_name, prefix)")
def prefix_join(spark, sf_dir):
    prefixes = spark.createDataFrame([("small",), ("red w",), ("big",), ("blue",)], "prefix string")
    return joins.prefix_join(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), prefixes, "p_name", "prefix").select("p_partkey", "prefix")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, o_orderkey FROM lineitem JOIN orders ON l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 30 DAY AND l_suppkey = o_custkey""")
def range_join(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.unix_date(F.col("l_shipdate").cast("date")).alias("day"), F.col("l_suppkey").alias("k"))
    first = F.unix_date(F.col("o_orderdate").cast("date"))
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", first.alias("first"), (first + 30).alias("last"), F.col("o_custkey").alias("k"))
    return joins.range_join(lines, orders, F.col("day"), F.col("first"), F.col("last"), 32, ["k"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "o_orderkey")


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS degree FROM lineitem GROUP BY l_suppkey")
def edges_merge(spark, sf_dir):
    edges = trees.merge_edges(_t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")), ["src", "dst"])
    return edges.groupBy(F.col("src").alias("l_suppkey")).agg(F.count("*").alias("degree"))


@query("SELECT p_partkey, CAST(i AS INTEGER) AS i, CAST(4 + 8 * i AS BIGINT) AS off FROM (SELECT p_partkey, unnest(range(0, p_size)) AS i FROM part)")
def seq_expand(spark, sf_dir):
    expanded = trees.expand_registers(_t(spark, sf_dir, "part").select("p_partkey", F.lit("4 + 8 * x").alias("formula"), F.lit(0).alias("lo"), (F.col("p_size") - 1).alias("hi")), "formula", "lo", "hi")
    return expanded.select("p_partkey", F.col("x").cast("int").alias("i"), F.col("offset").alias("off"))


@query("SELECT conv_id, role, max(turn) AS turn FROM conversations GROUP BY conv_id, role")
def ordered_dedup_keep_last(spark, sf_dir):
    return aggregates.keep_last_duplicate(_t(spark, sf_dir, "conversations"), ["conv_id"], "role", "turn")


@query("""WITH p AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 0 ELSE 1 END AS part FROM conversations),
    s AS (SELECT conv_id, part, count(*) AS n FROM p GROUP BY conv_id, part),
    o AS (SELECT conv_id, part, sum(n) OVER (PARTITION BY conv_id ORDER BY part) - n AS skip FROM s)
    SELECT conv_id, part, turn, CAST(row_number() OVER (PARTITION BY conv_id, part ORDER BY turn) - 1 + skip AS BIGINT) AS y FROM p JOIN o USING (conv_id, part)""")
def sub_table_append(spark, sf_dir):
    part = F.when(F.col("role") == "user", 0).otherwise(1)
    rows = _t(spark, sf_dir, "conversations").select("conv_id", "turn", part.alias("part"))
    rows = rows.withColumn("row", windows.place(["conv_id", "part"], ["turn"]))
    return tables.append_rows(rows, ["conv_id"], "part", "row").select("conv_id", "part", "turn", F.col("y").cast("bigint").alias("y"))


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_extension(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("quantity"), F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN p_size >= 40 THEN 1 WHEN p_size >= 25 THEN 2 WHEN p_size >= 10 THEN 3 ELSE 0 END AS level, CAST(p_size // 8 AS INTEGER) AS byte, length(ltrim(bin(p_size >> 2), '0')) AS width FROM part")
def bit_geometry(spark, sf_dir):
    size = F.col("p_size")
    return _t(spark, sf_dir, "part").select(
        "p_partkey", geometry.heading_level(size, {40: 1, 25: 2, 10: 3}).alias("level"), F.floor(size / 8).cast("int").alias("byte"), geometry.mask_width(size.cast("bigint"), F.lit(2)).cast("bigint").alias("width")
    )


@query("""WITH b AS (SELECT l_orderkey, min(l_partkey) AS x0, min(l_suppkey) AS y0, max(l_partkey) AS x1, max(l_suppkey) AS y1, count(*) AS n FROM lineitem GROUP BY l_orderkey) SELECT * FROM b""")
def bounding_boxes(spark, sf_dir):
    point = F.struct(F.col("l_partkey").alias("x0"), F.col("l_suppkey").alias("y0"), F.col("l_partkey").alias("x1"), F.col("l_suppkey").alias("y1"))
    return aggregates.bounding_box(_t(spark, sf_dir, "lineitem").select("l_orderkey", point.alias("bbox")), ["l_orderkey"]).select("l_orderkey", "bbox.*", "n")


@query("SELECT r_name || '/' || n_name AS path, row_number() OVER (PARTITION BY r_name ORDER BY n_name DESC) AS place FROM region JOIN nation ON n_regionkey = r_regionkey")
def tree_reverse_order(spark, sf_dir):
    nodes = _t(spark, sf_dir, "region").join(_t(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey")).select("r_name", F.concat("r_name", F.lit("/"), "n_name").alias("path"))
    return nodes.select("path", trees.reverse_preorder("path", ["r_name"]).cast("bigint").alias("place"))


@query("""SELECT user_id, floor(epoch_us(ts) / 3600000000)::BIGINT AS line, count(*) AS glyphs, min(event_id) AS first FROM events GROUP BY user_id, floor(epoch_us(ts) / 3600000000)""")
def line_buckets(spark, sf_dir):
    line = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000)
    return layout.line_buckets(_t(spark, sf_dir, "events").withColumn("line", line), ["user_id", "line"], "event_id")


@query("SELECT count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders")
def pivot_status(spark, sf_dir):
    return _t(spark, sf_dir, "orders").groupBy().pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))


def _matrix(spark, sf_dir):
    """Suppliers by nation as a table with a row header that spans a nation's rows, scanned and placed on its grid."""
    both = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    few = both.groupBy("n_nationkey", "n_name").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("s"))
    first = F.concat(F.lit("<tr><th rowspan='"), F.size("s").cast("string"), F.lit("'>"), "n_name", F.lit("</th>"))
    body = F.transform("s", lambda x: F.concat(F.lit("<td>"), x["s_suppkey"].cast("string"), F.lit("</td><td>"), x["s_name"], F.lit("</td></tr>")))
    page = F.concat(F.lit("<table>"), first, F.array_join(body, "<tr>"), F.lit("</table>"))
    return tables.grid(html.items(few.select(F.col("n_nationkey").cast("string").alias("doc"), F.lit("n").alias("chapter"), page.alias("html"))))


@query("""WITH s AS (SELECT n_nationkey, n_name, s_suppkey, s_name, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) - 1 AS INTEGER) AS gy,
        CAST(count(*) OVER (PARTITION BY n_nationkey) AS INTEGER) AS height FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT n_nationkey || '#n#0' AS table_id, 0 AS gx, gy, 3 AS width, height, n_name AS text FROM s
    UNION ALL SELECT n_nationkey || '#n#0', 1, gy, 3, height, CAST(s_suppkey AS VARCHAR) FROM s UNION ALL SELECT n_nationkey || '#n#0', 2, gy, 3, height, s_name FROM s""")
def grid_of_spans(spark, sf_dir):
    return _matrix(spark, sf_dir).select("table_id", "gx", "gy", "width", "height", F.col("html").alias("text"))


@query("""SELECT n_nationkey || '#n#0' AS table_id, s_name AS text FROM (SELECT *, row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey) WHERE n = 1""")
def cell_point_lookup(spark, sf_dir):
    return tables.cell_at(_matrix(spark, sf_dir), 2, 0).select("table_id", F.col("html").alias("text"))


@query("SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey")
def value_sets(spark, sf_dir):
    return aggregates.sets_by(_t(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "flags").select("l_orderkey", F.array_join("flags", ",").alias("flags"))


@query("SELECT conv_id, string_agg(role, '>' ORDER BY turn, role) AS roles FROM conversations GROUP BY conv_id")
def ordered_lists(spark, sf_dir):
    rows = _t(spark, sf_dir, "conversations")
    return aggregates.lists_by(rows, ["conv_id"], "turn", F.col("role"), "roles").select("conv_id", F.array_join("roles", ">").alias("roles"))


@query("SELECT conv_id, string_agg(left(role, 1), '' ORDER BY turn, left(role, 1)) AS text FROM conversations GROUP BY conv_id")
def line_content(spark, sf_dir):
    glyphs = _t(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("x0"), F.left("role", F.lit(1)).alias("ch"))
    return aggregates.content(glyphs, ["conv_id"])


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def last_row_wins(spark, sf_dir):
    return aggregates.last_wins(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], F.col("o_orderkey"))


@query("SELECT n_regionkey, string_agg(n_nationkey || '=' || n_name, ',' ORDER BY n_nationkey) AS codes FROM nation GROUP BY n_regionkey")
def section_codes(spark, sf_dir):
    codes = aggregates.codes_by_section(_t(spark, sf_dir, "nation"), "n_regionkey", "n_nationkey", "n_name")
    pairs = F.transform(F.array_sort(F.map_entries("codes")), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"]))
    return codes.select("n_regionkey", F.array_join(pairs, ",").alias("codes"))


@query("SELECT 'MEM' || n_nationkey AS memory, CAST(n_nationkey * 16 AS BIGINT) AS bytes FROM nation")
def define_sizes(spark, sf_dir):
    size = F.concat(F.lit("(0x"), F.hex(F.col("n_nationkey") * 16), F.lit("UL)"))
    defines = _t(spark, sf_dir, "nation").select(F.concat(F.lit("MEM"), F.col("n_nationkey").cast("string"), F.lit("_SIZE")).alias("name"), size.alias("expr"))
    return aggregates.memory_sizes(defines.unionByName(defines.withColumn("name", F.lit("OTHER"))))


@query("SELECT n_nationkey, n_name AS name FROM nation UNION SELECT n_nationkey, 'HAS_' || n_regionkey FROM nation")
def tested_names(spark, sf_dir):
    test = F.concat(F.lit("#if defined("), "n_name", F.lit(") || defined HAS_"), F.col("n_regionkey").cast("string"), F.lit(" && defined ("), "n_name", F.lit(")"))
    return aggregates.defined_names(_t(spark, sf_dir, "nation").select("n_nationkey", test.alias("text")), "text", "n_nationkey")


@query("""SELECT l_orderkey, l_linenumber, CAST(count(DISTINCT l_partkey) AS BIGINT) AS pins FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(DISTINCT l_partkey) > 1 AND bool_or(l_returnflag = 'R')""")
def double_positions(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").withColumn("variant", F.when(F.col("l_returnflag") == "R", "x PINREMAP"))
    return aggregates.double_pinout(rows, ["l_orderkey"], "l_linenumber", "l_partkey", "variant")


@query("""SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS r,
    count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS n FROM orders) WHERE r = 1 AND n = 1""")
def unambiguous_best(spark, sf_dir):
    return joins.unambiguous(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], F.col("o_orderpriority"))


@query("SELECT n_nationkey, coalesce(n, 0) AS n FROM nation LEFT JOIN (SELECT s_nationkey AS n_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) USING (n_nationkey)")
def join_with_default(spark, sf_dir):
    n = _t(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return joins.left_with_default(_t(spark, sf_dir, "nation").select("n_nationkey"), n, ["n_nationkey"], {"n": 0})


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def resolved_references(spark, sf_dir):
    nations = _t(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return joins.resolve(nations, _t(spark, sf_dir, "region"), ["r_regionkey"]).select("n_name", "r_name")


@query("""SELECT p_partkey, min(d.p_type) AS define FROM (SELECT p_partkey, p_brand, upper(p_name) AS key FROM part) n
    JOIN (SELECT DISTINCT p_brand, p_type FROM part) d ON n.p_brand = d.p_brand AND d.p_type >= key GROUP BY p_partkey""")
def nearest_define(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    names, defines = part.select("p_partkey", "p_brand", F.upper("p_name").alias("key")), part.select("p_brand", "p_type").distinct()
    return joins.nearest_define(names, defines, "p_brand", F.col("key"), F.col("p_type"), ["p_partkey"]).select("p_partkey", "define")


@query("SELECT n.n_nationkey AS k, m.n_name AS name FROM nation n JOIN nation m ON m.n_nationkey = n.n_nationkey - n.n_nationkey % 3")
def alias_rules(spark, sf_dir):
    k = F.col("n_nationkey")
    rules = _t(spark, sf_dir, "nation").select(k.alias("k"), F.when(k % 3 != 0, k - k % 3).alias("of"), F.col("n_name").alias("name"))
    return joins.alias_lookup(rules.select("k"), rules, "k", "of").select("k", "name")


@query("SELECT p_partkey, p_size + CASE WHEN regexp_matches(p_name, '^small') THEN 1000 WHEN regexp_matches(p_name, 'bolt$') THEN 2000 ELSE 0 END AS address FROM part")
def offsets_by_pattern(spark, sf_dir):
    offsets = spark.createDataFrame([(0, "^small", 1000), (1, "bolt$", 2000)], "ord int, pattern string, offset int")
    parts = _t(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_size").alias("address"))
    return joins.offset_lookup(parts, offsets, "p_name", "pattern", ["p_partkey"]).select("p_partkey", "address")


@query("SELECT r_name || '/' || n_name AS path, r_name AS root FROM region JOIN nation ON n_regionkey = r_regionkey")
def children_by_path(spark, sf_dir):
    regions = _t(spark, sf_dir, "region")
    paths = regions.join(_t(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.concat("r_name", F.lit("/"), "n_name").alias("path"))
    return joins.children_of(paths.unionByName(regions.select(F.col("r_name").alias("path"))), "path", regions.select(F.col("r_name").alias("root")), "root").select("path", F.rtrim(F.col("root"), F.lit("/")).alias("root"))


@query("SELECT p_partkey, p_brand || '|' || left(p_brand, length(p_brand) - length(CAST(p_size AS VARCHAR))) || p_size AS names FROM part")
def text_expand_combo(spark, sf_dir):
    names = text.expand_combo(F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(names, "|").alias("names"))


@query("SELECT p_partkey, 'stm32f40' || p_size % 10 || '.|stm32f41' || p_size % 10 || '.|stm32g0' || p_partkey % 4 || '.' AS pattern FROM part")
def text_device_pattern(spark, sf_dir):
    n = (F.col("p_size") % 10).cast("string")
    caption = F.concat(F.lit("Pins of STM32G0"), (F.col("p_partkey") % 4).cast("string"), F.lit("x and STM32F40"), n, F.lit("x/F41"), n, F.lit("x"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.device_pattern(caption).alias("pattern"))


@query("SELECT o_orderkey, 'stm32' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || CASE WHEN o_orderstatus = 'F' THEN '@m4' ELSE '' END AS name FROM orders")
def text_format_device(spark, sf_dir):
    name = F.concat(F.lit("STM32"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.when(F.col("o_orderstatus") == "F", "@M4").otherwise(""))
    return _t(spark, sf_dir, "orders").select("o_orderkey", text.format_device(text.parse_device(name)).alias("name"))


@query("SELECT p_partkey, CASE WHEN p_size % 11 BETWEEN 1 AND 9 THEN 'v' || p_size % 11 || '_' || p_partkey % 10 ELSE p_type || '-v' || p_size % 11 || '_' || p_partkey % 10 || '_0' END AS version FROM part")
def text_clean_version(spark, sf_dir):
    raw = F.concat("p_type", F.lit("-v"), (F.col("p_size") % 11).cast("string"), F.lit("_"), (F.col("p_partkey") % 10).cast("string"), F.lit("_0"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.clean_version(raw).alias("version"))


@query("""SELECT p_partkey, CASE WHEN p_size % 13 < 11 THEN lower(chr(CAST(65 + p_size % 13 AS INTEGER))) END AS port, CASE WHEN p_size % 13 < 11 THEN CAST(p_partkey % 16 AS INTEGER) END AS number,
    CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_size % 13 >= 11, CASE WHEN p_size % 13 < 11 THEN p_size % 13 END, CASE WHEN p_size % 13 < 11 THEN p_partkey % 16 END,
        'P' || chr(CAST(65 + p_size % 13 AS INTEGER)) || p_partkey % 16, p_partkey) AS INTEGER) AS place FROM part""")
def text_pin_order(spark, sf_dir):
    pin = F.concat(F.lit("P"), F.char(65 + F.col("p_size") % 13), (F.col("p_partkey") % 16).cast("string"))
    parts = _t(spark, sf_dir, "part").withColumn("pin", pin)
    name = text.pin_name("pin")
    place = windows.place(["p_brand"], [text.pin_order("pin"), F.col("p_partkey")]) + 1
    return parts.select("p_partkey", name["port"].alias("port"), name["number"].alias("number"), place.alias("place"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS signal FROM part UNION ALL SELECT p_partkey, p_type FROM part")
def text_split_signals(spark, sf_dir):
    joined = F.concat(F.translate("p_name", " ", "-"), F.lit("--"), "p_type", F.lit("-"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.explode(text.split_signals(joined)).alias("signal"))


@query("SELECT p_partkey, CASE WHEN p_size = 13 THEN NULL WHEN p_size = 2 THEN 45 WHEN p_size = 50 THEN 8226 ELSE p_size END AS code FROM part")
def text_visible_glyph(spark, sf_dir):
    code = F.when(F.col("p_size") == 50, 61623).otherwise(F.col("p_size"))
    return _t(spark, sf_dir, "part").select("p_partkey", text.visible_glyph(code).alias("code"))


@query("SELECT p_partkey, replace(p_name, ' ', '_') || '_mm2_' || lower(p_type) AS slug, p_size || '.' || p_partkey || '__' || replace(p_name, ' ', '_') || '_' || p_type AS file FROM part")
def text_slugs(spark, sf_dir):
    title = F.concat(F.col("p_size").cast("string"), F.lit("."), F.col("p_partkey").cast("string"), F.lit(": "), "p_name", F.lit(" (mm²)/"), "p_type")
    plain = F.concat(F.col("p_size").cast("string"), F.lit("."), F.col("p_partkey").cast("string"), F.lit(": "), "p_name", F.lit("/"), "p_type")
    return _t(spark, sf_dir, "part").select("p_partkey", text.slug(title).alias("slug"), text.file_name(plain).alias("file"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 3 THEN NULL ELSE CAST(p_partkey * 3 AS BIGINT) END AS number,
    CAST(p_size * 1000 + 500 AS BIGINT) AS millivolts, CAST(p_size * 1000000 AS BIGINT) AS hertz FROM part""")
def text_numbers(spark, sf_dir):
    n, kind = F.col("p_partkey") * 3, F.col("p_size") % 4
    written = F.when(kind == 0, F.concat(F.lit("0x"), F.lower(F.hex(n)))).when(kind == 1, F.concat(F.lit("0b"), F.bin(n))).when(kind == 2, n.cast("string")).otherwise(F.lit("n/a"))
    size = F.col("p_size").cast("string")
    return _t(spark, sf_dir, "part").select("p_partkey", text.number_of(written).alias("number"), text.quantity(F.concat(F.lit("above "), size, F.lit(".5 V"))).alias("millivolts"), text.quantity(F.concat(size, F.lit("MHz max"))).alias("hertz"))


@query("SELECT p_partkey, upper(split_part(p_name, ' ', 1)) || p_size || ',' || p_type AS vectors, upper(p_type) || '-' || p_size AS offset_ FROM part")
def text_vendor_rules(spark, sf_dir):
    first = F.upper(F.substring_index("p_name", " ", 1))
    cell = F.concat(F.lit("<p>"), first, F.col("p_size").cast("string"), F.lit("_IRQn</p><p>"), "p_type", F.lit(" (reserved)</p>"))
    span = F.concat(F.upper("p_type"), F.lit(" to "), F.col("p_size").cast("string"), F.lit(" (2)"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(text.vector_names(cell), ",").alias("vectors"), text.fold(span, text.OFFSET_RULES).alias("offset_"))


@query("""SELECT p_partkey, 'LQFP' || p_size || '+' || p_type AS name, 'LQFP' AS family, p_size AS pins FROM part
    UNION ALL SELECT p_partkey, 'UFQFPN' || p_size || '+' || p_type, 'UFQFPN', p_size FROM part""")
def text_packages(spark, sf_dir):
    n = F.col("p_size").cast("string")
    domain = F.concat(F.lit("Pin:Number:LPQF"), n, F.lit("/UFQFN "), n, F.lit("_"), "p_type")
    found = F.explode(text.packages(domain)).alias("p")
    return _t(spark, sf_dir, "part").select("p_partkey", found).select("p_partkey", "p.name", "p.family", "p.pins")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'flash' WHEN 'O' THEN 'eeprom' ELSE 'x' || o_orderkey % 3 END AS memory,
    CASE o_orderkey % 3 WHEN 0 THEN 'wb0x' WHEN 1 THEN 'h7rsxx' ELSE 'f4xx' END AS folder FROM orders""")
def text_renames(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    raw = F.when(F.col("o_orderstatus") == "F", "irom1").when(F.col("o_orderstatus") == "O", "m24_eeprom.flm").otherwise(F.concat(F.lit("x"), k.cast("string")))
    device = F.when(k == 0, "STM32WB09").when(k == 1, "STM32H7S3").otherwise("STM32F407")
    return _t(spark, sf_dir, "orders").select("o_orderkey", text.memory_name(raw).alias("memory"), text.hal_folder(device).alias("folder"))


@query("""WITH r AS (SELECT n_name AS name, n_nationkey AS id FROM nation UNION ALL SELECT 'GENERATOR' || n_nationkey, n_nationkey + 100 FROM nation UNION ALL SELECT 'DAC' || n_nationkey || '_CHANNEL1', n_nationkey + 200 FROM nation WHERE n_nationkey < 10)
    SELECT * FROM r UNION ALL SELECT 'DMA_' || name, id FROM r WHERE name LIKE 'GENERATOR%' UNION ALL SELECT replace(name, 'CHANNEL', 'CH'), id FROM r WHERE name LIKE 'DAC%'""")
def request_aliases(spark, sf_dir):
    nations, k = _t(spark, sf_dir, "nation"), F.col("n_nationkey")
    names = nations.select(F.col("n_name").alias("name"), k.alias("id")).unionByName(nations.select(F.concat(F.lit("GENERATOR"), k.cast("string")).alias("name"), (k + 100).alias("id")))
    names = names.unionByName(nations.filter(k < 10).select(F.concat(F.lit("DAC"), k.cast("string"), F.lit("_CHANNEL1")).alias("name"), (k + 200).alias("id")))
    return devices.request_map(names)


@query("SELECT doc_id, source FROM documents WHERE regexp_matches(source, '(?i)SRC1')")
def rows_by_pattern(spark, sf_dir):
    return filters.by_pattern(_t(spark, sf_dir, "documents").select("doc_id", "source"), "source", "SRC1")


@query("SELECT p_partkey, CASE WHEN p_type LIKE '%O%' THEN 'type|' ELSE '' END || 'size' AS keys, CASE WHEN p_type LIKE '%O%' THEN p_name END AS value FROM part")
def map_keys_by_pattern(spark, sf_dir):
    m = F.create_map(F.when(F.contains("p_type", F.lit("O")), "type").otherwise("other"), "p_name", F.lit("size"), F.col("p_size").cast("string"))
    values = maps.match_values(m, "^TYPE$")
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(maps.match_keys(m, "TYPE|SIZE"), "|").alias("keys"), F.get(values, 0).alias("value"))


@query("SELECT p_partkey, regexp_matches(p_brand, 'Brand#1') OR regexp_matches(p_brand, '3$') AS fits FROM part")
def any_filter_of_map(spark, sf_dir):
    wanted = F.create_map(F.lit("brand"), F.array(F.lit("Brand#1"), F.lit("3$")), F.lit("absent"), F.array(F.lit(".")))
    return _t(spark, sf_dir, "part").select("p_partkey", maps.any_filter(wanted, F.create_map(F.lit("brand"), "p_brand")).alias("fits"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'left' END AS a, p_brand AS b FROM part")
def map_overlay(spark, sf_dir):
    left, right = F.create_map(F.lit("a"), F.lit("left"), F.lit("b"), "p_brand"), F.create_map(F.when(F.col("p_size") % 2 == 0, "a").otherwise("c"), "p_name")
    both = maps.overlay(left, right)
    return _t(spark, sf_dir, "part").select("p_partkey", F.element_at(both, "a").alias("a"), F.element_at(both, "b").alias("b"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(source || p, '^-+', ''), '-+$', '') AS stripped FROM (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN '--' ELSE '-x-' END AS p FROM documents)")
def strip_lists(spark, sf_dir):
    ends = F.when(F.col("doc_id") % 3 == 0, "--").otherwise("-x-")
    letters = F.split(F.concat("source", ends), "")
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(maps.strip(letters, lambda c: c == "-"), "").alias("stripped"))


@query("""SELECT s_suppkey, CAST(s_nationkey % 5 = s_nationkey % 7 AS BOOLEAN) AS inside, CASE WHEN s_nationkey % 3 = 0 THEN 'horizontal' WHEN s_nationkey % 4 = 0 THEN 'vertical' ELSE 'angle' END AS direction,
    s_nationkey + 4 > 10 AND 15 > s_nationkey AS overlap FROM supplier""")
def geometry_predicates(spark, sf_dir):
    k = F.col("s_nationkey")
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    strip = geometry.box(k % 5, F.lit(1), k % 5, F.lit(0))
    inside = geometry.contains_point(strip, point(k % 7, F.lit(1)))
    direction = geometry.direction(point(F.lit(0), F.lit(0)), point(k % 4, k % 3))
    return _t(spark, sf_dir, "supplier").select("s_suppkey", inside.alias("inside"), direction.alias("direction"), geometry.interval_overlaps(k, k + 4, F.lit(10), F.lit(15)).alias("overlap"))


@query("""SELECT s_suppkey, CAST(s_nationkey * 2 AS DOUBLE) AS x0, CAST(s_nationkey * 2 + 20 AS DOUBLE) AS x1, CAST(s_nationkey + 5 AS DOUBLE) AS mid, CAST(s_nationkey * s_nationkey + 9 AS DOUBLE) AS far FROM supplier""")
def geometry_measures(spark, sf_dir):
    k = F.col("s_nationkey").cast("double")
    unit = geometry.box(k, F.lit(0.0), k + 10, F.lit(3.0))
    scaled = geometry.scaled_area(unit, F.lit(2.0), F.lit(1.0))
    far = geometry.squared_distance(F.struct(k.alias("x"), F.lit(3.0).alias("y")), F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")))
    return _t(spark, sf_dir, "supplier").select("s_suppkey", scaled["x0"].alias("x0"), scaled["x1"].alias("x1"), geometry.midpoint(unit)["x"].alias("mid"), far.alias("far"))


@query("SELECT s_suppkey, unnest(generate_series(CAST(s_nationkey * 4 AS BIGINT), s_nationkey * 4 + 3)) AS byte FROM supplier")
def register_bytes(spark, sf_dir):
    address = F.col("s_nationkey").cast("bigint") * 4
    return _t(spark, sf_dir, "supplier").select("s_suppkey", F.explode(geometry.byte_range(address, F.lit(4))).alias("byte"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity + 0.5 BETWEEN 10 AND 20 AND l_linenumber + 0.5 BETWEEN 2 AND 4")
def glyphs_in_area(spark, sf_dir):
    x, y = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    chars = _t(spark, sf_dir, "lineitem").withColumn("bbox", geometry.box(x, y, x + 1, y + 1))
    return filters.chars_in_area(chars, 10, 2, 20, 4).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT p_partkey, CAST(length(split_part(p_name, ' ', 1)) + 1 AS INTEGER) AS at FROM part WHERE split_part(p_name, ' ', 2) = 'bolt' UNION ALL SELECT p_partkey, CAST(length(p_name) + 1 AS INTEGER) FROM part")
def find_words(spark, sf_dir):
    lines = _t(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" BOLT bolts")).alias("line"))
    return filters.find_words(lines, "line", "bolt", case_sensitive=False).select("p_partkey", "at")


@query("SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE 'small%' AND p_name NOT LIKE '%bolt' AND p_name <> 'cold widget'")
def usable_defines(spark, sf_dir):
    return filters.usable_defines(_t(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", ["bolt"], ["small"], ["cold widget"])


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand NOT LIKE 'Brand#1%' AND p_brand NOT LIKE 'Brand#3%'")
def without_prefixes(spark, sf_dir):
    return filters.without_prefixes(_t(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", ["Brand#1", "Brand#3"])


@query("SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_size ORDER BY length(p) DESC, length(regexp_replace(p, '[^x.]', '', 'g')), instr(p, 'x') DESC, p, p_partkey) AS INTEGER) AS place FROM (SELECT p_partkey, p_size, p_name || '.x' || p_type AS p FROM part)")
def pattern_specificity(spark, sf_dir):
    parts = _t(spark, sf_dir, "part").withColumn("p", F.concat("p_name", F.lit(".x"), "p_type"))
    return parts.select("p_partkey", (windows.place(["p_size"], [filters.specificity("p"), F.col("p_partkey")]) + 1).alias("place"))


@query("""WITH b AS (SELECT l_orderkey, min(r) AS rotation FROM (SELECT l_orderkey, l_linenumber % 3 AS r, rank() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC) AS k FROM lineitem GROUP BY 1, 2) WHERE k = 1 GROUP BY 1)
    SELECT l_orderkey, avg(l_quantity) AS origin, avg(CAST(l_returnflag = 'R' AS INTEGER)) AS bold_share, min(rotation) AS rotation FROM lineitem JOIN b USING (l_orderkey) GROUP BY l_orderkey""")
def line_figures(spark, sf_dir):
    chars = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").alias("origin"), (F.col("l_returnflag") == "R").alias("bold"), (F.col("l_linenumber") % 3).alias("rotation"))
    return aggregates.line_figures(chars, ["l_orderkey"])


@query("""SELECT event_id, coalesce(CAST(round((lag(value) OVER w - value) / 60) AS INTEGER), 0) AS breaks FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def newlines_between(spark, sf_dir):
    breaks = windows.newlines(F.col("value"), F.lit(40.0), 1.5, ["user_id"], ["ts", "event_id"])
    return _t(spark, sf_dir, "events").select("event_id", breaks.alias("breaks"))


@query("""SELECT event_id, coalesce(last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id),
    first_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), value) AS value FROM events""")
def fill_boxes(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", windows.fill_boxes(F.col("value"), F.col("event_type") != "error", ["user_id"], ["ts", "event_id"]).alias("value"))


@query("SELECT 'root/' || r_name || '/' || n_name AS path FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_name LIKE '%1%' UNION ALL SELECT 'root/' || r_name FROM region WHERE r_name LIKE '%1%'")
def tree_find(spark, sf_dir):
    return trees.find(_region_tree(spark, sf_dir), F.contains("name", F.lit("1")), 3).select("path")


def _region_tree(spark, sf_dir):
    regions, nations = _t(spark, sf_dir, "region"), _t(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    top = regions.select(F.concat(F.lit("root/"), "r_name").alias("path"), F.col("r_name").alias("name"))
    return top.unionByName(nations.join(regions, "r_regionkey").select(F.concat(F.lit("root/"), "r_name", F.lit("/"), "n_name").alias("path"), F.col("n_name").alias("name")))


@query("SELECT '    ' || n_name AS line FROM nation UNION ALL SELECT '  ' || r_name FROM region")
def tree_outline(spark, sf_dir):
    return trees.outline(_region_tree(spark, sf_dir))


@query("SELECT n_name AS name FROM nation WHERE NOT (n_nationkey >= 10 AND n_nationkey % 10 = 0)")
def tree_without_aliases(spark, sf_dir):
    return trees.without_aliases(_t(spark, sf_dir, "nation").select(F.col("n_name").alias("name")), "0")


@query("SELECT s_suppkey, s_nationkey * 4096 + c_custkey * 4 AS address FROM supplier JOIN customer ON s_nationkey = c_nationkey")
def tree_instantiate(spark, sf_dir):
    instances = _t(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("type"), (F.col("s_nationkey") * 4096).alias("base"))
    registers = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("type"), (F.col("c_custkey") * 4).alias("offset"))
    return trees.instantiate(instances, registers).select("s_suppkey", (F.col("base") + F.col("offset")).alias("address"))


@query("""SELECT n_nationkey AS did, v.position AS position, 'N' || n_nationkey % 5 AS peripheral FROM nation, (SELECT unnest(generate_series(0, 9)) AS position) v WHERE contains('N' || v.position || '_IRQ', 'N' || n_nationkey % 5)""")
def graph_interrupts(spark, sf_dir):
    nations = _t(spark, sf_dir, "nation")
    vectors = nations.select(F.col("n_nationkey").alias("did"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(9).cast("bigint"))).alias("position"))
    vectors = vectors.withColumn("name", F.concat(F.lit("N"), F.col("position").cast("string"), F.lit("_IRQ")))
    return trees.interrupts_of(vectors, nations.select(F.col("n_nationkey").alias("did"), F.concat(F.lit("N"), (F.col("n_nationkey") % 5).cast("string")).alias("name")))


@query("""WITH RECURSIVE e AS (SELECT n_nationkey AS a, (n_nationkey * 2 + n_regionkey) % 25 AS b FROM nation), r(node, steps) AS
    (SELECT n_nationkey, 0 FROM nation WHERE n_nationkey = 1 UNION ALL SELECT e.b, r.steps + 1 FROM r JOIN e ON r.node = e.a WHERE r.steps < 3) SELECT node, min(steps) AS steps FROM r GROUP BY node""")
def graph_reachable(spark, sf_dir):
    k = F.col("n_nationkey")
    nations = _t(spark, sf_dir, "nation")
    edges = nations.select(k.alias("a"), ((k * 2 + F.col("n_regionkey")) % 25).alias("b"))
    return trees.reachable(edges, nations.filter(k == 1).select("n_nationkey"), "a", "b", 3)


@query("SELECT DISTINCT r_name FROM region JOIN nation ON r_regionkey = n_nationkey % 4")
def chapters_of_sections(spark, sf_dir):
    chapters = _t(spark, sf_dir, "region").select("r_name", F.concat(F.lit("Chapter "), F.col("r_regionkey").cast("string"), F.lit(" "), "r_name").alias("chapter"))
    sections = _t(spark, sf_dir, "nation").select(F.concat((F.col("n_nationkey") % 4).cast("string"), F.lit(".1."), "n_name").alias("section"))
    return filters.chapters_of(chapters, sections).select("r_name")


@query("SELECT n_name || '.h' AS header, CAST(1 AS INTEGER) AS line_no, n_name || '_SIZE' AS name, '(' || n_nationkey || ' << 2)' AS expr FROM nation")
def header_defines(spark, sf_dir):
    body = F.concat(F.lit("/* a #define in\na comment */#if 1\n#define "), "n_name", F.lit("_SIZE  ("), F.col("n_nationkey").cast("string"), F.lit(" << 2) // bytes\n#define MACRO(x) x\n"))
    return cheader.defines(_t(spark, sf_dir, "nation").select(F.concat("n_name", F.lit(".h")).alias("header"), body.alias("text")))


@query("SELECT n_name || '.h' AS header, n_name || '_SIZE' AS name, CAST(n_nationkey * 4 + 1 AS BIGINT) AS value FROM nation UNION ALL SELECT n_name || '.h', 'BASE', CAST(n_nationkey * 2 AS BIGINT) FROM nation")
def header_values(spark, sf_dir):
    k = F.col("n_nationkey").cast("string")
    body = F.concat(F.lit("#define "), "n_name", F.lit("_SIZE ((BASE << 1) | 0x1UL)\n#define BASE ("), k, F.lit(" + "), k, F.lit(")\n"))
    found = cheader.evaluated(cheader.defines(_t(spark, sf_dir, "nation").select(F.concat("n_name", F.lit(".h")).alias("header"), body.alias("text"))))
    return found.select("header", "name", F.col("value").cast("bigint").alias("value"))


@query("SELECT n_name AS name, unnest(['IRQ' || n_regionkey, 'IRQ' || n_nationkey || '_B']) AS item FROM nation")
def xml_query(spark, sf_dir):
    raw = F.concat(F.lit("<a xmlns='urn:x'><b n='IRQ"), F.col("n_regionkey").cast("string"), F.lit("'/><b n='IRQ"), F.col("n_nationkey").cast("string"), F.lit("_B'/><b n='IRQ"), F.col("n_regionkey").cast("string"), F.lit("'/></a>"))
    return _t(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.explode(xml.query(xml.strip_namespace(raw), "/a/b/@n")).alias("item"))


@query("""WITH m AS (SELECT l_orderkey AS did, l_linenumber AS y, avg(CAST(l_returnflag = 'R' AS INTEGER)) AS b FROM lineitem GROUP BY 1, 2)
    SELECT CAST(did AS VARCHAR) AS table_id, CAST(coalesce(min(CASE WHEN b <= 0.3 THEN y END), max(y) + 1) AS INTEGER) AS header_rows FROM m GROUP BY did""")
def bold_header_rows(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("table_id"), F.col("l_linenumber").alias("y")).agg(F.avg((F.col("l_returnflag") == "R").cast("int")).alias("bold_share"))
    return layout.header_rows(rows)


@query("""WITH g AS (SELECT *, sum(CASE WHEN l_quantity - p > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY l_quantity ROWS UNBOUNDED PRECEDING) AS number
        FROM (SELECT l_orderkey, l_quantity, lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS p FROM (SELECT DISTINCT l_orderkey, l_quantity FROM lineitem)))
    SELECT l_orderkey, CAST(number AS BIGINT) AS number, avg(l_quantity) AS l_quantity FROM g GROUP BY 1, 2""")
def ruled_grid_lines(spark, sf_dir):
    return layout.grid_lines(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity").distinct(), "l_quantity", 2, ["l_orderkey"])


@query("""SELECT l_orderkey, CAST(count(DISTINCT l_linenumber) AS BIGINT) AS n FROM lineitem GROUP BY 1""")
def crosstab_widths(spark, sf_dir):
    table = aggregates.cross_table(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey")
    return table.groupBy("l_orderkey").agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classify parts by first-match rules, coalesce the lines of each class into fields, and group orders of equal structure."""
    parts = devices_first_match(spark, sf_dir).withColumnRenamed("p_partkey", "l_partkey")
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").join(parts, "l_partkey")
    fields = aggregates.bit_fields(lines, ["l_orderkey", "class"], "l_linenumber")
    shape = F.concat_ws(":", F.col("class"), F.col("position").cast("string"), F.col("width").cast("string"))
    return aggregates.structural_groups(fields, "l_orderkey", shape)


_CLASS = "CASE " + " ".join(f"WHEN regexp_matches(p_name, '{p}') THEN '{v}'" for p, v in PART_RULES) + " ELSE '-' END"
QUERIES["flagship"] = flagship
SQL["flagship"] = f"""WITH f AS (SELECT l_orderkey, {_CLASS} AS class, min(l_linenumber) AS position, max(l_linenumber) + 1 - min(l_linenumber) AS width FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
    s AS (SELECT l_orderkey, string_agg(DISTINCT class || ':' || position || ':' || width, '|' ORDER BY class || ':' || position || ':' || width) AS signature FROM f GROUP BY l_orderkey)
    SELECT signature, count(*) AS members, min(l_orderkey) AS first FROM s GROUP BY signature"""
