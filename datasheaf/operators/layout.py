"""Page layout: glyphs to lines, paths to clusters and ruled grids, lines to blocks.

Where a result depends on what was accumulated before (greedy line merging, the
flood through open cell borders, the indentation stack), one page is one group
of a grouped map; all else is windows and joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datasheaf.operators.windows import gap_clusters, merged_intervals


def line_buckets(chars: DataFrame, by: Sequence[str], first: str) -> DataFrame:
    """Glyphs of one bucket of origins (WIN-04's first step): their number and first."""
    return chars.groupBy(*by).agg(F.count("*").alias("glyphs"), F.min(first).alias("first"))


LINES = "doc string, page int, line int, text string, x0 double, y0 double, x1 double, y1 double, height double"


def merge_lines(chars: DataFrame, overlap: float = 0.3) -> DataFrame:
    """Glyphs (doc, page, x0, y0, x1, y1, origin, ch) to lines from the top (WIN-04, LAY-01).

    Glyphs whose origin rounds to the same tenth are a line. From the top, a line
    joins the one before it if the two, each widened by ``overlap`` of the taller
    one's height, overlap; the taller one then stands for both. A page is a group.
    """

    def page(glyphs: pd.DataFrame) -> pd.DataFrame:
        glyphs = glyphs[glyphs["ch"].str.strip().astype(bool)]
        out: list[dict] = []
        for _, line in sorted(glyphs.groupby(glyphs["origin"].round(1)), key=lambda kv: -kv[0]):
            height, origin = float((line["y1"] - line["y0"]).max()), float(line["origin"].mean())
            last = out[-1] if out else None
            tall = max(height, last["height"]) if last else 0
            if last and last["origin"] - overlap * tall < origin + overlap * tall:
                last["glyphs"].append(line)
                if height > last["height"]:
                    last |= {"height": height, "origin": origin}
            else:
                out.append({"glyphs": [line], "height": height, "origin": origin})
        rows = []
        for n, x in enumerate(out):
            g = pd.concat(x["glyphs"]).sort_values(["x0", "y0"], kind="stable")
            rows.append((g["doc"].iloc[0], int(g["page"].iloc[0]), n, "".join(g["ch"]), g["x0"].min(), g["y0"].min(), g["x1"].max(), g["y1"].max(), x["height"]))
        return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in LINES.split(", ")])

    return chars.groupBy("doc", "page").applyInPandas(page, LINES)


def char_clusters(chars: DataFrame, gap: Column | float, by: Sequence[str] = ("doc", "page", "line")) -> DataFrame:
    """Runs of glyphs on a line, cut where the distance to the one before is more than the gap (WIN-03)."""
    return gap_clusters(chars, F.col("x0"), gap, list(by), ["x0"])


def graphic_clusters(paths: DataFrame, tolerance: float, by: Sequence[str] = ("doc", "page")) -> DataFrame:
    """Boxes (x0, y0, x1, y1) into clusters: first by overlap in y, then inside each band by overlap in x (LAY-02). In reading order."""
    wide = paths.withColumns({"lo": F.col("y0") - tolerance, "hi": F.col("y1") + tolerance})
    bands = merged_intervals(wide, "lo", "hi", by).drop("n").withColumnsRenamed({"lo": "band0", "hi": "band1"})
    inside = paths.join(bands, list(by)).filter((F.col("y0") >= F.col("band0")) & (F.col("y1") <= F.col("band1")))
    wide = inside.withColumns({"lo": F.col("x0") - tolerance, "hi": F.col("x1") + tolerance})
    columns = merged_intervals(wide, "lo", "hi", [*by, "band0", "band1"]).drop("n")
    found = inside.join(columns, [*by, "band0", "band1"]).filter((F.col("x0") >= F.col("lo")) & (F.col("x1") <= F.col("hi")))
    boxes = found.groupBy(*by, "band0", "lo").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("paths"))
    return boxes.drop("band0", "lo").withColumn("cluster", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("y1"), "x0")) - 1)


def classify_graphics(clusters: DataFrame, captions: DataFrame, em: float, by: Sequence[str] = ("doc", "page")) -> DataFrame:
    """kind of each cluster: by the nearest caption above it whose columns it lies in, else table if it is ruled, figure if not (LAY-03, JOI-10). Clusters below one em are dropped."""
    c = clusters.filter((F.col("x1") - F.col("x0") >= em) & (F.col("y1") - F.col("y0") >= em)).alias("c")
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}") == F.col(f"t.{k}") for k in by])
    above = (F.col("t.y0") >= F.col("c.y1") - em) & (F.col("t.x0") <= F.col("c.x1")) & (F.col("c.x0") <= F.col("t.x1"))
    near = c.join(captions.alias("t"), same & above, "left")
    best = near.groupBy(*[F.col(f"c.{k}") for k in (*by, "cluster")]).agg(F.min_by(F.struct(F.col("t.kind").alias("kind"), F.col("t.text").alias("text")), F.col("t.y0") - F.col("c.y1")).alias("caption"))
    ruled = F.when(F.col("paths") > 1, "table").otherwise("figure")
    return clusters.join(best, [*by, "cluster"]).withColumn("kind", F.coalesce("caption.kind", ruled)).withColumn("caption", F.col("caption.text"))


def grid_lines(lines: DataFrame, position: str, tolerance: float, by: Sequence[str]) -> DataFrame:
    """Positions of ruled lines: those closer than the tolerance are one, at their mean (TAB-09)."""
    found = gap_clusters(lines, F.col(position), tolerance, list(by), [position])
    return found.groupBy(*by, "cluster").agg(F.avg(position).alias(position)).withColumnRenamed("cluster", "number")


def register_columns(chars: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bit number and its place in a register's header strip (TAB-10): digits that adjoin are one number."""
    close = gap_clusters(chars.filter(F.col("ch").rlike(r"^\d$")), F.col("x0"), F.lit(1.5) * (F.col("x1") - F.col("x0")), list(by), ["x0"])
    digits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "ch"))), lambda d: d["ch"]), "")
    return close.groupBy(*by, "cluster").agg(digits.try_cast("int").alias("bit"), F.min("x0").alias("x0"), F.max("x1").alias("x1")).filter("bit between 0 and 31").drop("cluster")


SPANS = "table_id string, cell_id int, x int, y int, xspan int, yspan int"


def merge_open_cells(borders: DataFrame) -> DataFrame:
    """Places (table_id, x, y, open_right, open_bottom booleans) into cells (TAB-11, TAB-12).

    A border is open only if both sides say so where both are known; what is
    connected through open borders is one cell, its span the box around it. A
    table is a group.
    """

    def table(places: pd.DataFrame) -> pd.DataFrame:
        root = {(x, y): (x, y) for x, y in zip(places["x"], places["y"], strict=True)}

        def find(p):
            while root[p] != p:
                root[p] = root[root[p]]
                p = root[p]
            return p

        for r in places.itertuples(index=False):
            for is_open, q in ((r.open_right, (r.x + 1, r.y)), (r.open_bottom, (r.x, r.y + 1))):
                if is_open and q in root:
                    a, b = sorted((find((r.x, r.y)), find(q)))
                    root[b] = a
        groups: dict = {}
        for p in root:
            groups.setdefault(find(p), []).append(p)
        rows = []
        for n, points in enumerate(sorted(groups.values(), key=lambda g: min((y, x) for x, y in g))):
            xs, ys = [x for x, _ in points], [y for _, y in points]
            rows.append((places["table_id"].iloc[0], n, min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1))
        return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in SPANS.split(", ")])

    return borders.groupBy("table_id").applyInPandas(table, SPANS)


def header_rows(rows: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Header rows of each table: the rows from the top whose share of bold glyphs is above the threshold (TAB-12). ``rows``: table_id, y, bold_share."""
    plain = rows.groupBy("table_id").agg(F.min(F.when(F.coalesce("bold_share", F.lit(0.0)) <= threshold, F.col("y"))).alias("first_plain"), (F.max("y") + 1).alias("height"))
    return plain.select("table_id", F.coalesce("first_plain", "height").alias("header_rows"))


def left_aligned(lines: Column, x0: Column, em: float) -> Column:
    """All lines of a cell start within one em of its left edge (TAB-17)."""
    return F.forall(lines, lambda line: line["x0"] - x0 < em)


BLOCKS = "doc string, page int, block int, kind string, level int, text string, x0 double"
#: What opens a block, in order of precedence.
OPENERS = (
    ("note", r"^(?:Note|Caution|Warning):?\b"),
    ("caption", r"^(?:Figure|Table) \d+\."),
    ("list_bullet", r"^[•–]\s*"),
    ("list_number", r"^\d+\.\s+"),
    ("list_letter", r"^[a-z]\)\s+"),
    ("bit", r"^B[iu]ts? \d+"),
)


def blocks(lines: DataFrame, em: float, content_x: float = 0.0) -> DataFrame:
    """Lines (doc, page, line, text, x0, bold, heading_level, newlines) to blocks, by an indentation stack (LAY-04).

    A bold line with a heading level is a heading, by its numbering if it has one;
    a line that an opener matches starts such a block; two or more line breaks, or
    a step left of the open block by over one em, start a paragraph; else the
    line continues the open block. Level is the depth of indentation, of headings
    their own. A page is a group.
    """
    import re

    openers = [(k, re.compile(p)) for k, p in OPENERS]
    numbered = re.compile(r"^(\d+(?:\.\d+){0,3})\s")

    def page(group: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        stack: list[float] = []
        for r in group.sort_values("line").itertuples(index=False):
            text = (r.text or "").strip()
            kind = next((k for k, p in openers if p.search(text)), None)
            if kind == "caption" and not r.bold:
                kind = None
            head = bool(r.bold) and int(r.heading_level) > 0 and r.x0 < content_x + 2 * em and kind is None
            while stack and r.x0 < stack[-1] - em:
                stack.pop()
            if head:
                found = numbered.match(text)
                level = found.group(1).count(".") + 1 if found else int(r.heading_level)
                if out and out[-1][3] == "heading" and out[-1][4] == level and r.newlines < 2 and not found:
                    out[-1][5] += " " + text
                    continue
                stack = []
                out.append([r.doc, r.page, len(out), "heading", level, text, r.x0])
                continue
            left = bool(out) and r.x0 < out[-1][6] - em
            if kind or not out or out[-1][3] == "heading" or r.newlines >= 2 or left:
                if not stack or r.x0 > stack[-1] + em:
                    stack.append(r.x0)
                out.append([r.doc, r.page, len(out), kind or "paragraph", len(stack), text, r.x0])
            else:
                out[-1][5] += " " + text
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in BLOCKS.split(", ")])

    return lines.groupBy("doc", "page").applyInPandas(page, BLOCKS)


def merge_pages(blocks: DataFrame) -> DataFrame:
    """Blocks of all pages of a document in order, each under its latest heading (LAY-05, LAY-06, LAY-07): doc, position, kind, level, text, heading."""
    w = Window.partitionBy("doc").orderBy("page", "block")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    out = blocks.withColumn("position", F.row_number().over(w) - 1).withColumn("heading", F.last(F.when(F.col("kind") == "heading", F.col("text")), ignorenulls=True).over(so_far))
    return out.select("doc", "position", "page", "kind", "level", "text", "heading", "x0")


def grouped_lists(blocks: DataFrame) -> DataFrame:
    """Runs of list blocks of one kind and level as one list (LAY-07, WIN-02): doc, first, kind, level, items."""
    w = Window.partitionBy("doc").orderBy("position")
    key = F.struct("kind", "level", "heading")
    changed = (~key.eqNullSafe(F.lag(key).over(w))).cast("int")
    runs = blocks.withColumn("__c", changed).withColumn("__r", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(F.startswith(F.col("kind"), F.lit("list_")))
    items = F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda x: x["text"])
    return runs.groupBy("doc", "__r", "kind", "level").agg(F.min("position").alias("first"), items.alias("items")).drop("__r")


def caption_targets(blocks: DataFrame, reach: int = 5) -> DataFrame:
    """Each caption with the next table or figure within so many blocks (JOI-12, LAY-07)."""
    w = Window.partitionBy("doc").orderBy("position").rowsBetween(1, reach)
    wanted = F.when(F.startswith(F.col("text"), F.lit("Table")), "table").otherwise("figure")
    following = F.collect_list(F.struct("position", "kind")).over(w)
    hit = F.get(F.filter(following, lambda x: x["kind"] == wanted), F.lit(0))
    return blocks.withColumn("__hit", hit).filter("kind = 'caption'").select("doc", "position", "text", F.col("__hit.position").alias("target"))


def chapters(blocks: DataFrame, level: int = 1) -> DataFrame:
    """Blocks under the latest heading of a level, with its number (LAY-08)."""
    w = Window.partitionBy("doc").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    top = (F.col("kind") == "heading") & (F.col("level") <= level)
    return blocks.withColumn("chapter_no", F.sum(top.cast("int")).over(w)).withColumn("chapter", F.last(F.when(top, F.col("text")), ignorenulls=True).over(w))


def contents(entries: DataFrame) -> DataFrame:
    """(doc, page, level, title) of a table of contents (SRC-10): an entry without a page has that of the one before it; each (page, title) once, in order. ``entries``: doc, ord, page, level, title."""
    w = Window.partitionBy("doc").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    # page 0 counts as missing
    filled = entries.withColumn("page", F.coalesce(F.last(F.when(F.col("page") != 0, F.col("page")), ignorenulls=True).over(w), F.lit(0)))
    return filled.groupBy("doc", "page", "title").agg(F.min_by("level", "ord").alias("level")).select("doc", "page", "level", "title").orderBy("doc", "page", "level", "title")


def page_template(producer: Column, templates: Sequence[tuple[str, str]], default: str) -> Column:
    """Layout template by what made the document: the first pattern found (LAY-09, FLT-15)."""
    out = F.lit(default)
    for pattern, name in reversed(templates):
        out = F.when(producer.rlike(pattern), name).otherwise(out)
    return out


def overlays(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(kind, colour, doc, page, x0, y0, x1, y1) of what a debug view would draw (SNK-08)."""
    out = None
    for kind, (df, colour) in tables.items():
        part = df.select(F.lit(kind).alias("kind"), F.lit(colour).alias("colour"), "doc", "page", "x0", "y0", "x1", "y1")
        out = part if out is None else out.unionByName(part)
    return out
