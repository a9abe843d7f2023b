"""Lines and regions of a page: de-duplication, reading order, assignment, table candidates, routing, blocks.

All operators work on the key (doc_id, page), so that one shuffle by it serves a chain of them. Order-dependent greedy
rules are folds over the sorted boxes of one page; each order ends with the ordinal of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import geometry as geo
from scriptorium.functions import text as tx
from scriptorium.functions.geometry import Box

PAGE = ["doc_id", "page"]
LINE_IOU, LINE_OVERLAP, REGION_IOU, TABLE_OVERLAP = 0.38, 0.72, 0.45, 0.70
#: Table candidates: least and greatest share of the page, least squareness, least lines, padding, line and candidate overlap.
MIN_AREA, MAX_AREA, MIN_SQUARE, MIN_LINES, PADDING, LINE_SHARE, CANDIDATE_SHARE = 0.05, 0.65, 0.25, 2, 0.008, 0.55, 0.30
SEPARATE = ("page_number", "date", "title", "subtitle", "list_item", "formula")


def fold_first_match(rows: Column, matches, merge, kept_type: str) -> Column:
    """Folds sorted structs: each is merged into the first kept one that it matches, or else is kept."""

    def step(kept: Column, row: Column) -> Column:
        hit = F.array_position(F.transform(kept, lambda e: matches(e, row)), F.lit(True))
        return tx.let(
            hit,
            lambda at: F.when(at == 0, F.array_append(kept, row)).otherwise(F.transform(kept, lambda e, k: F.when(k + 1 == at, merge(e, row)).otherwise(e))),
        )

    return F.aggregate(rows, F.array().cast(f"array<{kept_type}>"), step)


def _tiles(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(a["tiles"], b["tiles"])))


def _folded(df: DataFrame, order: list[Column], fields: list[str], matches, merge) -> DataFrame:
    """One fold for each page; ``order`` is put before the fields, and ends with what makes it total."""
    row = F.struct(*(c.alias(f"k{n}") for n, c in enumerate(order)), *fields)
    pages = df.groupBy(*PAGE).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    kind = pages.schema["rows"].dataType.elementType.simpleString()
    folded = pages.select(*PAGE, F.explode(fold_first_match(F.col("rows"), matches, merge, kind)).alias("r"))
    return folded.select(*PAGE, *(F.col(f"r.{f}").alias(f) for f in fields))


def dedup_lines(det: DataFrame) -> DataFrame:
    """One box of the boxes that tiles see of a line. det: (doc_id, page, i, tile, x1, y1, x2, y2, conf, tiles)."""

    def matches(a: Column, b: Column) -> Column:
        x, y = Box.of(a), Box.of(b)
        near = F.abs(x.cy - y.cy) <= F.greatest(x.height, y.height)
        return near & ((geo.iou(x, y) >= F.lit(LINE_IOU)) | (geo.over_smaller(x, y) >= F.lit(LINE_OVERLAP)))

    def better(a: Column, b: Column) -> Column:
        first = F.when(F.abs(a["conf"] - b["conf"]) <= F.lit(0.08), Box.of(a).area >= Box.of(b).area).otherwise(a["conf"] >= b["conf"])
        return F.when(first, a.withField("tiles", _tiles(a, b))).otherwise(b.withField("tiles", _tiles(a, b)))

    fields = ["i", "tile", "x1", "y1", "x2", "y2", "conf", "tiles"]
    return _folded(det, [F.col("y1"), F.col("x1"), -F.col("conf"), F.col("tile"), F.col("i")], fields, matches, better)


def dedup_regions(reg: DataFrame) -> DataFrame:
    """Regions without those that a surer one covers, numbered from the top. reg: (doc_id, page, r, box, conf, tiles)."""
    kept = _folded(
        reg,
        [-F.col("conf"), F.col("r")],
        ["r", "x1", "y1", "x2", "y2", "conf", "tiles"],
        lambda a, b: geo.iou(Box.of(b), Box.of(a)) >= F.lit(REGION_IOU),
        lambda a, b: a.withField("tiles", _tiles(a, b)),
    )
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy("y1", "x1", F.col("conf").desc(), "r"))
    return kept.withColumn("region_id", F.format_string("r%03d", n))


def merge_tables(tables: DataFrame) -> DataFrame:
    """Located tables of which overlapping ones grow together, surest first. tables: (doc_id, page, r, box, conf)."""

    def grow(a: Column, b: Column) -> Column:
        x, y = Box.of(a), Box.of(b)
        return F.struct(
            a["k0"].alias("k0"), a["k1"].alias("k1"), a["r"].alias("r"),
            F.least(x.x1, y.x1).alias("x1"), F.least(x.y1, y.y1).alias("y1"), F.greatest(x.x2, y.x2).alias("x2"), F.greatest(x.y2, y.y2).alias("y2"),
            F.greatest(a["conf"], b["conf"]).alias("conf"),
        )

    kept = _folded(tables, [-F.col("conf"), F.col("r")], ["r", "x1", "y1", "x2", "y2", "conf"], lambda a, b: geo.over_smaller(Box.of(b), Box.of(a)) >= F.lit(TABLE_OVERLAP), grow)
    return kept.withColumn("n", F.row_number().over(Window.partitionBy(*PAGE).orderBy("y1", "x1", F.col("conf").desc(), "r")))


def reading_order(lines: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, page, i, ord) and the columns ``keep`` of lines; ord counts from 1: rows from the top, lines of a row
    from the left. As lines come in the order of their centres, a line can only join the latest row, whose centre is the
    mean of its lines. What is kept goes along, so that no join has to bring it back."""
    row = F.struct(Box.of().cy.alias("cy"), F.col("x1").alias("_x"), "i", *keep)
    pages = lines.groupBy(*PAGE).agg(F.array_sort(F.collect_list(row)).alias("rows"), F.greatest(F.lit(8.0), F.median(Box.of().height) * F.lit(0.45)).alias("tol"))
    start = F.struct(F.lit(0).alias("row"), F.lit(None).cast("double").alias("sum"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        joins = (s["n"] > 0) & (F.abs(x["cy"] - s["sum"] / s["n"]) <= F.col("tol"))
        row = F.when(joins, s["row"]).otherwise(s["row"] + 1)
        return F.struct(
            row.alias("row"), F.when(joins, s["sum"] + x["cy"]).otherwise(x["cy"]).alias("sum"), F.when(joins, s["n"] + 1).otherwise(F.lit(1)).alias("n"), F.array_append(s["out"], row).alias("out")
        )

    placed = pages.select(*PAGE, F.explode(F.arrays_zip("rows", F.aggregate("rows", start, step)["out"].alias("row"))).alias("z"))
    placed = placed.select(*PAGE, F.col("z.rows.i").alias("i"), *(F.col(f"z.rows.{c}").alias(c) for c in keep), F.col("z.rows._x").alias("_x"), F.col("z.rows.cy").alias("_cy"), F.col("z.row").alias("_row"))
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy("_row", "_x", "_cy", "i"))
    return placed.select(*PAGE, "i", n.alias("ord"), *keep)


def covering(lines: DataFrame, boxes: DataFrame, share: float, prefix: str = "b_") -> DataFrame:
    """Pairs of a line (x1 ..) and a box (b_x1 ..) of a page where the box holds the line's centre or enough of it."""
    return lines.join(boxes, PAGE).where(geo.belongs(Box.of(), Box.of(prefix=prefix), share))


def assign_regions(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Each line with its region: that of the greatest overlap, then the smallest, then the first; null without one."""
    boxes = regions.select(*PAGE, "region_id", *(F.col(c).alias(f"b_{c}") for c in ("x1", "y1", "x2", "y2")))
    hits = covering(lines, boxes, 0.35)
    b = Box.of(prefix="b_")
    key = F.struct((-geo.over_smaller(Box.of(), b)).alias("overlap"), b.area.alias("area"), "region_id")
    best = hits.groupBy(*PAGE, "i").agg(F.min(key)["region_id"].alias("region_id"))
    return lines.join(best, [*PAGE, "i"], "left")


def table_candidates(lines: DataFrame, regions: DataFrame, width: int, height: int) -> DataFrame:
    """Regions that may be tables, with their lines and a score, before the choice among them."""
    w, h, box = F.lit(width), F.lit(height), Box.of()
    crop = geo.expand(box, w, h, PADDING)
    shaped = (
        regions.where((box.width > 0) & (box.height > 0))
        .withColumn("area_ratio", box.area / F.lit(max(1, width * height)))
        .withColumn("squareness", F.least(box.width, box.height) / F.greatest(box.width, box.height))
        .where(F.col("area_ratio").between(MIN_AREA, MAX_AREA) & (F.col("squareness") >= F.lit(MIN_SQUARE)))
        .select(*PAGE, "region_id", F.struct("x1", "y1", "x2", "y2", "conf", "area_ratio", "squareness").alias("_shape"), *(c.alias(f"b_{n}") for c, n in zip(crop, ("x1", "y1", "x2", "y2"), strict=True)))
    )
    # The region goes along with its lines, so that it is not made twice.
    hits = covering(lines.select(*PAGE, "i", "x1", "y1", "x2", "y2"), shaped, LINE_SHARE)
    crop_box = ["b_x1", "b_y1", "b_x2", "b_y2"]
    held = hits.groupBy(*PAGE, "region_id").agg(F.array_sort(F.collect_list("i")).alias("lines"), F.first("_shape").alias("_shape"), *(F.first(c).alias(c) for c in crop_box))
    held = held.select(*PAGE, "region_id", "_shape.*", *crop_box, "lines")
    n = F.size("lines")
    score = F.col("squareness") * 2.0 + F.least(F.lit(1.0), F.col("area_ratio") / F.lit(max(MIN_AREA * 3, 1e-6))) + F.least(F.lit(1.0), n / 8) + F.col("conf") * 0.25
    return held.where(n >= MIN_LINES).withColumn("score", score)


def select_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates without those that overlap, or share a line with, one of a higher score; numbered from the top."""
    fields = ["region_id", "x1", "y1", "x2", "y2", "b_x1", "b_y1", "b_x2", "b_y2", "score", "lines"]

    def clash(a: Column, b: Column) -> Column:
        return (geo.over_smaller(Box.of(b, "b_"), Box.of(a, "b_")) >= F.lit(CANDIDATE_SHARE)) | F.arrays_overlap(a["lines"], b["lines"])

    kept = _folded(candidates, [-F.col("score"), F.col("region_id")], fields, clash, lambda a, b: a)
    return kept.withColumn("candidate", F.row_number().over(Window.partitionBy(*PAGE).orderBy("y1", "x1", F.col("score").desc(), "region_id")))


def route(lines: DataFrame, candidates: DataFrame) -> DataFrame:
    """Lines of candidates that succeeded, each with its first candidate as owner."""
    held = candidates.select(*PAGE, "candidate", F.explode("lines").alias("i")).groupBy(*PAGE, "i").agg(F.min("candidate").alias("owner"))
    return lines.join(held, [*PAGE, "i"])


def unrouted(lines: DataFrame, candidates: DataFrame) -> DataFrame:
    """Lines that no candidate that succeeded holds."""
    return lines.join(candidates.select(*PAGE, F.explode("lines").alias("i")), [*PAGE, "i"], "left_anti")


def group_blocks(lines: DataFrame, width: int, height: int) -> DataFrame:
    """Blocks of ordered lines: (doc_id, page, block, type, content, lines, box), and recognizers, the different ones of
    its lines, where lines have a recognizer. A line begins a block where its type or the one before stands alone, the
    type changes, or the gap, the overlap or the indentation says so."""
    box = Box.of()
    page = Window.partitionBy(*PAGE)
    typed = lines.withColumn("type", tx.line_type(F.col("text"), *box, F.lit(width), F.lit(height))).withColumn("mh", F.median(F.greatest(F.lit(1), box.height)).over(page))
    before = page.orderBy("ord")
    prev = {c: F.lag(c).over(before) for c in ("x1", "y1", "x2", "y2", "type")}
    typed = typed.select("*", *(c.alias(f"p_{n}") for n, c in prev.items()))
    p = Box.of(prefix="p_")
    gap = F.col("y1") - p.y2
    alone = lambda t: t.isin(*SEPARATE)
    new = (
        F.col("p_type").isNull() | alone(F.col("type")) | alone(F.col("p_type")) | (F.col("type") != F.col("p_type"))
        | (gap > F.col("mh") * F.lit(1.45))
        | ((geo.x_overlap(box, p) < F.lit(0.15)) & (gap > F.col("mh") * F.lit(0.25)))
        | ((F.abs(F.col("x1") - p.x1) / F.lit(max(1, width)) > F.lit(0.16)) & (gap > F.col("mh") * F.lit(0.45)))
    )
    islands = typed.withColumn("block", F.sum(new.cast("int")).over(before.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    own = F.array_sort(F.collect_list(F.struct("ord", "i", "text")))
    by = [F.array_sort(F.collect_set("recognizer")).alias("recognizers")] if "recognizer" in lines.columns else []
    blocks = islands.groupBy(*PAGE, "block").agg(F.first("type").alias("type"), own.alias("own"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), *by)
    return blocks.select(*PAGE, "block", "type", F.array_join("own.text", "\n").alias("content"), F.col("own.i").alias("lines"), "x1", "y1", "x2", "y2", *(["recognizers"] if by else []))


def merge_blocks(blocks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Text blocks with what recognised them, and the blocks of candidates, numbered from the top.

    blocks: (.., block, type, content, lines, box, recognizers); candidates: (.., candidate, type, content, lines, box)."""
    n = F.size("recognizers")
    recognizer = F.when(n == 1, F.get("recognizers", F.lit(0))).when(n > 1, "hybrid").otherwise("trocr")
    first = blocks.select(*PAGE, "type", "content", "lines", "x1", "y1", "x2", "y2", recognizer.alias("recognizer"), F.lit(0).alias("kind"), F.col("block").alias("n"))
    second = candidates.select(*PAGE, "type", "content", "lines", "x1", "y1", "x2", "y2", F.lit("qwen3-vl").alias("recognizer"), F.lit(1).alias("kind"), F.col("candidate").alias("n"), F.col("candidate"))
    both = first.unionByName(second, allowMissingColumns=True)
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy("y1", "x1", "kind", "n"))
    return both.withColumn("id", F.format_string("b%04d", n)).drop("kind", "n")


def regroup(proposed: DataFrame, lines: DataFrame) -> DataFrame:
    """Blocks proposed by a model over the lines of a page: unknown lines and second uses go, empty blocks go, lines
    that are left come back alone; blocks follow their first line.

    proposed: (doc_id, page, b, type, lines) in the model's order; lines: (doc_id, page, i, ord, text, type)."""
    uses = proposed.select(*PAGE, "b", "type", F.posexplode("lines").alias("pos", "i"))
    first = uses.withColumn("use", F.row_number().over(Window.partitionBy(*PAGE, "i").orderBy("b", "pos"))).where("use = 1")
    known = first.join(lines.select(*PAGE, "i", "ord", "text"), [*PAGE, "i"])
    grouped = known.groupBy(*PAGE, "b", "type").agg(F.array_sort(F.collect_list(F.struct("pos", "i", "ord", "text"))).alias("own"))
    used = grouped.select(*PAGE, "type", F.array_join("own.text", "\n").alias("content"), F.col("own.i").alias("lines"), F.array_min("own.ord").alias("first"))
    rest = lines.join(first.select(*PAGE, "i"), [*PAGE, "i"], "left_anti").select(*PAGE, "type", F.col("text").alias("content"), F.array("i").alias("lines"), F.col("ord").alias("first"))
    return used.unionByName(rest).withColumn("n", F.row_number().over(Window.partitionBy(*PAGE).orderBy("first")))
