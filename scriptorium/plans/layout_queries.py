"""Queries on the lines, regions and blocks of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import jsonx as js
from scriptorium.functions import text as tx
from scriptorium.functions.geometry import Box
from scriptorium.operators import layout as lo
from scriptorium.operators import records
from scriptorium.plans import fixtures as fx
from scriptorium.plans.geometry_queries import SQL_EXPAND
from scriptorium.plans.text_queries import SQL_TYPE

W, H = fx.PAGE_WIDTH, fx.PAGE_HEIGHT
PAGE = lo.PAGE
BOX = ["x1", "y1", "x2", "y2"]


def tiled(spark, d):
    return fx.detections(spark, d).withColumn("tiles", F.array(F.col("tile") + 1))


def lines(spark, d):
    return fx.detections(spark, d).where("tile = 0").drop("tile")


def regions(spark, d):
    return lo.dedup_regions(fx.regions(spark, d).withColumn("tiles", F.array((F.col("r") % 4 + 1).cast("int"))))


def candidates(spark, d):
    return lo.table_candidates(lines(spark, d), fx.regions(spark, d).withColumn("region_id", F.format_string("r%03d", "r")), W, H)


def selected(spark, d):
    return lo.select_candidates(candidates(spark, d))


def successful(spark, d):
    """Candidates with an odd number count as recognised."""
    return selected(spark, d).where("candidate % 2 = 1")


def ordered(spark, d):
    return lo.reading_order(recognizers(spark, d), "text", *BOX, "recognizer")


def blocks(spark, d):
    return lo.group_blocks(ordered(spark, d), W, H)


def ids(c="lines"):
    return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)


def recognizers(spark, d):
    return lines(spark, d).withColumn("recognizer", F.expr("CASE WHEN i % 3 = 0 THEN 'qwen3-vl-line-review' ELSE 'trocr' END"))


def merged(spark, d):
    found = successful(spark, d).select(*PAGE, "candidate", F.lit("table").alias("type"), F.concat(F.lit("table "), "region_id").alias("content"), "lines", *BOX)
    return lo.merge_blocks(blocks(spark, d), found)


def proposed(spark, d):
    """A model's blocks: by the ordinal of a line modulo 4, some lines twice, some unknown, some left out."""
    rows = lines(spark, d).where("i % 5 <> 4")
    once = rows.select(*PAGE, F.expr("CAST(i % 4 AS INT)").alias("b"), "i")
    twice = rows.where("i % 7 = 0").select(*PAGE, F.expr("CAST((i + 1) % 4 AS INT)").alias("b"), "i")
    unknown = rows.where("i % 11 = 0").select(*PAGE, F.expr("CAST(i % 4 AS INT)").alias("b"), (F.col("i") + 100000).alias("i"))
    every = once.unionByName(twice).unionByName(unknown)
    return every.groupBy(*PAGE, "b").agg(F.array_sort(F.collect_list("i")).alias("lines")).withColumn("type", F.expr("CASE b WHEN 0 THEN 'title' WHEN 1 THEN 'table' ELSE 'text' END"))


def regrouped(spark, d):
    typed = lines(spark, d).select(*PAGE, "i", F.col("i").alias("ord"), "text", tx.line_type(F.col("text"), *Box.of(), F.lit(W), F.lit(H)).alias("type"))
    return lo.regroup(proposed(spark, d), typed)


def routing_stats(spark, d):
    every, chosen = lines(spark, d), selected(spark, d)
    done = chosen.where("candidate % 2 = 1")
    per = [
        lo.unrouted(every, done).groupBy(*PAGE).agg(F.count("*").alias("ocr_lines")),
        chosen.groupBy(*PAGE).agg(F.count("*").alias("candidates"), F.count_if(F.expr("candidate % 2 = 1")).alias("successes")),
        lo.route(every, done).groupBy(*PAGE).agg(F.count("*").alias("routed_lines")),
    ]
    out = every.groupBy(*PAGE).agg(F.count("*").alias("lines"))
    for p in per:
        out = out.join(p, PAGE, "left")
    return out.na.fill(0)


def ios(a: str, b: str) -> str:
    """DuckDB: intersection over the smaller of two structs with boxes."""
    i = f"greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    return f"({i} / CAST(least(greatest(1, ({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1)), greatest(1, ({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1))) AS DOUBLE))"


def iou(a: str, b: str) -> str:
    i = f"greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    area = lambda x: f"({x}.x2 - {x}.x1) * ({x}.y2 - {x}.y1)"
    return f"({i} / CAST(greatest(1, {area(a)} + {area(b)} - {i}) AS DOUBLE))"


def fold(rows: str, match: str, merge: str) -> str:
    """DuckDB: a fold of a list of structs; ``match`` and ``merge`` speak of the kept e and the new x[1]."""
    first = f"coalesce(list_position(list_transform(acc, lambda e: {match}), true), 0)"
    return f"""list_reduce(list_transform({rows}, lambda v: [v]), lambda acc, x: CASE WHEN {first} = 0 THEN list_append(acc, x[1])
      ELSE list_transform(acc, lambda e, k: CASE WHEN k = {first} THEN {merge} ELSE e END) END)"""


LINE_MATCH = f"""abs((e.y1 + e.y2) - (x[1].y1 + x[1].y2)) / 2.0 <= greatest(e.y2 - e.y1, x[1].y2 - x[1].y1)
  AND ({iou("e", "x[1]")} >= CAST(0.38 AS DOUBLE) OR {ios("e", "x[1]")} >= CAST(0.72 AS DOUBLE))"""
LINE_BETTER = """CASE WHEN CASE WHEN abs(e.conf - x[1].conf) <= CAST(0.08 AS DOUBLE) THEN (e.x2 - e.x1) * (e.y2 - e.y1) >= (x[1].x2 - x[1].x1) * (x[1].y2 - x[1].y1) ELSE e.conf >= x[1].conf END
  THEN {'i': e.i, 'tile': e.tile, 'x1': e.x1, 'y1': e.y1, 'x2': e.x2, 'y2': e.y2, 'conf': e.conf, 'tiles': list_sort(list_distinct(list_concat(e.tiles, x[1].tiles)))}
  ELSE {'i': x[1].i, 'tile': x[1].tile, 'x1': x[1].x1, 'y1': x[1].y1, 'x2': x[1].x2, 'y2': x[1].y2, 'conf': x[1].conf, 'tiles': list_sort(list_distinct(list_concat(e.tiles, x[1].tiles)))} END"""
SQL_DEDUP_LINES = f"""{fx.DETECTIONS}, fl AS (SELECT doc_id, page, unnest({fold("rows", LINE_MATCH, LINE_BETTER)}) AS r FROM (
  SELECT doc_id, page, list({{'i': i, 'tile': tile, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'conf': conf, 'tiles': [tile + 1]}} ORDER BY y1, x1, -conf, tile, i) AS rows FROM det GROUP BY doc_id, page))"""
REGION_MERGE = "{'r': e.r, 'x1': e.x1, 'y1': e.y1, 'x2': e.x2, 'y2': e.y2, 'conf': e.conf, 'tiles': list_sort(list_distinct(list_concat(e.tiles, x[1].tiles)))}"
SQL_DEDUP_REGIONS = f"""{fx.REGIONS}, fr AS (SELECT doc_id, page, unnest({fold("rows", iou("x[1]", "e") + " >= CAST(0.45 AS DOUBLE)", REGION_MERGE)}) AS r FROM (
  SELECT doc_id, page, list({{'r': r, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'conf': conf, 'tiles': [CAST(r % 4 + 1 AS INTEGER)]}} ORDER BY -conf, r) AS rows FROM reg GROUP BY doc_id, page)),
 dreg AS (SELECT doc_id, page, r.r AS r, r.x1 AS x1, r.y1 AS y1, r.x2 AS x2, r.y2 AS y2, r.conf AS conf, r.tiles AS tiles,
   format('r{{:03d}}', row_number() OVER (PARTITION BY doc_id, page ORDER BY r.y1, r.x1, r.conf DESC, r.r)) AS region_id FROM fr)"""
TABLE_GROW = "{'r': e.r, 'x1': least(e.x1, x[1].x1), 'y1': least(e.y1, x[1].y1), 'x2': greatest(e.x2, x[1].x2), 'y2': greatest(e.y2, x[1].y2), 'conf': greatest(e.conf, x[1].conf)}"
SQL_TABLES = f"""{fx.REGIONS}, ft AS (SELECT doc_id, page, unnest({fold("rows", ios("x[1]", "e") + " >= CAST(0.7 AS DOUBLE)", TABLE_GROW)}) AS r FROM (
  SELECT doc_id, page, list({{'r': r, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'conf': conf}} ORDER BY -conf, r) AS rows FROM reg GROUP BY doc_id, page)),
 tab AS (SELECT doc_id, page, r.r AS r, r.x1 AS x1, r.y1 AS y1, r.x2 AS x2, r.y2 AS y2, r.conf AS conf, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY r.y1, r.x1, r.conf DESC, r.r) AS INTEGER) AS n FROM ft)"""

SQL_BELONGS = """((l.x1 + l.x2) / 2.0 BETWEEN b.x1 AND b.x2 AND (l.y1 + l.y2) / 2.0 BETWEEN b.y1 AND b.y2) OR %s >= CAST({share} AS DOUBLE)""" % ios("l", "b")
SQL_CANDIDATES = f"""{fx.REGIONS},
 shaped AS (SELECT doc_id, page, format('r{{:03d}}', r) AS region_id, x1, y1, x2, y2, conf, (x2 - x1) * (y2 - y1) / CAST({W * H} AS DOUBLE) AS area_ratio, least(x2 - x1, y2 - y1) / CAST(greatest(x2 - x1, y2 - y1) AS DOUBLE) AS squareness,
   {SQL_EXPAND.format(x1="x1", y1="y1", x2="x2", y2="y2", w=W, h=H, r=lo.PADDING, p="b_")} FROM reg WHERE x2 > x1 AND y2 > y1),
 crop AS (SELECT doc_id, page, region_id, b_x1 AS x1, b_y1 AS y1, b_x2 AS x2, b_y2 AS y2 FROM shaped),
 held AS (SELECT b.doc_id, b.page, b.region_id, list(l.i ORDER BY l.i) AS lines FROM crop b JOIN det l ON l.doc_id = b.doc_id AND l.page = b.page AND l.tile = 0 AND ({SQL_BELONGS.format(share=0.55)}) GROUP BY ALL),
 cand AS (SELECT s.*, h.lines, s.squareness * 2 + least(1, area_ratio / CAST({lo.MIN_AREA * 3!r} AS DOUBLE)) + least(1, len(lines) / CAST(8 AS DOUBLE)) + conf * CAST(0.25 AS DOUBLE) AS score
   FROM shaped s JOIN held h USING (doc_id, page, region_id) WHERE len(lines) >= 2 AND area_ratio BETWEEN CAST(0.05 AS DOUBLE) AND CAST(0.65 AS DOUBLE) AND squareness >= CAST(0.25 AS DOUBLE))"""
SQL_SELECTED = f"""{SQL_CANDIDATES},
 fc AS (SELECT doc_id, page, unnest({fold("rows", "(" + ios("x[1].crop", "e.crop") + " >= CAST(0.3 AS DOUBLE) OR list_has_any(e.lines, x[1].lines))", "e")}) AS r FROM (
   SELECT doc_id, page, list({{'region_id': region_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'crop': {{'x1': b_x1, 'y1': b_y1, 'x2': b_x2, 'y2': b_y2}}, 'score': score, 'lines': lines}} ORDER BY -score, region_id) AS rows FROM cand GROUP BY doc_id, page)),
 sel AS (SELECT doc_id, page, r.region_id AS region_id, r.x1 AS x1, r.y1 AS y1, r.x2 AS x2, r.y2 AS y2, r.score AS score, r.lines AS lines,
   CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY r.y1, r.x1, r.score DESC, r.region_id) AS INTEGER) AS candidate FROM fc)"""
SQL_ROUTED = f"""{SQL_SELECTED}, routed AS (SELECT doc_id, page, i, min(candidate) AS owner FROM (SELECT doc_id, page, candidate, unnest(lines) AS i FROM sel WHERE candidate % 2 = 1) GROUP BY ALL)"""

SQL_ORDERED = """og AS (SELECT doc_id, page, greatest(8, median(y2 - y1) * CAST(0.45 AS DOUBLE)) AS tol, list({'cy': (y1 + y2) / CAST(2 AS DOUBLE), 'x1': x1, 'i': i} ORDER BY (y1 + y2), x1, i) AS rows FROM det WHERE tile = 0 GROUP BY doc_id, page),
 oz AS (SELECT doc_id, page, rows, list_reduce(list_transform(rows, lambda v: {'row': 1, 's': v.cy, 'n': 1, 'out': [1]}), lambda a, v: CASE WHEN abs(v.s - a.s / a.n) <= tol
   THEN {'row': a.row, 's': a.s + v.s, 'n': a.n + 1, 'out': list_append(a.out, a.row)} ELSE {'row': a.row + 1, 's': v.s, 'n': 1, 'out': list_append(a.out, a.row + 1)} END).out AS nos FROM og),
 ord AS (SELECT doc_id, page, v.i AS i, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY no, v.x1, v.cy, v.i) AS INTEGER) AS ord FROM (SELECT doc_id, page, unnest(rows) AS v, unnest(nos) AS no FROM oz))"""
SQL_BLOCKS = f"""{SQL_ORDERED},
 bt AS (SELECT l.doc_id, l.page, l.i, ord, text, x1, y1, x2, y2, {SQL_TYPE} AS type, median(greatest(1, y2 - y1)) OVER (PARTITION BY l.doc_id, l.page) AS mh FROM det l JOIN ord o ON l.doc_id = o.doc_id AND l.page = o.page AND l.i = o.i AND l.tile = 0),
 bp AS (SELECT *, lag(x1) OVER o AS px1, lag(y2) OVER o AS py2, lag(x2) OVER o AS px2, lag(type) OVER o AS pt FROM bt WINDOW o AS (PARTITION BY doc_id, page ORDER BY ord)),
 bn AS (SELECT *, pt IS NULL OR type IN ('page_number', 'date', 'title', 'subtitle', 'list_item', 'formula') OR pt IN ('page_number', 'date', 'title', 'subtitle', 'list_item', 'formula') OR type <> pt
   OR y1 - py2 > mh * CAST(1.45 AS DOUBLE) OR (greatest(0, least(x2, px2) - greatest(x1, px1)) / CAST(greatest(1, least(x2 - x1, px2 - px1)) AS DOUBLE) < CAST(0.15 AS DOUBLE) AND y1 - py2 > mh * CAST(0.25 AS DOUBLE))
   OR (abs(x1 - px1) / CAST({W} AS DOUBLE) > CAST(0.16 AS DOUBLE) AND y1 - py2 > mh * CAST(0.45 AS DOUBLE)) AS fresh FROM bp),
 bi AS (SELECT *, CAST(sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id, page ORDER BY ord ROWS UNBOUNDED PRECEDING) AS INTEGER) AS block FROM bn),
 blk AS (SELECT doc_id, page, block, first(type ORDER BY ord) AS type, string_agg(text, chr(10) ORDER BY ord) AS content, list(i ORDER BY ord) AS lines, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM bi GROUP BY doc_id, page, block)"""
SQL_MERGED = f"""{SQL_SELECTED}, {SQL_BLOCKS},
 rec AS (SELECT doc_id, page, block, count(DISTINCT CASE WHEN i % 3 = 0 THEN 'qwen3-vl-line-review' ELSE 'trocr' END) AS n, min(CASE WHEN i % 3 = 0 THEN 'qwen3-vl-line-review' ELSE 'trocr' END) AS one FROM (SELECT doc_id, page, block, unnest(lines) AS i FROM blk) GROUP BY ALL),
 mb AS (SELECT doc_id, page, type, content, lines, x1, y1, x2, y2, CASE WHEN n = 1 THEN one WHEN n > 1 THEN 'hybrid' ELSE 'trocr' END AS recognizer, 0 AS kind, block AS k, CAST(NULL AS INTEGER) AS candidate FROM blk LEFT JOIN rec USING (doc_id, page, block)
   UNION ALL SELECT doc_id, page, 'table', 'table ' || region_id, lines, x1, y1, x2, y2, 'qwen3-vl', 1, candidate, candidate FROM sel WHERE candidate % 2 = 1),
 mrg AS (SELECT *, format('b{{:04d}}', row_number() OVER (PARTITION BY doc_id, page ORDER BY y1, x1, kind, k)) AS id FROM mb)"""
SQL_IDS = "array_to_string(lines, ',') AS lines"

def line_records(spark, d):
    rows = lines(spark, d).withColumn("id", F.format_string("p%03d_l%04d", "page", "i")).withColumn("type", F.lit("text_line")).withColumn("tiles", F.array(F.lit(2), F.lit(1), F.lit(2)))
    none = {"polygon": "array<array<int>>", "crop_path": "string", "quality_flags": "array<string>", "raw_text": "string"}
    rows = rows.withColumns({n: F.lit(None).cast(t) for n, t in none.items()}).withColumn("region_id", F.expr("CASE WHEN i % 3 = 0 THEN concat('r', i) END"))
    return rows.select(*PAGE, "i", js.dump(records.detection(True)).alias("line"), js.dump(records.detection(False)).alias("region"))


SQL_RECORD = """'{"id":"' || format('p{:03d}_l{:04d}', page, i) || '","type":"text_line","bbox":[' || x1 || ',' || y1 || ',' || x2 || ',' || y2 || '],"detector_confidence":' || conf || ',"tile_ids":[1,2]' || CASE WHEN i % 3 = 0 THEN ',"region_id":"r' || i || '"' ELSE '' END"""

QUERIES = {
    "detection_record_json": (
        line_records,
        f"""WITH {fx.DETECTIONS} SELECT doc_id, page, i, {SQL_RECORD} || ',"text":' || CAST(to_json(text) AS VARCHAR) || ',"raw_text":"","quality_flags":[]}}' AS line, {SQL_RECORD} || '}}' AS region FROM det WHERE tile = 0""",
    ),
    "dedup_lines": (
        lambda s, d: lo.dedup_lines(tiled(s, d)).select(*PAGE, "i", "tile", *BOX, "conf", ids("tiles")),
        f"WITH {SQL_DEDUP_LINES} SELECT doc_id, page, r.i AS i, r.tile AS tile, r.x1 AS x1, r.y1 AS y1, r.x2 AS x2, r.y2 AS y2, r.conf AS conf, array_to_string(r.tiles, ',') AS tiles FROM fl",
    ),
    "dedup_regions": (
        lambda s, d: regions(s, d).select(*PAGE, "region_id", *BOX, "conf", ids("tiles")),
        f"WITH {SQL_DEDUP_REGIONS} SELECT doc_id, page, region_id, x1, y1, x2, y2, conf, array_to_string(tiles, ',') AS tiles FROM dreg",
    ),
    "localized_tables_merged": (lambda s, d: lo.merge_tables(fx.regions(s, d)).select(*PAGE, "n", *BOX, "conf"), f"WITH {SQL_TABLES} SELECT doc_id, page, n, x1, y1, x2, y2, conf FROM tab"),
    "reading_order": (lambda s, d: lo.reading_order(lines(s, d)), f"WITH {fx.DETECTIONS}, {SQL_ORDERED} SELECT doc_id, page, i, ord FROM ord"),
    "line_ids": (
        lambda s, d: lo.reading_order(lines(s, d)).select(*PAGE, "i", F.format_string("p%03d_l%04d", "page", "ord").alias("line_id")),
        f"WITH {fx.DETECTIONS}, {SQL_ORDERED} SELECT doc_id, page, i, format('p{{:03d}}_l{{:04d}}', page, ord) AS line_id FROM ord",
    ),
    "assign_regions": (
        lambda s, d: lo.assign_regions(lines(s, d), regions(s, d)).select(*PAGE, "i", "region_id"),
        f"""WITH {SQL_DEDUP_REGIONS}, best AS (SELECT l.doc_id, l.page, l.i, b.region_id, row_number() OVER (PARTITION BY l.doc_id, l.page, l.i ORDER BY {ios("l", "b")} DESC, (b.x2 - b.x1) * (b.y2 - b.y1), b.region_id) AS k
          FROM det l JOIN dreg b ON l.doc_id = b.doc_id AND l.page = b.page AND l.tile = 0 AND ({SQL_BELONGS.format(share=0.35)}))
        SELECT l.doc_id, l.page, l.i, region_id FROM det l LEFT JOIN best b ON l.doc_id = b.doc_id AND l.page = b.page AND l.i = b.i AND k = 1 WHERE l.tile = 0""",
    ),
    "region_line_coverage": (
        lambda s, d: lo.covering(lines(s, d), fx.regions(s, d).select(*PAGE, "r", *(F.col(c).alias(f"b_{c}") for c in BOX)), lo.LINE_SHARE)
        .groupBy(*PAGE, "r").agg(F.array_sort(F.collect_list("i")).alias("lines")).select(*PAGE, "r", F.size("lines").alias("n"), ids()),
        f"""WITH {fx.REGIONS} SELECT b.doc_id, b.page, b.r, CAST(count(*) AS INTEGER) AS n, string_agg(l.i, ',' ORDER BY l.i) AS lines
        FROM reg b JOIN det l ON l.doc_id = b.doc_id AND l.page = b.page AND l.tile = 0 AND ({SQL_BELONGS.format(share=0.55)}) GROUP BY ALL""",
    ),
    "table_candidates_scored": (
        lambda s, d: candidates(s, d).select(*PAGE, "region_id", F.round("area_ratio", 6).alias("area_ratio"), F.round("squareness", 6).alias("squareness"), F.round("score", 6).alias("score"), ids()),
        f"WITH {SQL_CANDIDATES} SELECT doc_id, page, region_id, round(area_ratio, 6) AS area_ratio, round(squareness, 6) AS squareness, round(score, 6) AS score, {SQL_IDS} FROM cand",
    ),
    "table_candidates_selected": (
        lambda s, d: selected(s, d).select(*PAGE, "candidate", "region_id", F.round("score", 6).alias("score"), ids()),
        f"WITH {SQL_SELECTED} SELECT doc_id, page, candidate, region_id, round(score, 6) AS score, {SQL_IDS} FROM sel",
    ),
    "localized_table_candidates": (
        lambda s, d: localized(s, d),
        f"""WITH {SQL_TABLES}, tc AS (SELECT doc_id, page, n, conf, x1 AS ox1, {SQL_EXPAND.format(x1="x1", y1="y1", x2="x2", y2="y2", w=W, h=H, r=lo.PADDING, p="")}, (x2 - x1) * (y2 - y1) / CAST({W * H} AS DOUBLE) AS area_ratio, (x2 - x1) / CAST(y2 - y1 AS DOUBLE) AS aspect_ratio FROM tab),
        th AS (SELECT b.doc_id, b.page, b.n, string_agg(l.i, ',' ORDER BY l.i) AS lines FROM tc b JOIN det l ON l.doc_id = b.doc_id AND l.page = b.page AND l.tile = 0 AND ({SQL_BELONGS.format(share=0.55)}) GROUP BY ALL)
        SELECT doc_id, page, format('table_candidate_{{:03d}}', n) AS candidate_id, round(area_ratio, 6) AS area_ratio, round(aspect_ratio, 6) AS aspect_ratio, round(1 + conf, 6) AS score, coalesce(lines, '') AS lines FROM tc LEFT JOIN th USING (doc_id, page, n)""",
    ),
    "lines_for_ocr": (
        lambda s, d: lo.unrouted(lines(s, d), successful(s, d)).select(*PAGE, "i"),
        f"WITH {SQL_ROUTED} SELECT doc_id, page, i FROM det WHERE tile = 0 AND NOT EXISTS (SELECT 1 FROM routed r WHERE r.doc_id = det.doc_id AND r.page = det.page AND r.i = det.i)",
    ),
    "lines_routed_owner": (
        lambda s, d: lo.route(lines(s, d), successful(s, d)).select(*PAGE, "i", F.format_string("routed_to_vlm:table_candidate_%03d", "owner").alias("flag")),
        f"WITH {SQL_ROUTED} SELECT doc_id, page, i, format('routed_to_vlm:table_candidate_{{:03d}}', owner) AS flag FROM routed",
    ),
    "routing_stats": (
        routing_stats,
        f"""WITH {SQL_ROUTED}, n AS (SELECT doc_id, page, count(*) AS lines FROM det WHERE tile = 0 GROUP BY ALL), r AS (SELECT doc_id, page, count(*) AS routed_lines FROM routed GROUP BY ALL),
        c AS (SELECT doc_id, page, count(*) AS candidates, count(*) FILTER (candidate % 2 = 1) AS successes FROM sel GROUP BY ALL)
        SELECT doc_id, page, lines, lines - coalesce(routed_lines, 0) AS ocr_lines, coalesce(candidates, 0) AS candidates, coalesce(successes, 0) AS successes, coalesce(routed_lines, 0) AS routed_lines FROM n LEFT JOIN r USING (doc_id, page) LEFT JOIN c USING (doc_id, page)""",
    ),
    "group_lines_blocks": (
        lambda s, d: blocks(s, d).select(*PAGE, "block", "type", "content", ids(), *BOX),
        f"WITH {fx.DETECTIONS}, {SQL_BLOCKS} SELECT doc_id, page, block, type, content, {SQL_IDS}, x1, y1, x2, y2 FROM blk",
    ),
    "merge_blocks": (
        lambda s, d: merged(s, d).select(*PAGE, "id", "type", "recognizer", "candidate", ids()),
        f"WITH {SQL_MERGED} SELECT doc_id, page, id, type, recognizer, candidate, {SQL_IDS} FROM mrg",
    ),
    "block_recognizer": (
        lambda s, d: merged(s, d).groupBy("doc_id", "recognizer").agg(F.count("*").alias("blocks")),
        f"WITH {SQL_MERGED} SELECT doc_id, recognizer, count(*) AS blocks FROM mrg GROUP BY ALL",
    ),
    "block_ids": (
        lambda s, d: merged(s, d).select(*PAGE, "id", *BOX),
        f"WITH {SQL_MERGED} SELECT doc_id, page, id, x1, y1, x2, y2 FROM mrg",
    ),
    "structure_regroup": (
        lambda s, d: regrouped(s, d).select(*PAGE, "n", "type", "content", ids()),
        f"""WITH {fx.DETECTIONS}, ls AS (SELECT doc_id, page, i, text, {SQL_TYPE} AS type FROM det WHERE tile = 0),
        every AS (SELECT doc_id, page, i % 4 AS b, i FROM ls WHERE i % 5 <> 4 UNION ALL SELECT doc_id, page, (i + 1) % 4, i FROM ls WHERE i % 5 <> 4 AND i % 7 = 0 UNION ALL SELECT doc_id, page, i % 4, i + 100000 FROM ls WHERE i % 5 <> 4 AND i % 11 = 0),
        uses AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, b ORDER BY i) AS pos FROM every),
        firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, i ORDER BY b, pos) AS use FROM uses) WHERE use = 1),
        used AS (SELECT f.doc_id, f.page, CASE b WHEN 0 THEN 'title' WHEN 1 THEN 'table' ELSE 'text' END AS type, string_agg(text, chr(10) ORDER BY pos) AS content, string_agg(l.i, ',' ORDER BY pos) AS lines, min(l.i) AS k
          FROM firsts f JOIN ls l ON l.doc_id = f.doc_id AND l.page = f.page AND l.i = f.i GROUP BY f.doc_id, f.page, b),
        a AS (SELECT * FROM used UNION ALL SELECT doc_id, page, type, text, CAST(i AS VARCHAR), i FROM ls WHERE NOT EXISTS (SELECT 1 FROM firsts f WHERE f.doc_id = ls.doc_id AND f.page = ls.page AND f.i = ls.i))
        SELECT doc_id, page, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY k) AS INTEGER) AS n, type, content, lines FROM a""",
    ),
    "page_text": (
        lambda s, d: page_text(s, d),
        f"WITH {SQL_MERGED} SELECT doc_id, page, string_agg(content, chr(10) || chr(10) ORDER BY id) AS text FROM mrg WHERE content <> '' GROUP BY doc_id, page",
    ),
    "document_text": (
        lambda s, d: page_text(s, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", F.concat(F.lit("--- page "), "page", F.lit(" ---\n"), "text").alias("t")))).alias("p")).select("doc_id", F.array_join("p.t", "\n\n").alias("text")),
        f"""WITH {SQL_MERGED}, pt AS (SELECT doc_id, page, string_agg(content, chr(10) || chr(10) ORDER BY id) AS text FROM mrg WHERE content <> '' GROUP BY doc_id, page)
        SELECT doc_id, string_agg('--- page ' || page || ' ---' || chr(10) || text, chr(10) || chr(10) ORDER BY page) AS text FROM pt GROUP BY doc_id""",
    ),
}


def localized(spark, d):
    from scriptorium.functions import geometry as geo

    tables = lo.merge_tables(fx.regions(spark, d))
    box = Box.of()
    shaped = tables.select(
        *PAGE, "n", "conf", (F.greatest(F.lit(1), box.width) * F.greatest(F.lit(1), box.height) / F.lit(W * H)).alias("area_ratio"), (F.greatest(F.lit(1), box.width) / F.greatest(F.lit(1), box.height)).alias("aspect_ratio"),
        *(c.alias(f"b_{n}") for c, n in zip(geo.expand(box, F.lit(W), F.lit(H), lo.PADDING), BOX, strict=True)),
    )
    held = lo.covering(lines(spark, d), shaped.select(*PAGE, "n", *(f"b_{c}" for c in BOX)), lo.LINE_SHARE).groupBy(*PAGE, "n").agg(F.array_sort(F.collect_list("i")).alias("lines"))
    out = shaped.join(held, [*PAGE, "n"], "left").withColumn("lines", F.coalesce("lines", F.array().cast("array<int>")))
    return out.select(
        *PAGE, F.format_string("table_candidate_%03d", "n").alias("candidate_id"), F.round("area_ratio", 6).alias("area_ratio"), F.round("aspect_ratio", 6).alias("aspect_ratio"), F.round(F.col("conf") + 1, 6).alias("score"), ids()
    )


def page_text(spark, d):
    rows = merged(spark, d).where("content <> ''").groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("id", "content"))).alias("b"))
    return rows.select(*PAGE, F.array_join("b.content", "\n\n").alias("text"))
