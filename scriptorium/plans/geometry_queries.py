"""Queries on boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import geometry as geo
from scriptorium.functions.geometry import Box
from scriptorium.operators import models
from scriptorium.plans import fixtures as fx

W, H = fx.PAGE_WIDTH, fx.PAGE_HEIGHT


def pairs(spark, d):
    """Pairs of boxes of the two tiles of a page, not more than 60 pixels apart in height."""
    det = fx.detections(spark, d)
    a = det.where("tile = 0").selectExpr("doc_id", "page", "i AS a", *(f"{c} AS a_{c}" for c in ("x1", "y1", "x2", "y2")))
    b = det.where("tile = 1").selectExpr("doc_id", "page", "i AS b", *(f"{c} AS b_{c}" for c in ("x1", "y1", "x2", "y2")))
    return a.join(b, ["doc_id", "page"]).where("abs(a_y1 - b_y1) <= 60")


PAIRS = f"""{fx.DETECTIONS}, pair AS (
  SELECT a.doc_id, a.page, a.i AS a, b.i AS b, a.x1 AS ax1, a.y1 AS ay1, a.x2 AS ax2, a.y2 AS ay2, b.x1 AS bx1, b.y1 AS by1, b.x2 AS bx2, b.y2 AS by2,
    greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS inter
  FROM det a JOIN det b ON a.doc_id = b.doc_id AND a.page = b.page AND a.tile = 0 AND b.tile = 1 AND abs(a.y1 - b.y1) <= 60)"""


def both():
    return Box.of(prefix="a_"), Box.of(prefix="b_")


SQL_EXPAND = """greatest(0, {x1} - greatest(4, CAST(trunc({w} * CAST({r} AS DOUBLE)) AS INTEGER))) AS {p}x1, greatest(0, {y1} - greatest(4, CAST(trunc({h} * CAST({r} AS DOUBLE)) AS INTEGER))) AS {p}y1,
  least({w}, {x2} + greatest(4, CAST(trunc({w} * CAST({r} AS DOUBLE)) AS INTEGER))) AS {p}x2, least({h}, {y2} + greatest(4, CAST(trunc({h} * CAST({r} AS DOUBLE)) AS INTEGER))) AS {p}y2"""


def bbox_normalized_to_pixels(spark, d):
    rows = fx.regions(spark, d).selectExpr("doc_id", "page", "r", "x2 * 1.0D AS nx1", "y1 * 0.9D AS ny1", "(x1 - 70) * 1.25D AS nx2", "y2 * 0.9D AS ny2", "CASE WHEN r % 3 = 0 THEN 'x' WHEN r % 3 = 1 THEN '1.7' ELSE CAST(conf AS STRING) END AS raw")
    box = Box(F.col("nx1"), F.col("ny1"), F.col("nx2"), F.col("ny2"))
    conf = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.col("raw").try_cast("double"), F.lit(0.5))))
    out = rows.select("doc_id", "page", "r", conf.alias("confidence"), geo.from_thousandths(box, F.lit(W), F.lit(H)).alias("p"))
    return out.select("doc_id", "page", "r", "confidence", "p.*")


def detection_to_page_coords(spark, d):
    """Tile detections scaled from a 768-pixel model image to a tile that starts at the page's 400th row, clamped to it;
    boxes of a too small share of the tile go."""
    lit = F.lit
    place = geo.from_model(Box.of(), lit(W / 768), lit(900 / 692), lit(W), lit(900), lit(400))
    rows = fx.detections(spark, d).select("doc_id", "page", "i", (F.col("tile") + 1).alias("tile_id"), place.alias("b"))
    return rows.where(F.col("b.share") >= lit(7e-05)).select("doc_id", "page", "i", "tile_id", "b.x1", "b.y1", "b.x2", "b.y2")


def located(spark, d):
    """Replies of a model that locates tables: by the event one, one that is too sure, two, none, no JSON, not asked."""
    rows = fx.table(spark, d, "events").selectExpr(
        "event_id AS doc_id", "1 AS page", "CAST(NULL AS STRING) AS error",
        """CASE event_id % 6 WHEN 3 THEN '{"data":{"tables":[]}}' WHEN 4 THEN 'none' WHEN 5 THEN NULL ELSE concat('{"name":"locate_tables","arguments":{"data":{"tables":[{"bbox":[', event_id % 900, ',', event_id % 37 * 20, ',', event_id % 900 + 300, ',', event_id % 37 * 20 + 90, ']',
          CASE event_id % 6 WHEN 1 THEN ',"confidence":7' ELSE '' END, '},{"bbox":[1,2]},5', CASE event_id % 6 WHEN 2 THEN ',{"bbox":[1000,0,-5,500],"confidence":0.25}' ELSE '' END, ']}}}') END AS reply""",
    )
    found = models.localisation(rows, W, H)
    as_text = F.transform("tables", lambda t: F.concat_ws(",", *(t[c].cast("string") for c in ("x1", "y1", "x2", "y2", "confidence"))))
    return found.select(F.col("doc_id").alias("event_id"), "status", F.size("tables").alias("n"), F.array_join(as_text, " ").alias("tables"))


QUERIES = {
    "bbox_iou_pairs": (
        lambda s, d: pairs(s, d).select("doc_id", "page", "a", "b", F.round(geo.iou(*both()), 6).alias("iou")),
        f"WITH {PAIRS} SELECT doc_id, page, a, b, round(CASE WHEN inter > 0 THEN inter / CAST((ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - inter AS DOUBLE) ELSE 0 END, 6) AS iou FROM pair",
    ),
    "bbox_ios_pairs": (
        lambda s, d: pairs(s, d).select("doc_id", "page", "a", "b", F.round(geo.over_smaller(*both()), 6).alias("ios")),
        f"WITH {PAIRS} SELECT doc_id, page, a, b, round(inter / CAST(least(greatest(1, (ax2 - ax1) * (ay2 - ay1)), greatest(1, (bx2 - bx1) * (by2 - by1))) AS DOUBLE), 6) AS ios FROM pair",
    ),
    "bbox_x_overlap": (
        lambda s, d: pairs(s, d).select("doc_id", "page", "a", "b", F.round(geo.x_overlap(*both()), 6).alias("x_overlap")),
        f"WITH {PAIRS} SELECT doc_id, page, a, b, round(greatest(0, least(ax2, bx2) - greatest(ax1, bx1)) / CAST(greatest(1, least(ax2 - ax1, bx2 - bx1)) AS DOUBLE), 6) AS x_overlap FROM pair",
    ),
    "bbox_expand": (
        lambda s, d: fx.regions(s, d).select("doc_id", "page", "r", *geo.expand(Box.of(), F.lit(W), F.lit(H), 0.012).named()),
        f"WITH {fx.REGIONS} SELECT doc_id, page, r, {SQL_EXPAND.format(x1='x1', y1='y1', x2='x2', y2='y2', w=W, h=H, r=0.012, p='')} FROM reg",
    ),
    "bbox_normalized_to_pixels": (
        bbox_normalized_to_pixels,
        f"""WITH {fx.REGIONS},
        a AS (SELECT doc_id, page, r, CASE WHEN r % 3 = 0 THEN CAST(0.5 AS DOUBLE) WHEN r % 3 = 1 THEN CAST(1 AS DOUBLE) ELSE conf END AS confidence,
          greatest(0, least(1000, CAST(x2 AS DOUBLE))) AS p, greatest(0, least(1000, (x1 - 70) * CAST(1.25 AS DOUBLE))) AS q, greatest(0, least(1000, y1 * CAST(0.9 AS DOUBLE))) AS t, greatest(0, least(1000, y2 * CAST(0.9 AS DOUBLE))) AS u FROM reg),
        b AS (SELECT *, CAST(round_even(least(p, q) * {W} / 1000, 0) AS INTEGER) AS x1, CAST(round_even(least(t, u) * {H} / 1000, 0) AS INTEGER) AS y1, CAST(round_even(greatest(p, q) * {W} / 1000, 0) AS INTEGER) AS x2, CAST(round_even(greatest(t, u) * {H} / 1000, 0) AS INTEGER) AS y2 FROM a),
        c AS (SELECT *, x2 - x1 >= 8 AND y2 - y1 >= 8 AND (x2 - x1) * (y2 - y1) / CAST({W * H} AS DOUBLE) >= CAST(0.002 AS DOUBLE) AS ok FROM b)
        SELECT doc_id, page, r, confidence, CASE WHEN ok THEN x1 END AS x1, CASE WHEN ok THEN y1 END AS y1, CASE WHEN ok THEN x2 END AS x2, CASE WHEN ok THEN y2 END AS y2 FROM c""",
    ),
    "detection_to_page_coords": (
        detection_to_page_coords,
        f"""WITH {fx.DETECTIONS}, a AS (SELECT doc_id, page, i, tile, greatest(0, least({W - 1}, CAST(round_even(x1 * CAST({W / 768!r} AS DOUBLE), 0) AS INTEGER))) AS x1, greatest(0, least(899, CAST(round_even(y1 * CAST({900 / 692!r} AS DOUBLE), 0) AS INTEGER))) AS y1,
          greatest(0, least({W}, CAST(round_even(x2 * CAST({W / 768!r} AS DOUBLE), 0) AS INTEGER))) AS x2, greatest(0, least(900, CAST(round_even(y2 * CAST({900 / 692!r} AS DOUBLE), 0) AS INTEGER))) AS y2 FROM det),
        b AS (SELECT doc_id, page, i, tile, x1, y1, greatest(x1 + 1, x2) AS x2, greatest(y1 + 1, y2) AS y2 FROM a)
        SELECT doc_id, page, i, tile + 1 AS tile_id, x1, y1 + 400 AS y1, x2, y2 + 400 AS y2 FROM b WHERE (x2 - x1) * (y2 - y1) / CAST({W * 900} AS DOUBLE) >= CAST(7e-05 AS DOUBLE)""",
    ),
    "union_bbox": (
        lambda s, d: fx.detections(s, d).groupBy("doc_id", "page").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")),
        f"WITH {fx.DETECTIONS} SELECT doc_id, page, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM det GROUP BY doc_id, page",
    ),
    "median_line_height": (
        lambda s, d: fx.detections(s, d).groupBy("doc_id", "page").agg(F.median(F.greatest(F.lit(1), F.col("y2") - F.col("y1"))).alias("median_height")),
        f"WITH {fx.DETECTIONS} SELECT doc_id, page, CAST(median(greatest(1, y2 - y1)) AS DOUBLE) AS median_height FROM det GROUP BY doc_id, page",
    ),
    "normalize_angle": (
        lambda s, d: fx.table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "(l_orderkey * 15 + l_partkey * 45) % 900 - 450.0D AS angle").select("l_orderkey", "l_linenumber", geo.normalize_angle(F.col("angle")).alias("angle")),
        """WITH a AS (SELECT l_orderkey, l_linenumber, (l_orderkey * 15 + l_partkey * 45) % 900 - CAST(450 AS DOUBLE) AS g FROM lineitem),
        b AS (SELECT l_orderkey, l_linenumber, g - 180 * ceil((g - 90) / 180) AS g FROM a)
        SELECT l_orderkey, l_linenumber, CASE WHEN g < -45 THEN g + 90 WHEN g > 45 THEN g - 90 ELSE g END AS angle FROM b""",
    ),
    "fit_canvas_geometry": (
        lambda s, d: fx.detections(s, d).select("doc_id", "page", "i", "tile", geo.fit_canvas(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("f")).select("doc_id", "page", "i", "tile", "f.*"),
        f"""WITH {fx.DETECTIONS}, a AS (SELECT doc_id, page, i, tile, x2 - x1 AS w, y2 - y1 AS h, least(CAST(992 AS DOUBLE) / greatest(1, x2 - x1), CAST(154 AS DOUBLE) / greatest(1, y2 - y1)) AS z FROM det),
        b AS (SELECT doc_id, page, i, tile, greatest(1, CAST(round_even(w * z, 0) AS INTEGER)) AS new_width, greatest(1, CAST(round_even(h * z, 0) AS INTEGER)) AS new_height FROM a)
        SELECT *, CAST(floor((1022 - new_width) / 2) AS INTEGER) AS x, CAST(floor((182 - new_height) / 2) AS INTEGER) AS y FROM b""",
    ),
    "safe_crop_decision": (
        lambda s, d: fx.regions(s, d).select("doc_id", "page", "r", geo.safe_crop(Box.of(), F.lit(W), F.lit(H)).alias("c")).select("doc_id", "page", "r", "c.applied", "c.x1", "c.y1", "c.x2", "c.y2", F.round("c.retained", 6).alias("retained")),
        f"""WITH {fx.REGIONS}, a AS (SELECT doc_id, page, r, greatest(0, x1 - 30) AS x1, greatest(0, y1 - 39) AS y1, least({W}, x2 + 31) AS x2, least({H}, y2 + 40) AS y2 FROM reg),
        b AS (SELECT *, NOT (x2 - x1 < {W} * CAST(0.3 AS DOUBLE) OR y2 - y1 < {H} * CAST(0.2 AS DOUBLE) OR (x2 - x1) * (y2 - y1) / CAST({W * H} AS DOUBLE) < CAST(0.1 AS DOUBLE)) AS applied FROM a)
        SELECT doc_id, page, r, applied, CASE WHEN applied THEN x1 ELSE 0 END AS x1, CASE WHEN applied THEN y1 ELSE 0 END AS y1, CASE WHEN applied THEN x2 ELSE {W} END AS x2, CASE WHEN applied THEN y2 ELSE {H} END AS y2,
          CASE WHEN applied THEN round((x2 - x1) * (y2 - y1) / CAST({W * H} AS DOUBLE), 6) END AS retained FROM b""",
    ),
    "masked_crop_bounds": (
        lambda s, d: fx.detections(s, d).select("doc_id", "page", "i", "tile", geo.line_crop(Box.of(), F.lit(W), F.lit(H)).alias("c")).select("doc_id", "page", "i", "tile", "c.*"),
        f"""WITH {fx.DETECTIONS}, a AS (SELECT *, greatest(1, x2 - x1) AS w, greatest(1, y2 - y1) AS h FROM det),
        b AS (SELECT *, greatest(4, CAST(trunc(h * CAST(0.3 AS DOUBLE)) AS INTEGER)) AS py, greatest(8, CAST(trunc(greatest(h * CAST(0.55 AS DOUBLE), w * CAST(0.018 AS DOUBLE))) AS INTEGER)) AS px, greatest(3, CAST(round_even(h * CAST(0.08 AS DOUBLE), 0) AS INTEGER)) AS k FROM a)
        SELECT doc_id, page, i, tile, greatest(0, x1 - px) AS x1, greatest(0, y1 - py) AS y1, least({W}, x2 + px) AS x2, least({H}, y2 + py) AS y2, CASE WHEN k % 2 = 0 THEN k + 1 ELSE k END AS kernel FROM b""",
    ),
    "trimmed_line_bounds": (
        lambda s, d: fx.detections(s, d).select("doc_id", "page", "i", "tile", geo.trimmed(Box.of(), F.lit(W), F.lit(H)).alias("c")).select("doc_id", "page", "i", "tile", "c.*"),
        f"""WITH {fx.DETECTIONS}, a AS (SELECT *, greatest(4, CAST(trunc((x2 - x1) * CAST(0.02 AS DOUBLE)) AS INTEGER)) AS px, greatest(3, CAST(trunc((y2 - y1) * CAST(0.12 AS DOUBLE)) AS INTEGER)) AS py FROM det)
        SELECT doc_id, page, i, tile, greatest(0, x1 - px) AS x1, greatest(0, y1 - py) AS y1, least({W}, x2 + px) AS x2, least({H}, y2 + py) AS y2 FROM a""",
    ),
    "located_tables": (
        located,
        f"""WITH a AS (SELECT event_id, event_id % 6 AS kind, event_id % 900 AS x, event_id % 37 * 20 AS y FROM events),
        t AS (SELECT event_id, 0 AS n, x AS p, y AS q, least(1000, x + 300) AS u, y + 90 AS v, CASE WHEN kind = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS c FROM a WHERE kind < 3
          UNION ALL SELECT event_id, 1, 0, 0, 1000, 500, CAST(0.25 AS DOUBLE) FROM a WHERE kind = 2),
        b AS (SELECT *, CAST(round_even(p * CAST({W} AS DOUBLE) / 1000, 0) AS INTEGER) AS x1, CAST(round_even(q * CAST({H} AS DOUBLE) / 1000, 0) AS INTEGER) AS y1, CAST(round_even(u * CAST({W} AS DOUBLE) / 1000, 0) AS INTEGER) AS x2, CAST(round_even(v * CAST({H} AS DOUBLE) / 1000, 0) AS INTEGER) AS y2 FROM t),
        k AS (SELECT event_id, string_agg(x1 || ',' || y1 || ',' || x2 || ',' || y2 || ',' || c, ' ' ORDER BY n) AS tables, count(*) AS n FROM b WHERE x2 - x1 >= 8 AND y2 - y1 >= 8 AND (x2 - x1) * (y2 - y1) / CAST({W * H} AS DOUBLE) >= CAST(0.002 AS DOUBLE) GROUP BY event_id)
        SELECT event_id, CASE kind WHEN 4 THEN 'error' WHEN 5 THEN 'off' ELSE 'ok' END AS status, CAST(coalesce(n, 0) AS INTEGER) AS n, coalesce(tables, '') AS tables FROM a LEFT JOIN k USING (event_id)""",
    ),
    "tile_union": (
        lambda s, d: fx.detections(s, d).groupBy("doc_id", "page", "tile").agg(F.count("*").alias("boxes"), F.round(F.sum("conf"), 4).alias("conf_sum")),
        f"WITH {fx.DETECTIONS} SELECT doc_id, page, tile, count(*) AS boxes, round(sum(conf), 4) AS conf_sum FROM det GROUP BY doc_id, page, tile",
    ),
}
