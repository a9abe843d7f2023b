"""Detected lines, regions and table candidates as the records of a result: JSON with the keys that hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import text as tx

BOX = ("x1", "y1", "x2", "y2")


def box(prefix: str = "") -> Column:
    return F.array(*(F.col(prefix + c) for c in BOX))


def detection(line: bool) -> Column:
    """The record of a line or a region: (id, type, x1 .., polygon, conf, tiles, region_id, crop_path, and for lines text,
    raw_text, quality_flags). The confidence is rounded to six places and tiles are sorted, each once; keys without a
    region or a crop go when it is written as JSON, and only lines have texts."""
    fields = [
        F.col("id"), F.col("type"), box().alias("bbox"), F.col("polygon"), F.round("conf", 6).alias("detector_confidence"), F.array_sort(F.array_distinct("tiles")).alias("tile_ids"),
        F.col("region_id"), F.col("crop_path"),
    ]
    texts = [F.coalesce("text", F.lit("")).alias("text"), F.coalesce("raw_text", F.lit("")).alias("raw_text"), F.coalesce("quality_flags", F.array().cast("array<string>")).alias("quality_flags")]
    return F.struct(*fields, *(texts if line else []))


def with_reviews(lines: DataFrame, reviews: DataFrame, keys: list[str]) -> DataFrame:
    """Lines (keys, ..) with the record of their review, where they have one: primary_recognizer, qwen_review and
    alternatives. reviews: (keys, status, trocr, qwen3_vl, ..), trocr and qwen3_vl structs of a reading; a review that
    failed has no qwen3_vl. Lines are kept whether or not they were reviewed."""
    rest = [c for c in reviews.columns if c not in keys]
    return _recognizer(lines.join(reviews.select(*keys, *_review(rest)), keys, "left"))


def with_own_reviews(rows: DataFrame, names: list[str], given: Column) -> DataFrame:
    """As ``with_reviews``, of lines that have the columns of their review beside them: ``names`` are these (status,
    trocr, qwen3_vl, ..), and ``given`` holds where there was a review. Nothing is joined."""
    kept = [f"`{c}`" for c in rows.columns if c not in names]
    return _recognizer(rows.select(*kept, *_review(names, given)))


def _review(names: list[str], given: Column | None = None) -> list[Column]:
    held = {"qwen_review": F.struct(*names), "alternatives": F.struct("trocr", F.col("qwen3_vl").alias("qwen3-vl"))}
    return [(c if given is None else F.when(given, c)).alias(n) for n, c in held.items()]


def _recognizer(rows: DataFrame) -> DataFrame:
    return rows.withColumn("primary_recognizer", F.when(F.col("qwen_review.status") == "accepted", "qwen3-vl-line-review").otherwise("trocr"))


def candidate() -> Column:
    """The record of a table candidate: (candidate_id, region_id, x1 .., b_x1 .. of its crop, crop_path, conf, area_ratio,
    aspect_ratio, squareness, score, lines, localization_source, result, error); shares are rounded to six places."""
    six = lambda c, n: F.round(c, 6).alias(n)
    return F.struct(
        F.col("candidate_id").alias("id"), F.col("region_id").alias("detector_region_id"), box().alias("bbox"), F.coalesce(F.when(F.col("b_x1").isNotNull(), box("b_")), box()).alias("crop_bbox"),
        F.col("crop_path"), six("conf", "detector_confidence"), six("area_ratio", "area_ratio"), six("aspect_ratio", "aspect_ratio"), six("squareness", "squareness"), six("score", "candidate_score"),
        F.col("lines").alias("covered_line_ids"), F.col("localization_source"), F.col("result").alias("vlm_result"), F.col("error"),
    )


def overlay(boxes: DataFrame, width: int, height: int, keys: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    """(keys, svg): the boxes (keys, id, x1 .., type) of a page as a drawing to lay over its picture: rectangles with
    their ids, lines and regions in colours of their own."""
    n = lambda c: F.col(c).cast("string")
    colour = F.when(F.col("type") == "text_line", "#d62728").otherwise("#1f77b4")
    shape = F.concat(
        F.lit('<rect x="'), n("x1"), F.lit('" y="'), n("y1"), F.lit('" width="'), (F.col("x2") - F.col("x1")).cast("string"), F.lit('" height="'), (F.col("y2") - F.col("y1")).cast("string"),
        F.lit('" fill="none" stroke="'), colour, F.lit('"/><text x="'), n("x1"), F.lit('" y="'), n("y1"), F.lit('">'), tx.escape(n("id")), F.lit("</text>"),
    )
    pages = boxes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("y1", "x1", "id", shape.alias("shape")))).alias("s"))
    head = f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {width} {height}">'
    return pages.select(*keys, F.concat(F.lit(head), F.array_join("s.shape", ""), F.lit("</svg>")).alias("svg"))
