"""Inputs that queries derive from the tables: detected boxes, typed lines, documents as JSON, replies, claims.

Each is made by the same integer rules in Spark and, as a common table expression, in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_WIDTH, PAGE_HEIGHT = 1000, 1300


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, i, text): the lines of the documents, numbered from 0."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "text"))


LINES = """lines AS (
  SELECT doc_id, i, text FROM (
    SELECT doc_id, unnest(ts) AS text, CAST(unnest(range(len(ts))) AS INTEGER) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ts FROM documents)))"""

_PLACE = """60 + (h * 31 % 5) * 40 + CASE WHEN h % 6 = 1 THEN 480 ELSE 0 END AS x1,
  40 + (k - CASE WHEN h % 6 = 1 AND k > 0 THEN 1 ELSE 0 END) * 30 + h % 7 + CASE WHEN h % 17 = 0 THEN 20 ELSE 0 END AS y1,
  least(420, 40 + least(length(text), 120) * 4) AS w, 18 + (h % 5) * 3 AS t"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, i, tile, x1, y1, x2, y2, conf, text): line boxes on pages; some are seen by a second tile."""
    placed = lines(spark, sf_dir).selectExpr("doc_id", "i", "text", "doc_id * 7 + i * 13 AS h", "i % 40 AS k", "CAST(i div 40 + 1 AS INT) AS page")
    placed = placed.selectExpr("*", *_split(_PLACE))
    first = placed.selectExpr("doc_id", "page", "i", "0 AS tile", *_ints("x1", "y1", "x1 + w AS x2", "y1 + t AS y2"), "h * 37 % 100 / 100D AS conf", "text")
    second = placed.where("h % 4 = 0").selectExpr(
        "doc_id", "page", "i", "1 AS tile", *_ints("x1 + h % 9 - 4 AS x1", "y1 + h % 11 - 5 AS y1", "x1 + w + h % 9 - 4 AS x2", "y1 + t + h % 11 - 5 AS y2"), "h * 53 % 100 / 100D AS conf", "text"
    )
    return first.unionByName(second)


def _split(text: str) -> list[str]:
    """The expressions of a select list: commas inside brackets do not separate."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]


def _ints(*exprs: str) -> list[str]:
    pairs = [e.rsplit(" AS ", 1) if " AS " in e else [e, e] for e in exprs]
    return [f"CAST({a} AS INT) AS {b}" for a, b in pairs]


DETECTIONS = f"""{LINES},
placed AS (SELECT *, {_PLACE} FROM (SELECT doc_id, i, text, doc_id * 7 + i * 13 AS h, i % 40 AS k, i // 40 + 1 AS page FROM lines)),
det AS (
  SELECT doc_id, page, i, 0 AS tile, CAST(x1 AS INTEGER) AS x1, CAST(y1 AS INTEGER) AS y1, CAST(x1 + w AS INTEGER) AS x2, CAST(y1 + t AS INTEGER) AS y2, CAST(h * 37 % 100 / 100.0 AS DOUBLE) AS conf, text FROM placed
  UNION ALL
  SELECT doc_id, page, i, 1, CAST(x1 + h % 9 - 4 AS INTEGER), CAST(y1 + h % 11 - 5 AS INTEGER), CAST(x1 + w + h % 9 - 4 AS INTEGER), CAST(y1 + t + h % 11 - 5 AS INTEGER), CAST(h * 53 % 100 / 100.0 AS DOUBLE), text
  FROM placed WHERE h % 4 = 0)"""


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, r, x1, y1, x2, y2, conf): regions around runs of 5 and of 12 lines of the first tile."""
    det = detections(spark, sf_dir).where("tile = 0").withColumn("k", F.expr("i % 40"))
    box = [F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")]
    both = det.select("doc_id", "page", "x1", "y1", "x2", "y2", F.expr("explode(array(CAST(k div 5 AS INT), CAST(100 + k div 12 AS INT))) AS r"))
    return both.groupBy("doc_id", "page", "r").agg(*box).withColumn("conf", F.expr("(doc_id * 11 + page * 5 + r * 7) % 100 / 100D"))


REGIONS = f"""{DETECTIONS},
reg AS (
  SELECT *, CAST((doc_id * 11 + page * 5 + r * 7) % 100 / 100.0 AS DOUBLE) AS conf FROM (
    SELECT doc_id, page, (i % 40) // 5 AS r, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM det WHERE tile = 0 GROUP BY ALL
    UNION ALL
    SELECT doc_id, page, 100 + (i % 40) // 12 AS r, min(x1), min(y1), max(x2), max(y2) FROM det WHERE tile = 0 GROUP BY doc_id, page, 100 + (i % 40) // 12))"""


def typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, id, text, x1, y1, x2, y2): dates, page numbers, list items, titles and plain lines at five places."""
    t = lambda n: table(spark, sf_dir, n)
    rows = (
        t("orders").selectExpr("'date' AS kind", "o_orderkey AS id", "date_format(o_orderdate, 'dd.MM.yyyy') AS text")
        .unionByName(t("orders").selectExpr("'number' AS kind", "o_orderkey AS id", "concat('- ', o_orderkey % 10000, ' -') AS text"))
        .unionByName(t("part").selectExpr("'item' AS kind", "p_partkey AS id", "concat(p_partkey % 9, ') ', p_name) AS text"))
        .unionByName(t("part").selectExpr("'title' AS kind", "p_partkey AS id", "upper(p_name) AS text"))
        .unionByName(t("customer").selectExpr("'name' AS kind", "c_custkey AS id", "c_name AS text"))
    )
    return rows.selectExpr("*", *_ints(*(f"{e} AS {n}" for e, n in zip(_TYPED, ("x1", "y1", "x2", "y2"), strict=True))))


_TYPED = (
    "CASE id % 5 WHEN 0 THEN 20 WHEN 1 THEN 350 WHEN 2 THEN 400 WHEN 3 THEN 850 ELSE 300 END",
    "CASE id % 5 WHEN 0 THEN 20 WHEN 1 THEN 60 WHEN 2 THEN 600 WHEN 3 THEN 500 ELSE 1200 END",
    "CASE id % 5 WHEN 0 THEN 90 WHEN 1 THEN 650 WHEN 2 THEN 620 WHEN 3 THEN 960 ELSE 700 END",
    "CASE id % 5 WHEN 0 THEN 50 WHEN 1 THEN 90 WHEN 2 THEN 640 WHEN 3 THEN 530 ELSE 1280 END",
)
TYPED = f"""typed AS (
  SELECT *, {_TYPED[0]} AS x1, {_TYPED[1]} AS y1, {_TYPED[2]} AS x2, {_TYPED[3]} AS y2 FROM (
    SELECT 'date' AS kind, o_orderkey AS id, strftime(o_orderdate, '%d.%m.%Y') AS text FROM orders
    UNION ALL SELECT 'number', o_orderkey, '- ' || (o_orderkey % 10000) || ' -' FROM orders
    UNION ALL SELECT 'item', p_partkey, (p_partkey % 9) || ') ' || p_name FROM part
    UNION ALL SELECT 'title', p_partkey, upper(p_name) FROM part
    UNION ALL SELECT 'name', c_custkey, c_name FROM customer))"""
