"""Queries on files, archives and sequences of numbers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptorium.operators import archive as ar
from scriptorium.operators import quality, signal
from scriptorium.plans import fixtures as fx
from scriptorium.plans.text_queries import SQL_INSPECTED, scored
from scriptorium.sources import files

_HEADS = ("255044462D", "504B0304", "504B0506", "504B0708", "FFD8FF", "49492A00", "4D4D002B", "00", "")


def sniff(spark, d):
    rows = fx.table(spark, d, "pages").select("page_id", F.concat(F.unhex(F.element_at(F.array(*map(F.lit, _HEADS)), (F.col("page_id") % 9 + 1).cast("int"))), F.encode("html", "UTF-8")).alias("content"))
    return rows.select("page_id", files.kind(F.col("content")).alias("kind"))


def members(spark, d):
    """The documents of a source as members of an archive."""
    rows = fx.table(spark, d, "documents").select("doc_id", F.col("source").alias("archive"), F.concat("source", F.lit("\\sub/"), "doc_id", F.lit(".PDF")).alias("archive_path"), F.col("n_chars").alias("size_bytes"))
    rows = rows.withColumn("ordinal", F.row_number().over(Window.partitionBy("archive").orderBy("doc_id")))
    rows = rows.selectExpr("*", "doc_id % 13 = 0 AS encrypted", "CASE WHEN doc_id % 17 = 0 THEN 'zip_archive' ELSE 'pdf' END AS kind", "CASE WHEN doc_id % 11 = 0 THEN 'BadZipFile: bad' END AS error", "CAST(size_bytes div 2000 + 1 AS INT) AS pages")
    return ar.member_status(rows)


def pages(spark, d):
    rows = members(spark, d).where("status = 'ok'").select("archive", "ordinal", "archive_path", F.explode(F.sequence(F.lit(1), "pages")).alias("source_page"))
    return ar.number_pages(rows)


SQL_MEMBERS = f"""mem AS (SELECT doc_id, source AS archive, source || '\\sub/' || doc_id || '.PDF' AS archive_path, n_chars AS size_bytes, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS ordinal, n_chars // 2000 + 1 AS pages,
  CASE WHEN doc_id % 13 = 0 THEN '{ar.ENCRYPTED}' WHEN doc_id % 11 = 0 THEN 'BadZipFile: bad' WHEN doc_id % 17 = 0 THEN '{ar.NESTED}' END AS error FROM documents)"""


def names(spark, d):
    return fx.table(spark, d, "events").selectExpr(
        "event_id", "CAST(event_id % 12000 AS INT) AS n",
        "CASE event_id % 8 WHEN 0 THEN concat('a\\\\b c (', event_id, ').PDF') WHEN 1 THEN concat('x/../', event_type, '.tar.gz') WHEN 2 THEN '.hidden' WHEN 3 THEN concat('d/é ü', event_id, '.JPEG') WHEN 4 THEN 'noext' WHEN 5 THEN '...' WHEN 6 THEN '__.zip' ELSE concat(event_type, '.verylongsuffix') END AS path",
    )


SQL_NAMES = """nm AS (SELECT event_id, CAST(event_id % 12000 AS INTEGER) AS n, list_last(string_split(replace(CASE event_id % 8 WHEN 0 THEN 'a\\b c (' || event_id || ').PDF' WHEN 1 THEN 'x/../' || event_type || '.tar.gz' WHEN 2 THEN '.hidden' WHEN 3 THEN 'd/é ü' || event_id || '.JPEG'
  WHEN 4 THEN 'noext' WHEN 5 THEN '...' WHEN 6 THEN '__.zip' ELSE event_type || '.verylongsuffix' END, '\\', '/'), '/')) AS b FROM events),
ns AS (SELECT *, regexp_matches(b, '^.+\\.[^.]+$') AND NOT regexp_matches(b, '^\\.+[^.]*$') AS cut FROM nm),
nc AS (SELECT event_id, n, CASE WHEN cut THEN regexp_extract(b, '^(.+)\\.[^.]+$', 1) ELSE b END AS stem, CASE WHEN cut THEN lower(regexp_extract(b, '(\\.[^.]+)$', 1)) ELSE '' END AS suffix FROM ns)"""


def selections(spark, d):
    rows = fx.table(spark, d, "events").selectExpr("event_id", "CAST(event_id % 12 + 1 AS INT) AS pages", "CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN '1,3-5' WHEN 2 THEN '5-3, 2' WHEN 3 THEN concat(event_id % 15) WHEN 4 THEN ' , 2 ,,1-2' WHEN 5 THEN '9-40' ELSE NULL END AS spec")
    return rows.select("event_id", F.explode(files.page_selection(F.col("spec"), F.col("pages"))).alias("page"))


def signals(spark, d):
    return fx.table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_orderkey % 100 AS g", "l_discount AS v", "l_quantity AS w")


def angles(spark, d):
    return signals(spark, d).selectExpr("CASE WHEN g = 99 THEN l_orderkey + 1000 ELSE g END AS g", "v * 100 AS v", "w")


def profiles(spark, d):
    """The ink of 600 rows for each document, by a rule of its id."""
    rows = fx.table(spark, d, "documents").selectExpr("doc_id", "transform(sequence(0, 599), i -> CAST((doc_id * 31 + i * i * 7 + i * 13) % 101 AS DOUBLE) / 100D) AS profile")
    return rows.select("doc_id", signal.line_safe_cuts(F.col("profile"), 4).alias("cuts"))


def review_stats(spark, d, most: int = 5):
    """Of the suspicious lines of a document the first five are reviewed; every third review fails, every other is taken."""
    rows = scored(spark, d).where(quality.suspicious(F.col("flags"))).withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy("i")))
    n, seen = F.count("*"), F.col("rank") <= most
    return rows.groupBy("doc_id").agg(
        n.alias("candidates"), F.count_if(seen).alias("reviewed"), F.count_if(seen & F.expr("i % 3 = 1")).alias("accepted"), F.count_if(seen & F.expr("i % 3 = 2")).alias("rejected"),
        F.count_if(seen & F.expr("i % 3 = 0")).alias("failed"), F.count_if(~seen).alias("skipped_by_limit"),
    )


SQL_WM = """{n}0 AS (SELECT {g} AS g, {v} AS v, sum({w}) AS w FROM {t} GROUP BY 1, 2), {n}1 AS (SELECT *, sum(w) OVER (PARTITION BY g ORDER BY v ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY g) AS total FROM {n}0),
{n} AS (SELECT g, min(v) AS median FROM {n}1 WHERE run >= total / 2 GROUP BY g)"""

def _cut(n: int, tiles: int = 4, height: int = 600) -> str:
    """DuckDB: the n-th cut, between borders that follow from the cut before."""
    core, radius, nominal = max(40, int(height / tiles * 0.55)), max(20, int(height / tiles * 0.25)), round(n * height / tiles)
    least, most = f"greatest({nominal - radius}, {'c + ' if n > 1 else ''}{core})", min(nominal + radius, height - (tiles - n) * core)
    before = f"c{n - 1}" if n > 1 else "(SELECT doc_id, '' AS cuts FROM documents)"
    return f"""r{n} AS (SELECT doc_id, cuts, CAST((doc_id * 31 + y * y * 7 + y * 13) % 101 AS DOUBLE) / 100 AS ink, y FROM (SELECT doc_id, cuts, unnest(range({least}, {most} + 1)) AS y FROM {before})),
s{n} AS (SELECT doc_id, cuts, y, ink + abs(y - {nominal}) / CAST({radius} AS DOUBLE) * greatest(quantile_cont(ink, 0.75) OVER (PARTITION BY doc_id), CAST(1e-6 AS DOUBLE)) * CAST(0.08 AS DOUBLE) AS score FROM r{n}),
m{n} AS (SELECT doc_id, cuts, y, row_number() OVER (PARTITION BY doc_id ORDER BY score, y) AS k FROM s{n}),
c{n} AS (SELECT doc_id, y AS c, cuts || '{',' if n > 1 else ''}' || y AS cuts FROM m{n} WHERE k = 1)"""


QUERIES = {
    "sniff_file_type": (
        sniff,
        "SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'pdf' WHEN 1 THEN 'zip_archive' WHEN 2 THEN 'zip_archive' WHEN 3 THEN 'zip_archive' WHEN 4 THEN 'jpeg' WHEN 5 THEN 'tiff' WHEN 6 THEN 'tiff' ELSE 'unsupported' END AS kind FROM pages",
    ),
    "archive_member_name": (
        lambda s, d: names(s, d).select("event_id", files.member_name(F.col("n"), F.col("path")).alias("name")),
        f"""WITH {SQL_NAMES}, x AS (SELECT *, trim(regexp_replace(stem, '[^\\p{{L}}\\p{{N}}_.-]+', '_', 'g'), '._') AS t FROM nc)
        SELECT event_id, format('{{:04d}}_', n) || CASE WHEN t = '' THEN 'member' ELSE t END || CASE WHEN regexp_full_match(suffix, '\\.[a-z0-9]{{1,10}}') THEN suffix ELSE '.bin' END AS name FROM x""",
    ),
    "safe_upload_name": (
        lambda s, d: names(s, d).select("event_id", files.upload_name(F.col("path")).alias("name")),
        f"""WITH {SQL_NAMES}, x AS (SELECT *, trim(regexp_replace(stem, '[^\\p{{L}}\\p{{N}}_ .()-]+', '_', 'g'), ' ._') AS t FROM nc)
        SELECT event_id, CASE WHEN suffix IN ('.pdf', '.tif', '.tiff', '.jpg', '.jpeg', '.zip') THEN CASE WHEN t = '' THEN 'document' ELSE t END || suffix END AS name FROM x""",
    ),
    "archive_member_status": (
        lambda s, d: members(s, d).select("doc_id", "archive", "ordinal", "archive_path", "status", "error"),
        f"WITH {SQL_MEMBERS} SELECT doc_id, archive, ordinal, archive_path, CASE WHEN error IS NULL THEN 'ok' ELSE 'skipped' END AS status, error FROM mem",
    ),
    "archive_pages_renumber": (
        pages,
        f"""WITH {SQL_MEMBERS}, p AS (SELECT archive, ordinal, archive_path, CAST(unnest(range(1, pages + 1)) AS INTEGER) AS source_page FROM mem WHERE error IS NULL)
        SELECT *, CAST(row_number() OVER (PARTITION BY archive ORDER BY ordinal, source_page) AS INTEGER) AS page FROM p""",
    ),
    "archive_rollup": (
        lambda s, d: ar.roll_up(members(s, d)),
        f"WITH {SQL_MEMBERS} SELECT archive, count(*) AS members, count(*) FILTER (error IS NULL) AS processed, CAST(coalesce(sum(pages) FILTER (error IS NULL), 0) AS BIGINT) AS pages FROM mem GROUP BY archive",
    ),
    "page_selection": (
        selections,
        """WITH a AS (SELECT event_id, event_id % 12 + 1 AS n, CASE event_id % 7 WHEN 1 THEN [1, 3, 4, 5] WHEN 2 THEN [2, 3, 4, 5] WHEN 3 THEN [event_id % 15] WHEN 4 THEN [1, 2] WHEN 5 THEN range(9, 41) ELSE range(1, 13) END AS ps FROM events)
        SELECT event_id, CAST(p - 1 AS INTEGER) AS page FROM (SELECT event_id, n, unnest(ps) AS p FROM a) WHERE p BETWEEN 1 AND n""",
    ),
    "content_sha256": (lambda s, d: fx.table(s, d, "pages").select("page_id", F.sha2("html", 256).alias("sha256")), "SELECT page_id, sha256(html) AS sha256 FROM pages"),
    "data_url": (
        lambda s, d: fx.table(s, d, "pages").select("page_id", F.concat(F.lit("data:image/png;base64,"), F.regexp_replace(F.base64(F.encode("html", "UTF-8")), "[\r\n]", "")).alias("url")),
        "SELECT page_id, 'data:image/png;base64,' || base64(encode(html)) AS url FROM pages",
    ),
    "batch_assignment": (
        lambda s, d: fx.lines(s, d).select("doc_id", "i", F.floor((F.row_number().over(Window.partitionBy("doc_id").orderBy("i")) - 1) / 4).alias("batch")),
        f"WITH {fx.LINES} SELECT doc_id, i, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1) // 4 AS batch FROM lines",
    ),
    "review_stats": (
        review_stats,
        f"""WITH {SQL_INSPECTED}, r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rank FROM insp WHERE len(flags) > 0)
        SELECT doc_id, count(*) AS candidates, count(*) FILTER (rank <= 5) AS reviewed, count(*) FILTER (rank <= 5 AND i % 3 = 1) AS accepted, count(*) FILTER (rank <= 5 AND i % 3 = 2) AS rejected, count(*) FILTER (rank <= 5 AND i % 3 = 0) AS failed, count(*) FILTER (rank > 5) AS skipped_by_limit FROM r GROUP BY doc_id""",
    ),
    "weighted_median": (
        lambda s, d: signal.weighted_median(signals(s, d), "g"),
        f"WITH {SQL_WM.format(n='m', g='l_orderkey % 100', v='l_discount', w='l_quantity', t='lineitem')} SELECT g, median FROM m",
    ),
    "robust_weighted_median": (
        lambda s, d: signal.robust_median(angles(s, d), "g"),
        f"""WITH a AS (SELECT CASE WHEN l_orderkey % 100 = 99 THEN l_orderkey + 1000 ELSE l_orderkey % 100 END AS g, l_discount * 100 AS v, l_quantity AS w FROM lineitem), {SQL_WM.format(n='m', g='g', v='v', w='w', t='a')},
        c AS (SELECT a.* FROM a JOIN m USING (g) WHERE abs(v - median) <= 2.5), k AS (SELECT c.* FROM c WHERE (SELECT count(*) FROM c x WHERE x.g = c.g) >= 3), {SQL_WM.format(n='m2', g='g', v='v', w='w', t='k')},
        n AS (SELECT g, count(*) AS n FROM a GROUP BY g) SELECT g, CASE WHEN n < 3 THEN CAST(0 AS DOUBLE) ELSE coalesce(m2.median, m.median) END AS median FROM n JOIN m USING (g) LEFT JOIN m2 USING (g)""",
    ),
    "centered_moving_average": (
        lambda s, d: signals(s, d).select("l_orderkey", "l_linenumber", F.round(signal.centered_mean(F.col("v"), Window.partitionBy("g").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), 2), 6).alias("mean")),
        "SELECT l_orderkey, l_linenumber, round(sum(l_discount) OVER (PARTITION BY l_orderkey % 100 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 6) AS mean FROM lineitem",
    ),
    "line_safe_cuts": (lambda s, d: profiles(s, d).select("doc_id", F.array_join(F.col("cuts").cast("array<string>"), ",").alias("cuts")), f"WITH {', '.join(map(_cut, (1, 2, 3)))} SELECT doc_id, cuts FROM c3"),
    "tile_bounds": (
        lambda s, d: fx.table(s, d, "documents").selectExpr("doc_id", "array(CAST(300 + doc_id % 20 AS INT), CAST(650 + doc_id % 31 AS INT), CAST(980 - doc_id % 17 AS INT)) AS cuts").select("doc_id", F.inline(signal.tile_bounds(F.col("cuts"), F.lit(1300)))),
        """WITH a AS (SELECT doc_id, [0, 300 + doc_id % 20, 650 + doc_id % 31, 980 - doc_id % 17, 1300] AS e FROM documents), b AS (SELECT doc_id, e, unnest(range(0, 4)) AS i FROM a)
        SELECT doc_id, CAST(i AS INTEGER) AS tile, CAST(CASE WHEN i > 0 THEN greatest(0, e[i + 1] - 48) ELSE e[i + 1] END AS INTEGER) AS top, CAST(CASE WHEN i < 3 THEN least(1300, e[i + 2] + 48) ELSE e[i + 2] END AS INTEGER) AS bottom FROM b""",
    ),
}
