"""Queries on documents as JSON and on the replies of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import jsonx as js
from scriptorium.functions import text as tx
from scriptorium.operators import documents as doc
from scriptorium.plans import fixtures as fx


def raw_blocks(spark, d):
    """(conv_id, turn, j, line, form): the lines of a turn as blocks, in one of seven forms."""
    rows = fx.table(spark, d, "conversations").select("conv_id", "turn", "role", F.posexplode(F.split("text", "\n", -1)).alias("j", "line"))
    return rows.withColumn("form", F.expr("(conv_id + turn + j) % 7"))


def documents(spark, d):
    """(conv_id, json): each conversation as the JSON of a recognised document, ragged on purpose."""
    q = lambda c: F.to_json(F.struct(F.col(c).alias("v")))  # noqa: E731  the value as a JSON string, from the fifth letter on
    text = F.expr("substring(qline, 6, length(qline) - 6)")
    blocks = raw_blocks(spark, d).withColumn("qline", q("line")).withColumn("s", text)
    blocks = blocks.withColumn("cells", F.regexp_replace(F.col("s"), " ", '","'))
    body = F.expr("""CASE form WHEN 0 THEN concat('"content":"","rows":[[', cells, ']]') WHEN 1 THEN concat('"content":[', s, ',"x"]') WHEN 2 THEN '"content":5' WHEN 3 THEN '"content":null' ELSE concat('"content":', s) END""")
    kind = F.expr("CASE role WHEN 'system' THEN ' Title' WHEN 'assistant' THEN 'TABLE' ELSE 'stamp' END")
    blocks = blocks.select("conv_id", "turn", "j", F.concat(F.lit('{"type":"'), kind, F.lit('",'), body, F.lit("}")).alias("b"))
    pages = blocks.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("j", "b"))).alias("bs"))
    head = F.expr("concat('{\"page\":', turn + 1, CASE turn % 3 WHEN 0 THEN concat(',\"source_page\":\"', turn + 10, '\"') WHEN 1 THEN '' ELSE ',\"source_page\":\"x\"' END, CASE WHEN turn % 2 = 0 THEN ',\"source_file\":\"/a/b/p.pdf\"' ELSE '' END)")
    pages = pages.select("conv_id", "turn", F.concat(head, F.lit(',"blocks":[7,'), F.array_join("bs.b", ","), F.lit("]}")).alias("p"))
    whole = pages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "p"))).alias("ps"))
    return whole.select("conv_id", F.concat(F.lit('{"source_file":"dir\\\\f'), "conv_id", F.lit('.pdf","pages":['), F.array_join("ps.p", ","), F.lit("]}")).alias("json"))


def cleaned(spark, d):
    return documents(spark, d).select("conv_id", F.try_parse_json("json").alias("v")).select("conv_id", doc.clean(F.col("v")).alias("pages"))


SQL_RAW = """raw AS (SELECT conv_id, turn, role, j, line, (conv_id + turn + j) % 7 AS form FROM (SELECT conv_id, turn, role, unnest(ls) AS line, unnest(range(len(ls))) AS j FROM (SELECT conv_id, turn, role, string_split(text, chr(10)) AS ls FROM conversations))),
blk AS (SELECT conv_id, turn, j, CASE role WHEN 'system' THEN 'title' WHEN 'assistant' THEN 'table' ELSE 'text' END AS type,
  CASE form WHEN 0 THEN trim(array_to_string(list_transform(string_split(line, ' '), lambda c: trim(c)), ' | ')) WHEN 1 THEN trim(line || chr(10) || 'x', ' ' || chr(10)) WHEN 2 THEN '5' WHEN 3 THEN '' ELSE trim(line) END AS content FROM raw),
pg AS (SELECT DISTINCT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS p, CASE WHEN turn % 2 = 0 THEN 'p.pdf' ELSE 'f' || conv_id || '.pdf' END AS file, CAST(CASE turn % 3 WHEN 0 THEN turn + 10 ELSE turn + 1 END AS INTEGER) AS page FROM conversations),
cln AS (SELECT pg.conv_id, p, file, page, CAST(row_number() OVER (PARTITION BY pg.conv_id, p ORDER BY j) - 1 AS INTEGER) AS k, type, content FROM pg JOIN blk ON pg.conv_id = blk.conv_id AND pg.turn = blk.turn AND content <> ''),
clean AS (SELECT conv_id, p, file, page, k, type, content FROM pg LEFT JOIN cln USING (conv_id, p, file, page))"""


def search(spark, d):
    rows = doc.explode_clean(cleaned(spark, d), ["conv_id"]).withColumn("ord", F.struct("p", "k"))
    return doc.search_texts(rows, ["conv_id", "file", "page"])


def replies(spark, d):
    """(event_id, reply): the props of an event in one of six wrappings."""
    return fx.table(spark, d, "events").selectExpr(
        "event_id",
        """CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN concat('```json\n', props, '\n```') WHEN 2 THEN concat('text <tool_call> ', props, ' </tool_call>') WHEN 3 THEN concat('noise ', props, ' tail')
           WHEN 4 THEN concat('[', props, ']') ELSE concat('{"broken": ', props) END AS reply""",
    )


SQL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def calls(spark, d):
    """(event_id, calls, content): up to two tool calls, some with broken arguments, and a message."""
    return fx.table(spark, d, "events").selectExpr(
        "event_id",
        """array(named_struct('name', CASE WHEN event_id % 2 = 0 THEN 'other' ELSE 'save' END, 'arguments', CASE WHEN event_id % 3 = 0 THEN 'broken' ELSE props END),
                 named_struct('name', CASE WHEN event_id % 5 = 0 THEN 'save' ELSE 'more' END, 'arguments', '{"k": 7000}')) AS both""",
        """CASE WHEN event_id % 4 = 3 THEN array() ELSE array(1) END AS some""",
        "concat('see ', props) AS content",
    ).selectExpr("event_id", "CASE WHEN size(some) = 0 THEN slice(both, 1, 0) ELSE both END AS calls", "content")


def select_call(calls, content, tool: str):
    """The object of the first readable call of a tool, of any call where none is of it, else of the message."""
    named = F.filter(calls, lambda c: c["name"] == tool)
    chosen = F.when(F.size(named) > 0, named).otherwise(calls)
    parsed = F.filter(F.transform(chosen, lambda c: js.object_in_text(c["arguments"])), lambda v: v.isNotNull())
    return F.coalesce(F.get(parsed, F.lit(0)), js.object_in_text(content))


def region_sanitize(spark, d):
    rows = fx.table(spark, d, "events").selectExpr(
        "event_id",
        """concat('{"type":"', CASE event_id % 3 WHEN 0 THEN ' Table' WHEN 1 THEN 'text' ELSE 'stamp' END, '","source":"', CASE event_id % 2 WHEN 0 THEN 'PRINTED' ELSE 'x' END, '","languages":', CASE event_id % 4 WHEN 0 THEN '["de",""]' WHEN 1 THEN '"fr"' WHEN 2 THEN '5' ELSE '[]' END,
           ',"content":', CASE event_id % 5 WHEN 0 THEN '""' WHEN 1 THEN '["a","b"]' WHEN 2 THEN '12' ELSE concat('" ', event_type, ' "') END, CASE WHEN event_id % 7 < 5 THEN concat(',"rows":[["', event_type, '",', event_id % 9, ',null],"z"]') ELSE '' END, '}') AS j""",
    )
    out = rows.select("event_id", doc.region(F.try_parse_json("j")).alias("r"))
    return out.select("event_id", "r.type", "r.source", F.array_join("r.languages", ",").alias("languages"), "r.content", F.size("r.rows").alias("n_rows"))


def manifests(spark, d):
    """The detection manifest of each page, and its lines read back with their defaults."""
    rows = fx.detections(spark, d).where("tile = 0").groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("i", "x1", "y1", "x2", "y2", "conf"))).alias("ls"))
    as_json = F.to_json(F.struct(F.col("page"), F.transform("ls", lambda r: F.struct(r["i"].cast("string").alias("id"), F.array(r["x1"], r["y1"], r["x2"], r["y2"]).alias("bbox"), F.when(r["i"] % 3 > 0, r["conf"]).alias("detector_confidence"))).alias("lines")))
    kind = "struct<page:int,lines:array<struct<id:string,bbox:array<int>,detector_confidence:double,tile_ids:array<int>,text:string>>>"
    read = rows.select("doc_id", F.from_json(as_json, kind).alias("m")).select("doc_id", "m.page", F.inline("m.lines"))
    return read.select(
        "doc_id", "page", F.col("id").cast("int").alias("i"), *(F.get("bbox", F.lit(n)).alias(c) for n, c in enumerate(("x1", "y1", "x2", "y2"))),
        F.coalesce("detector_confidence", F.lit(0.0)).alias("conf"), F.size(F.coalesce("tile_ids", F.array().cast("array<int>"))).alias("tiles"), F.coalesce("text", F.lit("")).alias("text"),
    )


def prompts(spark, d):
    rows = fx.table(spark, d, "benchmark").selectExpr(
        "item_id",
        "CASE item_id % 6 WHEN 0 THEN concat('[SYSTEM] ', text, ' [USER] do ', item_id) WHEN 1 THEN text WHEN 2 THEN concat('[SYSTEM]', text) WHEN 3 THEN concat('[USER] x [SYSTEM] ', text) WHEN 4 THEN concat('[SYSTEM] [USER] ', text) ELSE '  ' END AS t",
    ).select("item_id", tx.strip(F.col("t")).alias("t"))
    system, user = F.instr("t", "[SYSTEM]"), F.instr("t", "[USER]")
    after = F.locate("[USER]", F.col("t"), 1)
    part = rows.select("item_id", "t", system.alias("s"), F.when(system > 0, F.expr("locate('[USER]', t, instr(t, '[SYSTEM]') + 8)")).otherwise(after).alias("u"), (user > 0).alias("has_user"))
    both = (F.col("s") > 0) & F.col("has_user")
    a = F.when(both & (F.col("u") > 0), tx.strip(F.expr("substring(t, s + 8, u - s - 8)"))).when((F.col("s") == 0) & ~F.col("has_user"), F.col("t"))
    b = F.when(both & (F.col("u") > 0), tx.strip(F.expr("substring(t, u + 6)"))).when((F.col("s") == 0) & ~F.col("has_user"), F.lit("default"))
    out = part.select("item_id", a.alias("system"), b.alias("user"))
    ok = (F.col("system") != "") & (F.col("user") != "")
    return out.select("item_id", F.when(ok, F.col("system")).alias("system"), F.when(ok, F.col("user")).alias("user"), F.coalesce(~ok, F.lit(True)).alias("invalid"))


QUERIES = {
    "clean_document": (
        lambda s, d: doc.explode_clean(cleaned(s, d), ["conv_id"]),
        f"WITH {SQL_RAW} SELECT conv_id, p, file, page, k, type, content FROM clean",
    ),
    "clean_document_validate": (
        lambda s, d: cleaned(s, d).select("conv_id", "pages", doc.clean(F.try_parse_json(F.to_json(F.struct(F.transform("pages", lambda p: F.struct(p["file"].alias("source_file"), p["page"].alias("page"), p["blocks"].alias("blocks"))).alias("pages"))))).alias("again")).select("conv_id", (F.col("pages") == F.col("again")).alias("valid")),
        "SELECT DISTINCT conv_id, true AS valid FROM conversations",
    ),
    "block_content_rows": (
        lambda s, d: doc.explode_clean(cleaned(s, d), ["conv_id"]).where("type = 'table'").groupBy("conv_id").agg(F.count("*").alias("tables"), F.sum(F.regexp_count("content", F.lit(" \\| "))).alias("bars")),
        f"WITH {SQL_RAW} SELECT conv_id, count(*) AS tables, CAST(sum(len(regexp_extract_all(content, ' \\| '))) AS BIGINT) AS bars FROM clean WHERE type = 'table' GROUP BY conv_id",
    ),
    "document_stats": (
        lambda s, d: cleaned(s, d).select("conv_id", doc.statistics(F.col("pages")).alias("x")).select("conv_id", "x.*"),
        f"WITH {SQL_RAW} SELECT conv_id, count(DISTINCT p) AS pages, count(k) AS blocks, count(k) FILTER (type = 'table') AS tables, CAST(coalesce(sum(length(content)), 0) AS BIGINT) AS content_chars FROM clean GROUP BY conv_id",
    ),
    "size_reduction": (
        lambda s, d: fx.table(s, d, "documents").select("doc_id", F.length("text").alias("a"), F.length(tx.normalize_space(F.col("text"))).alias("b")).select("doc_id", F.when(F.col("a") > 0, F.round(100.0 * (F.lit(1.0) - F.col("b") / F.col("a")), 2)).otherwise(0.0).alias("reduction")),
        "SELECT doc_id, CASE WHEN length(text) > 0 THEN round(100 * (1 - length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) / CAST(length(text) AS DOUBLE)), 2) ELSE 0 END AS reduction FROM documents",
    ),
    "page_search_texts": (
        search,
        f"""WITH {SQL_RAW}, t AS (SELECT conv_id, file, page, string_agg(content, chr(10) ORDER BY p, k) AS t FROM clean WHERE content <> '' GROUP BY ALL)
        SELECT conv_id, file, page, replace(lower(trim(regexp_replace(t, '\\s+', ' ', 'g'))), 'ß', 'ss') AS hay1, replace(lower(trim(regexp_replace(replace(t, ' | ', ' '), '\\s+', ' ', 'g'))), 'ß', 'ss') AS hay2 FROM t""",
    ),
    "json_from_text": (
        lambda s, d: replies(s, d).select("event_id", js.object_in_text(F.col("reply")).alias("v")).select("event_id", F.col("v").isNotNull().alias("parsed"), js.get(F.col("v"), "$.k", "int").alias("k")),
        f"SELECT event_id, true AS parsed, {SQL_K} AS k FROM events WHERE event_id % 6 <> 5 UNION ALL SELECT event_id, true, {SQL_K} FROM events WHERE false UNION ALL SELECT event_id, false, NULL FROM events WHERE event_id % 6 = 5",
    ),
    "tool_payload_unwrap": (
        lambda s, d: fx.table(s, d, "events")
        .selectExpr("event_id", """CASE event_id % 5 WHEN 0 THEN concat('{"name":"save","arguments":{"data":', props, '}}') WHEN 1 THEN concat('{"arguments":', to_json(struct(props AS x)), '}') WHEN 2 THEN concat('{"data":', props, '}') WHEN 3 THEN '{"data":[1]}' ELSE props END AS j""")
        .select("event_id", js.unwrap(F.try_parse_json("j"), "save").alias("v"))
        .select("event_id", F.col("v").isNotNull().alias("ok"), js.get(F.col("v"), "$.k", "int").alias("k")),
        f"SELECT event_id, event_id % 5 <> 3 AS ok, CASE WHEN event_id % 5 NOT IN (1, 3) THEN {SQL_K} END AS k FROM events",
    ),
    "tool_call_select": (
        lambda s, d: calls(s, d).select("event_id", select_call(F.col("calls"), F.col("content"), "save").alias("v")).select("event_id", js.get(F.col("v"), "$.k", "int").alias("k")),
        f"""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN {SQL_K}
          WHEN event_id % 2 = 1 AND event_id % 3 <> 0 THEN {SQL_K} WHEN event_id % 2 = 1 AND event_id % 5 = 0 THEN 7000 WHEN event_id % 2 = 1 THEN {SQL_K}
          WHEN event_id % 5 = 0 THEN 7000 WHEN event_id % 3 <> 0 THEN {SQL_K} ELSE 7000 END AS k FROM events""",
    ),
    "region_sanitize": (
        region_sanitize,
        """WITH a AS (SELECT event_id, event_id % 7 < 5 AS has_rows, event_id % 3 = 0 AS is_table, CASE WHEN event_id % 5 = 0 THEN CASE WHEN event_id % 7 < 5 THEN event_type || ' | ' || (event_id % 9) || ' | None' || chr(10) || 'z' ELSE '' END WHEN event_id % 5 = 1 THEN 'a' || chr(10) || 'b' WHEN event_id % 5 = 2 THEN '12' ELSE event_type END AS c FROM events)
        SELECT event_id, CASE WHEN c <> '' THEN CASE WHEN is_table THEN 'table' ELSE 'text' END END AS type, CASE WHEN c <> '' THEN CASE WHEN event_id % 2 = 0 THEN 'printed' ELSE 'mixed' END END AS source,
          CASE WHEN c <> '' THEN CASE event_id % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'fr' ELSE 'ru' END END AS languages, nullif(c, '') AS content, CASE WHEN c <> '' AND is_table AND has_rows THEN 2 END AS n_rows FROM a""",
    ),
    "manifest_explode": (
        manifests,
        f"WITH {fx.DETECTIONS} SELECT doc_id, page, i, x1, y1, x2, y2, CASE WHEN i % 3 > 0 THEN conf ELSE 0 END AS conf, 0 AS tiles, '' AS text FROM det WHERE tile = 0",
    ),
    "prompt_sections": (
        prompts,
        """SELECT item_id, CASE WHEN item_id % 6 < 2 THEN trim(text) END AS system, CASE item_id % 6 WHEN 0 THEN 'do ' || item_id WHEN 1 THEN 'default' END AS user, item_id % 6 > 1 AS invalid FROM benchmark""",
    ),
}
