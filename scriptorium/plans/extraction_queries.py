"""Queries on extraction results and their reports.

Two hundred texts make one document of up to ten pages, whose numbers begin anew in each, and each text makes one claim.
Some claims are made of the document after theirs, whose pages of that number do not hold their evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.operators import documents as doc
from scriptorium.operators import extraction as ex
from scriptorium.operators import report as rp
from scriptorium.plans import fixtures as fx

_NAMES = ", ".join(f"'{p}'" for p in (*ex.PARAMETERS, "Глубина"))
_KINDS = ", ".join(f"'{p}'" for p in (*ex.CONFLICTS, "other"))
_RULE = """doc_id, doc_id {div} 200 + CASE WHEN doc_id % 23 = 0 THEN 1 ELSE 0 END AS doc, CAST(doc_id % 200 + 1 + CASE WHEN doc_id % 23 = 0 THEN 1000 ELSE 0 END AS INTEGER) AS idx,
  CASE WHEN doc_id % 19 = 0 THEN '' ELSE {name} END AS parameter, CASE WHEN doc_id % 13 = 0 THEN ' ' ELSE concat('v', doc_id % 4, ' & ', doc_id) END AS value,
  CASE WHEN doc_id % 6 = 5 THEN 'absent' WHEN doc_id % 4 = 0 THEN concat('v', doc_id % 4, ' & ', doc_id) ELSE substring(text, 9, 20) END AS raw_value, CASE doc_id % 5 WHEN 1 THEN '' WHEN 2 THEN 'nofile' ELSE concat('dir/', source) END AS file,
  CAST(doc_id % 200 {div} 20 + 1 + CASE WHEN doc_id % 7 = 3 THEN 1 ELSE 0 END AS INTEGER) AS page, substring(text, 5, 110) AS evidence,
  CASE doc_id % 8 WHEN 0 THEN 'sure' WHEN 1 THEN ' HIGH' WHEN 2 THEN 'medium' WHEN 3 THEN 'low' ELSE 'high' END AS confidence, CASE WHEN doc_id % 3 = 0 THEN concat('<note> ', doc_id) ELSE '' END AS notes,
  {kind} AS conflict_type, CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'seen twice' END AS reason"""


def claims(spark, d):
    rule = _RULE.format(div="div", name=f"element_at(array({_NAMES}), CAST(doc_id % 10 + 1 AS INT))", kind=f"element_at(array({_KINDS}), CAST(doc_id % 7 + 1 AS INT))")
    return fx.table(spark, d, "documents").selectExpr(*fx._split(rule))


def pages(spark, d):
    rows = fx.table(spark, d, "documents").selectExpr("doc_id div 200 AS doc", "source AS file", "CAST(doc_id % 200 div 20 + 1 AS INT) AS page", "doc_id AS ord", "text AS content")
    return doc.search_texts(rows, ["doc", "file", "page"])


def judged(spark, d):
    return ex.judge_records(claims(spark, d).drop("doc_id", "conflict_type", "reason"), pages(spark, d))


def records(spark, d):
    return ex.records(judged(spark, d))


def conflicts(spark, d):
    return ex.judge_conflicts(claims(spark, d).drop("doc_id", "confidence", "notes", "value"), pages(spark, d))


def docs(spark, d):
    return claims(spark, d).select("doc", F.concat(F.lit("doc"), "doc").alias("name")).distinct()


def missing(spark, d):
    return ex.missing(docs(spark, d).select("doc"), records(spark, d))


def warnings(spark, d):
    a = judged(spark, d).where("warning IS NOT NULL").select("doc", F.lit(0).alias("part"), "idx", "warning")
    b = conflicts(spark, d).where("warning IS NOT NULL").select("doc", F.lit(1).alias("part"), "idx", "warning")
    return a.unionByName(b)


def counts(spark, d):
    a = records(spark, d).groupBy("doc").agg(F.count("*").alias("records"))
    b = conflicts(spark, d).where("warning IS NULL").groupBy("doc").agg(F.count("*").alias("conflicts"))
    c = missing(spark, d).groupBy("doc").agg(F.count("*").alias("missing"))
    return docs(spark, d).select("doc").join(a, "doc", "left").join(b, "doc", "left").join(c, "doc", "left").na.fill(0)


def numbered(spark, d):
    return records(spark, d).withColumn("row_number", F.expr("CASE WHEN idx % 4 = 0 THEN 'x' ELSE CAST(row_number AS STRING) END"))


SQL_NORM = "replace(lower(trim(regexp_replace({0}, '\\s+', ' ', 'g'))), 'ß', 'ss')"
_DUCK = _RULE.format(div="//", name=f"[{_NAMES}][doc_id % 10 + 1]", kind=f"[{_KINDS}][doc_id % 7 + 1]")
SQL_CLAIMS = f"""claims AS (SELECT {_DUCK} FROM documents),
pages AS (SELECT doc, file, page, {SQL_NORM.format("t")} AS hay1, {SQL_NORM.format("replace(t, ' | ', ' ')")} AS hay2 FROM (SELECT doc_id // 200 AS doc, source AS file, CAST(doc_id % 200 // 20 + 1 AS INTEGER) AS page, string_agg(trim(text, ' ' || chr(10)), chr(10) ORDER BY doc_id) AS t FROM documents GROUP BY ALL)),
met AS (SELECT c.doc_id, list_last(string_split(c.file, '/')) AS f, p.file AS pf, {SQL_NORM.format("evidence")} <> '' AND (contains(hay1, {SQL_NORM.format("evidence")}) OR contains(hay2, {SQL_NORM.format("evidence")})) AS hit FROM claims c JOIN pages p USING (doc, page)),
res AS (SELECT doc_id, CASE WHEN f = '' THEN CASE WHEN count(*) FILTER (hit) = 1 THEN min(pf) FILTER (hit) END WHEN count(*) FILTER (pf = f) > 0 THEN CASE WHEN count(*) FILTER (hit AND pf = f) = 1 THEN f END
  WHEN count(*) = 1 THEN min(pf) FILTER (hit) END AS resolved FROM met GROUP BY doc_id, f),
cl AS (SELECT c.doc_id, doc, idx, trim(parameter) AS parameter, trim(value) AS value, trim(raw_value, ' ' || chr(10)) AS raw_value, file, page, trim(evidence, ' ' || chr(10)) AS evidence, lower(trim(confidence)) AS confidence, trim(notes) AS notes, conflict_type, reason, resolved FROM claims c LEFT JOIN res USING (doc_id)),
jr AS (SELECT *, CASE WHEN parameter NOT IN ({", ".join(f"'{p}'" for p in ex.PARAMETERS)}) OR value = '' OR raw_value = '' THEN '{ex.INCOMPLETE}records[' || idx || '] (' || CASE WHEN parameter = '' THEN '{ex.NAMELESS}' ELSE parameter END || ').'
  WHEN confidence NOT IN ('high', 'medium', 'low') THEN '{ex.GONE}records[' || idx || ']{ex.BAD_CONFIDENCE}'
  WHEN length(evidence) > 300 OR resolved IS NULL THEN '{ex.GONE}records[' || idx || ']{ex.NO_EVIDENCE}' || page || '.'
  WHEN NOT contains({SQL_NORM.format("evidence")}, {SQL_NORM.format("raw_value")}) THEN '{ex.GONE}records[' || idx || ']{ex.NO_VALUE}' END AS warning FROM cl),
rec AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc ORDER BY idx) AS INTEGER) AS row_number FROM jr WHERE warning IS NULL),
jc AS (SELECT *, CASE WHEN parameter NOT IN ({", ".join(f"'{p}'" for p in ex.PARAMETERS)}) OR conflict_type NOT IN ({", ".join(f"'{p}'" for p in ex.CONFLICTS)}) OR raw_value = '' OR reason = '' OR length(evidence) > 300 OR resolved IS NULL
  OR NOT contains({SQL_NORM.format("evidence")}, {SQL_NORM.format("raw_value")}) THEN '{ex.BAD_CONFLICT[0]}' || idx || '{ex.BAD_CONFLICT[1]}' END AS warning FROM cl),
docs AS (SELECT DISTINCT doc, 'doc' || doc AS name FROM claims),
mis AS (SELECT doc, n, parameter FROM docs, (SELECT unnest([{", ".join(f"'{p}'" for p in ex.PARAMETERS)}]) AS parameter, CAST(unnest(range(1, 10)) AS INTEGER) AS n) WHERE NOT EXISTS (SELECT 1 FROM rec WHERE rec.doc = docs.doc AND rec.parameter = parameter.parameter))"""
SQL_CLAIMS = SQL_CLAIMS.replace("rec.parameter = parameter.parameter", "rec.parameter = p.parameter").replace("AS n) WHERE NOT EXISTS", "AS n) p WHERE NOT EXISTS")


def _esc(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '<br/>')"


def _case(x: str, names: dict[str, str]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + f" ELSE {x} END"


SQL_DOMINANT = """dom AS (SELECT docs.doc, coalesce((SELECT f FROM (SELECT list_last(string_split(file, '/')) AS f, idx FROM cl WHERE cl.doc = docs.doc) x WHERE f <> '' GROUP BY f ORDER BY count(*) DESC, min(idx) LIMIT 1), name) AS dominant_file FROM docs)"""

QUERIES = {
    "evidence_resolve": (
        lambda s, d: ex.resolve(claims(s, d).withColumnRenamed("doc_id", "claim"), pages(s, d)).select(F.col("claim").alias("doc_id"), "page", "file", "resolved", F.col("resolved").isNotNull().alias("found")),
        f"WITH {SQL_CLAIMS} SELECT doc_id, page, file, resolved, resolved IS NOT NULL AS found FROM cl",
    ),
    "extraction_records": (lambda s, d: records(s, d), f"WITH {SQL_CLAIMS} SELECT doc, row_number, idx, parameter, value, raw_value, resolved AS file, page, evidence, confidence, notes FROM rec"),
    "extraction_conflicts": (
        lambda s, d: conflicts(s, d).where("warning IS NULL").select("doc", "idx", "parameter", "conflict_type", "raw_value", F.col("resolved").alias("file"), "page", "evidence", "reason"),
        f"WITH {SQL_CLAIMS} SELECT doc, idx, parameter, conflict_type, raw_value, resolved AS file, page, evidence, reason FROM jc WHERE warning IS NULL",
    ),
    "extraction_warnings": (
        warnings,
        f"WITH {SQL_CLAIMS} SELECT doc, 0 AS part, idx, warning FROM jr WHERE warning IS NOT NULL UNION ALL SELECT doc, 1, idx, warning FROM jc WHERE warning IS NOT NULL",
    ),
    "missing_parameters": (missing, f"WITH {SQL_CLAIMS} SELECT doc, n, parameter FROM mis"),
    "extraction_counts": (
        counts,
        f"""WITH {SQL_CLAIMS} SELECT doc, (SELECT count(*) FROM rec WHERE rec.doc = docs.doc) AS records, (SELECT count(*) FROM jc WHERE jc.doc = docs.doc AND warning IS NULL) AS conflicts, (SELECT count(*) FROM mis WHERE mis.doc = docs.doc) AS missing FROM docs""",
    ),
    "report_records": (
        lambda s, d: rp.record_rows(numbered(s, d)),
        f"""WITH {SQL_CLAIMS} SELECT doc, idx, CASE WHEN idx % 4 = 0 THEN idx ELSE row_number END || '.' AS number, {_case("parameter", rp.PARAMETER_NAMES)} AS parameter, value, resolved AS file, CAST(page AS VARCHAR) AS page,
          concat_ws('<br/>', CASE WHEN notes <> '' THEN '<b>Примечание:</b> ' || {_esc("notes")} END, CASE WHEN {SQL_NORM.format("raw_value")} <> {SQL_NORM.format("value")} THEN '<b>OCR:</b> ' || {_esc("raw_value")} END,
            CASE WHEN confidence <> 'high' THEN '<b>Уверенность:</b> ' || {_case("confidence", rp.CONFIDENCE_NAMES)} END, '<b>Фрагмент:</b> «' || {_esc("evidence")} || '»') AS notes FROM rec""",
    ),
    "report_conflicts": (
        lambda s, d: rp.conflict_rows(claims(s, d), rp.dominant_file(claims(s, d), docs(s, d))),
        f"""WITH {SQL_CLAIMS}, {SQL_DOMINANT} SELECT c.doc, idx, {_case("parameter", rp.PARAMETER_NAMES)} AS parameter, raw_value, CASE WHEN file = '' THEN dominant_file ELSE list_last(string_split(file, '/')) END AS file, CAST(page AS VARCHAR) AS page, evidence,
          {_case("conflict_type", rp.CONFLICT_NAMES)} || CASE WHEN reason = '' THEN '' ELSE '. ' || reason END AS reason FROM cl c JOIN dom USING (doc)""",
    ),
    "report_details": (
        lambda s, d: rp.details(missing(s, d), judged(s, d).where("warning IS NOT NULL").select("doc", "idx", "warning")),
        f"""WITH {SQL_CLAIMS}, a AS (SELECT doc, '<b>Не найдены:</b> ' || string_agg({_esc("parameter")}, ', ' ORDER BY n) AS missing FROM mis GROUP BY doc),
        b AS (SELECT doc, string_agg('<b>Предупреждение:</b> ' || {_esc("warning")}, chr(10) ORDER BY idx) AS warnings FROM jr WHERE warning IS NOT NULL GROUP BY doc) SELECT doc, missing, warnings FROM a FULL JOIN b USING (doc)""",
    ),
    "report_labels": (
        lambda s, d: claims(s, d).groupBy(rp.label(F.col("parameter"), rp.PARAMETER_NAMES).alias("parameter"), rp.label(F.col("conflict_type"), rp.CONFLICT_NAMES).alias("kind")).agg(F.count("*").alias("n")),
        f"WITH {SQL_CLAIMS} SELECT {_case('parameter', rp.PARAMETER_NAMES)} AS parameter, {_case('conflict_type', rp.CONFLICT_NAMES)} AS kind, count(*) AS n FROM claims GROUP BY ALL",
    ),
    "report_input_violations": (
        lambda s, d: rp.violations(claims(s, d)),
        f"WITH {SQL_CLAIMS} SELECT doc, idx, 'records[' || idx || '] без parameter/value' AS problem FROM cl WHERE parameter = '' OR value = ''",
    ),
    "report_input_problems": (
        lambda s, d: fx.table(s, d, "events")
        .selectExpr("event_id", """CASE event_id % 8 WHEN 0 THEN concat('{"records":[{"parameter":"p","value":', event_id, '}],"conflicts":null}') WHEN 1 THEN '{}' WHEN 2 THEN concat('[', props, ']') WHEN 3 THEN concat('{"records":', props, ',"warnings":5}')
          WHEN 4 THEN concat('{"records":[', event_id, ',', props, ',{"parameter":" ","value":"x"}]}') WHEN 5 THEN '{"conflicts":"a","missing_parameters":[],"records":[{"parameter":"a","value":false}]}' WHEN 6 THEN 'no json' END AS j""")
        .select("event_id", F.array_join(rp.input_problems(F.try_parse_json("j")), "; ").alias("problems")),
        """SELECT event_id, CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 3 THEN 'records: list expected; warnings: list expected'
          WHEN 4 THEN 'records[1]: object expected; records[2]: parameter and value expected; records[3]: parameter and value expected' WHEN 5 THEN 'conflicts: list expected' ELSE 'object expected' END AS problems FROM events""",
    ),
    "dominant_file": (lambda s, d: rp.dominant_file(claims(s, d), docs(s, d)), f"WITH {SQL_CLAIMS}, {SQL_DOMINANT} SELECT doc, dominant_file FROM dom"),
    "document_title": (
        lambda s, d: rp.titles(claims(s, d), docs(s, d)),
        f"""WITH {SQL_CLAIMS}, t AS (SELECT doc, first(value ORDER BY idx) FILTER (parameter = 'Номер скважины' AND value <> '') AS no, first(value ORDER BY idx) FILTER (parameter = 'Расположение скважины' AND value <> '') AS place FROM cl GROUP BY doc)
        SELECT doc, 'Параметры скважины' || coalesce(' № ' || no, '') || ' — ' || coalesce(place, name) AS title FROM docs LEFT JOIN t USING (doc)""",
    ),
}
