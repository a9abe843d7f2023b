"""The tables of a report on extraction results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions import jsonx as js
from scriptorium.functions import text as tx
from scriptorium.sources import files

# Labels and marks.
NOTE, OCR, CERTAINTY, FRAGMENT = "<b>Примечание:</b> ", "<b>OCR:</b> ", "<b>Уверенность:</b> ", ("<b>Фрагмент:</b> «", "»")
MISSING, WARNING = "<b>Не найдены:</b> ", "<b>Предупреждение:</b> "
TITLE, NUMBER, PLACE = "Параметры скважины", "Номер скважины", "Расположение скважины"
LISTS = ("records", "conflicts", "missing_parameters", "warnings")
PARAMETER_NAMES = {"Статус скважины": "Этап жизненного цикла"}
CONFIDENCE_NAMES = {"high": "высокая", "medium": "средняя", "low": "низкая"}
CONFLICT_NAMES = {
    "ocr_error": "вероятная ошибка OCR",
    "possible_document_inconsistency": "возможное противоречие документа",
    "possible_rounding": "возможное округление",
    "technical_stage_difference": "разные технические этапы",
    "temporal_change": "изменение во времени",
    "unresolved": "неразрешённый конфликт",
}


def safe(c: str | Column) -> Column:
    return tx.strip(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))


def label(c: Column, names: dict[str, str]) -> Column:
    """The name for a code, the code itself without one."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), c), c)


def cleaned(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with these columns as text without white space at the ends; each is cleaned once, however often it is used."""
    return df.select(*(F.col(c) for c in df.columns if c not in names), *(safe(c).alias(c) for c in names))


def notes() -> Column:
    """What is to be noted on a cleaned record; one space where there is nothing."""
    raw, value, confidence, evidence, own = (F.col(c) for c in ("raw_value", "value", "confidence", "evidence", "notes"))
    level = F.lower(confidence)
    parts = F.array_compact(
        F.array(
            F.when(own != "", F.concat(F.lit(NOTE), tx.escape(own))),
            F.when((raw != "") & (tx.normalized_literal(raw) != tx.normalized_literal(value)), F.concat(F.lit(OCR), tx.escape(raw))),
            F.when((confidence != "") & (level != "high"), F.concat(F.lit(CERTAINTY), tx.escape(label(level, CONFIDENCE_NAMES)))),
            F.when(evidence != "", F.concat(F.lit(FRAGMENT[0]), tx.escape(evidence), F.lit(FRAGMENT[1]))),
        )
    )
    return F.when(F.size(parts) == 0, F.lit(" ")).otherwise(F.array_join(parts, "<br/>"))


def record_rows(records: DataFrame) -> DataFrame:
    """The rows of the table of records: (doc, idx, number, parameter, value, file, page, notes)."""
    number = F.concat(F.coalesce(F.col("row_number").cast("string").try_cast("int"), F.col("idx")).cast("string"), F.lit("."))
    rows = cleaned(records, "parameter", "value", "raw_value", "page", "confidence", "evidence", "notes")
    return rows.select("doc", "idx", number.alias("number"), label(F.col("parameter"), PARAMETER_NAMES).alias("parameter"), "value", tx.basename(F.col("file")).alias("file"), "page", notes().alias("notes"))


def conflict_rows(conflicts: DataFrame, named_files: DataFrame) -> DataFrame:
    """The rows of the table of conflicts; named_files: (doc, dominant_file) for conflicts without a file."""
    rows = cleaned(conflicts, "parameter", "conflict_type", "raw_value", "page", "evidence", "reason").withColumn("_file", tx.basename(F.col("file")))
    kind, reason = F.col("conflict_type"), F.col("reason")
    named = label(kind, CONFLICT_NAMES)
    text = F.when(kind == "", reason).when(reason == "", named).otherwise(F.concat(named, F.lit(". "), reason))
    return rows.join(named_files, "doc", "left").select(
        "doc", "idx", label(F.col("parameter"), PARAMETER_NAMES).alias("parameter"), "raw_value", F.when(F.col("_file") == "", F.col("dominant_file")).otherwise(F.col("_file")).alias("file"),
        "page", "evidence", text.alias("reason"),
    )


def dominant_file(records: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, dominant_file): the file most records name, the first named of equals, else the document's own name.

    docs: (doc, name)."""
    named = records.select("doc", "idx", tx.basename(F.col("file")).alias("f")).where("f <> ''")
    counts = named.groupBy("doc", "f").agg(F.count("*").alias("n"), F.min("idx").alias("first"))
    best = counts.groupBy("doc").agg(F.min(F.struct((-F.col("n")).alias("n"), "first", "f"))["f"].alias("f"))
    return docs.join(best, "doc", "left").select("doc", F.coalesce("f", "name").alias("dominant_file"))


def titles(records: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc, title) from the first number and place that a document's records name. docs: (doc, name)."""
    first = lambda p: F.min(F.when((safe("parameter") == p) & (safe("value") != ""), F.struct("idx", safe("value").alias("v"))))["v"]
    found = records.groupBy("doc").agg(first(NUMBER).alias("no"), first(PLACE).alias("place"))
    rows = docs.join(found, "doc", "left")
    where = F.coalesce("place", "name", F.lit(""))
    title = F.concat(F.lit(TITLE), F.coalesce(F.concat(F.lit(" № "), "no"), F.lit("")), F.when(where == "", "").otherwise(F.concat(F.lit(" — "), where)))
    return rows.select("doc", title.alias("title"))


def details(missing: DataFrame, warnings: DataFrame) -> DataFrame:
    """(doc, missing, warnings) as a report's last paragraphs. missing: (doc, n, parameter); warnings: (doc, idx, warning)."""
    a = missing.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("n", "parameter"))).alias("m")).select("doc", F.concat(F.lit(MISSING), F.array_join(F.transform("m.parameter", tx.html_escape), ", ")).alias("missing"))
    b = warnings.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("idx", "warning"))).alias("w")).select("doc", F.array_join(F.transform("w.warning", lambda w: F.concat(F.lit(WARNING), tx.html_escape(w))), "\n").alias("warnings"))
    return a.join(b, "doc", "full")


def violations(records: DataFrame) -> DataFrame:
    """Records that a report can't show: (doc, idx, problem)."""
    rows = cleaned(records, "parameter", "value")
    return rows.where((F.col("parameter") == "") | (F.col("value") == "")).select("doc", "idx", F.concat(F.lit("records["), "idx", F.lit("] без parameter/value")).alias("problem"))


def input_problems(v: Column) -> Column:
    """What a report's input, read as VARIANT, is refused for, in order; empty where it is accepted.

    The root has to be an object, each of the four lists a list, null or missing, each record an object with a parameter
    and a value."""
    lists = F.array_compact(F.array(*(F.when(~F.coalesce(js.field_kind(v, f"$.{f}"), F.lit("VOID")).rlike(r"\A(VOID|ARRAY<.*)\z"), F.lit(f"{f}: list expected")) for f in LISTS)))
    text = lambda r, f: tx.strip(js.truthy_or_plain(js.get(r, f"$.{f}", "variant")))

    def record(r: Column, i: Column) -> Column:
        at = F.concat(F.lit("records["), (i + 1).cast("string"), F.lit("]: "))
        return F.when(~js.is_object(r), F.concat(at, F.lit("object expected"))).when((text(r, "parameter") == "") | (text(r, "value") == ""), F.concat(at, F.lit("parameter and value expected")))

    rows = F.when(js.field_kind(v, "$.records").startswith("ARRAY"), js.get(v, "$.records", js.VARIANTS))
    each = F.coalesce(F.array_compact(F.transform(rows, record)), F.array().cast("array<string>"))
    return F.when(~js.is_object(v), F.array(F.lit("object expected"))).otherwise(F.concat(lists, each))


def read_extractions(spark: SparkSession, path: str) -> DataFrame:
    """(path, v, problems): extraction results from JSON files, with or without a byte-order mark; a file that is no JSON
    has the problem of a root that is no object."""
    return files.read_json_texts(spark, path).withColumn("problems", input_problems(F.col("v")))
