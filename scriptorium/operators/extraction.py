"""Extraction results checked against the pages they cite: evidence, records, conflicts, warnings, missing parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as tx

# What records may name, and the messages on those that go.
PARAMETERS = (
    "Номер скважины",
    "Расположение скважины",
    "Дата начала бурения",
    "Дата завершения бурения",
    "Статус скважины",
    "Проектная глубина",
    "Фактическая глубина (забой)",
    "Максимальный угол отклонения",
    "Проектное назначение",
)
CONFIDENCES = ("high", "medium", "low")
CONFLICTS = ("ocr_error", "possible_document_inconsistency", "possible_rounding", "technical_stage_difference", "temporal_change", "unresolved")
EVIDENCE_MOST = 300
INVALID = ("Удалена невалидная запись records[", "].")
INCOMPLETE, NAMELESS = "Удалена неполная запись ", "без параметра"
GONE, BAD_CONFIDENCE = "Удалена запись ", " с некорректным confidence."
NO_EVIDENCE, NO_VALUE = ": evidence не найдена однозначно для файла/страницы ", ": raw_value отсутствует в evidence."
INVALID_CONFLICT = ("Удалён невалидный conflicts[", "].")
BAD_CONFLICT = ("Удалён conflicts[", "]: поля или evidence не прошли проверку.")


def resolve(claims: DataFrame, pages: DataFrame, key: str = "claim") -> DataFrame:
    """Adds ``resolved``: the file of the one page that holds a claim's evidence, else null.

    claims: (claim, doc, file, page, evidence, ..); pages: (doc, file, page, hay1, hay2). Evidence counts only where the
    claim's own document has it. A named file is held to where it has that page; where it hasn't, another is taken only
    if it is the only one of the document with that page. Claims meet pages by document and page, so the pairs that are
    compared are a document's files with that page, however many documents there are."""
    asked = claims.select(key, F.col("doc").alias("_doc"), F.col("page").alias("_page"), tx.basename(F.col("file")).alias("_file"), tx.normalized_literal(F.col("evidence")).alias("_needle"))
    met = asked.join(pages.select(F.col("doc").alias("_doc"), F.col("page").alias("_page"), F.col("file").alias("p_file"), "hay1", "hay2"), ["_doc", "_page"])
    # Texts are searched once for each pair, before the pairs are counted.
    there = (F.col("_needle") != "") & (F.contains("hay1", "_needle") | F.contains("hay2", "_needle"))
    met = met.select(key, "_file", "p_file", F.coalesce(F.col("p_file") == F.col("_file"), F.lit(False)).alias("_same"), F.coalesce(there, F.lit(False)).alias("_hit"))
    same, hit = F.col("_same"), F.col("_hit")
    found = met.groupBy(key).agg(
        F.first("_file").alias("f"), F.count("*").alias("n"), F.count_if(same).alias("n_same"), F.count_if(hit).alias("n_hit"), F.count_if(hit & same).alias("n_both"),
        F.min(F.when(hit, F.col("p_file"))).alias("hit"), F.min(F.when(hit & same, F.col("p_file"))).alias("both"),
    )
    any_file = F.when(F.col("n_hit") == 1, F.col("hit"))
    resolved = F.when(F.col("f") == "", any_file).when(F.col("n_same") > 0, F.when(F.col("n_both") == 1, F.col("both"))).when(F.col("n") == 1, any_file)
    return claims.join(found.select(key, resolved.alias("resolved")), key, "left")


def _literal_in(part: str, whole: str) -> Column:
    return F.contains(tx.normalized_literal(F.col(whole)), tx.normalized_literal(F.col(part)))


def _cleaned(df: DataFrame, *names: str) -> DataFrame:
    return df.select("*", *(tx.strip(F.coalesce(F.col(n), F.lit(""))).alias(f"_{n}") for n in names)).drop(*names).withColumnsRenamed({f"_{n}": n for n in names})


def judge_records(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds ``warning`` to raw records (doc, idx, parameter, value, raw_value, file, page, evidence, confidence, notes):
    null where a record stands, else why it goes. Records may have is_object, false for what is none."""
    rows = _cleaned(records, "parameter", "value", "raw_value", "evidence", "confidence", "notes").withColumn("confidence", F.lower("confidence")).withColumn("claim", F.struct("doc", "idx"))
    rows = resolve(rows, pages)
    at = F.concat(F.lit("records["), "idx", F.lit("]"))
    page = F.coalesce("page", F.lit(-1)).cast("string")
    broken = ~F.col("is_object") if "is_object" in records.columns else F.lit(False)
    warning = (
        F.when(broken, F.concat(F.lit(INVALID[0]), "idx", F.lit(INVALID[1])))
        .when(~F.col("parameter").isin(*PARAMETERS) | (F.col("value") == "") | (F.col("raw_value") == ""),
               F.concat(F.lit(INCOMPLETE), at, F.lit(" ("), F.when(F.col("parameter") == "", NAMELESS).otherwise(F.col("parameter")), F.lit(").")))
        .when(~F.col("confidence").isin(*CONFIDENCES), F.concat(F.lit(GONE), at, F.lit(BAD_CONFIDENCE)))
        .when((F.length("evidence") > EVIDENCE_MOST) | F.col("resolved").isNull(), F.concat(F.lit(GONE), at, F.lit(NO_EVIDENCE), page, F.lit(".")))
        .when(~_literal_in("raw_value", "evidence"), F.concat(F.lit(GONE), at, F.lit(NO_VALUE)))
    )
    return rows.withColumn("warning", warning).drop("claim")


def records(judged: DataFrame) -> DataFrame:
    """The records that stand, numbered anew in each document, with the file they were found in."""
    n = F.row_number().over(Window.partitionBy("doc").orderBy("idx"))
    return judged.where("warning IS NULL").select("doc", n.alias("row_number"), "idx", "parameter", "value", "raw_value", F.when(F.col("resolved") != "", F.col("resolved")).alias("file"), "page", "evidence", "confidence", "notes")


def judge_conflicts(conflicts: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds ``warning`` to raw conflicts (doc, idx, parameter, conflict_type, raw_value, file, page, evidence, reason)."""
    rows = _cleaned(conflicts, "parameter", "conflict_type", "raw_value", "evidence", "reason").withColumn("claim", F.struct("doc", "idx"))
    rows = resolve(rows, pages)
    bad = (
        ~F.col("parameter").isin(*PARAMETERS) | ~F.col("conflict_type").isin(*CONFLICTS) | (F.col("raw_value") == "") | (F.col("reason") == "")
        | (F.length("evidence") > EVIDENCE_MOST) | F.col("resolved").isNull() | ~_literal_in("raw_value", "evidence")
    )
    broken = ~F.col("is_object") if "is_object" in conflicts.columns else F.lit(False)
    return rows.withColumn("warning", F.when(broken, F.concat(F.lit(INVALID_CONFLICT[0]), "idx", F.lit(INVALID_CONFLICT[1]))).when(bad, F.concat(F.lit(BAD_CONFLICT[0]), "idx", F.lit(BAD_CONFLICT[1])))).drop("claim")


def missing(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(doc, n, parameter): the parameters without a record, in their fixed order. docs: (doc)."""
    names = F.posexplode(F.array(*map(F.lit, PARAMETERS))).alias("n", "parameter")
    return docs.select("doc", names).join(kept.select("doc", "parameter"), ["doc", "parameter"], "left_anti").select("doc", (F.col("n") + 1).alias("n"), "parameter")
