"""Archives: the status of members, pages numbered over members, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.sources.files import MOST_MEMBER_BYTES

# Messages.
ENCRYPTED = "Зашифрованные элементы ZIP не поддерживаются."
TOO_LARGE = f"Размер элемента превышает {MOST_MEMBER_BYTES} байт."
NESTED = "Вложенные ZIP-архивы не поддерживаются."


def member_status(members: DataFrame) -> DataFrame:
    """Adds status and error to members (archive, ordinal, size_bytes, encrypted, kind, error)."""
    error = F.when(F.col("encrypted"), ENCRYPTED).when(F.col("size_bytes") > MOST_MEMBER_BYTES, TOO_LARGE).when(F.col("error").isNotNull(), F.col("error")).when(F.col("kind") == "zip_archive", NESTED)
    return members.withColumn("error", error).withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("skipped"))


def number_pages(pages: DataFrame) -> DataFrame:
    """Numbers the pages of an archive (archive, ordinal, source_page) over its members, from 1."""
    return pages.withColumn("page", F.row_number().over(Window.partitionBy("archive").orderBy("ordinal", "source_page")))


def roll_up(members: DataFrame) -> DataFrame:
    """For each archive its members, those processed, and their pages. members: (archive, status, pages)."""
    ok = F.col("status") == "ok"
    return members.groupBy("archive").agg(F.count("*").alias("members"), F.count_if(ok).alias("processed"), F.sum(F.when(ok, F.col("pages")).otherwise(0)).alias("pages"))
