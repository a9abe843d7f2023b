"""Inspection of recognised lines: flags, scores and the choice between two readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import text as tx


def inspection(text: Column, normal: bool = False) -> Column:
    """Struct (text, flags) of a line (``normal``: whose white space is normalised already). Each step is bound to a name, so that it is made once."""
    return tx.let(
        tx.headline_stripped(text, normal),
        lambda raw: tx.let(
            tx.truncate_repetition(raw),
            lambda cut: tx.let(tx.repeated_pattern(cut["text"], normal=True), lambda loop: tx.inspected(raw, cut["text"], cut["truncated"], loop)),
        ),
    )


def inspect(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``inspected`` (struct text, flags) to lines."""
    return df.withColumn("inspected", inspection(F.col(text)))


def suspicious(flags: Column) -> Column:
    return F.arrays_overlap(flags, F.array(*map(F.lit, tx.SUSPICIOUS_FLAGS)))


def review(score: Column, new_score: Column, flags: Column, new_flags: Column) -> Column:
    """Struct (accepted, flags): a second reading is taken where it scores higher; flags tell where they come from, those
    for which a line was read again by name."""
    accepted = new_score > score
    why = F.filter(flags, lambda f: f.isin(*tx.SUSPICIOUS_FLAGS))
    taken = F.concat(F.array(F.lit("reviewed_by_qwen")), new_flags, F.transform(why, lambda f: F.concat(F.lit("trocr_flag:"), f)))
    return F.struct(accepted.alias("accepted"), F.when(accepted, F.array_distinct(taken)).otherwise(F.array_append(flags, F.lit("qwen_review_rejected"))).alias("flags"))
