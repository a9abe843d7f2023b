"""A corpus pipeline: toxic documents go, one document of each near-duplicate group stays, documents that hold benchmark
items go, secrets are masked, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs. A stage
reads all that the one before kept.

Defined results: rows with a null text or id pass the filters, and so do empty texts unless the machine scores them
toxic; rows that repeat an id and a text stay once; a text that shares its id with another goes for its own reasons only;
extra columns are kept up to the last stage, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import bpe, decontaminate, jaccard_join, secrets, toxicity
from scriptorium.llm.common import read, small_batches, staged


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column has it."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below its threshold."""
    machine = toxicity.fit_toxicity(docs, read(spark, sf_dir, "labels"))
    score = unused(docs, "_toxicity_score")
    scored = toxicity.score_toxicity(docs, machine, out=score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, and all that are near no other."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    hits = unused(docs, "_benchmark_hits")
    found = decontaminate.find_contamination(docs, read(spark, sf_dir, "benchmark"), out=hits)
    return found.where(F.size(hits) == 0).select(*columns(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked and n_chars brought up to date."""
    masked = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*columns(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and whether they decode to its text."""
    small_batches(spark)
    coded = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"), bpe.bpe_encode("text").alias("ids"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", (bpe.bpe_decode("ids") == F.col("_text")).alias("round_trips"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode),
]

#: The trained stages and the encoder can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
