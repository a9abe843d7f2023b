"""What the corpus operators share: reading, staging in the cluster's shared folder, Arrow batches, labels."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch that a Python worker holds, and the bytes from which a batch ends before that; texts may be
#: long, so both are far below Spark's defaults. A batch holds as much more as its last row does.
ARROW_ROWS, ARROW_BYTES = 512, 16 << 20
#: Rows of a staged table for which it has a file, where their number is about known.
FILE_ROWS = 1 << 14


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of ``sf_dir``; batches for Python workers are kept small."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of whole texts: those that go to Python workers, and those that Parquet is read in."""
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES),
        ("spark.sql.parquet.columnarReaderBatchSize", ARROW_ROWS),
    ):
        now = re.match(r"-?\d+$", spark.conf.get(key, None) or "")
        if not now or not 0 < int(now[0]) <= most:
            spark.conf.set(key, str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver see: spark.checkpoint.dir. Only where the driver is the only worker
    (master local, as in tests) is one of our own made if that is unset; on a cluster it has to be named."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="scriptorium-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: it cuts the lineage and survives lost executors.

    The table stays there as long as the folder is kept, for frames made from it may be read at any time. rows: about
    how many it has, so that a small one has few files, however many partitions hold it. In a local folder without
    Hadoop's native library, an executor starts three processes for each file (chmod), and one that is just being
    started shares the executor's memory, which is then seen twice. All rows are written in any case. Not for a ``df``
    that Python makes after its last shuffle: that keeps memory for each partition until the task ends."""
    at = new_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(rows // FILE_ROWS + 1)
    df.write.option("compression", "zstd").parquet(at)
    back = df.sparkSession.read.schema(df.schema).parquet(at)
    back.staged_at = at
    return back


def drop_staged(*frames: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(doc_id: int, k: int) -> int:
    """The fold of a document: crc32 of its id as text, modulo ``k``."""
    return zlib.crc32(str(doc_id).encode()) % k


def crc_mod_col(col, k: int):
    return (F.crc32(col.cast("string").cast("binary")) % k).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, k: int, held: int, most: int, features) -> list[tuple[bytes, int]]:
    """At most ``most`` labelled (features, label) rows outside the held-out fold, the same ones each time.

    ``features`` makes an array of numbers of a text on the executors, so that no text is sent to the driver.
    The rows are the first of a fixed pseudo-random order of their ids, so that the bound does not favour a source;
    rows with a null label, id or text are left out. An id counts once: labelled twice, with its greatest label; with
    several texts, with the one of the least hash. The fold is decided before the texts are read, and only the bounded
    choice meets the documents.
    """

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()).tobytes() for t in texts], pa.binary())

    keep = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & (crc_mod_col(F.col("_id"), k) != held))
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    rows = (
        docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))
        .join(F.broadcast(keep), F.col("_doc") == F.col("_id"))  # at most `most` rows of two numbers
        .where(F.col("_text").isNotNull())
        .select("_id", "_y", F.struct(F.xxhash64("_text").alias("h"), packed("_text").alias("x")).alias("_f"))
        .groupBy("_id")  # repeated rows meet before they are shuffled
        .agg(F.min("_f").alias("_f"), F.first("_y").alias("_y"))
        .select("_id", F.col("_f.x").alias("_x"), "_y")
        .collect()
    )
    return [(bytes(r["_x"]), r["_y"]) for r in sorted(rows, key=lambda r: r["_id"])]
