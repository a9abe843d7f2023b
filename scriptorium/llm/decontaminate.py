"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Items are parted into classes by their number of shingles, and each class has a table of its own with its own bound. The
sketch of an item is its smallest shingle hashes, as many as the largest item of its class may miss and still be
contained, and a few more; so a document that holds 0.8 of an item's shingles always holds so many of its sketch,
however long the document is. Documents that hold that many are verified against all shingles of the item. A document
with too few shingles for a class does not ask its table.

A benchmark of up to ``BLOCK_SHINGLES`` shingles, whose size is counted first, is broadcast, and searched for in one pass
over the documents without a shuffle. A larger one is never gathered: the sketches are a table that is joined by
shuffling to the shingles of the documents, each different text once, and what meets often enough is verified.

Defined results: texts without words (null, empty) are contained in nothing and contain nothing; items and documents of
one to four words have one shingle, so an item of fewer than five words is found only in a document of exactly its
words, and is not searched for inside longer ones, as in the SQL; repeated items and documents are reported for each of
their rows; with an empty benchmark no document has hits; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import read, small_batches, staged
from scriptorium.llm.shingles import shingle_set, shingles_sql

CONTAINED = 0.8
#: Shingles of a sketch beyond those that a contained item may miss.
SPARE = 8
#: Shingles of a benchmark that may be broadcast: 16 MB of them.
BLOCK_SHINGLES = 2_000_000
HITS = "array<struct<item_id:bigint,n_item:bigint,n_shared:bigint,containment:double>>"


def may_miss(n: int, share: float) -> int:
    """How many of ``n`` shingles a text may lack and still hold ``share`` of them."""
    return int((1 - share) * n + 1e-9)


def size_class(n: int) -> int:
    """The class of an item of ``n`` shingles: it holds the sizes from 2^class to 2^(class + 1) - 1."""
    return n.bit_length() - 1


def sketch_size(n: int, share: float) -> int:
    """How many of the smallest hashes of an item make its sketch; the bound of its class, or all of them."""
    return min(n, may_miss((2 << size_class(n)) - 1, share) + SPARE)


def least_met(n: int, share: float) -> int:
    """How many hashes of its sketch a text that contains an item of ``n`` shingles holds at least."""
    return max(1, sketch_size(n, share) - may_miss(n, share))


class ClassTable:
    """The sketches of the items of one size class: sorted hashes with their items, and the full sets."""

    def __init__(self, items: list[tuple[int, int | None, np.ndarray]], share: float):
        self.items = items
        self.least_size = min(len(s) - may_miss(len(s), share) for _, _, s in items)
        self.least = np.array([least_met(len(s), share) for _, _, s in items])
        sketches = [s[: sketch_size(len(s), share)] for _, _, s in items]  # the sets are sorted
        flat, owners = np.concatenate(sketches), np.repeat(np.arange(len(items)), [len(x) for x in sketches])
        order = np.argsort(flat, kind="stable")
        self.hashes, self.owners = flat[order], owners[order]

    def candidates(self, few: np.ndarray) -> np.ndarray:
        """The items of which the hashes hold enough."""
        first, last = np.searchsorted(self.hashes, few, "left"), np.searchsorted(self.hashes, few, "right")
        met = [self.owners[a:b] for a, b in zip(first, last, strict=True) if b > a]
        if not met:
            return np.zeros(0, np.int64)
        found, n = np.unique(np.concatenate(met), return_counts=True)
        return found[n >= self.least[found]]


class ItemIndex:
    """The tables of a benchmark, by size class."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], share: float = CONTAINED):
        self.share = share
        by_class: dict[int, list[tuple[int, int | None, np.ndarray]]] = {}
        for k, (i, s) in enumerate(items):
            if len(s):
                by_class.setdefault(size_class(len(s)), []).append((k, i, s))
        self.tables = [ClassTable(by_class[c], share) for c in sorted(by_class)]
        # Most hashes of a text are in no sketch; a bit for each tells most of them at once.
        flat = np.concatenate([t.hashes for t in self.tables]) if self.tables else np.zeros(0, np.uint64)
        self.bits = max(16, int(len(flat) * 16).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[self._low(flat)] = True

    def _low(self, h: np.ndarray) -> np.ndarray:
        return (h & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def hits(self, text: str | None) -> list[dict]:
        """The items that the text contains, in the order of the benchmark."""
        if not self.tables:
            return []
        own = shingle_set(text)
        few = own[self.maybe[self._low(own)]]
        out = []
        for table in self.tables if len(few) else ():
            if len(own) < table.least_size:
                break
            for k in table.candidates(few):
                number, item, whole = table.items[k]
                shared = int(np.isin(whole, own, assume_unique=True).sum())
                if shared >= len(whole) - may_miss(len(whole), self.share):
                    out.append((number, {"item_id": item, "n_item": len(whole), "n_shared": shared, "containment": shared / len(whole)}))
        return [hit for _, hit in sorted(out, key=lambda x: x[0])]


def item_sets(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, set, n): the items that have shingles, with them, sorted, and their number; written to the shared folder."""
    small_batches(benchmark.sparkSession)

    @F.arrow_udf("binary")
    def sets(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t.as_py()).tobytes() for t in texts], pa.binary())

    rows = benchmark.select(F.col(item).cast("bigint").alias("item"), sets(F.col(text)).alias("set"))
    return staged(rows.where(F.octet_length("set") > 0).withColumn("n", (F.octet_length("set") / 8).cast("bigint")), "items")


def index_of(items: DataFrame, share: float = CONTAINED) -> ItemIndex:
    """The index of a benchmark that may be broadcast."""
    rows = sorted(items.collect(), key=lambda r: (r["item"] is not None, r["item"] or 0, bytes(r["set"])))
    return ItemIndex([(r["item"], np.frombuffer(r["set"], np.uint64)) for r in rows], share)


def hits_in(text: Column | str, index: ItemIndex, spark: SparkSession) -> Column:
    """The items of a benchmark that each whole text contains."""
    sent = spark.sparkContext.broadcast(index)  # its size has been counted

    @F.arrow_udf(HITS)
    def find(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_item", pa.int64()), ("n_shared", pa.int64()), ("containment", pa.float64())]))
        return pa.array([sent.value.hits(t.as_py()) for t in texts], kind)

    return find(F.col(text) if isinstance(text, str) else text)


def hits_by_shuffle(texts: DataFrame, items: DataFrame, share: float) -> DataFrame:
    """(hash, hits) of the different texts (hash, text) that contain items (item, set, n). Nothing is gathered: sketches
    and shingles meet by hash, pairs that meet often enough meet their full sets by keys."""

    @F.arrow_udf("array<bigint>")
    def shingles(column: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t.as_py()).view(np.int64) for t in column], pa.list_(pa.int64()))

    @F.arrow_udf("array<bigint>")
    def sketch(sets: pa.Array) -> pa.Array:
        found = [np.frombuffer(s.as_py(), np.int64) for s in sets]
        return pa.array([s[: sketch_size(len(s), share)] for s in found], pa.list_(pa.int64()))

    @F.arrow_udf("bigint")
    def least(sizes: pa.Array) -> pa.Array:
        return pa.array([least_met(n, share) for n in sizes.to_pylist()], pa.int64())

    @F.arrow_udf("bigint")
    def shared(sets: pa.Array, column: pa.Array) -> pa.Array:
        return pa.array([np.isin(np.frombuffer(s.as_py(), np.uint64), shingle_set(t.as_py()), assume_unique=True).sum() for s, t in zip(sets, column, strict=True)], pa.int64())

    items = staged(items.withColumn("number", F.monotonically_increasing_id()), "numbered")
    sketches = items.select("number", least("n").alias("least"), F.explode(sketch("set")).alias("h"))
    asked = texts.select("hash", F.explode(shingles("text")).alias("h"))
    met = asked.join(sketches, "h").groupBy("hash", "number").agg(F.count("*").alias("met"), F.first("least").alias("least")).where("met >= least").select("hash", "number")
    # The pairs are staged, so that their side of the next joins has its true size.
    pairs = staged(met, "pairs")
    checked = pairs.join(items, "number").join(texts, "hash").select("hash", "item", "set", "n", shared("set", "text").alias("k"))
    few = F.floor((1 - F.lit(share)) * F.col("n") + F.lit(1e-9)).cast("bigint")
    hit = F.struct(F.col("item").alias("item_id"), F.col("n").alias("n_item"), F.col("k").alias("n_shared"), (F.col("k") / F.col("n")).alias("containment"))
    found = checked.where(F.col("k") >= F.col("n") - few).groupBy("hash").agg(F.array_sort(F.collect_list(F.struct(F.col("item").isNotNull().alias("a"), "item", "set", hit.alias("hit")))).alias("hits"))
    return found.select("hash", F.col("hits.hit").alias("hits"))


def find_contamination(df: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "contamination", share: float = CONTAINED) -> DataFrame:
    """``df`` with the items that each text contains, as ``HITS``, in the order of their ids."""
    small_batches(df.sparkSession)
    items = item_sets(benchmark)
    if (items.agg(F.sum("n")).first()[0] or 0) <= BLOCK_SHINGLES:
        return df.withColumn(out, hits_in(text, index_of(items, share), df.sparkSession))
    # Each different text once, by a digest of all of it; rows that repeat it meet before they are shuffled.
    digest = F.unhex(F.md5(F.col(f"`{text}`").cast("binary")))
    texts = staged(df.where(F.col(f"`{text}`").isNotNull()).select(digest.alias("hash"), F.col(f"`{text}`").alias("text")).groupBy("hash").agg(F.first("text").alias("text")), "texts")
    hits = hits_by_shuffle(texts, items, share).select(F.col("hash").alias("_h"), F.col("hits").alias("_hits"))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), digest.alias("_d")).join(hits, F.col("_d") == F.col("_h"), "left")
    kept = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != out]
    return rows.select(*kept, F.coalesce("_hits", F.array().cast(HITS)).alias(out))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item and document that contains 0.8 or more of its five-word shingles."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"), out="_hits").select("doc_id", F.explode("_hits").alias("_h"))
    return found.select("doc_id", "_h.item_id", "_h.n_item", "_h.n_shared", "_h.containment")


OP8_SQL = f"""
WITH d AS ({shingles_sql("documents", "doc_id")}),
     b AS ({shingles_sql("benchmark", "item_id")}),
     n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, CAST(n_item AS BIGINT) AS n_item, CAST(count(*) AS BIGINT) AS n_shared,
       CAST(count(*) AS DOUBLE) / n_item AS containment
FROM d JOIN b USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item
HAVING count(*) >= n_item - floor(0.2 * n_item + 1e-9)
"""
