"""N-gram Jaccard join: Bayesian pruning of MinHash candidates, and exact verification of the rest.

1. Texts with the same set of shingles form a class, and go on as one text. Classes have numbers of their own, for one
   id may come with several texts.
2. Banded MinHash values put classes into buckets; classes that share a bucket, also through others, form a cluster.
3. A cluster is compared in whichever way takes fewer comparisons: all pairs of it, or the pairs within each of its
   buckets, where a pair counts in the first band that it shares. The first serves tight groups, whose texts meet in
   many buckets; the second serves long chains, whose ends never meet. Both go by pairs of blocks of bounded size.
   The MinHash values of a pair are compared a few at a time; with a uniform prior, the posterior probability that its
   similarity reaches the threshold follows from the matches so far, and pairs that fall below the tolerance are
   dropped. What is left is verified exactly on the sets of shingles.
4. Blocks return sums of links and stars of linked texts, never the pairs; components join the stars.

Defined results: each row is a node, also where rows repeat an id or a text: rows that repeat both link with each other
as copies do, and two texts of one id link only where they are alike. Null texts and texts without words link with
nothing, and neither do rows with a null id; texts of one to four words have one shingle; an empty table gives no rows.
Extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import drop_staged, read, small_batches, staged
from scriptorium.llm.components import connected_components
from scriptorium.llm.shingles import SHINGLE, mixed, shingle_set, shingles_sql

#: A pair is linked from this similarity; kept as a fraction, so that the test on counts is exact.
SIMILAR = (4, 5)
#: A pair at the threshold shares no band with a chance of (1 - 0.8^ROWS)^BANDS, 4e-8, which is below the tolerance.
BANDS, ROWS = 56, 6
#: MinHash values that are compared at a time, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 28, 1e-7
#: Texts, and their shingles, in a block of a cluster; shingles of the small clusters that are compared in one group.
BLOCK_TEXTS, BLOCK_SHINGLES, GROUP_SHINGLES = 1024, 1_000_000, 250_000


@cache
def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    n = BANDS * ROWS
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a set with at least one shingle, as 32-bit numbers."""
    a, b = _family()
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[at : at + 1024, None] * a + b).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = values.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return h


@cache
def least_matches(compared: int) -> int:
    """The fewest matches of so many compared values that leave a pair above the tolerance.

    With a uniform prior the posterior of the similarity after m matches of n is Beta(m + 1, n - m + 1), and its
    tail above s is the chance of at most m successes in n + 1 trials of chance s.
    """
    s, n = SIMILAR[0] / SIMILAR[1], compared + 1
    tail = 0.0
    for m in range(compared + 1):
        tail += math.comb(n, m) * s**m * (1 - s) ** (n - m)
        if tail >= TOLERANCE:
            return m
    return compared


SKETCH = "struct<set_key:binary,n_shingles:bigint,bands:array<bigint>>"


def _sketch(texts: pa.Array) -> pa.Array:
    keys, sizes, bands = [], [], []
    for t in texts:
        s = shingle_set(t.as_py())
        keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
        sizes.append(len(s))
        bands.append(band_keys(min_hashes(s)).view(np.int64) if len(s) else None)
    return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["set_key", "n_shingles", "bands"])


def _content(texts: pa.Array) -> pa.Array:
    values, sets = [], []
    for t in texts:
        s = shingle_set(t.as_py())
        values.append(min_hashes(s).tobytes() if len(s) else b"")
        sets.append(s.tobytes())
    return pa.StructArray.from_arrays([pa.array(values, pa.binary()), pa.array(sets, pa.binary())], ["values", "shingles"])


def surviving_pairs(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows that the comparison of MinHash values does not drop; of one block, each pair once."""
    small, large = np.minimum(size_a[:, None], size_b[None, :]), np.maximum(size_a[:, None], size_b[None, :])
    alive = small * SIMILAR[1] >= large * SIMILAR[0]
    if same:
        alive = np.triu(alive, 1)
    matches = np.zeros(alive.shape, np.int16)
    for c in range(STEP):
        matches += a[:, c][:, None] == b[:, c][None, :]
    i, j = np.nonzero(alive & (matches >= least_matches(STEP)))
    got = matches[i, j].astype(np.int64)
    for at in range(STEP, a.shape[1], STEP):
        more = np.empty(len(i), np.int64)
        for x in range(0, len(i), 1 << 15):
            y = slice(x, x + (1 << 15))
            more[y] = (a[i[y], at : at + STEP] == b[j[y], at : at + STEP]).sum(1)
        got = got + more
        stay = got >= least_matches(at + STEP)
        i, j, got = i[stay], j[stay], got[stay]
    return i, j


def linked_pairs(sets_a: list[np.ndarray], sets_b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs whose exact similarity reaches the threshold."""
    if not len(i):
        return i, j
    ra, rb = np.unique(i), np.unique(j)
    flat = np.concatenate([*(sets_a[x] for x in ra), *(sets_b[x] for x in rb)])
    row = np.repeat(np.arange(len(ra) + len(rb)), [*(len(sets_a[x]) for x in ra), *(len(sets_b[x]) for x in rb)])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    start = np.flatnonzero(np.r_[True, np.diff(column) > 0]) if len(column) else np.zeros(0, int)
    both = np.zeros((len(ra), len(rb)), np.float32)
    width = 2048  # shared shingles that are multiplied at a time
    ends = np.r_[start[1:], len(column)]
    number = np.cumsum(np.r_[0, np.diff(column) > 0]) if len(column) else column
    for x in range(0, len(start), width):
        a, b = start[x], ends[min(x + width, len(start)) - 1]
        m = np.zeros((len(ra) + len(rb), min(width, len(start) - x)), np.float32)
        m[row[a:b], number[a:b] - x] = 1
        both += m[: len(ra)] @ m[len(ra) :].T
    shared_n = both[np.searchsorted(ra, i), np.searchsorted(rb, j)].astype(np.int64)
    n = np.array([len(s) for s in sets_a])[i] + np.array([len(s) for s in sets_b])[j]
    ok = shared_n * SIMILAR[1] >= (n - shared_n) * SIMILAR[0]
    return i[ok], j[ok]


def roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each row the smallest id that it reaches by the pairs of rows (i, j)."""
    label = ids.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        if (new == label).all():
            return label
        label = new


LINKS = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])
LINKS_SQL = "node bigint, n bigint, root bigint"


def summed_links(node: np.ndarray, copies: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node of the linked pairs of rows (i, j): the rows it links with, and the smallest node it reaches."""
    ids, at = np.unique(np.concatenate([node[i], node[j]]), return_inverse=True)
    a, b = at[: len(i)], at[len(i) :]
    n = np.zeros(len(ids), np.int64)
    np.add.at(n, a, copies[j])
    np.add.at(n, b, copies[i])
    return ids, n, roots(ids, a, b)


def links_table(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 3
    return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=LINKS)


def _compare(table: pa.Table) -> pa.Table:
    """The links within the block pairs of a group: for each linked text the sum of links, and a star."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    c = {k: table.column(k).to_numpy() for k in ("unit", "by_bucket", "left", "right", "block", "node", "copies")}
    values, sets = table.column("values").to_pylist(), table.column("shingles").to_pylist()
    lists = table.column("bands").combine_chunks()
    bands, first = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()  # none where a cluster is compared as a whole
    bands_of = lambda r: bands[first[r][:, None] - first[0] + np.arange(BANDS)]
    keys, which = np.unique(np.stack([c["unit"], c["by_bucket"].astype(np.int64), c["left"], c["right"]]), axis=1, return_inverse=True)
    which = which.ravel()
    order = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[order], np.arange(keys.shape[1] + 1))
    for k in range(keys.shape[1]):
        rows = order[cuts[k] : cuts[k + 1]]
        rows = rows[np.argsort(c["node"][rows], kind="stable")]
        unit, by_bucket, left, right = keys[:, k]
        same = left == right
        ra = rows if same else rows[c["block"][rows] == left]
        rb = rows if same else rows[c["block"][rows] == right]
        if not len(ra) or not len(rb):
            continue
        load = lambda r: (np.stack([np.frombuffer(values[x], np.uint32) for x in r]), [np.frombuffer(sets[x], np.uint64) for x in r])
        va, sa = load(ra)
        vb, sb = (va, sa) if same else load(rb)
        size = lambda s: np.array([len(x) for x in s])
        i, j = surviving_pairs(va, vb, size(sa), size(sb), same)
        if by_bucket and len(i):  # the pair counts in the first band that it shares
            own = bands_of(ra[i])
            here = own[np.arange(len(i)), (own == bands_of(rb[j])).argmax(1)] == unit
            i, j = i[here], j[here]
        i, j = linked_pairs(sa, sb, i, j)
        if len(i):
            out.append(summed_links(c["node"], c["copies"], ra[i], rb[j]))
    return links_table(out)


def _classes(df: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame, int]:
    """The rows (doc, hash, set_key) of ``df``, hash that of the text, and the linked result of each class: (set_key, n,
    class_id, keeper). keeper is the (doc, hash) of the row that stands for all that links reach: the smallest.
    Last, the number of groups of ``GROUP_SHINGLES`` that the texts make."""
    spark = df.sparkSession
    small_batches(spark)
    docs = df.select(F.col(id).cast("bigint").alias("doc"), F.col(text).alias("txt")).withColumn("hash", F.xxhash64("txt"))
    sketched = docs.select("doc", "hash", F.arrow_udf(_sketch, SKETCH)("txt").alias("s"))
    rows = staged(sketched.select("doc", "hash", F.when(F.col("doc").isNotNull(), F.col("s.set_key")).alias("set_key"), "s.n_shingles", "s.bands"), "sketches")
    n, shingles = rows.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    found = (
        rows.where(F.col("set_key").isNotNull())
        .groupBy("set_key")
        .agg(F.min(F.struct("doc", "hash")).alias("first"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    # Each task numbers the classes that it writes; the numbers stand once the table is written.
    classes = staged(found.withColumn("node", F.monotonically_increasing_id()), "classes", n)
    entries = classes.select("node", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1")
    met = entries.join(buckets, "band")
    clusters = connected_components(met.where(F.col("node") != F.col("least")).select(F.col("node").alias("a"), F.col("least").alias("b")), rows=n)
    members = staged(clusters.join(classes, "node"), "members", n)
    size = [F.count("*").alias("texts"), F.sum("n_shingles").alias("all")]
    blocks = F.greatest(F.ceil(F.col("texts") / BLOCK_TEXTS), F.ceil(F.col("all") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    sizes = staged(members.groupBy("component").agg(*size).select("component", "texts", blocks), "sizes", n)
    within = members.join(sizes.where("blocks > 1").select("component"), "component", "left_semi").select("component", "n_shingles", F.explode("bands").alias("band"))
    within = staged(within.groupBy("component", "band").agg(*size).where("texts > 1").select("component", "band", "texts", blocks), "within", n)
    square = F.col("texts").cast("double") * F.col("texts")
    loose = within.groupBy("component").agg(F.sum(square).alias("pairs")).join(sizes, "component").where(F.col("pairs") < square).select("component", F.lit(True).alias("by_bucket"))
    groups = int((members.agg(F.sum("n_shingles")).first()[0] or 0) // GROUP_SHINGLES) + 1
    placed = members.join(sizes.drop("texts"), "component").join(loose, "component", "left").select(
        "node", "first", "copies", "bands", F.col("component").alias("unit"), "blocks", F.coalesce("by_bucket", F.lit(False)).alias("by_bucket")
    )
    # One text for each class, which meets it by the id and text of one of its rows; rows that repeat both meet before
    # they are shuffled. One plan at every size: the members are shuffled to the texts, few as they may be.
    texts = docs.where(F.col("doc").isNotNull()).groupBy("doc", "hash").agg(F.first("txt").alias("txt"))
    content = texts.join(placed.hint("merge"), (F.col("doc") == F.col("first.doc")) & (F.col("hash") == F.col("first.hash")))
    content = content.select("node", "copies", "bands", "unit", "blocks", "by_bucket", F.arrow_udf(_content, "struct<values:binary,shingles:binary>")("txt").alias("c"))
    if loose.limit(1).count():
        content = staged(content, "content")
        split = content.where("by_bucket").drop("blocks").select("*", F.explode("bands").alias("band"))
        split = split.join(within.select(F.col("component").alias("unit"), "band", "blocks"), ["unit", "band"])
        content = content.where(~F.col("by_bucket")).unionByName(split.drop("unit").withColumnRenamed("band", "unit"))
    # A block meets each block of its unit once, itself included; small units share a group.
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("left"), F.greatest(x, F.col("block")).alias("right")))
    dealt = (
        content.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("*", F.explode(pairs).alias("p"))
        .select(
            "node", "copies", "unit", "by_bucket", "block", "p.left", "p.right", "c.values", "c.shingles", F.when(F.col("by_bucket"), F.col("bands")).otherwise(F.array().cast("array<bigint>")).alias("bands"),
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("unit"), F.lit(groups))).otherwise(F.xxhash64("unit", "p.left", "p.right")).alias("group"),
        )
    )
    links = staged(dealt.groupBy("group").applyInArrow(_compare, LINKS_SQL), "links")
    result = linked_classes(classes, links, "doc", n)
    drop_staged(classes, clusters, members, sizes, within, links, *([content] if hasattr(content, "staged_at") else []))
    return rows, result, shingles // GROUP_SHINGLES + 1


def linked_classes(classes: DataFrame, links: DataFrame, id: str, rows: int | None = None) -> DataFrame:
    """(set_key, n, class_id, keeper) of classes (set_key, node, copies, first) and their ``LINKS``. first is a struct
    with the field ``id`` before others; the least of those that links reach is the keeper, and its id the class's.
    rows: about how many classes there are, if known."""
    joined = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), rows=rows)
    sums = links.groupBy("node").agg(F.sum("n").alias("n"))
    all_ = classes.select("set_key", "node", "copies", "first").join(sums, "node", "left").join(joined, "node", "left")
    all_ = all_.select("set_key", "node", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), "component")
    keepers = all_.where("component IS NOT NULL").groupBy(F.col("component").alias("_c")).agg(F.min("first").alias("keeper"))
    # Most classes have no component: they get keys of their own, so that they do not all go to the partition of null.
    out = all_.withColumn("_c", F.coalesce("component", -F.col("node") - 1)).join(keepers, "_c", "left").withColumn("keeper", F.coalesce("keeper", "first"))
    out = staged(out.select("set_key", "n", F.col(f"keeper.{id}").alias("class_id"), "keeper"), "result", rows)
    drop_staged(joined)
    return out


def with_result(rows: DataFrame, result: DataFrame) -> DataFrame:
    """(id, n, class_id, kept) of rows (id, set_key) from the result of their classes; rows without a class link with
    nothing, and are not sent to the join, where they would all meet."""
    linked = rows.where("set_key IS NOT NULL").join(result, "set_key").select("id", F.col("n").cast("bigint").alias("n"), "class_id", (F.col("class_id") == F.col("id")).alias("kept"))
    return linked.unionByName(rows.where("set_key IS NULL").select("id", F.lit(0).cast("bigint").alias("n"), F.col("id").alias("class_id"), F.lit(True).alias("kept")))


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: (doc_id, n_links, class_id, kept).

    n_links counts the other rows linked directly, class_id is the smallest id reachable by links, its own included,
    and kept marks the rows with that id.
    """
    rows, result, _ = _classes(df, id, text)
    return with_result(rows.select(F.col("doc").alias("id"), "set_key"), result).toDF("doc_id", "n_links", "class_id", "kept")


def keep_one(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without those that are near duplicates of a row that stays: of all that links reach, the row
    with the smallest id, and of its texts the one with the least hash. Of rows that repeat an id and a text one stays,
    that with the least hash of the other columns.

    A row goes for its own text only, so a text that shares its id with a copy stays; rows with a null id stay.
    """
    rows, result, groups = _classes(df, id, text)
    fate = rows.where(F.col("set_key").isNotNull()).join(result.select("set_key", "keeper"), "set_key")
    away = fate.where((F.col("doc") != F.col("keeper.doc")) | (F.col("hash") != F.col("keeper.hash"))).select(F.col("doc").alias("_doc"), F.col("hash").alias("_hash"))
    inner = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")).select("_row", F.col(f"_row.`{id}`").cast("bigint").alias("_doc"), F.xxhash64(F.col(f"_row.`{text}`")).alias("_hash"))
    others = [f"_row.`{f.name}`" for f in df.schema if f.name not in (id, text) and f.dataType.typeName() not in ("map", "variant")]
    once = inner.where(F.col("_doc").isNotNull()).groupBy("_doc", "_hash").agg(F.min_by("_row", F.xxhash64(F.lit(0), *others)).alias("_row"))
    # Few texts over many partitions would be as many files. Only what comes from a shuffle goes to fewer tasks: columns
    # of ``df`` that Python makes would keep memory for each partition until the task ends.
    left = once.join(away, ["_doc", "_hash"], "left_anti").select("_row").coalesce(groups)
    return left.unionByName(inner.where(F.col("_doc").isNull()).select("_row")).select("_row.*")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the number of others at a five-word Jaccard similarity of 0.8 or more, and its class."""
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP10_SQL = f"""
WITH RECURSIVE g AS MATERIALIZED ({shingles_sql("documents", "doc_id", SHINGLE)}),
n AS MATERIALIZED (SELECT doc_id, count(*) AS k FROM g GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y USING (g) JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id, p.k, q.k HAVING 5 * count(*) >= 4 * (p.k + q.k - count(*))),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a),
c AS (SELECT a, min(c) AS c FROM r GROUP BY a),
m AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT d.doc_id, CAST(coalesce(m.n, 0) AS BIGINT) AS n_links, c.c AS class_id, c.c = d.doc_id AS kept
FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN m ON m.a = d.doc_id
"""
