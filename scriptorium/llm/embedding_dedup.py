"""Near duplicates among embeddings: iterative quantisation, multi-index Hamming tables, exact cosine.

Rotations, learned from a bounded sample from different starts, turn unit vectors into balanced codes of 64 bits each.
Runs of bits are the keys of tables, no bit serving two tables, and two vectors meet where they share a label and any
key. Keys get a bit wider each time that the rows double, so that buckets do not grow with the table, and tables more
in number, so that a pair at the threshold meets as surely as before. Pairs that meet are dropped where their whole
codes differ in more than ``MOST_DIFFERENT`` of the bits, and the rest are compared by their original vectors. A pair
that meets in several tables counts in the first only, which both codes tell.
Equal vectors go on as one; a bucket is compared in pairs of blocks, which return sums of links and stars, never pairs.

The rotations are fitted on at most ``SAMPLE`` different vectors; every row is indexed.

Defined results: each row is a node, also where rows repeat an id or a vector: equal vectors of a label link as copies,
and two vectors of one id link only where they are alike. Vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label or id, link with nothing; vectors of different lengths do not link; an empty
table gives no rows. Extra columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import drop_staged, read, small_batches, staged
from scriptorium.llm.jaccard_join import LINKS_SQL, linked_classes, links_table, summed_links, with_result

COSINE = 0.93
SAMPLE, ROUNDS, BITS, MOST_MEAN = 10_000, 40, 64, 0.6
#: The least width of a key, and the share of a code's bits in which two vectors that are compared may differ: those at
#: the threshold differ in 0.12 of them, unrelated ones in half.
KEY_BITS, MOST_DIFFERENT = 16, 0.3
#: The chance that a pair whose bits agree with the chance of vectors at the threshold shares no key.
MISSED = 0.004
BLOCK_VECTORS = 1024
GROUP_ROWS = 4096


def tables_for(rows: int, mean: float = 0.0) -> tuple[int, int]:
    """The width of keys, and how many tables they make, for so many rows. Bits are taken from the common mean, whose norm
    is ``mean``; seen from there two vectors at the threshold stand at a wider angle."""
    width = min(48, max(KEY_BITS, rows.bit_length()))
    cosine = (COSINE - mean**2) / (1 - mean**2)
    agree = (1 - np.arccos(cosine) / np.pi) ** width
    return width, int(np.ceil(np.log(MISSED) / np.log1p(-agree)))


class Quantiser:
    """The learned rotations for a table of so many rows; ``codes`` gives the bits of each unit vector, and ``keys``
    what they are in each table."""

    def __init__(self, sample: np.ndarray, rows: int = 1, seed: int = 3):
        self.dim = sample.shape[1] if len(sample) else 1
        self.mean = sample.mean(0) if len(sample) else np.zeros(1)
        if np.linalg.norm(self.mean) > MOST_MEAN:
            # Vectors that point one way lie too near their mean: taken from there, near ones would have any angle.
            self.mean = np.zeros(self.dim)
        self.width, self.tables = tables_for(rows, float(np.linalg.norm(self.mean)))
        x = sample - self.mean
        _, axes = np.linalg.eigh(x.T @ x + 1e-12 * np.eye(self.dim))
        axes = axes[:, ::-1][:, :BITS]
        axes = np.pad(axes, ((0, 0), (0, BITS - axes.shape[1])))
        v = x @ axes
        rng, projects = np.random.default_rng(seed), []
        for _ in range(-(-self.width * self.tables // BITS)):
            rotation, _ = np.linalg.qr(rng.normal(size=(BITS, BITS)))
            for _ in range(ROUNDS if len(sample) else 0):
                b = np.where(v @ rotation >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(b.T @ v)
                rotation = (left @ right).T
            projects.append(axes @ rotation)
        self.project = np.hstack(projects)

    def codes(self, unit: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(unit), self.dim))
        for i, u in enumerate(unit):
            x[i, : len(u)] = u[: self.dim]
        return np.packbits((x - self.mean) @ self.project >= 0, axis=1)

    def keys(self, codes: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(codes, axis=1)[:, : self.tables * self.width].reshape(len(codes), self.tables, self.width)
        return bits.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))


def unit(vector) -> np.ndarray | None:
    """The vector at length 1 in double precision, or None where it can't link."""
    if vector is None or not len(vector) or any(c is None for c in vector):
        return None
    x = np.array(vector, np.float64)
    n = np.linalg.norm(x)
    return x / n if np.isfinite(x).all() and np.isfinite(n) and n > 0 else None


def fit_quantiser(df: DataFrame, vector: str = "embedding", most: int = SAMPLE) -> Quantiser:
    """The rotations for a table of vectors, from ``most`` different vectors at most, the first of a fixed pseudo-random
    order; a vector that many rows repeat counts once."""
    hashed = df.where(F.col(vector).isNotNull()).select(F.col(vector).alias("_v"), F.xxhash64(vector).alias("_h"))
    chosen = hashed.select("_h").distinct().orderBy("_h").limit(most)
    rows = hashed.join(F.broadcast(chosen), "_h").groupBy("_h").agg(F.first("_v").alias("_v")).orderBy("_h").collect()
    found = [u for r in rows if (u := unit(r["_v"])) is not None]
    sizes = [len(u) for u in found]
    most_common = max(sorted(set(sizes)), key=sizes.count) if sizes else 1
    return Quantiser(np.array([u for u in found if len(u) == most_common]).reshape(-1, most_common), df.count())


def met_before(keys_a: np.ndarray, keys_b: np.ndarray, table: int) -> np.ndarray:
    """Which of the pairs, given as keys, meet in a table before this one."""
    before = np.zeros(np.broadcast_shapes(keys_a.shape[:-1], keys_b.shape[:-1]), bool)
    for c in range(table):
        before |= keys_a[..., c] == keys_b[..., c]
    return before


def near_codes(codes_a: np.ndarray, codes_b: np.ndarray) -> np.ndarray:
    """Which of the pairs, given as codes of 64-bit words, differ in few enough bits."""
    most = int(MOST_DIFFERENT * 64 * codes_a.shape[-1])
    differ = np.zeros(np.broadcast_shapes(codes_a.shape[:-1], codes_b.shape[:-1]), np.int32)
    for c in range(codes_a.shape[-1]):
        differ += np.bitwise_count(codes_a[..., c] ^ codes_b[..., c])
    return differ <= most


def _comparer(model: Quantiser):
    def compare(table: pa.Table) -> pa.Table:
        c = {k: table.column(k).to_numpy() for k in ("bucket", "t", "left", "right", "block", "node", "copies")}
        tags = np.unique(np.array(table.column("label").to_pylist(), dtype=object).astype(str), return_inverse=True)[1]
        vectors = table.column("vector").combine_chunks()
        flat, offsets = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
        dims = np.diff(offsets)
        codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(dims), -1)
        by_table, codes = model.keys(codes), codes.view(np.uint64)
        stacked = lambda r: np.stack([flat[offsets[x] : offsets[x + 1]] for x in r])
        cosines = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
        # A bucket is a hash: what its label, length and key are is looked at again, so that a clash links nothing.
        key = np.stack([c["bucket"], c["t"].astype(np.int64), c["left"], c["right"], tags, dims, by_table[np.arange(len(dims)), c["t"]]])
        keys, which = np.unique(key, axis=1, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        cuts = np.searchsorted(which.ravel()[order], np.arange(keys.shape[1] + 1))
        size, parts = np.diff(cuts), []
        # Buckets of two are many, and are compared together.
        pair = (size == 2) & (keys[2] == keys[3])
        for t, n in {tuple(x) for x in keys[[1, 5]][:, pair].T.tolist()}:
            at = cuts[:-1][pair & (keys[1] == t) & (keys[5] == n)]
            a, b = order[at], order[at + 1]
            ok = near_codes(codes[a], codes[b]) & ~met_before(by_table[a], by_table[b], t)
            a, b = a[ok], b[ok]
            if len(a):
                hit = np.einsum("ij,ij->i", cosines(stacked(a)), cosines(stacked(b))) >= COSINE
                parts.append((a[hit], b[hit]))
        for k in np.flatnonzero((size > 1) & ~pair):
            rows = order[cuts[k] : cuts[k + 1]]
            same = keys[2, k] == keys[3, k]
            ra = rows if same else rows[c["block"][rows] == keys[2, k]]
            rb = rows if same else rows[c["block"][rows] == keys[3, k]]
            if not len(ra) or not len(rb):
                continue
            near = near_codes(codes[ra][:, None], codes[rb][None])
            if same:
                near = np.triu(near, 1)
            i, j = np.nonzero(near & (cosines(stacked(ra)) @ cosines(stacked(rb)).T >= COSINE))
            for at in range(0, len(i), 1 << 16):
                a, b = ra[i[at : at + (1 << 16)]], rb[j[at : at + (1 << 16)]]
                first = ~met_before(by_table[a], by_table[b], keys[1, k])
                parts.append((a[first], b[first]))
        a, b = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
        return links_table([summed_links(c["node"], c["copies"], a, b)])

    return compare


def near_embeddings(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", quantiser: Quantiser | None = None) -> DataFrame:
    """One row for each row of ``df``: (vec_id, n_links, component_id, kept)."""
    small_batches(df.sparkSession)
    model = quantiser or fit_quantiser(df, vector)
    rows = df.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("vector"), F.col(label).cast("string").alias("label"))

    @F.arrow_udf("struct<set_key:binary,code:binary>")
    def sketch(vectors: pa.Array, labels: pa.Array) -> pa.Array:
        units = [unit(v.as_py()) for v in vectors]
        tags = labels.to_pylist()
        ok = [i for i, u in enumerate(units) if u is not None and tags[i] is not None]
        codes = {i: x.tobytes() for i, x in zip(ok, model.codes([units[i] for i in ok]), strict=True)} if ok else {}
        keys = [
            hashlib.blake2b(f"{tags[i]}\0{len(units[i])}\0".encode() + np.array(vectors[i].as_py(), np.float64).tobytes(), digest_size=16).digest() if i in codes else None
            for i in range(len(units))
        ]
        return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array([codes.get(i) for i in range(len(units))], pa.binary())], ["set_key", "code"])

    @F.arrow_udf("array<bigint>")
    def table_keys(codes: pa.Array) -> pa.Array:
        if not len(codes):
            return pa.array([], pa.list_(pa.int64()))
        found = model.keys(np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), -1))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * model.tables), pa.array(found.ravel()))

    sketched = rows.select("id", "label", "vector", sketch("vector", "label").alias("s"))
    sketched = staged(sketched.select("id", "label", "vector", F.when(F.col("id").isNotNull(), F.col("s.set_key")).alias("set_key"), "s.code"), "codes")
    found = (
        sketched.where(F.col("set_key").isNotNull())
        .groupBy("set_key")
        .agg(F.struct(F.min("id").alias("id")).alias("first"), F.count("*").alias("copies"), F.first("code").alias("code"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    )
    # Each task numbers the classes that it writes; the numbers stand once the table is written.
    classes = staged(found.withColumn("node", F.monotonically_increasing_id()), "classes")
    keyed = classes.select("node", "label", F.size("vector").alias("size"), F.posexplode(table_keys("code")).alias("t", "key"))
    entries = keyed.select("node", "t", F.xxhash64("label", "size", "t", "key").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", F.ceil(F.col("n") / BLOCK_VECTORS).cast("int").alias("blocks"))
    met = staged(entries.join(buckets, "bucket").select("node", "t", "bucket", "blocks"), "entries")
    groups = met.count() // GROUP_ROWS + 1
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("bigint")
    pairs = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("left"), F.greatest(x, F.col("block")).alias("right")))
    dealt = (
        met.withColumn("block", block)
        .select("node", "t", "bucket", "blocks", "block", F.explode(pairs).alias("p"))
        .join(classes.select("node", "copies", "code", "vector", "label"), "node")
        .select(
            "bucket", F.col("t").cast("bigint").alias("t"), "p.left", "p.right", "block", "node", "copies", "code", "vector", "label",
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("bucket"), F.lit(groups))).otherwise(F.xxhash64("bucket", "p.left", "p.right")).alias("group"),
        )
    )
    links = staged(dealt.groupBy("group").applyInArrow(_comparer(model), LINKS_SQL), "links")
    result = linked_classes(classes, links, "id")
    drop_staged(classes, met, links)
    return with_result(sketched.select("id", "set_key"), result).toDF("vec_id", "n_links", "component_id", "kept")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding with the number of others of its label at a cosine of 0.93 or more, and its component."""
    return near_embeddings(read(spark, sf_dir, "embeddings"))
