"""LM scoring: stupid-backoff scores of documents from n-gram count tables partitioned by hash.

The n-grams of a batch of documents are exploded and sorted by a 48-bit hash, and go to the hash partitions of the count
table as packed runs; a partition sums the counts of all batches and joins them back to the n-grams that asked, as
packed runs in the same order; each batch then sums the scores of its documents. A row of its own carries the number
of words of each batch to one more partition, which tells all batches how many there are. Rows are runs and not single
n-grams because a row for each was measured at 10 times the input in shuffles and 1,060 task seconds a GB.

A word's score is the share of its trigram in the bigram before it; where the table has no such trigram, the share of
its bigram with a factor of 0.4, and so on; a word that the table lacks counts as if it occurred once. ``score`` is by
the counts of the whole corpus. ``score_others`` is by those of all other documents, so that a document's own n-grams do
not vouch for themselves.

Batches and partitions are made in proportion to the text and have a bounded size each; up to ``MOST_GROWTH`` times they
grow with the fourth root of the text, so that a run holds 90 n-grams at 1 TB and 10 at 10 TB; from about 100 TB on, a run is
one n-gram, as in any shuffle by hash. Batches are dealt by the place of a row in its table, so that rows which repeat
an id and a text do not meet in one. Two n-grams share a hash with a chance of about one in a million at a billion
n-grams, and then share their counts.

Defined results: null texts and texts without words have no words and scores of 0; repeated texts vouch for each other;
rows that repeat an id, or have none, are scored row by row; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import read, small_batches
from scriptorium.llm.shingles import grams, word_hashes

ORDER, BACKOFF = 3, 0.4
#: Characters of a batch of documents, and of text for each partition of the count table; the text from which both
#: grow, and how often at most.
BATCH_CHARS, PART_CHARS, GROWS_FROM, MOST_GROWTH = 8_000_000, 4_000_000, 8_000_000_000, 4.0
HASH_BITS = 48
#: Runs of fewer n-grams are not compressed.
SHORT = 64

REQUEST = "bucket bigint, batch bigint, n bigint, hashes binary, counts binary"
REPLY = "batch bigint, bucket bigint, n bigint, counts binary"
SCORES = "id bigint, n_words bigint, score double, score_others double"


def pack(values: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the greatest needs, by planes; long runs are compressed."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return bytes([width]) + (planes if len(values) < SHORT else zstandard.compress(planes, 3))


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1) if n < SHORT else np.frombuffer(zstandard.decompress(data[1:]), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, : data[0]] = planes.reshape(data[0], n).T
    return out.view("<u8").ravel()


def document_grams(text: str | None) -> list[np.ndarray]:
    """The hashes of the n-grams of each order of a text, from single words on; each n-gram by its last word's place."""
    words = word_hashes(text)
    return [grams(words, n) >> np.uint64(64 - HASH_BITS) for n in range(1, ORDER + 1)]


def batch_grams(texts: list[str | None]) -> tuple[list[list[np.ndarray]], np.ndarray]:
    own = [document_grams(t) for t in texts]
    return own, np.concatenate([x for doc in own for x in doc]) if own else np.zeros(0, np.uint64)


def cuts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where the sorted hashes of each partition begin, and the end: a partition is a range of hashes."""
    edges = [(p << HASH_BITS) // parts for p in range(parts)]
    return np.r_[np.searchsorted(hashes, np.array(edges, np.uint64)), len(hashes)]


def _asker(parts: int):
    def ask(table: pa.Table) -> pa.Table:
        batch = table.column("batch")[0].as_py()
        own, flat = batch_grams(table.column("text").to_pylist())
        hashes, counts = np.unique(flat, return_counts=True)
        at = cuts(hashes, parts)
        rows = [(p, batch, int(at[p + 1] - at[p]), pack(np.diff(hashes[at[p] : at[p + 1]], prepend=np.uint64(0))), pack(counts[at[p] : at[p + 1]])) for p in np.flatnonzero(np.diff(at)).tolist()]
        rows.append((parts, batch, 1, b"", pack(np.array([sum(len(d[0]) for d in own)], np.uint64))))  # the words of the batch
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "batch", "n", "hashes", "counts"])

    return ask


def _counter(parts: int):
    def count(table: pa.Table) -> pa.Table:
        """The counts over all batches of one partition, joined back to the n-grams of each batch in their order."""
        bucket = table.column("bucket")[0].as_py()
        sizes = table.column("n").to_pylist()
        counts = np.concatenate([unpack(c, n) for c, n in zip(table.column("counts").to_pylist(), sizes, strict=True)])
        if bucket == parts:
            replies = [pack(counts.sum(keepdims=True))] * len(sizes)
        else:
            hashes = np.concatenate([np.cumsum(unpack(h, n), dtype=np.uint64) for h, n in zip(table.column("hashes").to_pylist(), sizes, strict=True)])
            distinct, which = np.unique(hashes, return_inverse=True)
            total = np.bincount(which, counts, len(distinct)).astype(np.int64)[which]
            ends = np.cumsum(sizes)
            replies = [pack(total[b - n : b]) for b, n in zip(ends, sizes, strict=True)]
        return pa.Table.from_arrays([table.column("batch"), pa.array([bucket] * len(sizes), pa.int64()), table.column("n"), pa.array(replies, pa.binary())], ["batch", "bucket", "n", "counts"])

    return count


def score_document(counts: list[np.ndarray], all_words: int) -> float:
    """The sum of the logarithms of the scores of a document's words. counts: how often the model has seen the n-grams
    of each order, each by the place of its last word."""
    n = len(counts[0])
    if not n:
        return 0.0
    score = np.maximum(counts[0], 1) / max(all_words, 1) * BACKOFF ** np.minimum(np.arange(n), ORDER - 1)
    for k in range(1, min(ORDER, n)):
        # The context of the n-gram at a place is the n-gram of one word less that ends a place before.
        seen, context = counts[k], counts[k - 1][: n - k]
        shorter = BACKOFF ** np.minimum(np.arange(n - k), ORDER - 1 - k)
        score[k:] = np.where(seen > 0, seen / np.maximum(context, 1) * shorter, score[k:])
    return float(np.log(score).sum())


def without_own(own: list[np.ndarray], totals: list[np.ndarray]) -> list[np.ndarray]:
    """The counts of a document's n-grams over all other documents."""
    rest = []
    for grams_, total in zip(own, totals, strict=True):
        _, which, times = np.unique(grams_, return_inverse=True, return_counts=True)
        rest.append(total - times[which])
    return rest


def _scorer(parts: int):
    def score(docs: pa.Table, replies: pa.Table) -> pa.Table:
        own, flat = batch_grams(docs.column("text").to_pylist())
        distinct, which = np.unique(flat, return_inverse=True)
        order = np.argsort(replies.column("bucket").to_numpy())
        packed, sizes = replies.column("counts").to_pylist(), replies.column("n").to_pylist()
        counts = [unpack(packed[i], sizes[i]).astype(np.int64) for i in order]
        all_words = int(counts.pop()[0])  # the last partition
        total = np.concatenate(counts)[which] if counts else np.zeros(0, np.int64)
        whole, others, at = [], [], 0
        for doc in own:
            mine = []
            for x in doc:
                mine.append(total[at : at + len(x)])
                at += len(x)
            whole.append(score_document(mine, all_words))
            others.append(score_document(without_own(doc, mine), all_words - len(doc[0])))
        return pa.Table.from_arrays([docs.column("id"), pa.array([len(d[0]) for d in own], pa.int64()), pa.array(whole, pa.float64()), pa.array(others, pa.float64())], ["id", "n_words", "score", "score_others"])

    return score


def layout(chars: int) -> tuple[int, int]:
    """How many batches and partitions a text of so many characters makes."""
    growth = min(MOST_GROWTH, max(1.0, (chars / GROWS_FROM) ** 0.25))
    return int(chars // (BATCH_CHARS * growth)) + 1, int(chars // (PART_CHARS * growth)) + 1


def lm_scores(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, score, score_others) for each row: the number of words and the sums of the logarithms of their
    scores, by the counts of the whole table and by those of all other rows."""
    small_batches(df.sparkSession)
    docs = df.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    batches, parts = layout(docs.agg(F.sum(F.char_length("text"))).first()[0] or 0)
    placed = docs.select("id", "text", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches)).alias("batch"))
    asked = placed.groupBy("batch").applyInArrow(_asker(parts), REQUEST)
    replies = asked.groupBy("bucket").applyInArrow(_counter(parts), REPLY)
    return placed.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_scorer(parts), SCORES)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stupid-backoff score of every document under the trigrams of all documents, and of all others."""
    scores = lm_scores(read(spark, sf_dir, "documents").select("doc_id", "text"))
    a_word = lambda c: F.round(F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words")).otherwise(0.0), 6)
    return scores.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.round("score", 4).alias("log_score"),
        a_word("score").alias("log_score_per_word"),
        F.round("score_others", 4).alias("log_score_by_others"),
        a_word("score_others").alias("log_score_by_others_per_word"),
    )


def _sql_score(c: str, n: str) -> str:
    return f"""sum(ln(CASE
      WHEN {c}3 > 0 THEN {c}3 / CAST(greatest(lag_{c}2, 1) AS DOUBLE)
      WHEN {c}2 > 0 THEN {c}2 / CAST(greatest(lag_{c}1, 1) AS DOUBLE) * CASE WHEN i = 2 THEN 1 ELSE {BACKOFF} END
      ELSE greatest({c}1, 1) / CAST(greatest({n}, 1) AS DOUBLE) * CASE WHEN i = 1 THEN 1 WHEN i = 2 THEN {BACKOFF} ELSE {BACKOFF * BACKOFF:.2f} END
    END))"""


OP9_SQL = f"""
WITH w AS MATERIALIZED (
  SELECT doc_id, unnest(ws) AS w3, unnest(range(1, len(ws) + 1)) AS i
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM documents)),
p AS MATERIALIZED (
  SELECT doc_id, i, w3, lag(w3) OVER o AS w2, lag(w3, 2) OVER o AS w1 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c AS MATERIALIZED (
  SELECT doc_id, i, count(*) OVER (PARTITION BY w3) AS c1, count(*) OVER (PARTITION BY w3, doc_id) AS d1,
    CASE WHEN w2 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY w2, w3) END AS c2,
    CASE WHEN w2 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY w2, w3, doc_id) END AS d2,
    CASE WHEN w1 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY w1, w2, w3) END AS c3,
    CASE WHEN w1 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY w1, w2, w3, doc_id) END AS d3,
    count(*) OVER () AS n, count(*) OVER (PARTITION BY doc_id) AS dn FROM p),
r AS (SELECT *, c1 - d1 AS r1, c2 - d2 AS r2, c3 - d3 AS r3 FROM c),
x AS (SELECT *, lag(c1) OVER o AS lag_c1, lag(c2) OVER o AS lag_c2, lag(r1) OVER o AS lag_r1, lag(r2) OVER o AS lag_r2 FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, count(*) AS k, {_sql_score("c", "n")} AS score, {_sql_score("r", "n - dn")} AS others FROM x GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(k, 0) AS BIGINT) AS n_words,
       round(coalesce(score, 0.0), 4) AS log_score, round(coalesce(score / k, 0.0), 6) AS log_score_per_word,
       round(coalesce(others, 0.0), 4) AS log_score_by_others, round(coalesce(others / k, 0.0), 6) AS log_score_by_others_per_word
FROM documents d LEFT JOIN s USING (doc_id)
"""
