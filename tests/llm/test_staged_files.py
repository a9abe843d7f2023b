"""How many files small tables make where many partitions hold them."""

import glob
import random

import pytest

from scriptorium.llm import components, jaccard_join


@pytest.fixture
def spread(spark):
    """Forty partitions for each shuffle, which Spark does not join."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_few_files_and_all_rows(spark, spread, monkeypatch, tmp_path):
    made, staged = [], jaccard_join.staged

    def noted(df, name, *rows):
        out = staged(df, name, *rows)
        made.append((name, len(glob.glob(out.staged_at.removeprefix("file://") + "/part-*")), out.count(), rows))
        return out

    monkeypatch.setattr(jaccard_join, "staged", noted)
    monkeypatch.setattr(components, "staged", noted)
    rng = random.Random(3)
    prose = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    texts = [prose() for _ in range(300)]
    texts += [t + " more" for t in texts[:100]] + texts[100:150] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    kept = jaccard_join.keep_one(docs)
    kept.write.parquet(f"{tmp_path}/kept")
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(300), 450, 451]
    assert len(glob.glob(f"{tmp_path}/kept/part-*")) == 1
    # The tables of links come from few groups; that of sketches has the partitions of the input.
    assert {name for name, *_ in made} >= {"classes", "edges", "parents", "members", "sizes", "within", "result"}
    assert max(files for name, files, *_ in made if name not in ("sketches", "links")) == 1
    assert next(n for name, _, n, _ in made if name == "classes") == 400
    # A table gets more files with its rows, and keeps all of them.
    monkeypatch.setattr("scriptorium.llm.common.FILE_ROWS", 100)
    back = staged(spark.range(1000).repartition(20), "rows", 1000)
    assert len(glob.glob(back.staged_at.removeprefix("file://") + "/part-*")) == 11 and back.count() == back.distinct().count() == 1000
