"""Each query of the subpackage over tables of hard cases, and over empty ones."""

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import queries
from scriptorium.llm.common import ARROW_BYTES, small_batches

QUERIES = queries.queries() | {"pipeline": corpus_pipeline.run}
KEY = {"op3": "page_id", "op4": "page_id", "op5": "vec_id"}


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing).collect() == []


@pytest.fixture(scope="module")
def results(spark, edges):
    done = {}

    def get(name):
        if name not in done:
            done[name] = [r.asDict() for r in QUERIES[name](spark, edges).collect()]
        return done[name]

    return get


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op8_decontamination", "pipeline")])
def test_each_row_has_a_result(spark, edges, results, name):
    table = {"op3": "pages", "op4": "pages", "op5": "embeddings"}.get(name.split("_")[0], "documents")
    assert len(results(name)) == spark.read.parquet(f"{edges}/{table}.parquet").count()


def by_id(rows, key="doc_id"):
    return {r[key]: r for r in rows if r[key] is not None}


def test_secret_spans(results):
    rows = by_id(results("op1_secret_scan"))
    assert (rows[14]["n_assign"], rows[14]["n_access"], rows[14]["n_hex"]) == (1, 1, 1)
    assert rows[4]["spans"] == rows[5]["spans"] == ""


def test_encoding_round_trips(results):
    assert all(r["round_trips"] for r in results("op2_bpe"))
    assert by_id(results("op2_bpe"))[4]["n_tokens"] == 0


def test_main_text(results):
    rows = by_id(results("op3_html_extraction"), "page_id")
    assert rows[1]["text"] == "Title\nSome text & more.\nNext."
    assert rows[4]["text"] == rows[5]["text"] == "" and rows[4]["n_chars"] == 0


def test_archives(results):
    rows = by_id(results("op4_warc"), "page_id")
    assert rows[2]["record_type"] == "revisit" and rows[2]["refers_to"] == 3 and rows[3]["record_type"] == "response"
    assert rows[1]["record_type"] == "response" and rows[4]["payload_bytes"] == 0


def test_embeddings(results):
    rows = by_id(results("op5_embedding_dedup"), "vec_id")
    assert rows[2]["n_links"] == 3 and rows[3]["component_id"] == 1 and rows[3]["n_links"] == 3
    assert all(rows[i]["n_links"] == 0 and rows[i]["kept"] for i in (4, 5, 6, 7, 8, 9, 10, 11, 12))


def test_scores(results):
    for name in ("op6_toxicity", "op7_quality"):
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in results(name))


def test_rows_without_an_id_are_in_no_fold(results):
    for name in ("op6_toxicity", "op7_quality"):
        assert [r["held_out"] for r in results(name) if r["doc_id"] is None] == [False]


def test_containment(results):
    found = {(r["doc_id"], r["item_id"]) for r in results("op8_decontamination")}
    assert found == {(12, 1), (12, 5), (12, None), (7, 4), (8, 4)}


def test_language_model(results):
    rows = by_id(results("op9_lm_score"))
    assert rows[4]["n_words"] == rows[5]["n_words"] == 0 and rows[4]["log_score"] == 0
    assert rows[9]["n_words"] == 200_000


def test_classes(results):
    rows = by_id(results("op10_jaccard_join"))
    assert {rows[i]["class_id"] for i in (0, 1, 2, 3)} == {0} and rows[3]["n_links"] == 3 and not rows[2]["kept"]
    assert rows[8]["class_id"] == 7 and rows[8]["n_links"] == 2
    assert all(rows[i]["n_links"] == 0 and rows[i]["kept"] for i in (4, 5, 6, 13))


def test_pipeline(results):
    ids = [r["doc_id"] for r in results("pipeline")]
    assert ids.count(0) == 1 and not {1, 2, 3, 8, 12} & set(ids) and {4, 5, 9, 10, 11, 13, 14} <= set(ids)
    assert None in ids and all(r["round_trips"] for r in results("pipeline"))


def test_shared_folder_has_to_be_named_on_a_cluster(spark):
    from types import SimpleNamespace

    from scriptorium.llm import common

    conf = lambda at: SimpleNamespace(get=lambda k, d: at, set=lambda k, v: None)
    session = lambda master, at: SimpleNamespace(conf=conf(at), sparkContext=SimpleNamespace(master=master))
    for master in ("spark://h:7077", "yarn", "k8s://h", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_dir(session(master, None))
        assert common.shared_dir(session(master, "hdfs:///x/")) == "hdfs:///x"
    assert common.shared_dir(session("local[*]", None)).startswith("file:///")


def test_batches_of_very_long_texts_are_bounded(spark):
    small_batches(spark)

    @F.arrow_udf("bigint")
    def held(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts), pa.int64())

    long = 6 << 20
    texts = spark.range(0, 12, 1, 1).select(F.repeat(F.lit("x"), F.lit(long).cast("int")).alias("text"))
    got = [r[0] for r in texts.select(held("text")).collect()]
    assert len(got) == 12 and max(got) < ARROW_BYTES + long + 4096
