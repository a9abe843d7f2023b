"""Reviews of lines: made from the line itself, whatever its document's id, and by patterns that skip what most texts lack."""

import random
import re

import duckdb
from pyspark.sql import functions as F

from scriptorium.functions import text as tx
from scriptorium.plans import registry

SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\u0085\u00a0\u1680\u2000\u2005\u200a\u2028\u2029\u202f\u205f\u3000"


def test_line_reviews_without_shuffle_for_repeated_and_missing_ids(spark, tmp_path):
    texts = ["Plain english line\nда да да да да\n\nПривет", "Another english line\n" + "ab" * 20, "# Title of five\nx " + "y z " * 5 + "y z"]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[0]), (2, texts[0])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    frame = registry.queries()["line_review_records"](spark, str(tmp_path))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = con.execute(registry.oracle_sql()["line_review_records"])
    names = [c[0] for c in result.description]
    want = sorted(str([r[names.index(c)] for c in frame.columns]) for r in result.fetchall())
    assert sorted(str(list(r)) for r in frame.collect()) == want


def test_odd_space_and_letters_by_plain_patterns(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices("  aбЁёѐЂé\u2019\u2013\u20acz9\u0663#" + SPACES * rng.randint(0, 1), k=rng.randint(0, 30))) for _ in range(600)] + [f"a{s}b" for s in SPACES]
    texts += ["abcd" + "ж" * n + "e" * k for n in range(5) for k in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    c = F.col("text")
    got = df.select("i", tx.normalize_space(c), tx.without_space(c), tx.strip(c), tx.latin_count(c), tx.cyrillic_count(c), tx.digit_count(c), tx.mostly_latin(c), tx.headline_stripped(c)).orderBy("i").collect()
    for t, (_, norm, bare, ends, latin, cyrillic, digits, mostly, headline) in zip(texts, got, strict=True):
        run = f"[ {SPACES}]+"
        plain = re.sub(run, " ", t).strip(" ")
        assert (norm, bare, ends) == (plain, re.sub(run, "", t), re.sub(rf"\A{run}|{run}\Z", "", t))
        a, b = len(re.findall("[A-Za-z]", t)), len(re.findall("[А-Яа-яЁё]", t))
        assert (latin, cyrillic, digits, mostly) == (a, b, len(re.findall(r"\d", t)), a >= 5 and a > b * 1.5)
        assert headline == re.sub(r"\A#{1,6} +", "", plain)
