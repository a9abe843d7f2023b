"""Each query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from scriptorium.plans import registry

SF = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(v):
    return ("nan" if math.isnan(v) else float(f"{v:.9g}")) if isinstance(v, float) else v


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, duck, name):
    rows = registry.queries()[name](spark, SF)
    columns = sorted(rows.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in rows.collect())
    if name not in SQL:
        assert got
        return
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    assert got == sorted(str([plain(r[names.index(c)]) for c in columns]) for r in result.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_import_without_spark():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(__spark_entry__.__file__)).returncode == 0


def test_rest_works_without_corpus_operators(tmp_path):
    """A copy without the subpackage, with and without the pipeline beside it, imports and answers a query."""
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(__spark_entry__.__file__)
    code = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
assert set(e.oracle_sql()) <= set(e.queries()) and not [n for n in e.queries() if n == "pipeline" or n.startswith("op1_")]
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert e.queries()["content_sha256"](spark, "/root/testdata/sf0.001").count() == 50
"""
    for n, also in enumerate(([], ["corpus_pipeline.py"])):
        copy = tmp_path / str(n)
        shutil.copytree(top, copy, ignore=shutil.ignore_patterns("llm", "__pycache__", ".git", *also))
        env = {**os.environ, "PYTHONPATH": str(copy)}
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr[-2000:]


def test_nothing_outside_imports_the_corpus_operators():
    top = os.path.join(os.path.dirname(__spark_entry__.__file__), "scriptorium")
    for folder, _, names in os.walk(top):
        for name in names:
            if name.endswith(".py") and os.path.relpath(folder, top).split(os.sep)[0] != "llm":
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert "scriptorium.llm" not in f.read(), name
