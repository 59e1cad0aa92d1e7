"""Chunks of mel frames as rows: odd lengths against the SQL, and what is worked out for every chunk."""

import re

import duckdb
from pyspark.sql import functions as F

from wavelake import queries as core
from wavelake.operators import geometry as g


def test_patches_without_frames(spark):
    df = spark.createDataFrame([(None,), (-1500,), (0,), (2999,)], "n bigint")
    assert [r[0] for r in df.select(g.chunk_patches(F.col("n"))).collect()] == [None, [], [], [250, 250, 249]]


def test_rows_of_chunks(spark):
    df = spark.createDataFrame([(None,), (-1500,), (3,), (1003,), (1004,), (2500,)], "n bigint")
    got = sorted(tuple(r) for r in g.with_chunks(df, F.col("n")).collect())
    assert got == [(1003, 0, 250, 1.0), (1004, 0, 250, 0.996015936), (1004, 1, 1, 0.003984064), (2500, 0, 250, 0.4), (2500, 1, 250, 0.4), (2500, 2, 125, 0.2)]


def test_odd_keys_give_the_rows_of_the_sql(spark, tmp_path):
    """No parts, parts below zero, tails at their limits, the widest keys of a table of 36 million lines, ties of the ninth digit (totals of 1,024 and 2,048 patches), a row that comes twice."""
    parts = [None, -5_000, -900, -899, -897, -896, -1, 0, 99, 100, 103, 104, 4096 - 900, 8192 - 900, 999_999, 2_200_000, 1_199_999]
    path = str(tmp_path / "lineitem.parquet")
    lines = [(i // 2, 1 + i % 2, k, 0) for i, k in enumerate(parts)]
    spark.createDataFrame([*lines, lines[-1]], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{path}/*.parquet'")
    want = con.sql(core.oracle_sql()["q37_chunk_weights"]).fetchall()
    got = [tuple(r) for r in core.queries()["q37_chunk_weights"](spark, str(tmp_path)).collect()]
    assert len(want) > 5_000 and sorted(got) == sorted(want)


def test_a_chunk_only_chooses_its_weight(spark, data):
    """Nothing is divided, rounded or interpreted for every chunk, and Java compiles the loop (it leaves out methods of over 8,000 bytes)."""
    q = core.queries()["q37_chunk_weights"](spark, data)._jdf.queryExecution()
    plan = q.executedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert not re.search(r"/|round|FLOOR|lambda", above) and "lambda" not in plan
    code = spark._jvm.PythonSQLUtils.explainString(q, "codegen")
    assert code.startswith("Found 1 WholeStageCodegen") and int(re.search(r"maxMethodCodeSize:(\d+)", code)[1]) < 8_000
