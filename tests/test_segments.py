import math

import pytest
from pyspark.sql import functions as F

from wavelake.operators.segments import empty_regions, plan_segments

INF = math.inf
CASES = [
    ((0, INF, 20, 10, 10, 0), [(0, 10), (10, 10)]),
    ((0, INF, 25, 10, 10, 0), [(0, 10), (10, 10), (20, 5)]),
    ((0, INF, 20.5, 10, 10, 1), [(0, 10), (10, 10)]),
    ((0, INF, 0.5, 10, 10, 1), [(0, 0.5)]),
    ((20, 40, 20.5, 10, 10, 1), [(20, 0.5)]),
    ((0, INF, 5, 10, 10, 0), [(0, 5)]),
    ((0, INF, 5, 10, 2, 0), [(0, 5), (2, 3), (4, 1)]),
    ((20, 40, 100, 10, 10, 0), [(20, 10), (30, 10)]),
    ((20, 40, 25, 10, 10, 0), [(20, 5)]),
    ((30, 40, 25, 10, 10, 0), []),
    ((0, INF, 30, 10, 10, 10), [(0, 10)]),
]


def plan(spark, start, end, duration, seg, hop, tol):
    df = spark.createDataFrame([(float(start), float(end), float(duration))], "s double, e double, d double")
    rows = plan_segments(df, F.col("s"), F.col("e"), F.col("d"), seg, hop, tol).orderBy("segment_id").collect()
    assert [r["segment_id"] for r in rows] == list(range(len(rows)))
    return [(r["seg_start"], r["valid_sec"]) for r in rows]


@pytest.mark.parametrize("given,expected", CASES)
def test_plan(spark, given, expected):
    assert plan(spark, *given) == expected


def test_settings_are_checked(spark):
    with pytest.raises(ValueError):
        plan(spark, 0, 1, 1, 10, 0, 0)


def test_bounds_that_are_no_numbers_give_nothing(spark):
    rows = [(None, 1.0, 2.0), (math.nan, 1.0, 2.0), (0.0, math.nan, 2.0), (0.0, INF, INF), (5.0, INF, 2.0)]
    df = spark.createDataFrame(rows, "s double, e double, d double")
    assert plan_segments(df, F.col("s"), F.col("e"), F.col("d"), 1, 1).count() == 0
    assert empty_regions(df, F.col("s"), F.col("e"), F.col("d")).count() == 4  # a recording without end is not empty
