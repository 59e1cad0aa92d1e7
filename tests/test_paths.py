import pytest
from pyspark.sql import functions as F

from wavelake.functions.paths import below_root, normal, normal_path

SAME = ["audio/fold1/1-2-3-4.wav", "./audio/fold1/1-2-3-4.wav", "/audio\\fold1\\1-2-3-4.wav", " audio/fold1//1-2-3-4.wav\t", "audio/fold1/x/../old/../1%2D2%2D3%2D4.wav", "s3://bucket/data/audio/fold1/1-2-3-4.wav", "C:\\sets\\audio\\fold1\\1-2-3-4.wav"]


def test_spellings(spark):
    df = spark.createDataFrame([(p, "urbansound8k") for p in SAME], "p string, d string")
    assert {r[0] for r in df.select(below_root(normal(F.col("p")), F.col("d"))).collect()} == {SAME[0]}


@pytest.mark.parametrize("given,want", [("wav/No\u0308rd 3/a.wav", "wav/N\u00f6rd 3/a.wav"), ("wav/N%C3%B6rd 3/a.wav", "wav/N\u00f6rd 3/a.wav"), (None, None), ("  ", None), ("../..", None), ("x+y/100%.wav", "x+y/100%.wav")])
def test_unicode_and_nothing(given, want):
    assert normal_path(given) == want


def test_columns_equal_the_function(spark):
    paths = [*SAME, None, "", " a b/c.wav ", "a/.hidden", "a./b", "a//b", "a\n", "x/y z/1.2.3.wav", "wav/N%C3%B6rd 3/a.wav", "..", "a/../b.wav"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    assert [r[0] for r in df.select(normal(F.col("p")), "i").orderBy("i").collect()] == [normal_path(p) for p in paths]
