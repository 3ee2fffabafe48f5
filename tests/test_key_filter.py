"""The filter of wanted keys: none lost, few others, whatever their number."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.key_filter import narrowed, with_chance


@pytest.mark.parametrize("n", [0, 1, 1000, 1_500_000])
def test_wanted_rows_pass_and_few_others(spark, n):
    rows = spark.range(max(20_000, 2 * n), numPartitions=8).select(F.col("id").alias("k"), F.lit("x").alias("__x"))
    wanted = spark.range(n).select((F.col("id") * 2).alias("w"))
    got = narrowed(rows, F.col("k"), wanted, F.col("w"))
    assert got.columns == rows.columns
    passed = got.agg(F.count_if((F.col("k") % 2 == 0) & (F.col("k") < 2 * n)), F.count(F.lit(1))).first()
    others = rows.count() - n
    assert passed[0] == n and passed[1] - n <= 0.05 * others


def test_null_keys_repeats_and_a_filter_too_large(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), ("b", 4)], "k string, n int")
    wanted = spark.createDataFrame([(None,), ("b",), ("b",)], "w string")
    assert {r.n: r["__maybe"] for r in with_chance(rows, F.col("k"), wanted, F.col("w")).collect()} == {1: True, 2: False, 3: True, 4: True}
    assert narrowed(rows, F.col("k"), wanted, F.col("w"), most_bytes=0).count() == 4
