from random import Random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelattice.operators.ranking import rank_within


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_equals_a_window(spark, rows, parts):
    rng = Random(parts)
    data = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, 1, 1, 1, 2, 3, rng.randrange(50)]), i % 40) for i in range(600)]
    data += [("one", 5, 0), ("ties", 1, 0), ("ties", 1, 0), ("none", None, 1), ("none", None, 2)]
    df = spark.createDataFrame(data, "g string, v int, item int")
    want = df.withColumn("rn", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())).cast("bigint"))
    assert rows(rank_within(df, "g", "v", parts=parts)) == rows(want)


def test_a_hot_group_lies_in_many_parts(spark):
    df = spark.range(20_000).select(F.lit("x").alias("g"), (F.col("id") % 3).alias("v"), "id")
    ranked = rank_within(df, "g", "v", parts=16)
    assert {tuple(r) for r in ranked.groupBy("v").agg(F.min("rn"), F.max("rn")).collect()} == {(2, 1, 1), (1, 6667, 6667), (0, 13334, 13334)}
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(_group" in plan and "windowspecdefinition(_part" in plan


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert rank_within(df, "g", "v").collect() == []
