"""A key that holds a third of the rows is split, whichever side it is on."""

import pytest
from pyspark.sql import functions as F

from wellspring.operators.joins import left_join

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_left_join_splits_a_hot_key(spark, hot_side):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    try:
        hot = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
            F.md5(F.col("id").cast("string")).alias("v"),
        )
        flat = spark.range(0, 1000, 1, 4).select(F.col("id").alias("k"), F.lit("x").alias("w"))
        left, right = (hot, flat) if hot_side == "left" else (flat, hot)
        joined = left_join(left, right, "k")
        expected = left.join(right, "k", "left").count()
        assert len(joined.collect()) == expected
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
