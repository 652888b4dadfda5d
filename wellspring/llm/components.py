"""Connected components of links between 64-bit ids, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.session import materialize


def connected(links: DataFrame) -> DataFrame:
    """``id, root``: every id of ``links`` (columns ``a, b``) with the least id it reaches.

    Each round hangs the larger neighbours of an id, then its smaller ones, below the least id it
    knows. Sizes of what is read halve or better from round to round; links of one id are only
    aggregated and joined, never gathered.
    """
    def oriented(rows: DataFrame) -> DataFrame:
        return rows.where("a != b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct()

    now = materialize(oriented(links))
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(oriented(large))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("b", "m").toDF("a", "b").unionByName(small.select("a", "m").toDF("a", "b"))
        now = materialize(oriented(small))
        found = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = now.select("b").distinct().select(F.col("b").alias("id"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)
