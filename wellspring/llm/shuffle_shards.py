"""Shuffled shards by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets by a seeded hash of their place in the input
(not of their content, so copies and repeated ids spread like all other rows); buckets are small
enough for memory. Pass two gives each bucket a Fisher-Yates shuffle. Buckets laid end to end are
a random order of all records, and that order is cut into shards whose row counts differ by one
at most.

Defined results: a null text has no bytes (size 1, checksum 0); null ids and repeated rows are
records like others; other columns travel along; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.session import materialize, work_dir

SHARDS = 16
#: Mean bytes of text in a bucket, which one task holds.
BUCKET_BYTES = 8 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of ``range(n)``: every place swaps with one not behind it."""
    order = np.arange(n)
    picks = rng.integers(0, np.arange(1, n + 1)) if n else order
    for i in range(n - 1, 0, -1):
        k = picks[i]
        order[i], order[k] = order[k], order[i]
    return order


def scatter(docs: DataFrame, seed: int, buckets: int) -> DataFrame:
    """``docs`` with the seeded ``mix`` of each row's place, and its ``bucket``."""
    place = F.monotonically_increasing_id()
    rows = docs.withColumn("mix", F.xxhash64(F.lit(seed).cast("long"), place))
    return rows.withColumn("bucket", F.pmod("mix", F.lit(buckets)))


def shuffle_buckets(rows: DataFrame, seed: int) -> DataFrame:
    """Rows of each ``bucket`` in Fisher-Yates order, numbered by ``position``."""
    fields = ", ".join(f"`{name}` {kind}" for name, kind in rows.drop("mix").dtypes)

    def shuffled(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        # arrival order depends on the cluster; the seeded hash does not
        own = own.sort_values("mix", kind="stable").drop(columns="mix")
        order = fisher_yates(len(own), np.random.default_rng([seed, int(key[0])]))
        own = own.iloc[order]
        own["position"] = np.arange(len(own))
        return own

    return rows.groupBy("bucket").applyInPandas(shuffled, f"{fields}, position long")


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All records with ``size``, ``text_crc32``, ``shard`` and gapless ``slot`` in it."""
    text = F.col(text_col)
    records = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    total = records.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    stored = materialize(shuffle_buckets(scatter(records, seed, buckets), seed))
    counts = stored.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row a bucket
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    rows = stored.count()
    base, more = divmod(rows, shards)
    at = F.col("start") + F.col("position")
    wide = more * (base + 1)
    number = F.when(at < wide, F.floor(at / (base + 1))).otherwise(
        more + F.floor((at - wide) / max(base, 1))
    )
    slot = F.when(at < wide, at % (base + 1)).otherwise((at - wide) % max(base, 1))
    placed = stored.join(starts, "bucket").withColumns(
        {"shard": number.cast("int"), "slot": slot.cast("long")}
    )
    return placed.drop("bucket", "position", "start")


def write_shards(sharded: DataFrame, path: str | None = None) -> str:
    """One folder a shard, one file in it, records in order of their slots."""
    path = path or work_dir(sharded.sparkSession)
    shards = sharded.select(F.max("shard")).first()[0]
    ordered = sharded.repartitionByRange(1 + (shards or 0), "shard").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
    return path
