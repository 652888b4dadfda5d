"""Warehouse catalog sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["owner", "table_name", "column_name", "column_id"]


def jdbc_predicates(owner: str, parts: int) -> list[str]:
    """One WHERE clause per partition; the slices split an owner's tables by hash."""
    name = owner.replace("'", "''")
    if parts == 1:
        return [f"OWNER = '{name}'"]
    return [
        f"OWNER = '{name}' AND ORA_HASH(TABLE_NAME, {parts - 1}) = {i}" for i in range(parts)
    ]


def read_catalog_jdbc(
    spark: SparkSession,
    url: str,
    owner: str,
    properties: dict[str, str],
    table: str = "ALL_TAB_COLUMNS",
    parts: int = 1,
) -> DataFrame:
    """``owner, table_name, column_name, column_id`` of one owner, read in parallel slices."""
    rows = spark.read.jdbc(
        url, table, predicates=jdbc_predicates(owner, parts), properties=properties
    )
    return rows.select(*[F.col(c).alias(c) for c in COLUMNS])


def read_catalog_snapshot(spark: SparkSession, path: str, owner: str | None = None) -> DataFrame:
    """The same rows from a parquet snapshot."""
    rows = spark.read.parquet(path)
    rows = rows.select(*[F.col(c).alias(c) for c in COLUMNS])
    return rows if owner is None else rows.where(F.col("owner") == owner)


def read_field_dictionary(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """``table_name, fields`` from JSON objects ``{table: [fields]}``.

    Either one object per file (pretty-printed or not) or one object per line.
    """
    text = spark.read.text(path, wholetext=whole_file)
    parsed = F.from_json("value", "map<string,array<string>>")
    return text.select(F.explode(parsed).alias("table_name", "fields"))
