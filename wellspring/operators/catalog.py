"""Warehouse catalog: ordered column lists per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def catalog_fields(columns: DataFrame) -> DataFrame:
    """``table_name, fields``: column names in column order, from owner/table/column rows."""
    cells = F.sort_array(F.collect_list(F.struct("column_id", "column_name")))
    return (
        columns.groupBy(F.concat_ws(".", "owner", "table_name").alias("table_name"))
        .agg(cells.alias("cells"))
        .select("table_name", F.col("cells.column_name").alias("fields"))
    )
