"""The wide dependency report as CSV: ``;``, ISO-8859-1, all strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions import text as X

CHARSET = "ISO-8859-1"


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report with stripped cells, empty ones NULL, and ``row_id`` in file order."""
    rows = spark.read.csv(path, sep=";", header=True, encoding=CHARSET)
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return clean_cells(rows.withColumn("row_id", order))


def clean_cells(report: DataFrame) -> DataFrame:
    """Text cells stripped, empty ones NULL."""
    return report.select(
        *[
            X.blank_to_null(X.strip(F.col(f"`{c}`"))).alias(c) if kind == "string" else F.col(c)
            for c, kind in report.dtypes
        ]
    )


def write_report_csv(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    report.write.mode(mode).csv(path, sep=";", header=True, encoding=CHARSET)
