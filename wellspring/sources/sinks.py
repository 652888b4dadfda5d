"""Where lineage results go. Every writer is a distributed Spark write."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.operators.flows import parse_flows


def write_lineage(rows: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Distinct rows as parquet or CSV; list columns become comma-separated text in CSV."""
    rows = rows.dropDuplicates()
    if fmt == "csv":
        lists = {name for name, kind in rows.dtypes if kind == "array<string>"}
        rows = rows.select(
            *[F.array_join(c, ", ").alias(c) if c in lists else F.col(c) for c in rows.columns]
        )
        rows.write.mode(mode).csv(path, header=True)
    elif fmt == "parquet":
        rows.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_field_dictionary(catalog: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``{table: [fields]}`` JSON objects, one per line."""
    entry = F.to_json(F.create_map("table_name", "fields"))
    catalog.select(entry.alias("value")).write.mode(mode).text(path)


def write_paths(files: DataFrame, path: str, mode: str = "errorifexists") -> None:
    files.select("path").write.mode(mode).text(path)


def write_files(files: DataFrame, root: str) -> int:
    """``path, content`` (binary) as one file each, at ``path`` below ``root``; how many there are.

    Spark's writers make a folder a file if each row is to have its own, and on a local file system
    start processes for its permissions. Here tasks write the files themselves, in any store that
    pyarrow reaches. Paths must be distinct; a task that runs again writes the same files.
    """
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        made = set()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                full = posixpath.join(base, path)
                folder = posixpath.dirname(full)
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(full, compression=None) as out:
                    out.write(content or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    written = files.select("path", "content").mapInArrow(run, "n long")
    return written.agg(F.sum("n")).first()[0] or 0


def write_flow_json(flows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Flow exports as JSON lines, keys in order; malformed exports are left out."""
    parse_flows(flows).select(F.to_json("doc").alias("value")).write.mode(mode).text(path)


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """``number, folder, columns`` of the committed writes below ``path``."""
    try:
        return spark.read.json(f"{path}/manifest", schema="number long, folder string, columns string")
    except AnalysisException:  # nothing was committed yet
        return None


def replace_rows(rows: DataFrame, path: str, key: str) -> None:
    """Writes rows so that those of the same keys that stood below ``path`` are replaced by them.

    Each write has a folder of its own for its rows and one for its keys. The manifest entry that
    makes them count is written last, as one file: a job that is killed before leaves the old rows, and
    a rerun replaces what an earlier run wrote. An entry's number can be given once only, so of two
    writers at a time one fails. Keys whose rows are gone stay as they are; to empty a key, write its
    rows anew under another sink.
    """
    spark = rows.sparkSession
    done = _manifest(spark, path)
    number = 1 + ((done.agg(F.max("number")).first()[0] or 0) if done is not None else 0)
    folder = f"{path}/rows/{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder)
    stored.select(F.col(key).alias("key")).distinct().write.parquet(f"{folder}-keys")
    entry = spark.range(1).select(
        F.lit(number).alias("number"),
        F.lit(folder).alias("folder"),
        F.lit(key).alias("columns"),
    )
    entry.coalesce(1).write.json(f"{path}/manifest/entry={number}")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows below ``path``: for every key those of the last committed write that has it."""
    done = _manifest(spark, path)
    if done is None:
        raise ValueError(f"nothing was written to {path}")
    writes = [(r.number, r.folder, r.columns) for r in done.orderBy("number").collect()]
    key = writes[-1][2]
    newest = None
    for number, folder, _ in writes:
        keys = spark.read.parquet(f"{folder}-keys").withColumn("number", F.lit(number))
        newest = keys if newest is None else newest.unionByName(keys)
    newest = newest.groupBy("key").agg(F.max("number").alias("number"))
    found = None
    for number, folder, _ in writes:
        rows = spark.read.parquet(folder).withColumn("number", F.lit(number))
        found = rows if found is None else found.unionByName(rows)
    valid = newest.select(F.col("key").alias("valid_key"), F.col("number").alias("valid_number"))
    return found.join(
        valid,
        F.col(key).eqNullSafe(F.col("valid_key")) & (F.col("number") == F.col("valid_number")),
        "left_semi",
    ).drop("number")
