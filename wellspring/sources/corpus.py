"""File corpora as DataFrames, one row per file."""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.session import materialize

#: Entries that a task lists before it leaves further folders to the next round.
LISTED = 10_000
#: Files that a task reads.
TASK_FILES = 4096
#: Bytes of contents in a batch (a larger file is alone).
BATCH_BYTES = 4 << 20


def _local_path(uri: str) -> Column:
    """Plain path of a ``file:`` URI, percent escapes decoded; other schemes are kept."""
    plain = F.regexp_replace(uri, r"^file:/+", "/")
    return F.coalesce(F.try_url_decode(F.regexp_replace(plain, r"\+", "%2B")), plain)


def _local_folder(spark: SparkSession, root: str) -> str | None:
    """The plain path of ``root`` if it is a folder of a file system that is mounted locally."""
    if any(c in root for c in "{}[]*?\\"):  # Spark expands these
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    try:
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        folder = store.getUri().getScheme() == "file" and store.getFileStatus(path).isDirectory()
    except Py4JJavaError:  # Spark's reader says what is wrong
        return None
    return store.makeQualified(path).toUri().getPath() if folder else None


def _skipped(name: str) -> bool:
    """Names that Spark's file sources take for hidden or unfinished."""
    return name[0] == "." or (name[0] == "_" and "=" not in name) or name.endswith("._COPYING_")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size`` of the files below a local folder that are not empty, as Spark's file sources
    have them. Tasks list the folders, round by round, so the driver holds no paths."""
    schema = pa.schema([("path", pa.string()), ("size", pa.int64()), ("folder", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            given = batch.column(0).to_pylist()
            left, rows, done = deque(given), [], 0
            while left and (done < len(given) or n < LISTED):
                done += 1
                with os.scandir(left.popleft()) as entries:
                    for entry in entries:
                        if _skipped(entry.name):
                            continue
                        n += 1
                        if entry.is_dir():
                            left.append(entry.path)
                            continue
                        try:
                            size = entry.stat().st_size
                        except FileNotFoundError:  # a link to nothing
                            continue
                        if size:
                            rows.append({"path": entry.path, "size": size, "folder": False})
                        if len(rows) >= LISTED:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
            rows += [{"path": path, "size": 0, "folder": True} for path in left]
            yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files, left = None, spark.range(1).select(F.lit(folder).alias("path"))
    while True:
        listed = materialize(left.mapInArrow(run, "path string, size long, folder boolean"))
        found = listed.where("NOT folder").select("path", "size")
        files = found if files is None else files.unionByName(found)
        left = listed.where("folder").select("path")
        if left.isEmpty():
            return files
        left = left.repartition(tasks, "path")


def _contents(files: DataFrame) -> DataFrame:
    """``path, content`` (binary) of ``files``, in tasks of bounded numbers of files and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, found, size = [], [], 0
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as file:
                    found.append(file.read())
                paths.append(path)
                size += len(found[-1])
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(found)], ["path", "content"])
                    paths, found, size = [], [], 0
            if paths:
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(found)], ["path", "content"])

    spark = files.sparkSession
    conf = spark._jsparkSession.sessionState().conf()
    n, total = files.agg(F.count(F.lit(1)), F.sum("size")).first()
    least = min(n, spark.sparkContext.defaultParallelism)
    tasks = max(1, least, -(-n // TASK_FILES), -(-(total or 0) // conf.filesMaxPartitionBytes()))
    return files.repartition(tasks, "path").mapInArrow(run, "path string, content binary")


def _any_compressed(spark: SparkSession, files: DataFrame) -> bool:
    """Whether there are files that Spark's text source decompresses."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    factory = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory
    codecs = [factory(conf).getCodecByClassName(c.getName()) for c in factory.getCodecClasses(conf)]
    ends = [F.endswith("path", F.lit(c.getDefaultExtension())) for c in codecs]
    return not files.where(F.greatest(F.lit(False), *ends)).isEmpty()


def read_files(
    spark: SparkSession, root: str, charset: str = "UTF-8", glob: str | None = None
) -> DataFrame:
    """``path, content`` of every file below ``root``, decoded with ``charset``.

    Spark's file sources list all files in the driver. Folders that are mounted locally are listed
    and read by tasks instead; other stores and compressed texts are left to the file sources.
    """
    utf8 = charset.upper().replace("-", "") == "UTF8"
    folder = _local_folder(spark, root)
    if folder is not None:
        files = _listed(spark, folder)
        if glob:
            name = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
            files = files.where(F.rlike(F.substring_index("path", "/", -1), F.lit(rf"(?s)^(?:{name})\z")))
        if not (utf8 and _any_compressed(spark, files)):
            content = F.col("content").cast("string") if utf8 else F.decode("content", charset)
            return _contents(files).select("path", content.alias("content"))
    if utf8:
        reader = spark.read.option("recursiveFileLookup", True)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        files = reader.text(root, wholetext=True)
        content = F.col("value")
    else:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        files = reader.load(root)
        content = F.decode("content", charset)
    return files.select(_local_path("_metadata.file_path").alias("path"), content.alias("content"))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` of every file below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(_local_path("path").alias("path"))


def read_flow_exports(spark: SparkSession, root: str) -> DataFrame:
    """``flow_id, json``: flow exports below ``root``, identified by their path."""
    files = read_files(spark, root, glob="*.json")
    return files.select(F.col("path").alias("flow_id"), F.col("content").alias("json"))
