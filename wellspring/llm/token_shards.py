"""Token sequences in training order, in shards of fixed-stride records.

Documents are encoded and cut into sequences of at most ``stride`` ids. Sequences have dense
numbers 0 .. N-1 in input order; a keyed Feistel network permutes them, and walking its cycles
keeps the results below N, so every sequence gets a global slot of its own. Slots are dealt to
shards by range, and a shard holds its records in order of slots, all of one length. The record of
slot ``s`` stands in shard ``s // rows`` at byte ``(s % rows) * record_bytes``, so that a reader
goes on anywhere without an index.

A record: ``doc_id`` (8 bytes), number of the sequence in its document (4), ids in it (4), all
big-endian; then ``stride`` ids of 2 bytes, little-endian, filled up with 0xFF; then a line feed.

Defined results: a null text is empty and has one sequence without ids; a null ``doc_id`` is stored
as the least 64-bit number and read back as null; repeated rows are sequences of their own; an
empty table writes no shard; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm.bpe import encoder
from wellspring.session import work_dir

STRIDE = 256
#: Records in a shard: 32 MB at the stride above.
SHARD_ROWS = 60_000
#: Documents encoded at once.
BLOCK_DOCS = 1000
HEADER = 16
ROUNDS = 4
NULL_ID = -(1 << 63)


def record_bytes(stride: int) -> int:
    return HEADER + 2 * stride + 1


def feistel(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of ``range(n)``, evaluated at ``numbers``."""
    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**64, ROUNDS, np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    x = once(np.asarray(numbers).astype(np.uint64))
    while (outside := np.flatnonzero(x >= n)).size:  # cycle-walking
        x[outside] = once(x[outside])
    return x.astype(np.int64)


def _parts(sizes: np.ndarray, stride: int) -> np.ndarray:
    """Sequences of texts of so many ids; a text without ids has one as well."""
    return np.maximum(-(-sizes // stride), 1)


def _cut(batches: Iterator[pa.RecordBatch], tokenizer: str, stride: int) -> Iterator[tuple]:
    """``task, doc_ids, doc, part, n_tokens, ids`` of blocks of documents; ``ids`` are those of all
    sequences of the block end to end."""
    encode = encoder(tokenizer)
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_DOCS):
            block = batch.slice(at, BLOCK_DOCS)
            ids, offsets = encode.encode(block.column("text").to_pylist())
            if len(ids) and ids.max() >= 0xFFFF:
                raise ValueError("ids of two bytes are too small for this vocabulary")
            sizes = np.diff(offsets)
            parts = _parts(sizes, stride)
            doc = np.repeat(np.arange(len(sizes)), parts)
            part = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            n_tokens = np.minimum(sizes[doc] - part * stride, stride)
            task = block.column("task")[0].as_py()
            yield task, block.column("doc_id"), doc, part, n_tokens, ids.astype("<u2")


@dataclass
class TokenSequences:
    """Documents (``doc_id, text``) cut into runs of at most ``stride`` ids, in the order of the scan."""

    docs: DataFrame
    tokenizer: str
    stride: int

    def _scan(self) -> DataFrame:
        return self.docs.withColumn("task", F.spark_partition_id())

    def rows(self) -> DataFrame:
        """``doc_id, part, n_tokens, ids``."""
        tokenizer, stride = self.tokenizer, self.stride

        def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, doc_ids, doc, part, n_tokens, ids in _cut(batches, tokenizer, stride):
                offsets = np.append(0, np.cumsum(2 * n_tokens)).astype(np.int32)
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
                columns = [
                    doc_ids.take(pa.array(doc)),
                    pa.array(part.astype(np.int32)),
                    pa.array(n_tokens.astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(doc), buffers),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "n_tokens", "ids"])

        return self._scan().mapInArrow(out, "doc_id long, part int, n_tokens int, ids binary")

    def counts(self) -> dict[int, int]:
        """Sequences by task of the scan."""
        tokenizer, stride = self.tokenizer, self.stride

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, task = 0, None
            for batch in batches:
                task = batch.column("task")[0].as_py()
                for at in range(0, batch.num_rows, BLOCK_DOCS):
                    texts = batch.column("text").slice(at, BLOCK_DOCS).to_pylist()
                    total += int(_parts(encoder(tokenizer).count(texts), stride).sum())
            if task is not None:
                yield pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "n": [total]})

        return dict(self._scan().mapInArrow(count, "task int, n long").collect())

    def records(self, key: int, shard_rows: int) -> tuple[DataFrame, int]:
        """``shard, slot, record``, and how many there are.

        Documents are encoded twice, once to count the sequences of each task, one number a task, and
        once to write them: encoding again takes less than a stored copy of all ids takes disk. A
        task that finds another number the second time fails.
        """
        counts = self.counts()
        starts = dict(zip(counts, np.cumsum([0, *counts.values()]).tolist()))
        n, tokenizer, stride = sum(counts.values()), self.tokenizer, self.stride

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done, task = 0, None
            for task, doc_ids, doc, part, n_tokens, ids in _cut(batches, tokenizer, stride):
                numbers = starts[task] + done + np.arange(len(doc))
                done += len(doc)
                slot = feistel(numbers, n, key)
                record = np.full((len(doc), HEADER + 2 * stride), 0xFF, np.uint8)
                doc_id = np.asarray(doc_ids.fill_null(NULL_ID))[doc]
                record[:, :8] = doc_id.astype(">i8")[:, None].view(np.uint8)
                record[:, 8:12] = part.astype(">u4")[:, None].view(np.uint8)
                record[:, 12:16] = n_tokens.astype(">u4")[:, None].view(np.uint8)
                own = np.full((len(doc), stride), 0xFFFF, "<u2")
                own[np.arange(stride) < n_tokens[:, None]] = ids
                record[:, HEADER:] = own.view(np.uint8)
                offsets = (np.arange(len(doc) + 1) * record.shape[1]).astype(np.int32)
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(record)]
                columns = [
                    pa.array(slot // shard_rows),
                    pa.array(slot),
                    pa.Array.from_buffers(pa.binary(), len(doc), buffers),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "slot", "record"])
            if task is not None and done != counts[task]:
                raise RuntimeError("the documents came in another order when read again")

        return self._scan().mapInArrow(place, "shard long, slot long, record binary"), n


def token_sequences(
    docs: DataFrame,
    tokenizer: str,
    stride: int = STRIDE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> TokenSequences:
    """Documents as runs of at most ``stride`` ids. ``docs`` must come in the same order when read
    again, as table scans do."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return TokenSequences(narrow, tokenizer, stride)


def write_shards(
    sequences: TokenSequences,
    key: int = 0,
    stride: int = STRIDE,
    shard_rows: int = SHARD_ROWS,
    path: str | None = None,
) -> str:
    """Writes ``shard=K`` folders of one file each below ``path``, and returns ``path``."""
    if stride != sequences.stride:
        raise ValueError(f"the sequences have a stride of {sequences.stride}")
    rows, n = sequences.records(key, shard_rows)
    path = path or work_dir(rows.sparkSession)
    # the shard is the number of the partition: no sampling, no hashing
    dealt = rows.repartitionById(max(1, -(-n // shard_rows)), F.col("shard").cast("int"))
    ordered = dealt.sortWithinPartitions("shard", "slot")
    record = F.col("record").cast("string").alias("record")
    ordered.select("shard", record).write.partitionBy("shard").option("lineSep", "\n").text(path)
    return path


def read_shards(
    spark: SparkSession, path: str, stride: int = STRIDE, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``slot, shard, row, doc_id, part, n_tokens, ids`` of all records below ``path``. A task holds
    one shard at a time and hands out its records in slices."""
    size = record_bytes(stride)
    schema = pa.schema(
        [(c, pa.int64()) for c in ("slot", "shard", "row", "doc_id", "part", "n_tokens")] + [("ids", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                records = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, size)
                for at in range(0, len(records), 10_000):
                    part = records[at : at + 10_000]
                    number = lambda lo, hi, kind: np.ascontiguousarray(part[:, lo:hi]).view(kind)[:, 0].astype(np.int64)  # noqa: B023, E731
                    doc, n = number(0, 8, ">i8"), number(12, 16, ">u4")
                    row = np.arange(at, at + len(part))
                    ids = [r[HEADER : HEADER + 2 * k].tobytes() for r, k in zip(part, n)]
                    columns = [shard * shard_rows + row, np.full(len(part), shard), row]
                    arrays = [pa.array(c, pa.int64()) for c in columns]
                    arrays += [pa.array(doc, pa.int64(), mask=doc == NULL_ID), pa.array(number(8, 12, ">u4")), pa.array(n), pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    shard = F.regexp_extract("path", r"shard=(\d+)", 1).cast("long")
    return files.select(shard.alias("shard"), "content").mapInArrow(
        cut, "slot long, shard long, row long, doc_id long, part long, n_tokens long, ids binary"
    )
