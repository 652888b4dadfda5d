"""Packing token sequences into windows by best-fit decreasing.

Overlong documents are first cut into full windows. What remains of each document (less than a
window) is packed with the remainders of other documents: longest first, each into the open window
with the least room that still holds it. A segment tree indexed by remaining room finds that
window. Remainders are dealt at random into groups of a fixed mean size, and each group is packed
by one task; in groups of this size windows fill as well as in one group of all documents.

Defined results: a null text counts as empty and yields the end id alone; a null ``doc_id`` is kept;
repeated rows are packed one by one; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.bpe import encoder
from wellspring.session import materialize

WINDOW = 2048
#: Mean number of remainders that one task packs.
GROUP_ROWS = 50_000
#: Sequence ids from here on are full windows, cut from one document.
FULL_WINDOW_IDS = 1 << 62


class RoomTree:
    """Open windows by their remaining room; finds the least room that is large enough."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = self.leaves + room
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Removes a window with the least room of ``length`` or more; ``(room, window)``."""
        any_, node = self.any, self.leaves + length
        if not any_[node]:
            while node > 1 and not (node % 2 == 0 and any_[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if any_[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            any_[node] = 0
            node >>= 1
            while node and not any_[2 * node] and not any_[2 * node + 1]:
                any_[node] = 0
                node >>= 1
        return room, window


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``(window number, offset in it)`` of each item; every length is from 1 to ``window``."""
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = RoomTree(window), 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        found = tree.take(length)
        if found is None:
            found = window, opened
            opened += 1
        room, number[item] = found
        offset[item] = window - room
        if room > length:
            tree.add(room - length, found[1])
    return number, offset


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    window: int = WINDOW,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Documents as pieces of at most ``window`` ids: all full windows, then the remainder.

    Columns ``doc_id, start, length, ids, ids_crc32, doc_tokens``: ``ids`` are little-endian
    unsigned 32-bit numbers (left out unless ``keep_ids``), ``ids_crc32`` their checksum.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            *[("ids", pa.binary())] * keep_ids,
            ("ids_crc32", pa.int64()),
            ("doc_tokens", pa.int64()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            ids, offsets = encode.encode(batch.column(1).to_pylist())
            doc, start, length, blobs, crc, total = [], [], [], [], [], []
            end = np.array([end_id], np.uint32)
            for i, key in enumerate(batch.column(0).to_pylist()):
                own = np.concatenate([ids[offsets[i] : offsets[i + 1]], end]).astype("<u4")
                raw = own.tobytes()
                for at in range(0, len(own), window):
                    blob = raw[4 * at : 4 * (at + window)]
                    doc.append(key)
                    start.append(at)
                    length.append(len(blob) // 4)
                    crc.append(zlib.crc32(blob))
                    total.append(len(own))
                    if keep_ids:
                        blobs.append(blob)
            columns = [doc, start, length, *[blobs] * keep_ids, crc, total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    spark_schema = (
        "doc_id long, start long, length long, "
        + "ids binary, " * keep_ids
        + "ids_crc32 long, doc_tokens long"
    )
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return narrow.mapInArrow(cut, spark_schema)


def pack(pieces: DataFrame, window: int = WINDOW, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, their place in the packed sequences.

    Needs a ``length`` from 1 to ``window``; all other columns are kept. Only lengths travel to
    the packing tasks when rows hold ids; the ids join their places afterwards.
    """
    stored = materialize(pieces.withColumn("piece", F.monotonically_increasing_id()))
    small = stored.drop("ids")
    rest = small.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_rows))
    rest = rest.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    fields = ", ".join(f"`{name}` {kind}" for name, kind in small.dtypes)
    schema = f"{fields}, sequence_id long, offset long"

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece", kind="stable")
        number, offset = best_fit_decreasing(rows["length"].to_numpy(), window)
        rows["sequence_id"], rows["offset"] = (int(key[0]) << 32) + number, offset
        return rows.drop(columns="group")

    packed = rest.groupBy("group").applyInPandas(place, schema)
    full = small.where(F.col("length") == window).select(
        "*",
        (F.lit(FULL_WINDOW_IDS) + F.col("piece")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    placed = packed.unionByName(full)
    if "ids" in stored.columns:
        ids = stored.select("piece", "ids")
        placed = placed.join(ids, "piece")
    return placed.drop("piece")


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids, doc_ids``: whole sequences, made of pieces with their ids."""
    part = F.struct("offset", "length", "doc_id", "ids")
    parts = F.sort_array(F.collect_list(part))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.expr("aggregate(sort_array(collect_list(struct(offset, ids))), CAST('' AS BINARY), "
               "(a, x) -> a || x.ids)").alias("ids"),
        F.transform(parts, lambda p: p["doc_id"]).alias("doc_ids"),
    )
