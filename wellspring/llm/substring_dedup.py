"""Removal of passages that stand earlier in the corpus, with a count-min sketch as prefilter.

A window is a number of consecutive words of one document. A word is removed if a window that covers
it also starts earlier: in a document with a smaller id, or further ahead in the same one.

1. Tasks count their windows in partial sketches of two rows of cells, which hold 0, 1 or "more".
   Partial sketches travel as the gaps between their filled cells, slice by slice, and are added up.
   A cell never has less than the count of any of its windows.
2. A second pass keeps the windows whose cells say "more" in both rows. No repeated window is lost;
   some single ones stay. Of equal windows in a task only the earliest is sent on, since the others
   are known to be covered. Keys travel in blobs, one for each bucket of keys. Equal windows of all
   tasks meet in a bucket, and all but the earliest are covered as well.
3. Covered windows are gathered by buckets of documents and then by document, and the words under them are left out.

The merged sketch has a bounded size: cells grow with the text up to ``MAX_BITS`` bits of address, and
only the addresses of the cells that say "more" reach the other tasks. Beyond that the sketch holds
back fewer windows, and the second pass groups more of them; results are the same at any size. A
window's key is 96 bits of multilinear hashes, with independent random factors by place, of keyed
digests of its words; a key is sent once by a task and flush at most, however often its window occurs.

Defined results: a null or empty text has no words and stays empty; a null id stands before all others;
rows that share an id are told apart by their texts and ordered by a hash of them, equal rows count as
one document and both keep what it keeps; an empty table gives an empty table; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.words import blocks, marks, numbered

#: Address bits of a sketch row at least and at most, and of the slices in which rows are merged.
MIN_BITS, MAX_BITS, SLICE_BITS = 12, 28, 20
#: Windows that a task counts before it sends a partial sketch, candidates before it sends keys.
SKETCH_WINDOWS, CANDIDATES = 1 << 22, 1 << 20
#: Rows whose texts are copied at a time.
SLICE_ROWS = 1000
#: Words of the corpus to a bucket of keys, all of which one task compares.
BUCKET_WORDS = 1 << 21
_KEY = b"windows"
ROW = "bucket int, ids binary, marks binary, docs binary, starts binary, k1 binary, k2 binary"


def pack(numbers: np.ndarray) -> bytes:
    """Sorted distinct non-negative numbers as gaps of one or two bytes; the greatest value of a
    gap stands for itself and goes on."""
    wide = len(numbers) == 0 or int(numbers[-1]) // len(numbers) > 200
    base, dtype = (65535, np.uint16) if wide else (255, np.uint8)
    gaps = np.diff(numbers.astype(np.int64), prepend=0)
    more = gaps // base
    out = np.full(len(gaps) + int(more.sum()), base, dtype)
    out[np.cumsum(more + 1) - 1] = gaps - more * base
    return bytes([out.itemsize]) + out.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    dtype = np.dtype(np.uint16 if packed[0] == 2 else np.uint8)
    gaps = np.frombuffer(packed, dtype, offset=1)
    return np.cumsum(gaps, dtype=np.int64)[gaps != np.iinfo(dtype).max]


def window_keys(block: list[list[bytes]], window: int) -> tuple[np.ndarray, ...]:
    """``text, start, key1, key2`` of all windows of a block of texts."""
    ids, ends, distinct = numbered(block)
    sizes = np.diff(ends, prepend=0)
    n = len(ids) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    of_word = marks(distinct, _KEY)
    rng = np.random.default_rng(13)
    keys = []
    for row in range(2):
        own = of_word[:, row][ids]
        key = np.zeros(n, np.uint64)
        for k, factor in enumerate(rng.integers(0, 1 << 63, window, np.uint64) * 2 + 1):
            key += own[k : k + n] * np.uint64(factor)
        keys.append(key)
    at = np.flatnonzero(np.arange(n) + window <= np.repeat(ends, sizes)[:n])
    text = np.repeat(np.arange(len(ends)), sizes)[at]
    return text, at - (ends - sizes)[text], keys[0][at], keys[1][at]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with their texts, so that few texts are copied at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            yield part, part.column("text").cast(pa.binary()).to_pylist()


class Sketch:
    """The merged sketch as tasks read it: a bit for every cell that says "more"."""

    def __init__(self, bits: int, slice_bits: int, slices: list[tuple[int, bytes]]):
        self.bits = bits
        self.rows = np.zeros((2, max(1 << bits, 8) // 8), np.uint8)
        for number, cells in slices:
            row, part = divmod(number, 1 << (bits - slice_bits))
            lo = (part << slice_bits) // 8
            if cells[0]:
                own = np.zeros(1 << slice_bits, bool)
                own[unpack(cells)] = True
                bitmap = np.packbits(own)
            else:
                bitmap = np.frombuffer(cells, np.uint8, offset=1)
            self.rows[row, lo : lo + len(bitmap)] = bitmap

    def repeated(self, *keys: np.ndarray) -> np.ndarray:
        """Which windows may occur more than once."""
        out = np.ones(len(keys[0]), bool)
        for row, key in zip(self.rows, keys):
            cell = key >> np.uint64(64 - self.bits)
            bit = np.uint8(128) >> (cell & np.uint64(7)).astype(np.uint8)
            out &= (row[cell >> np.uint64(3)] & bit) != 0
        return out


_SKETCHES: dict[str, Sketch] = {}


def _sketch(shared) -> Sketch:
    """The sketch of a broadcast variable, unpacked once a process."""
    name, *geometry = shared.value
    if name not in _SKETCHES:
        _SKETCHES.clear()
        _SKETCHES[name] = Sketch(*geometry)
    return _SKETCHES[name]


def _partial_sketches(docs: DataFrame, window: int, bits: int) -> DataFrame:
    """``slice, one, more``: filled cells of a slice in a task's sketch, packed."""
    slice_bits = min(SLICE_BITS, bits)

    def rows(keys: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for row in range(2):
            cells = np.concatenate([k[row] for k in keys])
            cells.sort()
            same = cells[1:] == cells[:-1]
            head, twice = np.ones(len(cells), bool), np.zeros(len(cells), bool)
            head[1:] = ~same
            twice[:-1] = same
            twice = twice[head]
            cells = cells[head]
            del same, head
            cuts = (np.arange(1, 1 << (bits - slice_bits)) << slice_bits).astype(np.uint32)
            bounds = [0, *np.searchsorted(cells, cuts).tolist(), len(cells)]
            out = []
            for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
                if lo < hi:
                    own = cells[lo:hi] - np.uint32(k << slice_bits)
                    more = twice[lo:hi]
                    out.append(((row << (bits - slice_bits)) + k, pack(own[~more]), pack(own[more])))
            number, one, more = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), pa.array(one, pa.binary()), pa.array(more, pa.binary())],
                names=["slice", "one", "more"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _SKETCHES.clear()  # of an earlier corpus
        held, total = [], 0
        for _, texts in _slices(batches):
            for block in blocks(texts):
                _, _, *keys = window_keys(block, window)
                held.append([(key >> np.uint64(64 - bits)).astype(np.uint32) for key in keys])
                total += len(keys[0])
                if total >= SKETCH_WINDOWS:
                    yield from rows(held)
                    held, total = [], 0
        if total:
            yield from rows(held)

    return docs.select("text").mapInArrow(count, "slice int, one binary, more binary")


def repeated_cells(docs: DataFrame, window: int, bits: int) -> DataFrame:
    """``slice, cells``: which cells of a slice have a merged count over one, as packed addresses or,
    where that is shorter, as a bitmap."""
    slice_bits = min(SLICE_BITS, bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, counts = -1, np.zeros(1 << slice_bits, np.uint8)

        def row() -> pa.RecordBatch:
            cells, bitmap = pack(np.flatnonzero(counts > 1)), np.packbits(counts > 1).tobytes()
            cells = min(cells, b"\0" + bitmap, key=len)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([cells], pa.binary())],
                names=["slice", "cells"],
            )

        for batch in batches:
            for part, one, more in zip(*(c.to_pylist() for c in batch.columns)):
                if part != number:
                    if number >= 0:
                        yield row()
                    number = part
                    counts[:] = 0
                at = unpack(one)
                counts[at] = np.minimum(counts[at] + 1, 2)
                counts[unpack(more)] = 2
        if number >= 0:
            yield row()

    partial = _partial_sketches(docs, window, bits)
    by_slice = partial.repartition("slice").sortWithinPartitions("slice")
    return by_slice.mapInArrow(merge, "slice int, cells binary")


class Windows:
    """Windows of several documents: ``known, ids, mark`` of the documents (a null id is not known),
    ``doc, start`` and, where they are compared, ``k1, k2`` of the windows."""

    def __init__(self, known, ids, mark, doc, start, k1=None, k2=None):
        self.known, self.ids, self.mark = known, ids, mark
        self.doc, self.start, self.k1, self.k2 = doc, start, k1, k2

    @classmethod
    def joined(cls, parts: list[Windows]) -> Windows:
        first = np.cumsum([0, *(len(p.ids) for p in parts)])
        columns = [[getattr(p, name) for p in parts] for name in ("known", "ids", "mark", "start", "k1", "k2")]
        doc = np.concatenate([p.doc + at for p, at in zip(parts, first)])
        known, ids, mark, start, k1, k2 = (c[0] if c[0] is None else np.concatenate(c) for c in columns)
        return cls(known, ids, mark, doc, start, k1, k2)

    @classmethod
    def unpacked(cls, row: dict) -> Windows:
        ids = np.frombuffer(zlib.decompress(row["ids"]), np.int64)
        mark, known = np.frombuffer(zlib.decompress(row["marks"]), np.int32).reshape(2, -1)
        start = np.frombuffer(zlib.decompress(row["starts"]), np.uint32).astype(np.int64)
        doc = np.frombuffer(zlib.decompress(row["docs"]), np.uint32).astype(np.int64)
        keys = (None, None)
        if row["k1"] is not None:
            keys = np.frombuffer(row["k1"], np.uint64), np.frombuffer(row["k2"], np.uint32)
        return cls(known.astype(bool), ids, mark, doc, start, *keys)

    def packed(self, at: np.ndarray) -> list[bytes | None]:
        """The columns of ``ROW`` after the first, of chosen windows."""
        own, doc = np.unique(self.doc[at], return_inverse=True)
        arrays = (
            self.ids[own],
            np.concatenate([self.mark[own], self.known[own].astype(np.int32)]),
            doc.astype(np.uint32),
            self.start[at].astype(np.uint32),
        )
        keys = (None, None)
        if self.k1 is not None:
            keys = self.k1[at].tobytes(), self.k2[at].tobytes()
        return [*(zlib.compress(x.tobytes(), 1) for x in arrays), *keys]

    def ranks(self) -> np.ndarray:
        """Places of the documents in their order; equal rows have the same."""
        order = np.lexsort((self.mark, self.ids, self.known))
        new = np.zeros(len(order), np.int64)
        for key in (self.mark, self.ids, self.known):
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def compared(self) -> tuple[np.ndarray, np.ndarray]:
        """The earliest windows of all keys, by key, and those that start later than another."""
        place = (self.ranks()[self.doc] << 32) | self.start
        order = np.lexsort((place, self.k2, self.k1))
        head = np.ones(len(order), bool)
        a, b = self.k1[order], self.k2[order]
        head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        place = place[order]
        least = place[np.flatnonzero(head)][np.cumsum(head) - 1]
        return order[head], order[place > least]

    def dealt(self, at: np.ndarray, buckets: int) -> Iterator[tuple]:
        """Rows of ``ROW`` with chosen windows by buckets of documents (numbers below zero)."""
        mixed = (self.ids.view(np.uint64) ^ self.mark.view(np.uint32)) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (((mixed >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket[self.doc[at]], kind="stable")
        own = bucket[self.doc[at]][order]
        numbers, cut = np.unique(own, return_index=True)
        plain = Windows(self.known, self.ids, self.mark, self.doc, self.start)
        for number, chosen in zip(numbers.tolist(), np.split(at[order], cut[1:])):
            yield -1 - number, *plain.packed(chosen)

    def by_document(self) -> pa.RecordBatch:
        """``doc_id, mark, covered`` with the starts of each document as gaps in bytes."""
        rank = self.ranks()
        order = np.lexsort((self.start, rank[self.doc]))
        doc, start = self.doc[order], self.start[order]
        head = np.flatnonzero(np.diff(rank[doc], prepend=-1))
        gaps = np.diff(start, prepend=0)
        gaps[head] = start[head]
        more = gaps // 255
        ends = np.cumsum(more + 1)
        data = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
        data[ends - 1] = gaps - more * 255
        offsets = np.append(0, ends[np.append(head[1:], len(doc)) - 1]) if len(doc) else np.zeros(1)
        covered = pa.Array.from_buffers(
            pa.binary(), len(head), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
        )
        own = doc[head]
        ids = pa.array(self.ids[own], pa.int64(), mask=~self.known[own])
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(self.mark[own]), covered], names=["doc_id", "mark", "covered"]
        )


def covered_starts(covered: bytes) -> np.ndarray:
    gaps = np.frombuffer(covered, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in ROW.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    kinds = [pa.int32() if kind == "int" else pa.binary() for kind in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _candidates(docs: DataFrame, window: int, buckets: int, shared) -> DataFrame:
    """Windows that may be repeated, as ``ROW``: the earliest of equal ones in a task by buckets of
    keys, and the others, known to be covered, by buckets of documents."""

    def rows(parts: list[Windows]) -> pa.RecordBatch:
        found = Windows.joined(parts)
        earliest, later = found.compared()  # sorted by key, and so by bucket
        bucket = ((found.k1[earliest] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        numbers, cut = np.unique(bucket, return_index=True)
        sent = zip(numbers.tolist(), np.split(earliest, cut[1:]))
        return _rows([(k, *found.packed(at)) for k, at in sent] + list(found.dealt(later, buckets)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = _sketch(shared)
        held, total = [], 0
        for batch, texts in _slices(batches):
            at = 0
            for block in blocks(texts):
                text, start, k1, k2 = window_keys(block, window)
                hit = np.flatnonzero(sketch.repeated(k1, k2))
                if len(hit):
                    own, doc = np.unique(text[hit], return_inverse=True)
                    ids = batch.column("doc_id").take(pa.array(own + at))
                    mark = np.asarray(batch.column("mark"))[own + at]
                    k2 = (k2[hit] >> np.uint64(32)).astype(np.uint32)
                    known, ids = np.asarray(ids.is_valid()), np.asarray(ids.fill_null(0))
                    held.append(Windows(known, ids, mark, doc, start[hit], k1[hit], k2))
                    total += len(hit)
                at += len(block)
                if total >= CANDIDATES:
                    yield rows(held)
                    held, total = [], 0
        if total:
            yield rows(held)

    return docs.mapInArrow(find, ROW)


def _covered(candidates: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, mark, covered``: one row for every document with covered windows."""

    def groups(rows: Iterator[dict]) -> Iterator[Windows]:
        """The rows of each bucket as one."""
        now, held = None, []
        for row in rows:
            if row["bucket"] != now and held:
                yield Windows.joined(held)
                held = []
            now = row["bucket"]
            held.append(Windows.unpacked(row))
        if held:
            yield Windows.joined(held)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: list[pa.RecordBatch] = []
        _SKETCHES.clear()  # a worker that looked windows up goes on without the sketch

        def keyed() -> Iterator[dict]:
            for batch in batches:
                passed.append(batch.filter(pc.less(batch.column("bucket"), 0)))
                yield from batch.filter(pc.greater_equal(batch.column("bucket"), 0)).to_pylist()

        held, total = [], 0
        for found in groups(keyed()):
            while passed:
                yield passed.pop()
            _, later = found.compared()
            own, doc = np.unique(found.doc[later], return_inverse=True)
            held.append(Windows(found.known[own], found.ids[own], found.mark[own], doc, found.start[later]))
            total += len(later)
            if total >= CANDIDATES:
                every = Windows.joined(held)
                yield _rows(list(every.dealt(np.arange(total), buckets)))
                held, total = [], 0
        yield from passed
        if total:
            yield _rows(list(Windows.joined(held).dealt(np.arange(total), buckets)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in groups(row for batch in batches for row in batch.to_pylist()):
            yield found.by_document()

    for step, schema in ((compare, ROW), (gather, "doc_id long, mark int, covered binary")):
        dealt = candidates.repartition("bucket").sortWithinPartitions("bucket")
        candidates = dealt.mapInArrow(step, schema)
    return candidates


def remove_repeats(
    docs: DataFrame,
    window: int = 20,
    sketch_bits: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: words left joined by single blanks.

    ``sketch_bits`` are the address bits of a sketch row; by default rows have about four cells for
    every word that the texts may hold, within ``MIN_BITS`` and ``MAX_BITS``.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    narrow = narrow.select("doc_id", F.hash("text").alias("mark"), "text")
    size = narrow.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    if sketch_bits is None:
        sketch_bits = min(max(int(size * 4 / 6).bit_length(), MIN_BITS), MAX_BITS)
    merged = repeated_cells(narrow, window, sketch_bits)
    slices = [(row.slice, bytes(row.cells)) for row in merged.collect()]
    shared = spark.sparkContext.broadcast(
        (uuid.uuid4().hex, sketch_bits, min(SLICE_BITS, sketch_bits), slices)
    )

    buckets = max(size // 6 // BUCKET_WORDS, 1)
    covered = _covered(_candidates(narrow, window, buckets, shared), buckets)
    covered = covered.withColumnsRenamed({"doc_id": "covered_id", "mark": "covered_mark"})
    joined = narrow.join(
        covered,
        F.col("doc_id").eqNullSafe(F.col("covered_id")) & (F.col("mark") == F.col("covered_mark")),
        "left",
    ).select("doc_id", "text", "covered")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _SKETCHES.clear()
        for batch, texts in _slices(batches):
            n_words, n_removed, kept = [], [], []
            for text, packed in zip(texts, batch.column("covered").to_pylist()):
                words = text.split()
                n_words.append(len(words))
                if packed:
                    at = covered_starts(packed)
                    edge = np.bincount(at, minlength=len(words) + 1)
                    edge -= np.bincount(at + window, minlength=len(words) + 1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
