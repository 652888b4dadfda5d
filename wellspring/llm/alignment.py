"""Alignment of two tokenizers, scored over the corpus by inverted pair bitmaps.

Both tokenizers encode a blank and the text. Where tokens of both end at the same byte, a group ends;
an A token and a B token are linked if their bytes overlap. The count of a pair of ids is the number of
documents that hold it linked.

1. A task encodes its documents in chunks. A chunk inverts its links: for every pair of ids the bitmap
   of its documents, as gaps between ordinals within the chunk, and planes with the bits of how often each
   document has the link. Bitmaps of all texts of a chunk are OR-merged before they leave the task.
   Pairs are dealt to slices by their A id; a slice of a chunk is one row of compressed columns.
2. Popcounts of the bitmaps, one number a pair and chunk, are added up by slice. Chunks have different
   documents, so their merged bitmap has the sum of their popcounts. As a slice has all pairs of an A id,
   the greatest count of each A id is known there too.
3. Postings meet the scores of their slice and give every document of their bitmaps the score of the pair,
   times its links. Tasks add up by document before anything is sent on.

What a task holds is bounded: links of a chunk, scores of a slice (at most the vocabularies' product over
``SLICES``), sums of a group of chunks. Slices are dealt out anew for every group of chunks, so the most
frequent token of the corpus does not end in one task.

Defined results: a null, empty or not losslessly encoded text has no tokens, zero counts and an empty
``groups``; a null id is kept; repeated rows give repeated rows, each of which counts as a document; an
empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.bpe import PieceTable, encoder, joined_values
from wellspring.session import materialize

#: Slices of the pairs, links and documents of a chunk, bytes of texts encoded at once, and chunks
#: whose sums a task holds.
SLICES, CHUNK_LINKS, CHUNK_DOCS, BLOCK_BYTES, GROUP_CHUNKS = 128, 1 << 22, 1 << 15, 1 << 20, 256
#: Bits of a B id in a pair, and of an ordinal.
B_BITS, DOC_BITS = 20, 16
_LOSSY = np.uint32(1 << 31)
_MIX = np.uint64(0x9E3779B97F4A7C15)

TOKENS = (
    "chunk long, slice int, doc_id long, ordinal int, n_a long, n_b long, n_groups long, "
    "n_links long, groups_sha256 string, pairs binary, n_docs binary, docs binary, planes binary"
)


def unit_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """A unit is a run of blanks with what follows up to the next blank."""
    blank = points == 32
    starts = blank.copy()
    starts[1:] &= ~blank[:-1]
    starts[text_starts] = True
    return np.flatnonzero(starts)


class UnitEncoder:
    """Ids of texts that begin with a blank, as a sentence-piece model gives them for what follows it.

    No piece goes on after a blank that stands behind another character, so units are encoded by
    themselves. Ids of units whose pieces do not spell the unit are marked with the highest bit.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any("▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError(f"{path}: pieces go on after a blank")
        self.blank = self.model.piece_to_id("▁")
        self.bytes = [
            bytes([int(piece[3:5], 16)])
            if self.model.is_byte(i)
            else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.width = np.array([len(b) for b in self.bytes])
        self.table = PieceTable([], self._resolve, np.uint32, unit_starts, r"(?<=[^ ]) ")

    def _resolve(self, units: list[str]) -> list:
        out = []
        for unit, ids in zip(units, self.model.encode([u[1:] for u in units], num_threads=1)):
            ids = np.array(ids if unit != " " else [self.blank], np.uint32)
            spelt = b"".join([self.bytes[i] for i in ids.tolist()])
            out.append(ids if spelt == unit.encode() else ids | _LOSSY)
        return out


_UNIT_ENCODERS: dict[str, UnitEncoder] = {}


def unit_encoder(path: str) -> UnitEncoder:
    if path not in _UNIT_ENCODERS:
        _UNIT_ENCODERS[path] = UnitEncoder(path)
    return _UNIT_ENCODERS[path]


_DECIMALS: list[np.ndarray] = []


def _decimals(n: int) -> list[np.ndarray]:
    """Decimal digits of the numbers below ``n``, padded, and how many digits each has."""
    if not _DECIMALS or len(_DECIMALS[1]) < n:
        texts = [str(i).encode() for i in range(1 << (n - 1).bit_length())]
        padded = b"".join([t.ljust(8) for t in texts])
        _DECIMALS[:] = [
            np.frombuffer(padded, np.uint8).reshape(-1, 8),
            np.array([len(t) for t in texts]),
        ]
    return _DECIMALS


class Aligned:
    """Tokens of both kinds of several texts end to end, with their groups and links."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray):
        """``a_ends`` and ``b_ends`` are byte offsets; every text ends in both."""
        self.a, self.b = a, b
        at = np.minimum(np.searchsorted(b_ends, a_ends), max(len(b_ends) - 1, 0))
        self.a_shared = b_ends[at] == a_ends if len(b_ends) else np.zeros(len(a_ends), bool)
        self.b_shared = np.zeros(len(b_ends), bool)
        self.b_shared[at[self.a_shared]] = True
        # every distinct end closes the link of the two tokens that hold the byte before it
        self.ends = np.sort(np.concatenate([a_ends, b_ends[~self.b_shared]]), kind="stable")
        self.link_a = np.searchsorted(a_ends, self.ends)
        self.link_b = np.searchsorted(b_ends, self.ends)
        self.group_ends = a_ends[self.a_shared]

    def texts(self, last: np.ndarray) -> Iterator[bytes]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``; ``last`` is the number of groups up to
        each text's end."""
        a_group = np.cumsum(self.a_shared) - self.a_shared
        b_group = np.cumsum(self.b_shared) - self.b_shared
        n = len(self.group_ends)
        a_count, b_count = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        sign = np.empty(len(ids), np.uint8)
        at = np.arange(len(self.a)) + (np.cumsum(b_count) - b_count)[a_group]
        ids[at], sign[at] = self.a, np.where(self.a_shared, ord("|"), ord(","))
        at = np.arange(len(self.b)) + np.cumsum(a_count)[b_group]
        ids[at], sign[at] = self.b, np.where(self.b_shared, ord(";"), ord(","))
        table, widths = _decimals(int(ids.max(initial=0)) + 1)
        digits, width = table[ids], widths[ids]
        digits[np.arange(len(ids)), width] = sign
        text = digits[np.arange(8) <= width[:, None]].tobytes()
        ends = np.cumsum(width + 1)
        tokens = np.append(0, np.cumsum(a_count + b_count))[last]
        begin = 0
        for end in np.append(0, ends)[tokens].tolist():
            yield text[begin : max(end - 1, begin)]
            begin = end


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def _unpack(packed: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype)


def pack_gaps(gaps: np.ndarray) -> bytes:
    """Gaps in bytes; 255 stands for itself and goes on."""
    more = gaps // 255
    out = np.full(len(gaps) + int(more.sum()), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = gaps - more * 255
    return _pack(out)


def unpack_gaps(packed: bytes) -> np.ndarray:
    """Running sums of gaps."""
    gaps = _unpack(packed, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps != 255]


def invert(keys: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """``slice, pairs, n_docs, docs, planes`` of the links of a chunk.

    ``keys`` are links as pair and document ordinal in one number. ``docs`` has the ordinals of each
    pair's documents, as gaps; ``planes`` the bits of the links over one, lowest plane first.
    """
    pair = keys >> DOC_BITS
    part = ((pair >> B_BITS).astype(np.uint64) * _MIX >> np.uint64(64 - 7)).astype(np.int64)
    keys = np.sort(part << (63 - 7) | keys)
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    links = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    part, keys = keys >> (63 - 7), keys & ((1 << (63 - 7)) - 1)
    bounds = np.searchsorted(part, np.arange(SLICES + 1))
    for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if lo == hi:
            continue
        pair, ordinal = keys[lo:hi] >> DOC_BITS, keys[lo:hi] & ((1 << DOC_BITS) - 1)
        head = np.flatnonzero(np.diff(pair, prepend=-1))
        gaps = np.diff(ordinal, prepend=0)
        gaps[head] = ordinal[head]
        over = links[lo:hi] - 1
        planes = [np.packbits((over >> bit) & 1 == 1) for bit in range(int(over.max()).bit_length())]
        n_docs = np.diff(np.append(head, hi - lo)).astype(np.uint16)
        pairs = np.diff(pair[head], prepend=0)
        yield k, _pack(pairs), _pack(n_docs), pack_gaps(gaps), _pack(np.array(planes, np.uint8))


def postings(n_docs: np.ndarray, docs: bytes, planes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ordinals and links of the postings of several pairs."""
    sums = unpack_gaps(docs)
    head = np.cumsum(n_docs) - n_docs
    before = np.where(head > 0, sums[head - 1], 0)
    links = np.ones(len(sums), np.int64)
    bits = _unpack(planes, np.uint8)
    if len(bits):
        for k, plane in enumerate(bits.reshape(-1, -(-len(sums) // 8))):
            links += np.unpackbits(plane, count=len(sums)).astype(np.int64) << k
    return sums - np.repeat(before, n_docs), links


def token_table(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents (``slice`` is -1) and the inverted links of their chunks, ``TOKENS`` as columns."""

    def batch_of(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        arrays = []
        for field in schema:
            column = columns.get(field.name)
            arrays.append(pa.nulls(n, field.type) if column is None else pa.array(column, field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    schema = pa.schema(
        [(name, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[kind])
         for name, kind in (column.split() for column in TOKENS.split(", "))]
    )

    def block(ids: pa.Array, texts: list[str], chunk: int, first: int):
        """Rows of documents and link keys of a block of texts."""
        a_encoder, b_encoder = encoder(a_path, plain=True), unit_encoder(b_path)
        spaced = [" " + text if text else "" for text in texts]
        a, a_cuts = a_encoder.encode(spaced)
        b, b_cuts = joined_values(b_encoder.table, spaced)
        lossy = np.append(0, np.cumsum(b >= _LOSSY))[b_cuts]
        good = lossy[1:] == lossy[:-1]
        a_sizes, b_sizes = np.diff(a_cuts), np.diff(b_cuts)
        a = a[np.repeat(good, a_sizes)].astype(np.int64)
        b = b[np.repeat(good, b_sizes)].astype(np.int64)
        a_sizes, b_sizes = a_sizes * good, b_sizes * good
        a_ends, b_ends = np.cumsum(a_encoder.width[a]), np.cumsum(b_encoder.width[b])
        found = Aligned(a, b, a_ends, b_ends)
        text_ends = np.append(0, a_ends)[np.cumsum(a_sizes)]
        groups = np.searchsorted(found.group_ends, text_ends, "right")
        links = np.searchsorted(found.ends, text_ends, "right")
        hashes = [
            hashlib.sha256(text).hexdigest() if text else "" for text in found.texts(groups)
        ]
        n = len(texts)
        columns = {
            "chunk": np.full(n, chunk),
            "slice": np.full(n, -1),
            "doc_id": ids,
            "ordinal": np.arange(first, first + n),
            "n_a": a_sizes,
            "n_b": b_sizes,
            "n_groups": np.diff(groups, prepend=0),
            "n_links": np.diff(links, prepend=0),
            "groups_sha256": hashes,
        }
        pair = a[found.link_a] << B_BITS | b[found.link_b]
        ordinal = np.repeat(columns["ordinal"], columns["n_links"])
        return batch_of(columns, n), pair << DOC_BITS | ordinal

    def invert_chunk(keys: list[np.ndarray], chunk: int) -> Iterator[pa.RecordBatch]:
        rows = list(invert(np.concatenate(keys)))
        if rows:
            names = ("slice", "pairs", "n_docs", "docs", "planes")
            columns = dict(zip(names, zip(*rows)))
            yield batch_of(columns | {"chunk": np.full(len(rows), chunk)}, len(rows))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, ordinal, held, total = None, 0, [], 0
        for batch in batches:
            if chunk is None:
                chunk = batch.column("part")[0].as_py() << 32
            texts = batch.column("text").to_pylist()
            sizes = np.cumsum([len(t) for t in texts]) // BLOCK_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
            for lo, hi in zip(cuts, cuts[1:]):
                if total >= CHUNK_LINKS or ordinal + hi - lo > CHUNK_DOCS:
                    yield from invert_chunk(held, chunk)
                    chunk, ordinal, held, total = chunk + 1, 0, [], 0
                rows, keys = block(batch.column("doc_id").slice(lo, hi - lo), texts[lo:hi], chunk, ordinal)
                yield rows
                held.append(keys)
                ordinal, total = ordinal + hi - lo, total + len(keys)
        if held:
            yield from invert_chunk(held, chunk)

    narrow = docs.select(
        F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().alias("part")
    )
    return narrow.mapInArrow(encode, TOKENS)


def _added_up(rows: DataFrame, keys: list[str], dtype: type) -> DataFrame:
    """``keys, pairs, counts``: counts of pairs (numbers of ``dtype``) added up by ``keys``."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def fold() -> None:
            pairs = np.concatenate([p for p, _ in held])
            counts = np.concatenate([c for _, c in held])
            order = np.argsort(pairs, kind="stable")
            pairs = pairs[order]
            head = np.flatnonzero(np.diff(pairs, prepend=-1))
            held[:] = [(pairs[head], np.add.reduceat(counts[order], head))]

        def row() -> pa.RecordBatch:
            fold()
            pairs, counts = held.pop()
            cells = [*now, _pack(np.diff(pairs, prepend=0)), _pack(counts)]
            arrays = [pa.array([cell], kind) for cell, kind in zip(cells, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for *key, pairs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if held:
                        yield row()
                    now = key
                held.append((np.cumsum(_unpack(pairs, np.int64)), _unpack(counts, dtype).astype(np.int64)))
                if sum(len(p) for p, _ in held[1:]) > max(len(held[0][0]), 1 << 18):
                    fold()
        if held:
            yield row()

    names = [*keys, "pairs", "counts"]
    kinds = [pa.int32()] * len(keys) + [pa.binary()] * 2
    dealt = rows.select(*names).repartition(*keys).sortWithinPartitions(*keys)
    schema = "".join(f"{k} int, " for k in keys) + "pairs binary, counts binary"
    return dealt.mapInArrow(merge, schema)


class Sums:
    """``n_best`` and ``count_sum`` of the documents of several chunks."""

    SCHEMA = "chunk long, ordinals binary, n_best binary, count_sum binary"

    def __init__(self):
        self.of_chunk: dict[int, np.ndarray] = {}
        self.size = 0

    def add(self, chunk: int, ordinals: np.ndarray, *columns: np.ndarray) -> None:
        """``columns`` by ordinal, of all those up to the greatest."""
        own = self.of_chunk.get(chunk, np.zeros((2, 0), np.int64))
        n = int(ordinals[-1]) + 1
        if own.shape[1] < n:
            self.size += n - own.shape[1]
            own = np.pad(own, ((0, 0), (0, n - own.shape[1])))
            self.of_chunk[chunk] = own
        for row, column in zip(own, columns):
            row[ordinals] += column

    def rows(self) -> Iterator[pa.RecordBatch]:
        for chunk, (best, total) in self.of_chunk.items():
            at = np.flatnonzero(total)
            cells = chunk, pack_gaps(np.diff(at, prepend=0)), _pack(best[at]), _pack(total[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(cells, [pa.int64()] + [pa.binary()] * 3)],
                names=["chunk", "ordinals", "n_best", "count_sum"],
            )
        self.__init__()


def returned_scores(posted: DataFrame, totals: DataFrame, groups: int) -> DataFrame:
    """``Sums`` of chunks: postings give their documents the scores of their pairs."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        pairs = counts = best = None
        for batch in batches:
            for row in batch.select(["chunk", "pairs", "n_docs", "docs", "planes"]).to_pylist():
                own = np.cumsum(_unpack(row["pairs"], np.int64))
                if row["chunk"] is None:  # the scores of a slice stand before its postings
                    pairs, counts = own, _unpack(row["n_docs"], np.int64)
                    head = np.flatnonzero(np.diff(pairs >> B_BITS, prepend=-1))
                    most = np.maximum.reduceat(counts, head)
                    best = counts == np.repeat(most, np.diff(np.append(head, len(pairs))))
                    continue
                n_docs = _unpack(row["n_docs"], np.uint16).astype(np.int64)
                ordinal, links = postings(n_docs, row["docs"], row["planes"])
                at = np.repeat(np.searchsorted(pairs, own), n_docs)
                count = counts[at]
                # sums of floats stay exact in halves
                low, high = count & ((1 << 20) - 1), count >> 20
                total = np.bincount(ordinal, links * low).astype(np.int64)
                total += np.bincount(ordinal, links * high).astype(np.int64) << 20
                n_best = np.bincount(ordinal, links * best[at]).astype(np.int64)
                touched = np.flatnonzero(total)
                sums.add(row["chunk"], touched, n_best[touched], total[touched])
                if sums.size > 1 << 22:
                    yield from sums.rows()
        yield from sums.rows()

    none = F.lit(None)
    scores = totals.select(
        F.lit(None).cast("long").alias("chunk"),
        "slice",
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("salt"),
        "pairs",
        F.col("counts").alias("n_docs"),
        none.cast("binary").alias("docs"),
        none.cast("binary").alias("planes"),
    )
    both = posted.select(*scores.columns).unionByName(scores).repartition("slice", "salt")
    return both.sortWithinPartitions("slice", "salt", F.col("chunk").asc_nulls_first()).mapInArrow(
        score, Sums.SCHEMA
    )


def _by_document(sums: DataFrame) -> DataFrame:
    """``chunk, ordinal, n_best, count_sum``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, Sums()

        def rows() -> pa.RecordBatch:
            best, total = held.of_chunk[now]
            at = np.flatnonzero(total)
            columns = np.full(len(at), now), at.astype(np.int32), best[at], total[at]
            held.__init__()
            return pa.RecordBatch.from_arrays(
                list(map(pa.array, columns)), names=["chunk", "ordinal", "n_best", "count_sum"]
            )

        for batch in batches:
            for chunk, ordinals, best, total in zip(*(c.to_pylist() for c in batch.columns)):
                if chunk != now and held.of_chunk:
                    yield rows()
                now = chunk
                held.add(chunk, unpack_gaps(ordinals), _unpack(best, np.int64), _unpack(total, np.int64))
        if held.of_chunk:
            yield rows()

    dealt = sums.repartition("chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(gather, "chunk long, ordinal int, n_best long, count_sum long")


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``a_path`` is a byte-level BPE file, ``b_path`` a sentence-piece model. ``n_best`` are the links
    whose pair has the greatest count of all pairs of its A id, ``count_sum`` adds up the counts of
    all links.
    """
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    table = materialize(token_table(narrow, a_path, b_path))
    chunks = table.where("slice = -1 AND ordinal = 0").count()
    groups = max(-(-chunks // GROUP_CHUNKS), 1)
    posted = table.where("slice >= 0").withColumn("salt", F.pmod(F.xxhash64("chunk"), groups).cast("int"))
    totals = posted.withColumnRenamed("n_docs", "counts")
    if groups > 1:
        totals = _added_up(totals, ["slice", "salt"], np.uint16)
    totals = _added_up(totals, ["slice"], np.int64 if groups > 1 else np.uint16)
    sums = _by_document(returned_scores(posted, totals, groups))
    found = table.where("slice = -1").join(sums, ["chunk", "ordinal"], "left")
    return found.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
