"""Exact set-similarity join of documents by word shingles, and its connected groups.

Method: sets of a size band are cut into ``m`` segments by hashing their tokens, the same cut for
all sets. Sets that are similar enough differ in at most ``H`` tokens; so for any allocation of a
budget to segments with ``sum(v + 1) = H + 1`` there is a segment whose two sides differ in at most
``v`` tokens. A segment with ``v = 0`` is looked up as it is, with ``v = 1`` also without one of its
tokens (on either side), with ``v = -1`` not at all. There are ``m = H + 1`` segments and some spare
ones, so every set leaves as many of its most frequent segments, the empty ones above all, at -1 and
starts with 0 elsewhere; then further frequent segments go to -1, each paid for by a designated
segment that goes to 1, if that makes its lookups fewer. A set is indexed in its own band with all
segments and looks up also in bands of smaller sets that it can be similar to.

In a bucket of equal signatures that few sets look up, these are paired with all members. A pair
goes on if sketches (numbers of tokens by hash cells, some bytes for a text's thousands) do not show
it to differ in too many tokens, so that the texts of few unrelated pairs are brought together.

Large groups are never expanded into pairs. In a bucket that many look up, all members are
verified against one hub, the member that shares most signatures with others, so a group of near
copies becomes a star. What is left are members that are not connected to their hub's group. If a
bucket has few of these outsiders, they meet its members of other groups by sketches. If it has many, all
sets of the hub are known by the tokens in which they differ from it, and two sets differ in exactly
the tokens that only one of these differences has. An outsider differs from its hub in more than
``H`` tokens, so to be similar to another member their differences must overlap. Members whose
differences have too few tokens in common with any others are left out by counting, without pairs; a
prefix-filtered join of the other differences, rarest tokens first, finds the pairs. Every link is
verified on the words themselves.

Equal sets are one class (128-bit fingerprints); only classes are joined.

Defined results: documents without words (null or empty text) have 0 shingles and link with nothing;
a document of fewer words than a shingle has one shingle; a null ``doc_id`` links like any other and
is never the smallest id of a group that has another; repeated rows are in one class; an empty table
gives an empty table; other columns are ignored (kept by ``keep_one``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellspring.llm.components import connected
from wellspring.llm.bpe import word_factors
from wellspring.session import materialize

#: Ratio of the sizes at the two ends of a band.
BAND_RATIO = 1.4
#: One segment in so many is designated for one-deletion neighbourhoods.
DESIGNATED = 32
#: One spare segment for so many that the pigeonhole needs.
SPARE = 8
#: Buckets that so many sets look up become stars.
STAR = 16
#: Outsiders of a bucket that are compared with its members by sketches; more, by differences. Pairs
#: grow with this number times the members, so it is small.
OUTSIDERS = 16
#: Differences looked at beyond a prefix, for each in it; as many must be in common.
MORE = 0.5
#: Shingles for a cell of a sketch.
PER_CELL = 4
#: Bytes of text that are hashed at once.
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch: with two texts each, still some MB in the JVM's buffers and in Python.
BATCH_ROWS = 1024

_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser; different salts give independent values."""
    x = x + _U((salt * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_MARK = np.random.default_rng(11).integers(0, 2**64, 256, np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(doc, token)``: distinct shingle hashes of each text, sorted by text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    ends = np.cumsum(lengths)
    edge = np.zeros(len(data) + 1, bool)
    edge[ends - lengths] = True
    edge[-1] = True
    word = ~_BLANK[data]
    begins = np.flatnonzero(word & (edge[:-1] | ~np.append(False, word[:-1])))
    stops = np.flatnonzero(word & (edge[1:] | ~np.append(word[1:], False))) + 1
    if not len(begins):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    # factors by place within a word are independent, so self-similar words do not clash
    place = np.arange(begins[0], len(data)) - np.repeat(begins, np.diff(np.append(begins, len(data))))
    own = data[begins[0] :]
    values = _MARK[own] * word_factors(int((stops - begins).max()))[np.where(_BLANK[own], 0, place)]
    words = mix(np.add.reduceat(np.where(_BLANK[own], _U(0), values), begins - begins[0]))
    doc = np.searchsorted(ends, begins, side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    # a shingle starts at every word that has size - 1 words behind it, or at the first word
    # of a text that is shorter
    at = np.arange(len(words))
    left = (first + n_words)[doc] - at
    start = np.flatnonzero((left >= size) | ((at == first[doc]) & (left < size)))
    tokens = np.zeros(len(start), _U)
    span = np.minimum(left[start], size)
    for k in range(size):
        has = span > k
        tokens[has] += words[start[has] + k] * _U(2 * k + 1) * _FACTOR
        tokens[has] = mix(tokens[has], k)
    doc = doc[start]
    order = np.lexsort((tokens, doc))
    doc, tokens = doc[order], tokens[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (tokens[1:] != tokens[:-1]))
    return doc[new], tokens[new]


def chunks(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of bounded size (longer texts alone), with the number of the first."""
    at, own, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or b""
        if own and size + len(text) > CHUNK_BYTES:
            yield at, own
            at, own, size = i, [], 0
        own.append(text)
        size += len(text)
    if own:
        yield at, own


def _total(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums (modulo 2**64) of the runs of ``values`` that end before ``ends``."""
    sums = np.append(_U(0), np.cumsum(values, dtype=_U))[ends]
    return np.diff(sums, prepend=_U(0))


def fingerprints(doc: np.ndarray, token: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Set size and two 64-bit fingerprints of each of ``n`` texts."""
    sizes = np.bincount(doc, minlength=n)
    ends = np.cumsum(sizes)
    one = mix(_total(mix(token, 1), ends) + sizes.astype(_U), 2)
    two = mix(_total(mix(token, 3), ends) + sizes.astype(_U), 4)
    return sizes, one, two


def sketches(doc: np.ndarray, token: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Numbers of tokens by hash cells, a byte a cell, of each text; empty if a number is over 255."""
    bits = np.maximum(np.ceil(np.log2(np.maximum(sizes, 1) / PER_CELL)), 3).astype(np.int64)
    ends = np.cumsum(1 << bits)
    begins = ends - (1 << bits)
    cell = mix(token, 9) >> (64 - bits)[doc].astype(_U)
    counts = np.bincount(begins[doc] + cell.astype(np.int64), minlength=int(ends[-1]) if len(ends) else 0)
    found = (counts[a:b] for a, b in zip(begins, ends))
    return [c.astype(np.uint8).tobytes() if c.max() < 256 else b"" for c in found]


def similar_sketches(ones: list[bytes], twos: list[bytes], similarity: tuple[int, int]) -> np.ndarray:
    """Which pairs of sets with these sketches can be similar: they differ in as many tokens at least
    as the numbers in their cells do. Cells are split evenly, so a finer sketch is folded."""
    num, den = similarity
    found = np.ones(len(ones), bool)
    lengths: dict[tuple[int, int], list[int]] = {}
    for i, (one, two) in enumerate(zip(ones, twos)):
        if one and two:
            lengths.setdefault((len(one), len(two)), []).append(i)
    for (n, m), places in lengths.items():
        least = min(n, m)
        # so many pairs at once that their cells stay a small array
        step = max(1, (1 << 20) // max(n, m))
        for own in (places[k : k + step] for k in range(0, len(places), step)):
            one, two = (
                np.frombuffer(b"".join([side[i] for i in own]), np.uint8)
                .reshape(len(own), least, -1)
                .sum(2, dtype=np.int32)
                for side in (ones, twos)
            )
            apart, total = np.abs(one - two).sum(1), one.sum(1) + two.sum(1)
            found[own] = (total - apart) * den >= (total + apart) * num
    return found


def may_be_similar(one: bytes, two: bytes, similarity: tuple[int, int]) -> bool:
    """``similar_sketches`` of one pair."""
    return bool(similar_sketches([one], [two], similarity)[0])


class Bands:
    """Size bands for a similarity of ``num / den``: bounds, segments, spare ones among these."""

    def __init__(self, similarity: tuple[int, int]):
        self.num, self.den = similarity
        self.low, self.segments, self.spare = [1], [], []

    def partner(self, size: int) -> int:
        """The largest set that a set of ``size`` can be similar to."""
        return size * self.den // self.num

    def differences(self, total: int) -> int:
        """Most tokens in which two similar sets of ``total`` tokens together can differ."""
        return total - 2 * (-(-self.num * total // (self.num + self.den)))

    def extend(self, size: int) -> None:
        while self.low[-1] <= size:
            low = self.low[-1]
            high = max(low, int(low * BAND_RATIO) - 1)
            most = high + self.partner(high)
            totals = range(max(2 * low, most - 2 * (self.num + self.den)), most + 1)
            most = max(0, *map(self.differences, totals))
            # without differences only equal sets are similar
            self.spare.append(-(-(most + 1) // SPARE) if most else 0)
            self.segments.append(most + 1 + self.spare[-1])
            self.low.append(high + 1)

    def arrays(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        self.extend(size)
        return np.array(self.low), np.array(self.segments)


def designated(segments: np.ndarray) -> np.ndarray:
    return -(-segments // DESIGNATED)


# Bits of a signature's ``meta``: whole segment (else one token is left out), own band (else
# looking up a lower one), designated segment; then 8 bits for the band, then the set's size.
WHOLE, OWN, DESIG = 1, 2, 4
BAND_SHIFT, SIZE_SHIFT = 3, 11


def signatures(
    doc: np.ndarray, token: np.ndarray, sizes: np.ndarray, similarity: tuple[int, int]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(signature, doc, meta)`` of all segments of all sets, band by band."""
    bands = Bands(similarity)
    low, segments = bands.arrays(int(sizes.max(initial=1)))
    own = np.searchsorted(low, sizes, side="right") - 1
    least = -(-sizes * bands.num // bands.den)  # size of the smallest similar set
    down, place, mark = 0, mix(token, 5) >> _U(32), mix(token, 6)
    while True:
        band = own - down
        here = (sizes > 0) & (band >= 0)
        band = np.where(here, band, 0)
        here &= low[band + 1] - 1 >= least
        if not here.any():
            return
        here &= segments[band] > 1  # else only equal sets are similar
        pick = here[doc]
        d, h, p = doc[pick], mark[pick], place[pick]
        if len(d):
            m = np.where(here, segments[band], 0)
            offset = np.cumsum(m) - m
            seg = ((p * m[d].astype(_U)) >> _U(32)).astype(np.int64)
            at = offset[d] + seg
            order = np.argsort(at, kind="stable")
            counts = np.bincount(at, minlength=int(m.sum()))
            sums = _total(h[order], np.cumsum(counts))
            owner = np.repeat(np.arange(len(sizes)), m)
            number = np.arange(len(owner)) - offset[owner]
            salt = mix((band[owner].astype(_U) << _U(40)) | number.astype(_U), 7)
            desig = number < designated(m)[owner]
            meta = (sizes << SIZE_SHIFT) | (band << BAND_SHIFT) | (OWN if down == 0 else 0)
            yield mix(sums + salt, 8), owner, meta[owner] | np.where(desig, DESIG, 0) | WHOLE
            less = np.flatnonzero(desig[at])
            yield mix(sums[at[less]] - h[less] + salt[at[less]], 8), d[less], meta[d[less]] | DESIG
        down += 1


def sets_of(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, rid, n, cls, check``: set size, class and second fingerprint of each document."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "rid", "n", "cls", "check")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, texts in chunks(batch.column(2).to_pylist()):
                doc, token = shingle_sets(texts, shingle)
                found.append(fingerprints(doc, token, len(texts)))
            if found:
                n, one, two = (np.concatenate(c) for c in zip(*found))
                arrays = [pa.array(c.view(np.int64), pa.int64()) for c in (n, one, two)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], schema=schema)

    narrow = docs.select("doc_id", "rid", F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, rid long, n long, cls long, check long")


def signature_rows(docs: DataFrame, shingle: int, similarity: tuple[int, int]) -> DataFrame:
    """``sig, cls, meta`` of all documents."""
    schema = pa.schema([(c, pa.int64()) for c in ("sig", "cls", "meta")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0).to_pylist()):
                doc, token = shingle_sets(texts, shingle)
                sizes, one, _ = fingerprints(doc, token, len(texts))
                cls = one.view(np.int64)
                for sig, owner, meta in signatures(doc, token, sizes, similarity):
                    columns = [sig.view(np.int64), cls[owner], meta.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    narrow = docs.select(F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(run, "sig long, cls long, meta long")


def shared_signatures(rows: DataFrame) -> DataFrame:
    """Rows whose signature two classes have, one of them in its own band, one with the whole
    segment. Signatures are shuffled once and never stored; a hot one passes through a buffer that
    spills, and the many segments of its sets are other signatures, in other tasks."""
    meta, own = F.col("meta"), Window.partitionBy("sig")
    marked = rows.withColumns(
        {
            "least": F.min("cls").over(own),
            "most": F.max("cls").over(own),
            "owned": F.max(meta.bitwiseAND(OWN)).over(own),
            "whole": F.max(meta.bitwiseAND(WHOLE)).over(own),
        }
    )
    useful = marked.where("least != most AND owned > 0 AND whole > 0").select("sig", "cls", "meta")
    return materialize(useful.dropDuplicates())


def allocate(shared: DataFrame, bands: Bands) -> DataFrame:
    """``shared`` with ``asks``: whether the set looks this signature up, under its allocation.

    Costs are the numbers of sets that lookups find. As many of a set's most frequent segments as
    there are spare ones go to -1. If as many further ones as there are designated segments find
    more than the one-deletion neighbourhoods of the latter would, these go to -1 too, designated
    ones stay, and the latter go to 1; else all others stay at 0.
    """
    meta = F.col("meta")
    counts = shared.groupBy("sig").agg(
        F.count(F.lit(1)).alias("freq"), F.count(F.when(meta.bitwiseAND(WHOLE) > 0, 1)).alias("wholes")
    )
    allowed = F.array(*[F.lit(int(designated(np.int64(m)))) for m in bands.segments])
    spare = F.array(*[F.lit(s) for s in bands.spare])
    band = F.shiftright(meta, BAND_SHIFT).bitwiseAND(255).cast("int")
    rows = shared.join(counts, "sig").select(
        "sig",
        "cls",
        "freq",
        (meta.bitwiseAND(WHOLE) > 0).alias("whole"),
        (meta.bitwiseAND(OWN) > 0).alias("own"),
        (meta.bitwiseAND(DESIG) > 0).alias("desig"),
        band.alias("band"),
        F.shiftright(meta, SIZE_SHIFT).alias("n"),
        F.when(meta.bitwiseAND(DESIG) == 0, 0)
        .when(meta.bitwiseAND(WHOLE) > 0, F.col("freq") - F.col("wholes"))
        .otherwise(F.col("wholes"))
        .alias("extra"),
    )
    # windows over the segments of one set in one band
    own = Window.partitionBy("cls", "band")
    plain = F.col("whole") & ~F.col("desig")

    def most_frequent(kind: Column, number: Column) -> Column:
        order = own.orderBy(F.when(kind, F.col("freq")).otherwise(0).desc(), "sig", F.col("whole").desc())
        return kind & (F.row_number().over(order) <= number)

    number = F.get(spare, F.col("band"))
    rows = rows.withColumns(
        {
            "free": most_frequent(F.col("whole"), number),
            "top": most_frequent(plain, number + F.get(allowed, F.col("band"))),
        }
    )

    def cost(left_out: str) -> Column:
        return F.sum(F.when(F.col("whole") & ~F.col(left_out), F.col("freq")).otherwise(0)).over(own)

    rows = rows.withColumn("swapped", cost("top") + F.sum("extra").over(own) < cost("free"))
    asks = F.when(F.col("swapped"), ~F.col("top")).otherwise(F.col("whole") & ~F.col("free"))
    return materialize(rows.select("sig", "cls", "n", "freq", "whole", "own", asks.alias("asks")))


def direct_pairs(rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Distinct ``a, b``: the sets that ask for a bucket, with all members whose size allows it."""
    num, den = similarity
    one = rows.where("asks").select("sig", F.col("cls").alias("a"), F.col("n").alias("n_a"))
    two = rows.select("sig", F.col("cls").alias("b"), F.col("n").alias("n_b"))
    fits = (F.col("a") != F.col("b")) & (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)
    pairs = one.join(two, "sig").where(fits)
    return materialize(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def pruned(pairs: DataFrame, texts: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``pairs`` that may be similar by their sketches."""
    left = texts.select(F.col("cls").alias("a"), F.col("sketch").alias("one"))
    right = texts.select(F.col("cls").alias("b"), F.col("sketch").alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = similar_sketches(batch.column(2).to_pylist(), batch.column(3).to_pylist(), similarity)
            yield batch.select([0, 1]).filter(pa.array(kept))

    both = pairs.join(right, "b").join(left, "a").select("a", "b", "one", "two")
    return materialize(both.mapInArrow(run, "a long, b long"))


def hubs_of(rows: DataFrame) -> DataFrame:
    """``sig, hub``: the hub of every bucket."""
    support = rows.groupBy("cls").agg(F.sum(F.when(F.col("whole"), F.col("freq")).otherwise(0)).alias("support"))
    ranked = rows.join(support, "cls")
    rank = F.struct("whole", "support", "cls")
    return materialize(ranked.groupBy("sig").agg(F.max_by("cls", rank).alias("hub")))


def hub_pairs(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """Distinct ``a, b``: the hub of every bucket, with all its members."""
    pairs = rows.select("sig", "cls").join(hubs, "sig").where("cls != hub")
    return materialize(pairs.select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct())


def bucket_members(rows: DataFrame, hubs: DataFrame, roots: DataFrame) -> DataFrame:
    """``sig, hub, cls, n, asks, root, out, outs``: members of the buckets that have outsiders
    (``out``: not in the hub's group), ``outs`` of them."""
    hub_root = roots.select(F.col("id").alias("hub"), F.col("root").alias("hub_root"))
    members = rows.groupBy("sig", "cls").agg(F.max("n").alias("n"), F.bool_or("asks").alias("asks"))
    members = members.join(roots.withColumnRenamed("id", "cls"), "cls", "left")
    members = members.join(hubs.join(hub_root, "hub", "left"), "sig")
    members = members.withColumn("root", F.coalesce("root", "cls"))
    members = members.withColumn("out", F.col("root") != F.coalesce("hub_root", "hub"))
    outs = F.count_if("out").over(Window.partitionBy("sig"))
    members = members.withColumn("outs", outs).where("outs > 0")
    return materialize(members.select("sig", "hub", "cls", "n", "asks", "root", "out", "outs"))


def sketched_pairs(members: DataFrame, texts: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Distinct ``a, b``: outsiders and other members of one bucket, in different groups so far, that
    may be similar by their sizes and sketches. Sketches go with the members, and pairs are never
    shuffled before they are compared."""
    num, den = similarity
    held = members.join(texts.select("cls", "sketch"), "cls")
    held = held.select("sig", "cls", "n", "asks", "root", "out", "sketch")
    # members are few for the pairs that they make, so their partitions are not put together
    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = held.repartition(tasks, "sig")
    left = held.where("out").select("sig", *[F.col(c).alias(f"x_{c}") for c in held.columns[1:]])
    near = left.join(held, "sig").where(
        (F.col("root") != F.col("x_root"))
        & (F.least("n", "x_n") * den >= F.greatest("n", "x_n") * num)
        & (F.col("asks") | F.col("x_asks"))
        & (~F.col("out") | (F.col("cls") < F.col("x_cls")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = similar_sketches(batch.column(2).to_pylist(), batch.column(3).to_pylist(), similarity)
            yield batch.select([0, 1]).filter(pa.array(kept))

    both = near.select(
        F.greatest("cls", "x_cls").alias("a"), F.least("cls", "x_cls").alias("b"), "sketch", "x_sketch"
    )
    return materialize(both.mapInArrow(run, "a long, b long").distinct())


def _most(n, similarity: tuple[int, int]):
    """Most tokens in which similar sets of ``n`` tokens together can differ."""
    num, den = similarity
    return F.floor(n * (den - num) / (den + num))


def unsettled(verified: DataFrame, roots: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``hub, cls, n, root, out, size, overlap``: members that may be similar to an outsider of
    their hub (``out``: not in the hub's group), going by ``size``, the number of tokens in which they
    differ from the hub. Similar sets have sizes no further apart than they differ themselves.
    ``overlap`` is the least number of tokens that the differences of such a pair have in common.
    """
    num, den = similarity
    hub_root = roots.select(F.col("id").alias("hub"), F.col("root").alias("hub_root"))
    members = verified.select(
        F.col("a").alias("hub"),
        F.col("b").alias("cls"),
        F.col("n_b").alias("n"),
        (F.col("total") - F.col("common")).alias("size"),
    )
    members = members.join(roots.withColumnRenamed("id", "cls"), "cls", "left").join(hub_root, "hub", "left")
    members = members.withColumn("root", F.coalesce("root", "cls"))
    members = members.withColumn("out", F.col("root") != F.coalesce("hub_root", "hub"))
    most = _most(F.col("n") + F.floor(F.col("n") * den / num), similarity)
    size, outside = F.col("size"), F.when(F.col("out"), F.col("size"))
    order = Window.partitionBy("hub").orderBy("size", "cls")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # the rows after, from the end: a frame without an end is read anew for every row
    after = Window.partitionBy("hub").orderBy(F.desc("size"), F.desc("cls"))
    after = after.rowsBetween(Window.unboundedPreceding, -1)
    # the nearest member an outsider could pair with, the nearest outsider any other member could
    below = F.when(F.col("out"), F.lag("size").over(order)).otherwise(F.max(outside).over(before))
    above = F.when(F.col("out"), F.lead("size").over(order)).otherwise(F.min(outside).over(after))
    members = members.withColumns({"below": below, "above": above, "most": most})
    near = (size - F.col("below") <= F.col("most")) | (F.col("above") - size <= F.col("most"))
    members = members.where(F.coalesce(near, F.lit(False)))
    least = F.min(size).over(Window.partitionBy("hub"))
    least_out = F.min(outside).over(Window.partitionBy("hub"))
    partner = F.greatest(F.when(F.col("out"), least).otherwise(least_out), size - F.col("most"))
    overlap = F.greatest(F.lit(1), F.ceil((size + partner - F.col("most")) / 2))
    return members.select("hub", "cls", "n", "root", "out", "size", overlap.alias("overlap"))


def meeting(members: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """The rows of ``members`` whose differences from their hub have enough tokens in common with those
    of other members, one of a key an outsider, to be similar to any. Prefixes are enough: in an order
    that holds for all members of a hub, two sets whose differences share ``overlap`` tokens share ``need``
    of those that come before the last ``overlap - need`` ones. The hub's own tokens come last, as most
    outsiders lack them all. Members are counted by token, not paired, so unrelated ones cost no more
    than their prefixes, and ``need`` is so large that a common passage does not reach it.
    """
    more = F.floor((F.col("size") - F.col("overlap")) * MORE).cast("long")
    need = F.greatest(F.lit(1), F.least("overlap", more))
    hubs = texts.select(F.col("cls").alias("hub"), F.col("text").alias("hub_text"))
    both = members.withColumn("need", need).hint("merge").join(texts.select("cls", "text"), "cls")
    both = both.hint("merge").join(hubs, "hub")
    both = both.select("hub", "cls", "root", "out", "need", "overlap", "text", "hub_text")
    names = ["key", "hub", "cls", "root", "out", "need"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            hub, need, overlap = (batch.column(k).to_pylist() for k in (0, 4, 5))
            for at, own in chunks(batch.column(6).to_pylist()):
                doc, token = shingle_sets(own, shingle)
                keys, counts = [], []
                for i, mine in enumerate(np.split(token, np.searchsorted(doc, np.arange(1, len(own)))), at):
                    if hub[i] != last:
                        last, kept = hub[i], shingle_sets([batch.column(7)[i].as_py()], shingle)[1]
                    place = np.minimum(np.searchsorted(kept, mine), len(kept) - 1)
                    same = kept[place] == mine
                    lost = np.ones(len(kept), bool)
                    lost[place[same]] = False
                    gained, lost = mine[~same], kept[lost]
                    first = max(0, len(gained) + len(lost) - overlap[i] + need[i])
                    order = np.sort(mix(gained, 10))[:first]
                    if len(order) < first:
                        order = np.append(order, np.sort(mix(lost, 10))[: first - len(order)])
                    keys.append(mix(order ^ _U(hub[i] & (1 << 64) - 1), 11))
                    counts.append(len(order))
                rows = batch.slice(at, len(own)).select([0, 1, 2, 3, 4])
                rows = rows.take(pa.array(np.repeat(np.arange(len(own)), counts)))
                key = pa.array(np.concatenate(keys).view(np.int64))
                yield pa.RecordBatch.from_arrays([key, *rows.columns], names)

    prefixes = both.mapInArrow(run, "key long, hub long, cls long, root long, out boolean, need long")
    own = Window.partitionBy("key")
    met = prefixes.withColumns(
        {
            "one": F.min("root").over(own),
            "other": F.max("root").over(own),
            "outs": F.bool_or("out").over(own),
            "least": F.min("need").over(own),
        }
    )
    met = met.where("one != other AND outs").groupBy("hub", "cls").agg(
        F.count(F.lit(1)).alias("shared"), F.min("least").alias("least")
    )
    return materialize(members.join(met.where("shared >= least"), ["hub", "cls"], "left_semi"))


def outsider_pairs(
    members: DataFrame, differences: DataFrame, similarity: tuple[int, int]
) -> DataFrame:
    """``a, b``: pairs of ``members`` of one hub, in different groups so far, whose ``differences``
    from the hub (``a, b, diff``) show them to be similar."""
    num, den = similarity
    diffs = differences.select(F.col("a").alias("hub"), F.col("b").alias("cls"), "diff")
    held = members.join(diffs, ["hub", "cls"])
    tokens = held.select("hub", "cls", "out", F.explode("diff").alias("token"))
    # Only a token that an outsider and another member differ in can be the first in common. All
    # others count as coming before these, which come rare ones first.
    own = Window.partitionBy("hub", "token")
    tokens = tokens.withColumns(
        {"freq": F.count(F.lit(1)).over(own), "outs": F.count(F.when(F.col("out"), 1)).over(own)}
    ).where("freq > 1 AND outs > 0")
    # the differences of one set: no more than its words and the hub's
    ranked = tokens.groupBy("hub", "cls").agg(
        F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("ranked")
    )
    earlier = F.col("size") - F.size("ranked")
    prefix = F.slice("ranked", F.lit(1), F.greatest(F.size("ranked") - F.col("overlap") + 1, F.lit(0)).cast("int"))
    prefixes = members.join(ranked, ["hub", "cls"]).select(
        "hub", "cls", "n", "root", "out", "size", earlier.alias("earlier"), F.posexplode(prefix).alias("pos", "t")
    )
    prefixes = prefixes.select(
        "hub", "cls", "n", "root", "out", "size", (F.col("earlier") + F.col("pos")).alias("pos"), F.col("t.token").alias("token")
    )
    prefixes = materialize(prefixes)
    left = prefixes.where("out").select(*[F.col(c).alias(f"x_{c}") for c in prefixes.columns])
    # if this is the first token that both have, so many are still to come
    rest = 1 + F.least(F.col("size") - F.col("pos"), F.col("x_size") - F.col("x_pos")) - 1
    need = (F.col("size") + F.col("x_size") - _most(F.col("n") + F.col("x_n"), similarity)) / 2
    near = left.join(
        prefixes, (F.col("hub") == F.col("x_hub")) & (F.col("token") == F.col("x_token"))
    ).where(
        (F.col("root") != F.col("x_root"))
        & (F.least("n", "x_n") * den >= F.greatest("n", "x_n") * num)
        & (~F.col("out") | (F.col("cls") < F.col("x_cls")))
        & (rest >= need)
    )
    near = near.select("hub", "cls", "n", "x_cls", "x_n").distinct()
    both = near.join(diffs, ["hub", "cls"]).join(
        diffs.select("hub", F.col("cls").alias("x_cls"), F.col("diff").alias("x_diff")), ["hub", "x_cls"]
    )
    apart = F.size("diff") + F.size("x_diff") - 2 * F.size(F.array_intersect("diff", "x_diff"))
    total = F.col("n") + F.col("x_n")
    both = both.where((total - apart) * den >= (total + apart) * num)
    return materialize(both.select(F.greatest("cls", "x_cls").alias("a"), F.least("cls", "x_cls").alias("b")).distinct())


def verify(pairs: DataFrame, texts: DataFrame, shingle: int, diff: bool = False) -> DataFrame:
    """``a, b, common, total, n_b`` of pairs of classes, from their words: sizes of the
    intersection and the union of their shingles and of ``b``; with ``diff`` also hashes of the
    shingles that only one of them has."""
    left = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    # texts grow with the input, so they are merged with the pairs at every size
    both = pairs.hint("merge").join(right, "b").hint("merge").join(left, "a")
    both = both.select("a", "b", "text_a", "text_b")
    schema = pa.schema(
        [(c, pa.int64()) for c in ("a", "b", "common", "total", "n_b")] + [("diff", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, set()
        for batch in batches:
            rows = []
            for a, b, one, two in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:
                    last, kept = a, word_shingles(one.as_py(), shingle)
                other = word_shingles(two.as_py(), shingle)
                same = len(kept & other)
                odd = kept ^ other if diff else ()
                apart = b"".join([blake2b(b" ".join(t), digest_size=8).digest() for t in odd])
                rows.append((a, b, same, len(kept) + len(other) - same, len(other), np.frombuffer(apart, np.int64)))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    result = both.mapInArrow(run, "a long, b long, common long, total long, n_b long, diff array<long>")
    return materialize(result)


def class_texts(docs: DataFrame, sets: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """``cls, text, sketch`` of one document of each class in ``classes``, written once."""
    one = sets.join(classes.distinct(), "cls").groupBy("cls").agg(F.min("rid").alias("rid"))
    texts = docs.select("rid", F.col("text").cast("binary").alias("text"))
    texts = texts.join(materialize(one).hint("merge"), "rid")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = batch.column(0).to_numpy(), []
            for at, own in chunks(batch.column(1).to_pylist()):
                doc, token = shingle_sets(own, shingle)
                sizes, cls, _ = fingerprints(doc, token, len(own))
                if (cls.view(np.int64) != keys[at : at + len(own)]).any():
                    raise ValueError("the documents come in another order when they are read again")
                found += sketches(doc, token, sizes)
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "text", "sketch"])

    return materialize(texts.select("cls", "text").mapInArrow(check, "cls long, text binary, sketch binary"))


def word_shingles(text: bytes, size: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves; ``bytes.lower`` and ``bytes.split`` know ASCII only, as wanted."""
    words = text.lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size))))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of ``BATCH_ROWS`` rows at most, in the jobs that run meanwhile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, "10000")
    spark.conf.set(name, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def grouped(
    docs: DataFrame, shingle: int, similarity: tuple[int, int]
) -> tuple[DataFrame, DataFrame]:
    """``(sets, roots)``: set sizes and classes of ``docs`` (``rid, doc_id, text``), and the root
    of every class that is linked with another."""
    with small_batches(docs.sparkSession):
        return _grouped(docs, shingle, similarity)


def _grouped(
    docs: DataFrame, shingle: int, similarity: tuple[int, int]
) -> tuple[DataFrame, DataFrame]:
    num, den = similarity
    sets = materialize(sets_of(docs, shingle))
    clash = sets.groupBy("cls").agg(
        F.min(F.struct("check", "n")).alias("x"), F.max(F.struct("check", "n")).alias("y")
    )
    if not clash.where("x != y").isEmpty():
        raise ValueError("two different sets have one fingerprint")
    bands = Bands(similarity)
    bands.extend(max(1, sets.agg(F.max("n")).first()[0] or 0))

    shared = shared_signatures(signature_rows(docs, shingle, similarity))
    rows = allocate(shared, bands)
    asked = rows.groupBy("sig").agg(F.count_if("asks").alias("asked"), F.bool_or("own").alias("owned"))
    asked = asked.where("asked > 0 AND owned").select("sig", "asked")
    rows = rows.join(asked, "sig")
    stars = rows.where(F.col("asked") >= STAR)
    hubs = hubs_of(stars)
    pairs = hub_pairs(stars, hubs)
    direct = direct_pairs(rows.where(F.col("asked") < STAR), similarity)
    classes = pairs.unionByName(direct).select(F.explode(F.array("a", "b")).alias("cls"))
    texts = class_texts(docs, sets, classes, shingle)
    verified = verify(pairs, texts, shingle)
    similar = F.col("common") * den >= F.col("total") * num
    links = verified.unionByName(verify(pruned(direct, texts, similarity), texts, shingle))
    links = links.where(similar).select("a", "b")
    roots = materialize(connected(links))
    members = bucket_members(stars, hubs, roots)
    near = sketched_pairs(members.where(F.col("outs") <= OUTSIDERS), texts, similarity)
    found = verify(near, texts, shingle)
    many = members.where(F.col("outs") > OUTSIDERS)
    if not many.isEmpty():
        both = many.select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
        members = materialize(unsettled(verified.join(both, ["a", "b"], "left_semi"), roots, similarity))
        members = meeting(members, texts, shingle)
        if not members.isEmpty():
            both = members.select(F.col("hub").alias("a"), F.col("cls").alias("b"))
            differences = verify(both, texts, shingle, diff=True)
            near = outsider_pairs(members, differences, similarity)
            found = found.unionByName(verify(near, texts, shingle))
    found = found.where(similar)
    if not found.isEmpty():
        roots = materialize(connected(links.unionByName(found.select("a", "b"))))
    return sets, roots


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("rid"),
    )


def _with_group(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """``sets`` with ``group``: the root of the class, null for documents without words."""
    joined = sets.join(roots.withColumnRenamed("id", "cls"), "cls", "left")
    return joined.withColumn("group", F.when(F.col("n") > 0, F.coalesce("root", "cls"))).drop("root")


def components(
    docs: DataFrame,
    shingle: int = 5,
    similarity: tuple[int, int] = (80, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; ``docs`` must be a table scan or
    otherwise come in the same order each time it is read."""
    sets, roots = grouped(_numbered(docs, id_col, text_col), shingle, similarity)
    rows = materialize(_with_group(sets, roots).select("doc_id", "n", "group"))
    least = rows.where("group IS NOT NULL").groupBy("group").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("members")
    )
    # most groups are one document
    joined = rows.join(least.where("members > 1"), "group", "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def keep_one(
    docs: DataFrame,
    shingle: int = 5,
    similarity: tuple[int, int] = (80, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with their own columns, but of each group only that with the least
    id (nulls last; of repeated rows the first)."""
    sets, roots = grouped(_numbered(docs, id_col, text_col), shingle, similarity)
    rows = _with_group(sets, roots).where("group IS NOT NULL")
    rows = materialize(
        rows.select("group", "rid", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order"))
    )
    first = rows.groupBy("group").agg(
        F.min_by("rid", F.struct("order", "rid")).alias("first"), F.count(F.lit(1)).alias("members")
    )
    gone = rows.join(first.where("members > 1"), "group").where("rid != first").select("rid")
    boxed = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("rid"))
    return boxed.join(materialize(gone), "rid", "left_anti").select("doc.*")
