"""Periodic runs in texts, from maximal pairs in the LCP-interval tree.

A run is a stretch of consecutive words with smallest period ``q`` that neither neighbour extends.
A run of length ``n`` that starts at ``s`` shows as a maximal pair: the ``n - q`` words at ``s`` and
at ``s + q`` are equal, the words before them differ and so do the words after them. The other way
round, a maximal pair whose distance is small against its length spans a stretch that cannot be
extended, so nothing is extended here: pairs are taken and the smallest distance of each stretch
is its period.

The tree is built bottom up from suffix and LCP arrays. Every node lists its positions with their
left-word classes; when two children meet, each position of the smaller list is paired with its
nearest neighbours of the larger one, provided that their classes differ. Nearest ones suffice: an
occurrence between ``s`` and ``s + q`` would be a smaller period.

A document is handled in one task, and a task handles documents in blocks of bounded size, so
there is no shuffle at all. Suffixes are sorted only where a word sequence as long as the shortest
possible pair recurs in its document.

Defined results: a null or empty text has no words, no runs and an empty ``collapsed`` text; a null
id is kept; repeated rows give repeated rows; an empty table gives an empty table; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.words import BLOCK_WORDS, blocks, numbered

RUN_TYPE = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


def _shortest_pair(min_length: int, min_exponent: int) -> int:
    """Length of the shortest pair that may stand for a run."""
    periods = range(1, min_length + 1)
    return min(max(min_length - q, (min_exponent - 1) * q) for q in periods)


def _recurring(words: np.ndarray, doc: np.ndarray, stop: np.ndarray, size: int) -> np.ndarray:
    """Documents in which some ``size`` words in a row may occur twice."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    rng = np.random.default_rng(12)
    factors = rng.integers(1 << 62, 1 << 63, size + 1, np.uint64) | np.uint64(1)
    mixed = words.astype(np.uint64) * factors[-1]
    mixed ^= mixed >> np.uint64(29)
    key = doc[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(size):
        key = key + mixed[k : k + n] * factors[k]
    whole = np.flatnonzero(np.arange(n) + size <= stop[:n])
    key = key[whole]
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    return np.unique(doc[whole[twice[at] == key]])


def _groups(ranks: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by ``ranks`` and then ``keys``, and where a new row of values begins in it."""
    order = np.lexsort((*keys[::-1], ranks))
    new = np.ones(len(order), bool)
    new[1:] = False
    for key in (ranks, *keys):
        own = key[order]
        new[1:] |= own[1:] != own[:-1]
    return order, new


def _suffixes(
    words: np.ndarray, doc: np.ndarray, stop: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next ``size`` words recur in their document, ordered as suffixes, and the
    common prefix of each with the one before it (0 when shorter than ``size``).

    The rank of a position is the number of those before its group; groups of equal prefixes of
    ``size``, ``2 * size``, ... words are split further until every position is alone.
    """
    n = len(words)
    padded = np.append(words + 1, np.zeros(size, np.int64))
    where = np.arange(n)
    columns = [np.where(where + k < stop, padded[k : k + n], 0) for k in range(size)]
    bits = int(padded.max(initial=1)).bit_length()
    fit = max(63 // bits, 1)  # several words make one sort key
    keys = []
    for k in range(0, size, fit):
        key = np.zeros(n, np.int64)
        for column in columns[k : k + fit]:
            key = (key << bits) | column
        keys.append(key)
    order, new = _groups(doc, *keys)
    rank = np.empty(n, np.int32)
    heads = np.flatnonzero(new)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))

    def crowded(order: np.ndarray, new: np.ndarray) -> np.ndarray:
        alone = new.copy()
        alone[:-1] &= new[1:]
        return order[~alone]

    active = open_ = crowded(order, new)
    levels, lengths = [rank], [size]
    while len(open_):
        at = open_ + lengths[-1]
        follow = np.where(at < stop[open_], levels[-1][np.minimum(at, n - 1)], -1)
        own = levels[-1][open_]
        order, new = _groups(own, follow)
        own, open_ = own[order], open_[order]
        heads = np.flatnonzero(new)
        group = np.flatnonzero(np.diff(own, prepend=-1))  # where the groups split here begin
        offset = np.arange(len(own)) - np.repeat(group, np.diff(np.append(group, len(own))))
        rank = levels[-1].copy()
        rank[open_] = np.repeat((own + offset)[heads], np.diff(np.append(heads, len(own))))
        levels.append(rank)
        lengths.append(2 * lengths[-1])
        open_ = crowded(open_, new)
    suffix = active[np.argsort(levels[-1][active])]

    lcp = np.zeros(len(suffix), np.int64)
    pair = np.flatnonzero(levels[0][suffix[1:]] == levels[0][suffix[:-1]]) + 1
    a, b = suffix[pair - 1].copy(), suffix[pair].copy()
    a_stop, b_stop = stop[a], stop[b]
    found = np.zeros(len(pair), np.int64)
    for ranks, length in zip(levels[::-1], lengths[::-1]):
        inside = (a < a_stop) & (b < b_stop)
        same = ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)]
        step = (inside & same) * length
        a, b, found = a + step, b + step, found + step
    going = np.ones(len(pair), bool)
    for _ in range(size - 1):
        going &= (a < a_stop) & (b < b_stop)
        going &= padded[np.minimum(a, n)] == padded[np.minimum(b, n)]
        a, b, found = a + going, b + going, found + going
    lcp[pair] = found
    return suffix, lcp


def maximal_pairs(
    suffix: list[int], lcp: list[int], left: dict[int, int], min_length: int, min_exponent: int
) -> Iterator[tuple[int, int, int]]:
    """``start, length, distance`` of stretches spanned by close maximal pairs of one subtree.

    ``suffix`` are positions in suffix order, ``lcp[k]`` the common prefix of positions ``k - 1`` and
    ``k`` (``lcp[0]`` is not read), ``left`` the left-word class of every position.
    """
    stack: list[tuple[int, list[int]]] = []  # common prefix with the entry below, positions

    def join_top() -> Iterator[tuple[int, int, int]]:
        depth, one = stack.pop()
        below, two = stack.pop()
        small, large = (one, two) if len(one) <= len(two) else (two, one)
        for p in small:
            at = bisect_left(large, p)
            for q in large[max(at - 1, 0) : at + 1]:
                distance = abs(p - q)
                if (
                    distance * (min_exponent - 1) <= depth
                    and distance + depth >= min_length
                    and left[p] != left[q]
                ):
                    yield min(p, q), distance + depth, distance
        if len(small) * 8 < len(large):
            for p in small:
                insort(large, p)
        else:
            large = sorted(large + small)  # two sorted lists: one merge
        stack.append((below, large))

    for k, position in enumerate(suffix):
        depth = lcp[k] if k else 0
        while len(stack) > 1 and stack[-1][0] > depth:  # intervals that end before this suffix
            yield from join_top()
        stack.append((depth, [position]))
    while len(stack) > 1:
        yield from join_top()


def block_runs(
    words: np.ndarray, ends: np.ndarray, min_length: int = 6, min_exponent: int = 4
) -> dict[int, list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of documents laid end to end, by document, in order.

    ``words`` are word numbers, ``ends`` says where each document ends. Starts count from the
    beginning of the document. Documents without runs are left out.
    """
    size = _shortest_pair(min_length, min_exponent)
    sizes = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), sizes)
    stop = np.repeat(ends, sizes)
    chosen = _recurring(words, doc, stop, size)
    begin = ends - sizes
    if len(chosen) < len(ends):  # go on with those documents only
        if not len(chosen):
            return {}
        inside = np.isin(doc, chosen)
        found = block_runs(words[inside], np.cumsum(sizes[chosen]), min_length, min_exponent)
        return {int(chosen[k]): runs for k, runs in found.items()}
    suffix, lcp = _suffixes(words, doc, stop, size)
    if not len(suffix):
        return {}
    first = np.flatnonzero(lcp == 0)
    # a subtree whose positions are all far apart for its depth has no close pair
    number = np.cumsum(lcp == 0) - 1
    order = np.lexsort((suffix, number))
    gap = np.full(len(suffix), np.iinfo(np.int64).max // min_exponent)
    gap[1:] = np.where(number[order[1:]] == number[order[:-1]], np.diff(suffix[order]), gap[0])
    close = np.minimum.reduceat(gap, first) * (min_exponent - 1) <= np.maximum.reduceat(lcp, first)

    found: dict[int, dict[tuple[int, int], int]] = defaultdict(dict)
    last = np.append(first[1:], len(suffix))
    for lo, hi in zip(first[close].tolist(), last[close].tolist()):
        positions = suffix[lo:hi]
        own = int(doc[positions[0]])
        # before the first word of a document stands a class of its own
        classes = np.where(positions > begin[own], words[positions - 1], -1)
        left = dict(zip(positions.tolist(), classes.tolist()))
        runs = found[own]
        for start, length, distance in maximal_pairs(
            positions.tolist(), lcp[lo:hi].tolist(), left, min_length, min_exponent
        ):
            key = start - int(begin[own]), length
            runs[key] = min(distance, runs.get(key, distance))
    return {
        own: sorted((start, length, period) for (start, length), period in runs.items())
        for own, runs in found.items()
        if runs
    }


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words outside runs and the first period of each run."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def find_runs(
    docs: DataFrame,
    min_length: int = 6,
    min_exponent: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``.

    ``runs`` holds ``start, length, period`` in words, by start and then period, of every run of at
    least ``min_length`` words and ``min_exponent`` (2 or more) periods. ``collapsed`` is the text
    with the first period of each run only, its words joined by single blanks.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two words and two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            at = 0
            for block in blocks(texts, BLOCK_WORDS):
                ids, ends, _ = numbered(block)
                found = block_runs(ids, ends, min_length, min_exponent)
                rows, collapsed = [], []
                for k, words in enumerate(block):
                    own = found.get(k, [])
                    rows.append([dict(zip(("start", "length", "period"), r)) for r in own])
                    collapsed.append(b" ".join(_kept(words, own) if own else words))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(block)),
                        pa.array([len(words) for words in block], pa.int64()),
                        pa.array(rows, RUN_TYPE),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                at += len(block)

    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    schema = (
        "doc_id long, n_words long, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    return narrow.mapInArrow(run, schema)


def longest_power(runs: str = "runs"):
    """The run with the greatest ``length / period``, the first of equals; null without runs."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(
        runs,
        none,
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
        ).otherwise(best),
    )
