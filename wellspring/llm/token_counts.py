"""Token counts at every prefix of a text, by dynamic programming over prefixes.

For the prefix that ends at byte ``i`` of a piece, the last token is the token ``t`` that ends
there and may follow the last token of the prefix before it; then ``count[i] = count[i - len(t)] + 1``.
Two tokens may follow each other exactly if the tokenizer cuts their joined bytes into these two.
Counts of a whole text add up over its pieces, so truncation and budget questions are answered
from stored counts, without encoding again.

Defined results: a null text counts as empty (0 tokens, 0 bytes); a null ``doc_id`` is kept;
repeated rows give repeated rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm.bpe import NONE, SPACE, PieceTable, _classes, _powers, gather, load_tokenizer

#: Pieces whose prefixes are two pieces.
SPLIT_INSIDE = {"'re", "'ve", "'ll"}
#: Here a piece begins whatever stands before and after.
WORD_END = re.compile(r"(?<=\S)\s")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTable:
    """Whether token ``b`` may follow token ``a``; answers are kept in a table of fixed size."""

    BITS = 20

    def __init__(self, decide):
        self.decide = decide
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.answers = np.zeros(1 << self.BITS, bool)

    def __call__(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        keys = (before.astype(np.int64) << 32) | token
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slot = (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)
        answers = self.answers[slot]
        missing = np.flatnonzero(self.keys[slot] != keys)
        if len(missing):
            new, one, inverse = np.unique(keys[missing], return_index=True, return_inverse=True)
            pairs = zip((new >> 32).tolist(), (new & 0xFFFFFFFF).tolist())
            found = np.fromiter((self.decide(a, b) for a, b in pairs), bool, len(new))
            answers[missing] = found[inverse]
            where = slot[missing[one]]
            self.keys[where], self.answers[where] = new, found
        return answers


class PrefixCounter:
    def __init__(self, path: str):
        self.tokenizer, spec = load_tokenizer(path)
        byte = _byte_of_char()
        as_bytes = lambda token: bytes(byte[c] for c in token)
        self.special = {t["content"] for t in spec["added_tokens"]}
        self.tokens = [as_bytes(t) for t in spec["model"]["vocab"] if t not in self.special]
        number = {t: i for i, t in enumerate(self.tokens)}
        self.rank: dict[tuple[int, int], int] = {}
        self.parents: dict[int, tuple[int, int, int]] = {}
        for k, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            left, right = as_bytes(left), as_bytes(right)
            pair = number[left], number[right]
            self.rank[pair] = k
            self.parents.setdefault(number[left + right], (*pair, k))
        self.edges: tuple[dict, dict] = ({}, {})
        self.follows = PairTable(self._apart)
        # tokens by length, as sorted hashes with their numbers
        self.mark = np.random.default_rng(7).integers(0, 2**64, 256, np.uint64)
        by_length: dict[int, list[int]] = {}
        for i, token in enumerate(self.tokens):
            by_length.setdefault(len(token), []).append(i)
        self.by_length = {}
        for length, own in sorted(by_length.items()):
            rows = np.frombuffer(b"".join(self.tokens[i] for i in own), np.uint8).reshape(-1, length)
            hashes = (self.mark[rows] * _powers(length)[0][:length]).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes)
            self.by_length[length] = hashes[order], np.array(own)[order]
        self.table = PieceTable(list(self.special), self._resolve, np.int32)

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """What stands at one edge of ``token`` while it is being merged: ``(token, from, to)``,
        ``from`` and ``to`` being the merges that make it and use it up."""
        found = self.edges[side].get(token)
        if found is None:
            found, now, until = [], token, 1 << 60
            while now in self.parents:
                made = self.parents[now][2]
                found.append((now, made, until))
                now, until = self.parents[now][side], made
            found.append((now, -1, until))
            self.edges[side][token] = found
        return found

    def _apart(self, before: int, token: int) -> bool:
        """Joined, the two are encoded as these two: at no time may a merge join what stands on
        both sides of the seam. Of equal merges the leftmost goes first."""
        rank = self.rank
        for left, left_from, left_to in self._edge(before, 1):
            for right, right_from, right_to in self._edge(token, 0):
                k = rank.get((left, right))
                if k is not None and left_from < k < left_to and right_from < k <= right_to:
                    return False
        return True

    def byte_prefixes(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of all prefixes of all pieces end to end, and where each piece ends.

        All pieces move on by one byte at a time: for every token that ends there and may follow
        the last token of the prefix before it, of which there is exactly one.
        """
        text = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        begins = np.repeat(ends - sizes, sizes)
        limit = np.repeat(ends, sizes)
        up, down = _powers(len(text) + 1)
        sums = np.append(np.uint64(0), np.cumsum(self.mark[text] * up[: len(text)], dtype=np.uint64))
        at_all, length_all, token_all = [], [], []
        where = np.arange(len(text))
        for length, (hashes, numbers) in self.by_length.items():
            where = where[where + length <= limit[where]]
            if not len(where):
                break
            own = (sums[where + length] - sums[where]) * down[where]
            found = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            hit = hashes[found] == own
            at_all.append(where[hit])
            length_all.append(np.full(int(hit.sum()), length))
            token_all.append(numbers[found[hit]])
        at, length = np.concatenate(at_all), np.concatenate(length_all)
        token = np.concatenate(token_all)
        step = at + length - begins[at]
        order = np.argsort(step, kind="stable")
        at, length, token, step = at[order], length[order], token[order], step[order]
        cuts = np.searchsorted(step, np.arange(1, int(sizes.max(initial=0)) + 2))
        last, count = np.full(len(text), -1), np.zeros(len(text), np.int64)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            a, size, t = at[lo:hi], length[lo:hi], token[lo:hi]
            first = a == begins[a]
            before = np.where(first, -1, last[a - 1])
            good = first.copy()
            inner = np.flatnonzero(~first & (before >= 0))
            good[inner] = self.follows(before[inner], t[inner])
            a, size, t, first = a[good], size[good], t[good], first[good]
            to = a + size - 1
            last[to], count[to] = t, np.where(first, 0, count[a - 1]) + 1
        if (count == 0).any():
            raise ValueError("the vocabulary lacks a byte")
        return count, ends

    def _resolve(self, pieces: list[str]) -> list:
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        counts, ends = self.byte_prefixes(raw)
        out = []
        for piece, own, end in zip(pieces, raw, ends.tolist()):
            found = counts[end - len(own) : end]
            if len(own) != len(piece):  # keep those bytes that end a character
                after = np.frombuffer(own[1:] + b" ", np.uint8)
                found = found[(after & 0xC0) != 0x80]
            if piece in self.special:
                found = found.copy()
                found[-1] = 1
            elif piece in SPLIT_INSIDE:  # "'r" is two pieces, "'re" is one
                found = found.copy()
                found[1] = 2
            out.append(found)
        return out

    def count(self, texts: list[str]) -> np.ndarray:
        """Token counts of whole texts."""
        total = np.zeros(len(texts), np.int64)
        for owner, part_ends, at, size in self.table.lookup(texts):
            last = self.table.pool[at + size - 1]
            ends = np.append(0, np.cumsum(last))[part_ends]
            np.add.at(total, owner, np.diff(ends, prepend=0))
        return total

    def prefixes(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the token counts of all its prefixes by code points, longest last."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for owner, part_ends, at, size in self.table.lookup(texts):
            last = self.table.pool[at + size - 1].astype(np.int64)
            before = np.cumsum(last) - last
            counts = gather(self.table.pool, at, size) + np.repeat(before, size)
            chars = np.append(0, np.cumsum(size))[part_ends]
            tokens = np.append(0, np.cumsum(last))[part_ends]
            for k, i in enumerate(owner.tolist()):
                lo, base = (chars[k - 1], tokens[k - 1]) if k else (0, 0)
                already = out[i][-1][-1] if out[i] else 0
                out[i].append(counts[lo : chars[k]] - base + already)
        return [
            self._as_ends(t, np.concatenate(c)) if c else np.zeros(0, np.int64)
            for t, c in zip(texts, out)
        ]

    def _as_ends(self, text: str, counts: np.ndarray) -> np.ndarray:
        """Corrects prefixes that are cut otherwise than the text: one that ends with a whole run
        of white space has the run as one piece, though the run's last character goes with what
        follows in longer prefixes; one that ends inside a special token has ordinary text there.
        """
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        space = _classes()[points] == SPACE
        after = np.append(_classes()[points[1:]], NONE)
        before = np.append(False, space[:-1])
        special = self.table.special
        edges = [0] + [m.end() for m in special.finditer(text)] if special else [0]
        for end in np.flatnonzero(space & before & (after != SPACE) & (after != NONE)).tolist():
            begin = end
            while begin and space[begin - 1]:
                begin -= 1
            run = text[begin : end + 1].encode("utf-8", "surrogatepass")
            counts[end] = (counts[begin - 1] if begin else 0) + self.byte_prefixes([run])[0][-1]
        for k, found in enumerate(special.finditer(text) if special else ()):
            begin = edges[k]
            for cut in WORD_END.finditer(text, begin, found.start()):
                begin = cut.start()
            base = counts[begin - 1] if begin else 0
            for end in range(found.start() + 1, found.end()):
                ids = self.tokenizer.encode(text[begin:end], add_special_tokens=False).ids
                counts[end - 1] = base + len(ids)
        return counts


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    keep_prefixes: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` and, if asked for, ``prefix_tokens``: an array whose k-th
    entry is the exact token count of the first k code points."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            columns = [batch.column(0), batch.column(1)]
            if keep_prefixes:
                found = own.prefixes(texts)
                columns.append(pa.array([int(f[-1]) if len(f) else 0 for f in found], pa.int64()))
                columns.append(pa.array(found, pa.list_(pa.int32())))
            else:
                columns.append(pa.array(own.count(texts), pa.int64()))
            names = ["doc_id", "n_bytes", "n_tokens", "prefix_tokens"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    schema = "doc_id long, n_bytes long, n_tokens long"
    return narrow.mapInArrow(count, schema + ", prefix_tokens array<int>" * keep_prefixes)


def longest_within(prefix_tokens: str | Column, budget: int) -> Column:
    """Code points of the longest prefix that takes at most ``budget`` tokens."""
    col = F.col(prefix_tokens) if isinstance(prefix_tokens, str) else prefix_tokens
    fits = F.transform(col, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0)).cast("long")
