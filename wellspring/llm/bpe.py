"""Byte-level BPE over whole batches of texts: cut into pieces with numpy, look pieces up.

A byte-level BPE tokenizer first cuts a text into pieces (words with the blank before them, runs of
digits, of signs, of white space) and then encodes every piece by itself. Pieces repeat a lot, so a
task cuts a batch of texts into pieces with array operations, looks them up in a bounded table and
asks the resolver only for pieces it has not got. Ids are those of the tokenizers library, which
encodes the missing pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

#: Characters handled at once. Arrays of this length are what a task holds besides its input.
CHUNK_CHARS = 1 << 19
#: Slots of the piece table, and values it may hold before it starts anew.
SLOT_BITS = 21
POOL_VALUES = 1 << 23

LETTER, NUMBER, SPACE, NONE = 1, 2, 3, 9
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Shared:
    """Tables that all encoders of a process share, made on first use."""

    classes: np.ndarray | None = None
    marks: tuple[np.ndarray, np.ndarray] | None = None
    places: tuple[np.ndarray, np.ndarray] | None = None
    powers: tuple[np.ndarray, np.ndarray] | None = None


def _classes() -> np.ndarray:
    if _Shared.classes is None:
        import regex

        chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        table = np.zeros(0x110000, np.uint8)
        for cls, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for run in regex.findall(pattern, chars):
                table[np.frombuffer(run.encode("utf-32-le"), np.uint32)] = cls
        _Shared.classes = table
    return _Shared.classes


def _marks() -> tuple[np.ndarray, np.ndarray]:
    """Two random 64-bit numbers for every code point, the same in every process."""
    if _Shared.marks is None:
        rng = np.random.default_rng(20)
        _Shared.marks = tuple(rng.integers(0, 2**64, 0x110000, np.uint64) for _ in range(2))
    return _Shared.marks


def _places(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two random odd 64-bit factors for every place within a piece. They are independent: hashes
    by powers of one factor agree on self-similar strings, whatever the factor."""
    if _Shared.places is None or len(_Shared.places[0]) < n:
        size = 1 << max(n - 1, 1023).bit_length()
        draw = (np.random.default_rng(seed).integers(0, 1 << 63, size, np.uint64) for seed in (21, 22))
        _Shared.places = tuple(factors * np.uint64(2) + np.uint64(1) for factors in draw)
    return _Shared.places


def word_factors(n: int) -> np.ndarray:
    """Random odd factors for at least the first ``n`` places of a word."""
    return _places(n)[0]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse modulo 2**64."""
    if _Shared.powers is None or len(_Shared.powers[0]) < n:
        size = max(n, CHUNK_CHARS) + 1
        inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
        up, down = np.full(size, _FACTOR), np.full(size, inverse)
        up[0] = down[0] = 1
        _Shared.powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _Shared.powers


def piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Positions in ``points`` (code points of texts laid end to end) where a piece starts.

    The rule of byte-level BPE: ``'s 't 're 've 'm 'll 'd``, letters, digits, other signs, the
    latter three with one blank before them, and white space, whose last character stands alone
    when something else follows.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    first = np.zeros(n, bool)
    first[text_starts] = True
    cls = _classes()[points]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = NONE, cls[:-1]
    before[first] = NONE
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = NONE, cls[1:]
    after[:-1][first[1:]] = NONE
    space = cls == SPACE
    blank = points == 32
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~first
    starts = first | (~space & (cls != before) & ~after_blank)
    starts |= space & (before != SPACE)
    starts |= space & (after != SPACE) & (after != NONE)
    # contractions
    quote = np.flatnonzero((points == 39) & starts & (after == LETTER))
    if len(quote):
        pad = np.append(points, np.zeros(3, points.dtype))
        edge = np.append(first, np.ones(3, bool))
        one, two = pad[quote + 1], pad[quote + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ~edge[quote + 2] & np.logical_or.reduce(
            [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
        )
        for at, length in ((quote[single], 2), (quote[double & ~single], 3)):
            starts[at + 1] = False
            end = at + length
            end = end[(end < n)]
            starts[end] |= cls[end] == LETTER
    return np.flatnonzero(starts)


class PieceTable:
    """Values of pieces (ids, counts, ...) found by ``resolve`` once and kept in bounded memory.

    ``starts`` cuts texts into pieces, and very long texts may be cut at any match of ``cut``.
    """

    def __init__(
        self,
        special: list[str],
        resolve: Callable[[list[str]], list],
        dtype: type,
        starts: Callable[[np.ndarray, np.ndarray], np.ndarray] = piece_starts,
        cut: str = r"(?<=\S)\s",
    ):
        self.resolve, self.dtype = resolve, dtype
        self.starts, self.cut = starts, re.compile(cut)
        ordered = sorted((s for s in special if s), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self._clear()

    def _clear(self) -> None:
        slots = 1 << SLOT_BITS
        self.key1, self.key2 = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.at, self.size = np.zeros(slots, np.int32), np.zeros(slots, np.int32)
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def _add(self, values: list) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, values), np.int64, len(values))
        total = int(sizes.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        at = self.used + np.cumsum(sizes) - sizes
        if total:
            self.pool[self.used : self.used + total] = np.concatenate(
                [np.asarray(v, self.dtype) for v in values]
            )
        self.used += total
        return at, sizes

    def _parts(self, texts: list[str]) -> Iterator[tuple[int, str, bool]]:
        """Texts cut at special tokens, and very long ones where a run of white space begins."""
        for i, text in enumerate(texts):
            cut = self.special.split(text) if self.special and self.special.search(text) else [text]
            for k, part in enumerate(cut):
                while len(part) > CHUNK_CHARS and k % 2 == 0:
                    found = self.cut.search(part, CHUNK_CHARS // 2)
                    if not found:
                        break
                    yield i, part[: found.start()], False
                    part = part[found.start() :]
                if part:
                    yield i, part, k % 2 == 1

    def lookup(self, texts: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        """For groups of whole parts of ``texts``, in order: ``(owner, part_ends, at, size)``.

        ``owner`` has the text of each part, ``part_ends`` the number of pieces up to its end;
        ``at`` and ``size`` say where in ``pool`` the values of each piece are. They hold until
        the next group is asked for.
        """
        group: list[tuple[int, str, bool]] = []
        length = 0
        for part in self._parts(texts):
            if group and length + len(part[1]) > CHUNK_CHARS:
                yield self._group(group)
                group, length = [], 0
            group.append(part)
            length += len(part[1])
        if group:
            yield self._group(group)

    def _group(self, group: list[tuple[int, str, bool]]) -> tuple[np.ndarray, ...]:
        if self.used > POOL_VALUES:
            self._clear()
        joined = "".join(part for _, part, _ in group)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter((len(p) for _, p, _ in group), np.int64, len(group))
        text_ends = np.cumsum(lengths)
        starts = self.starts(points, text_ends - lengths)
        for (_, _, whole), end, size in zip(group, text_ends, lengths):
            if whole:  # a special token is one piece
                lo, hi = np.searchsorted(starts, [end - size + 1, end])
                starts = np.delete(starts, slice(lo, hi))
        ends = np.append(starts[1:], len(points))
        sizes = ends - starts
        place = np.arange(len(points)) - np.repeat(starts, sizes)
        keys = [
            np.add.reduceat(marks[points] * factors[place], starts)
            for marks, factors in zip(_marks(), _places(int(sizes.max())))
        ]
        key1, key2 = keys
        key1 |= np.uint64(1)  # zero marks a free slot
        slot = (key1 >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        missing = np.flatnonzero((self.key1[slot] != key1) | (self.key2[slot] != key2))
        if len(missing):
            pair = np.empty(len(missing), [("a", np.uint64), ("b", np.uint64)])
            pair["a"], pair["b"] = key1[missing], key2[missing]
            _, one, inverse = np.unique(pair, return_index=True, return_inverse=True)
            new = missing[one]
            values = self.resolve([joined[s:e] for s, e in zip(starts[new], ends[new])])
            new_at, new_size = self._add(values)
            at[missing], size[missing] = new_at[inverse], new_size[inverse]
            where = slot[new]
            self.key1[where], self.key2[where] = key1[new], key2[new]
            self.at[where], self.size[where] = new_at, new_size
        owner = np.fromiter((i for i, _, _ in group), np.int64, len(group))
        return owner, np.searchsorted(starts, text_ends), at, size


def gather(pool: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``pool[at : at + size]`` laid end to end."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(at - (ends - size), size) + np.arange(total)]


def joined_values(table: PieceTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Values of all pieces of all texts end to end, and offsets (one more than texts) into them."""
    counts = np.zeros(len(texts), np.int64)
    values = []
    for owner, part_ends, at, size in table.lookup(texts):
        values.append(gather(table.pool, at, size))
        ends = np.append(0, np.cumsum(size))[part_ends]
        np.add.at(counts, owner, np.diff(ends, prepend=0))
    offsets = np.append(0, np.cumsum(counts))
    return (np.concatenate(values) if values else np.zeros(0, table.dtype)), offsets


def load_tokenizer(path: str):
    """The tokenizers object of a byte-level BPE file that cuts pieces as this module does."""
    from tokenizers import Tokenizer

    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in spec["added_tokens"])
    if (
        spec["model"]["type"] != "BPE"
        or spec.get("normalizer")
        or pre.get("type") != "ByteLevel"
        or pre.get("add_prefix_space")
        or not pre.get("use_regex", True)
        or not plain
    ):
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
    return Tokenizer.from_file(path), spec


class BatchEncoder:
    """Ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    With ``plain``, the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        self.tokenizer, spec = load_tokenizer(path)
        self.tokenizer.encode_special_tokens = plain
        special = [] if plain else [t["content"] for t in spec["added_tokens"]]
        size = 1 + max(spec["model"]["vocab"].values())
        # a byte-level token has one character for each of its bytes
        self.width = np.ones(size, np.int64)
        for token, at in spec["model"]["vocab"].items():
            self.width[at] = len(token)
        self.table = PieceTable(special, self._resolve, np.uint32)

    def _resolve(self, pieces: list[str]) -> list:
        """Ids of pieces. Words with a blank before them are the same pieces when run together,
        and the library takes half the time for them in texts of some hundred words."""
        out: list = [None] * len(pieces)
        words = [i for i, p in enumerate(pieces) if p[0] == " " and p[1:].isalpha()]
        rest = [i for i, p in enumerate(pieces) if not (p[0] == " " and p[1:].isalpha())]
        encode = self.tokenizer.encode_batch_fast
        for i, found in zip(rest, encode([pieces[i] for i in rest], add_special_tokens=False)):
            out[i] = found.ids
        groups = [words[k : k + 200] for k in range(0, len(words), 200)]
        texts = ["".join([pieces[i] for i in group]) for group in groups]
        for group, found in zip(groups, encode(texts, add_special_tokens=False)):
            ids = np.array(found.ids, np.uint32)
            ends = np.cumsum([len(pieces[i].encode()) for i in group])
            cuts = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
            for i, lo, hi in zip(group, [0, *cuts[:-1]], cuts):
                out[i] = ids[lo:hi]
        return out

    def count(self, texts: list[str]) -> np.ndarray:
        """How many ids each text has."""
        counts = np.zeros(len(texts), np.int64)
        for owner, part_ends, _, size in self.table.lookup(texts):
            ends = np.append(0, np.cumsum(size))[part_ends]
            np.add.at(counts, owner, np.diff(ends, prepend=0))
        return counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of all texts end to end, and ``offsets`` (one more than texts) into them."""
        return joined_values(self.table, texts)


_ENCODERS: dict[tuple[str, bool], BatchEncoder] = {}


def encoder(path: str, plain: bool = False) -> BatchEncoder:
    """One encoder a process and file; Python workers keep it from task to task."""
    if (path, plain) not in _ENCODERS:
        _ENCODERS[path, plain] = BatchEncoder(path, plain)
    return _ENCODERS[path, plain]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
