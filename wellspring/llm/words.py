"""Words of texts as numbers and marks, for operators that work on blocks of whole texts."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np

#: Words handled at once; a longer text is a block of its own.
BLOCK_WORDS = 1 << 18


def blocks(texts: list[bytes | None], most: int = BLOCK_WORDS) -> Iterator[list[list[bytes]]]:
    """Words of UTF-8 texts (null: none), in blocks of about ``most`` words and whole texts."""
    block: list[list[bytes]] = []
    total = 0
    for text in texts:
        words = text.split() if text else []  # bytes split at ASCII white space only
        if block and total + len(words) > most:
            yield block
            block, total = [], 0
        block.append(words)
        total += len(words)
    if block:
        yield block


def numbered(block: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of all words of a block end to end, where each text ends, and the distinct words."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ends = np.cumsum([len(words) for words in block])
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(block)), np.int64, int(ends[-1]))
    return ids, ends, list(number)


def marks(words: list[bytes], key: bytes) -> np.ndarray:
    """Two 64-bit numbers for every word, the same in every process: halves of a keyed digest."""
    digests = b"".join([blake2b(word, digest_size=16, key=key).digest() for word in words])
    return np.frombuffer(digests, np.uint64).reshape(-1, 2)
