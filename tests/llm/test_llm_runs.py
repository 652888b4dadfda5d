"""Periodic runs against a brute-force search, and the query against a plain replay."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from wellspring.llm import queries, runs

SF = "/root/testdata/sf0.001"


def brute_runs(words, min_length=6, min_exponent=4):
    """Runs by trying every period at every place."""
    n, found = len(words), set()
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(min_length, min_exponent * q):
                stretch = words[i : j + q]
                if not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found)


def fuzz(draw):
    k = draw.choice([1, 2, 3, 5])
    words = [draw.randrange(k) for _ in range(draw.randint(0, 50))]
    if draw.random() < 0.6:
        root = [draw.randrange(k) for _ in range(draw.randint(1, 6))]
        words[len(words) // 2 : 0] = root * draw.randint(1, 9) + root[: draw.randint(0, len(root))]
    return words


@pytest.mark.parametrize("min_length, min_exponent", [(6, 4), (2, 2), (4, 3)])
def test_runs_equal_brute_force(min_length, min_exponent):
    draw = random.Random(min_length)
    for _ in range(400):
        texts = [fuzz(draw) for _ in range(draw.randint(1, 4))]
        flat = np.array(sum(texts, []), np.int64)
        ends = np.cumsum([len(t) for t in texts])
        found = runs.block_runs(flat, ends, min_length, min_exponent)
        assert [found.get(i, []) for i in range(len(texts))] == [
            brute_runs(t, min_length, min_exponent) for t in texts
        ]


def test_long_repetitive_texts_end():
    for words in ([1] * 60000, list(range(700)) * 100):
        found = runs.block_runs(np.array(words, np.int64), np.array([len(words)]))
        assert found == {0: [(0, len(words), len(set(words)))]}


def test_edges_of_the_operator(spark, monkeypatch):
    monkeypatch.setattr(runs, "BLOCK_WORDS", 4)  # blocks are cut between documents only
    rows = [
        (1, "a b a b a b a b c", "x", 1),
        (1, "a b a b a b a b c", "x", 2),
        (2, None, None, None),
        (3, "", "", None),
        (None, "     \n", "", 3),
        (4, " z" * 9 + "\t", "", 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int")
    got = {r.doc_id: r for r in runs.find_runs(docs).collect()}
    assert runs.find_runs(docs).count() == 6 and runs.find_runs(docs.limit(0)).count() == 0
    assert [tuple(r) for r in got[1].runs] == [(0, 8, 2)] and got[1].collapsed == "a b c"
    assert got[2].n_words == got[3].n_words == 0 and got[2].collapsed == "" and got[2].runs == []
    assert got[None].n_words == 2 and got[None].collapsed == "    "
    assert [tuple(r) for r in got[4].runs] == [(0, 9, 1)] and got[4].collapsed == "z"
    with pytest.raises(ValueError):
        runs.find_runs(docs, min_exponent=1)


def test_query_equals_plain_replay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, text in docs:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = brute_runs(words)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        drop = {i for s, length, q in found for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
        text = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        want[doc_id] = (
            n,
            len(found),
            *(best or (None,) * 3),
            best and 1000 * best[1] // best[2],
            hashlib.sha256(text.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest(),
        )
    got = queries.QUERIES["op12_periodic_runs"](spark, SF)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert any(row[1] for row in want.values())
