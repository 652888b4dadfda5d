"""Removal of repeated passages against brute force; sketches against plain counts."""

import random

import numpy as np
import pytest

from wellspring.llm import substring_dedup as sd


def brute(rows, window):
    """Kept words of ``(doc_id, text)`` with distinct ids, in order."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        words = text.encode().split()
        drop = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                drop.update(range(i, i + window))
            seen.add(key)
        out[doc_id] = b" ".join(w for i, w in enumerate(words) if i not in drop).decode()
    return out


def test_packed_numbers_come_back():
    draw = random.Random(1)
    for _ in range(300):
        most = draw.choice([3, 300, 70000, 1 << 20])
        numbers = np.unique([draw.randrange(most) for _ in range(draw.randint(0, 60))]).astype(np.int64)
        assert sd.unpack(sd.pack(numbers)).tolist() == numbers.tolist()
    for numbers in ([], [0], [254, 255, 256, 510, 511], [65535, 131070, 200000]):
        assert sd.unpack(sd.pack(np.array(numbers, np.int64))).tolist() == numbers


def test_window_keys_do_not_clash_on_self_similar_texts():
    # sequences on which hashes by powers of one factor modulo 2**64 agree
    for size in (1024, 2048):
        bits = [bin(i).count("1") % 2 for i in range(size)]
        texts = [[b"ab"[b : b + 1] for b in bits], [b"ba"[b : b + 1] for b in bits]]
        _, _, k1, k2 = sd.window_keys(texts, size)
        assert len(k1) == 2 and k1[0] != k1[1] and k2[0] != k2[1]


@pytest.mark.parametrize("bits", [3, 12])
def test_sketch_never_loses_a_repeat(spark, bits, monkeypatch):
    monkeypatch.setattr(sd, "SLICE_BITS", 4)
    draw = random.Random(bits)
    texts = [" ".join(draw.choices("abc", k=draw.randint(0, 12))) for _ in range(200)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    cells = sd.repeated_cells(docs, 3, bits).collect()
    sketch = sd.Sketch(bits, min(bits, 4), [(r.slice, bytes(r.cells)) for r in cells])
    words = [t.encode().split() for t in texts]
    _, _, k1, k2 = sd.window_keys(words, 3)
    counts = {}
    for key in k1.tolist():
        counts[key] = counts.get(key, 0) + 1
    assert sketch.repeated(k1, k2)[[counts[k] > 1 for k in k1.tolist()]].all()


@pytest.mark.parametrize("bits", [3, 16])
def test_kept_words_equal_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(sd, "CANDIDATES", 50)
    monkeypatch.setattr(sd, "SLICE_BITS", 3)
    draw = random.Random(bits)
    shared = [" ".join(draw.choices("abcdef", k=9)) for _ in range(5)]
    rows = []
    for doc_id in draw.sample(range(-500, 500), 150):
        parts = [draw.choice(shared) if draw.random() < 0.5 else " ".join(draw.choices("abcdef", k=6)) for _ in range(draw.randint(0, 6))]
        rows.append((doc_id, draw.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(doc_id + 2000, text) for doc_id, text in rows[:20]]  # exact copies
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sd.remove_repeats(docs, window=4, sketch_bits=bits).collect()
    want = brute(rows, 4)
    assert len(got) == len(rows) and {r.doc_id: r.kept for r in got} == want
    sizes = {doc_id: len(text.split()) for doc_id, text in rows}
    assert all(r.n_words == sizes[r.doc_id] for r in got)
    assert all(r.n_removed == r.n_words - len(r.kept.split()) for r in got)


def test_edges_of_the_operator(spark):
    text = " ".join(f"w{i}" for i in range(30))
    schema = "doc_id long, text string, mark string, start int, covered string, k1 string"
    rows = [
        (None, text, "", 1, "", ""),
        (1, text + " x", "", 1, "", ""),
        (1, text + " x", None, 2, "", ""),
        (2, None, None, None, None, None),
        (3, "", "", 0, "", ""),
        (4, "a " * 20000, "", 0, "", ""),
    ]
    got = sd.remove_repeats(spark.createDataFrame(rows, schema)).collect()
    kept = sorted(((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got))
    assert kept == [
        (0, 30, 0, text),
        (1, 31, 30, "x"),
        (1, 31, 30, "x"),
        (2, 0, 0, ""),
        (3, 0, 0, ""),
        (4, 20000, 19999, "a"),
    ]
    twice = spark.createDataFrame(rows[1:3] * 2, schema)
    assert [r.n_removed for r in sd.remove_repeats(twice).collect()] == [0] * 4
    assert sd.remove_repeats(twice.limit(0)).count() == 0
