"""Ids, prefix counts, packing and token shards against the tokenizer library and brute force."""

import glob
import random
import zlib

import numpy as np
import pytest

from wellspring.llm import bpe, packing, token_counts, token_shards

PATH = bpe.tokenizer_path()
ALPHABET = [
    "'", "s", "re", "ll", "ve", " ", "  ", "\n", "\t", "a", "the", "é", "1", "²", "!", "<|endoftext|>", "<|",
    " ", "中", "🙂", "\x85", "'S", "don't", "ab", "_", "\x00", "　", "٣",
]
DOCS = "doc_id long, text string, piece string, ids string"


def fuzz(n, most, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(ALPHABET, k=draw.randint(0, most))) for _ in range(n)]


def library(text):
    return bpe.encoder(PATH).tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_library():
    texts = fuzz(3000, 14, 1) + ["", "word " * 3000, "x" * 5000]
    ids, offsets = bpe.encoder(PATH).encode(texts)
    for text, lo, hi in zip(texts, offsets, offsets[1:]):
        assert ids[lo:hi].tolist() == library(text), text


def test_long_texts_are_cut_without_effect(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 64)
    texts = [" ".join(fuzz(60, 6, seed)) for seed in range(20)]
    table = bpe.BatchEncoder(PATH)
    ids, offsets = table.encode(texts)
    for text, lo, hi in zip(texts, offsets, offsets[1:]):
        assert ids[lo:hi].tolist() == library(text)


@pytest.mark.parametrize("size", [1024, 2048, 4096, 8192])
def test_self_similar_words_get_their_own_ids(size):
    """Such words and their complements clash under hashes by powers of one factor modulo 2**64."""
    ones = [bin(i).count("1") % 2 for i in range(size)]
    texts = ["".join("ab"[i] for i in ones), "".join("ba"[i] for i in ones)]
    for case in (texts, [" " + t for t in texts], ["é" + t for t in texts]):
        ids, offsets = bpe.BatchEncoder(PATH).encode(case)
        assert [ids[lo:hi].tolist() for lo, hi in zip(offsets, offsets[1:])] == list(map(library, case))
        counted = token_counts.PrefixCounter(PATH).count(case)
        assert counted.tolist() == [len(library(t)) for t in case]


def test_prefix_counts_are_exact_at_every_prefix():
    own = token_counts.counter(PATH)
    texts = fuzz(300, 12, 2)
    for text, counts in zip(texts, own.prefixes(texts)):
        assert list(counts) == [len(library(text[: k + 1])) for k in range(len(text))], text
    assert own.count(texts).tolist() == [len(library(t)) for t in texts]


def test_token_counts_query_and_budget(spark):
    rows = [(1, "the cat sat on the mat", "p", "q"), (None, None, None, None), (1, "the cat sat on the mat", "", ""), (2, "", "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    found = token_counts.count_tokens(docs, PATH, keep_prefixes=True)
    got = sorted(found.select("n_bytes", "n_tokens", token_counts.longest_within("prefix_tokens", 3)).collect())
    ids = library("the cat sat on the mat")
    assert [tuple(r) for r in got] == [(0, 0, 0)] * 2 + [(22, len(ids), len("the cat sat"))] * 2
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_best_fit_decreasing_takes_the_tightest_window():
    draw = np.random.default_rng(3)
    for _ in range(20):
        lengths = draw.integers(1, 65, 200)
        number, offset = packing.best_fit_decreasing(lengths, 64)
        rooms = []
        for item in np.argsort(-lengths, kind="stable"):
            fits = [r for r in rooms if r >= lengths[item]]
            room = min(fits) if fits else 64
            if fits:
                rooms.remove(room)
            rooms.append(room - lengths[item])
            assert offset[item] == 64 - room
        assert number.max() + 1 == len(rooms)


def test_packing_holds_every_id_once(spark):
    texts = [None, "", "one two three", "word " * 700, "a b c d " * 300, "x"] + fuzz(100, 30, 5)
    rows = [(i if i else None, t, "p", "q") for i, t in enumerate(texts)] + [(2, "one two three", "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    pieces = packing.token_pieces(docs, PATH, end_id=1, window=256)
    placed = packing.pack(pieces, window=256, group_rows=40).toPandas()
    assert (placed["length"] <= 256).all()
    want = {}
    for key, text, *_ in rows:
        want.setdefault(key, []).append([*library(text or ""), 1])
    for key, own in placed.groupby("doc_id", dropna=False):
        key = None if key != key else int(key)
        joined = sorted((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.ids_crc32) for r in own.itertuples())
        assert sorted(len(x) for _, x, _ in joined) == sorted(
            len(w[k : k + 256]) for w in want[key] for k in range(0, len(w), 256)
        )
        for start, ids, crc in joined:
            assert any(w[start : start + 256] == ids for w in want[key])
            assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
    for _, own in placed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == (own["length"].cumsum() - own["length"]).tolist()
        assert own["length"].sum() <= 256
    assert packing.pack(packing.token_pieces(docs.limit(0), PATH)).count() == 0


def test_sequences_join_their_pieces(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "", "") for i in range(30)], DOCS)
    placed = packing.pack(packing.token_pieces(docs, PATH, window=64), window=64)
    whole = packing.sequences(placed).collect()
    assert sorted(d for r in whole for d in r["doc_ids"]) == list(range(30))
    for row in whole:
        assert len(row["ids"]) == 4 * row["length"]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_feistel_is_a_permutation(n):
    slots = token_shards.feistel(np.arange(n), n, key=5)
    assert sorted(slots) == list(range(n))
    if n > 100:
        assert (slots != token_shards.feistel(np.arange(n), n, key=6)).any()


def test_token_shards_round_trip_and_addresses(spark):
    texts = [None, "", "one two three", "word " * 90, "x", "one two three"] + fuzz(60, 30, 6)
    rows = [(i if i else None, t, "p", "q") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    stride, shard_rows = 16, 20
    sequences = token_shards.token_sequences(docs, PATH, stride)
    path = token_shards.write_shards(sequences, key=3, stride=stride, shard_rows=shard_rows)
    read = token_shards.read_shards(spark, path, stride, shard_rows).toPandas()
    n = len(read)
    assert sorted(read["slot"]) == list(range(n))
    size = token_shards.record_bytes(stride)
    for r in read.itertuples():
        (name,) = glob.glob(f"{path.removeprefix('file://')}/shard={r.slot // shard_rows}/part-*")
        with open(name, "rb") as file:
            file.seek((r.slot % shard_rows) * size)
            record = file.read(size)
        assert record[16 : 16 + 2 * r.n_tokens] == r.ids and record[-1:] == b"\n"
    for key, text in [(i if i else None, t) for i, t in enumerate(texts)]:
        own = read[read["doc_id"].isna()] if key is None else read[read["doc_id"] == key]
        own = own.sort_values("part")
        assert np.frombuffer(b"".join(own["ids"]), "<u2").tolist() == library(text or "")
    empty = token_shards.write_shards(token_shards.token_sequences(docs.limit(0), PATH))
    assert glob.glob(f"{empty.removeprefix('file://')}/shard=*") == []


def test_vocabulary_is_reached_by_its_own_merges():
    own = token_counts.counter(PATH)
    draw = random.Random(8)
    numbers = draw.sample(range(len(own.tokens)), 2000)
    for a, b in zip(numbers, numbers[1:]):
        joined = own.tokens[a] + own.tokens[b]
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            continue
        ids = [own.tokenizer.token_to_id(t.value) for t in own.tokenizer.model.tokenize("".join(_chars(joined)))]
        assert own._apart(a, b) == (len(ids) == 2 and len(own.tokens[a]) == len(own.tokenizer.id_to_token(ids[0]))), text


def _chars(raw):
    back = {b: c for c, b in token_counts._byte_of_char().items()}
    return [back[b] for b in raw]
