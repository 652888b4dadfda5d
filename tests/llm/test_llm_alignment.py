"""Alignment of two tokenizers against the libraries and plain counting."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece

from wellspring.llm import alignment, bpe, queries

SF = "/root/testdata/sf0.001"
A_PATH, B_PATH = bpe.tokenizer_path(), bpe.tokenizer_path("piece_bpe_32k.model")
A = bpe.BatchEncoder(A_PATH, plain=True)
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
ALPHABET = ["a", "the", " ", "  ", "\n", "\t", "é", "1", "<s>", "<|endoftext|>", "中", "🙂", "\x00", "ab", "x", "<0x41>", "ﬁ", "\r\n", "     "]


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def plain(text):
    """Ids and links of one text by the libraries, as ``a, b, groups text, links, n_groups``."""
    a = A.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
    b = B.encode(text) if text else []
    if b"".join(map(b_bytes, b)) != (" " + text).encode() or not text:
        return [], [], "", [], 0
    a_ends = np.cumsum([int(A.width[i]) for i in a]).tolist()
    b_ends = np.cumsum([len(b_bytes(i)) for i in b]).tolist()
    links = [
        (a[i], b[j])
        for i, (s, e) in enumerate(zip([0, *a_ends], a_ends))
        for j, (u, v) in enumerate(zip([0, *b_ends], b_ends))
        if s < v and u < e
    ]
    ends = sorted(set(a_ends) & set(b_ends))
    groups = []
    for lo, hi in zip([0, *ends], ends):
        own = [[str(i) for i, e in zip(ids, at) if lo < e <= hi] for ids, at in ((a, a_ends), (b, b_ends))]
        groups.append("|".join(map(",".join, own)))
    return a, b, ";".join(groups), links, len(ends)


def brute(rows):
    found = [(doc_id, *plain(text or "")) for doc_id, text in rows]
    counts = Counter(pair for row in found for pair in set(row[4]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return sorted(
        (
            doc_id or -(10**6),
            len(a),
            len(b),
            n_groups,
            len(links),
            sum(counts[p] == best[p[0]] for p in links),
            sum(counts[p] for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if a else "",
        )
        for doc_id, a, b, groups, links, n_groups in found
    )


def result(rows):
    return sorted((r[0] or -(10**6), *tuple(r)[1:]) for r in rows)


def fuzz(n, most, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(ALPHABET, k=draw.randint(0, most))) for _ in range(n)]


def test_unit_ids_are_those_of_the_library(monkeypatch):
    encoder = alignment.UnitEncoder(B_PATH)
    texts = [t for t in fuzz(2000, 12, 1) if t] + ["word " * 300, " ", "  ", "x"]
    for size in (bpe.CHUNK_CHARS, 16):
        monkeypatch.setattr(bpe, "CHUNK_CHARS", size)
        ids, cuts = bpe.joined_values(encoder.table, [" " + t for t in texts])
        for text, lo, hi in zip(texts, cuts, cuts[1:]):
            assert ids[lo:hi].tolist() == B.encode(text), repr(text)


def test_postings_come_back():
    draw = random.Random(2)
    links = [(draw.randrange(300), draw.randrange(40), draw.randrange(900)) for _ in range(4000)]
    links += [(7, 7, 5)] * 1000 + [(8, 8, i) for i in range(900)]
    keys = np.array([(a << alignment.B_BITS | b) << alignment.DOC_BITS | d for a, b, d in links])
    got = Counter()
    for _, pairs, n_docs, docs, planes in alignment.invert(keys):
        pairs = np.cumsum(alignment._unpack(pairs, np.int64))
        n_docs = alignment._unpack(n_docs, np.uint16).astype(np.int64)
        ordinal, times = alignment.postings(n_docs, docs, planes)
        for pair, doc, n in zip(np.repeat(pairs, n_docs).tolist(), ordinal.tolist(), times.tolist()):
            got[pair >> alignment.B_BITS, pair & ((1 << alignment.B_BITS) - 1), doc] += n
    assert got == Counter(links)


@pytest.mark.parametrize("chunks", [1, 256])
def test_scores_equal_plain_counting(spark, chunks, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 400)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 200)
    monkeypatch.setattr(alignment, "GROUP_CHUNKS", chunks)
    texts = fuzz(120, 25, 3) + ["a▁b", "the the the", "the the the", "", None, " "]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the a"), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(alignment.align(docs, A_PATH, B_PATH).collect()) == brute(rows)


def test_edges_of_the_operator(spark):
    schema = "doc_id long, text string, chunk string, slice int, n_a string"
    rows = [(1, None, "", 1, ""), (2, "", "", 1, ""), (3, "a▁b", None, None, "")]
    docs = spark.createDataFrame(rows, schema)
    got = alignment.align(docs, A_PATH, B_PATH).collect()
    assert result(got) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
    assert alignment.align(docs.limit(0), A_PATH, B_PATH).count() == 0


def test_query_equals_plain_counting(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op11_token_alignment"](spark, SF)
    short = [tuple(r) for r in rows if len(r.text or "") < 3000]
    tokens = {doc_id: plain(text or "") for doc_id, text in short}
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows)
    for doc_id, (a, b, groups, links, n_groups) in tokens.items():
        own = found[doc_id]
        assert (own.n_a, own.n_b, own.n_groups, own.n_links) == (len(a), len(b), n_groups, len(links))
        assert own.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if a else "")
    if len(short) == len(rows):
        assert result(found.values()) == brute(short)
