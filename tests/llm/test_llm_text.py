"""Quality rules, decontamination, the Jaccard join and shuffled shards against brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wellspring.llm import components, decontaminate, jaccard_join, quality, shuffle_shards

DOCS = "doc_id long, text string, words string, cls string, shard string"
BLANK = r"[\x20\x09-\x0D]+"


def docs_of(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, "w", "c", "s") for i, t in zip(ids, texts)], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- quality ---------------------------------------------------------------------------------
def features(text):
    text = text or ""
    words = [w for w in re.split(BLANK, text) if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.sub(BLANK, "", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(hit),
    )


def test_quality_features(spark):
    draw = random.Random(1)
    parts = ["a", "b", "the", "Ü", "#", "* x", "\n", "\n\n", " ", "\t", "\x0b", " ", "🙂", "&&"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(300)]
    texts += [None, "", " \n ", "a b c " * 2000, "same line\n" * 5, "a b c"]
    texts += texts[:3]
    got = quality.judge(docs_of(spark, texts)).collect()
    for row, text in zip(sorted(got), texts):
        want = features(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want, text
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row.base_failed and row.kept)
    assert quality.judge(docs_of(spark, texts).limit(0)).count() == 0


def test_quality_keeps_clean_and_drops_junk(spark):
    clean = " ".join(f"the word{i} of place{i} is number{i}" for i in range(20))
    junk = " ".join(f"word{i}###" for i in range(100))
    lines = "\n".join(["the same line of this text is here"] * 3 + [f"the {i} line of it is new" for i in range(3)])
    kept = quality.keep_good(docs_of(spark, [clean, junk, lines, "short", None]))
    assert kept.columns == ["doc_id", "text", "words", "cls", "shard"]
    assert [r.doc_id for r in kept.collect()] == [0]


# --- decontamination ---------------------------------------------------------------------------
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def scan_brute(text, items, window=10):
    words = [w for w in re.split(GAP, lower(text or "")) if w]
    hit, found = set(), set()
    for item, body in items:
        own = [w for w in re.split(GAP, lower(body or "")) if w]
        size = min(window, len(own))
        if item is None or not own:
            continue
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination(spark):
    import hashlib

    draw = random.Random(2)
    vocabulary = ["a", "b", "c", "dé", "e5", "Ff", "g"]
    sentence = lambda n: " ".join(draw.choices(vocabulary, k=n))
    items = [(i, sentence(n)) for i, n in enumerate([1, 2, 3, 4, 5, 7, 9, 10, 11, 14, 20, 30, 30])]
    items += [(5, items[5][1]), (99, None), (98, "..."), (None, "a b"), (7, sentence(12)), (50, "z")]
    texts = [sentence(draw.randint(0, 40)) for _ in range(60)]
    for _ in range(60):
        body = draw.choice(items[:13])[1].split()
        low = draw.randint(0, max(0, len(body) - 10))
        part = body[low : low + draw.randint(8, 30)]
        texts.append(sentence(draw.randint(0, 9)) + " " + "; ".join(part).upper() + "!" + sentence(draw.randint(0, 9)))
    texts += [None, "", items[12][1] * 40]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    ids = [i // 2 if i < 20 else i for i in range(len(texts))]  # repeated ids, other texts
    ids[5] = None
    docs = docs_of(spark, texts, ids)
    got = decontaminate.scan(docs, benchmark).collect()
    want = []
    for key, text in zip(ids, texts):
        n, hit, found = scan_brute(text, items)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        want.append((key, n, hit, len(found), digest, hit > 0))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    clean = decontaminate.keep_clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not w[-1] for w in want)
    none = decontaminate.scan(docs, benchmark.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(texts)
    assert decontaminate.scan(docs.limit(0), benchmark).count() == 0


# --- Jaccard join --------------------------------------------------------------------------------
def sets_brute(texts, size):
    out = []
    for text in texts:
        words = [w for w in re.split(BLANK, lower(text or "")) if w]
        out.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    return out


def groups_brute(ids, texts, size, num, den):
    sets = sets_brute(texts, size)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and den * common >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        least.setdefault(find(i), []).append(key)
    return [
        (key, len(s), min((k for k in least[find(i)] if k is not None), default=None) if s else key)
        for i, (key, s) in enumerate(zip(ids, sets))
    ]


def edited(words, n, draw):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


def hard_corpus(seed):
    """Copies, near copies around the threshold, chains of edits, short and shared texts."""
    draw = random.Random(seed)
    texts = [None, "", " ", "one", "one", "One Two", "one two", "a b c d e", "a b c d e f"]
    for length in (9, 12, 20, 35, 80, 200, 420):
        base = [f"w{draw.randrange(400)}" for _ in range(length)]
        texts.append(" ".join(base))
        for n in (0, 1, 1, 2, 3, length // 60, length // 40, length // 20):
            texts.append(" ".join(edited(base, n, draw)))
        chain = base
        for _ in range(5):
            chain = edited(chain, max(1, length // 70), draw)
            texts.append(" ".join(chain))
        texts.append(" ".join(base[: length - 2]))
        texts.append(" ".join(base + ["tail"]))
    shared = " ".join(f"s{k}" for k in range(12))
    texts += [shared + " " + " ".join(f"u{i}x{k}" for k in range(draw.randint(1, 30))) for i in range(40)]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("size, similarity, seed", [(3, (90, 100), 1), (5, (80, 100), 2), (1, (7, 10), 3)])
def test_jaccard_components(spark, size, similarity, seed):
    texts = hard_corpus(seed)
    ids = [1000 - i for i in range(len(texts))]
    ids[4] = None
    got = jaccard_join.components(docs_of(spark, texts, ids), size, similarity).collect()
    want = groups_brute(ids, texts, size, *similarity)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_jaccard_star_of_many_near_copies(spark):
    """A group whose members are similar to their source, not to each other."""
    draw = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(edited(base, 2, draw)) for _ in range(150)] + [" ".join(base)] * 3
    texts += [" ".join(edited(base, 8, draw)) for _ in range(20)]
    ids = list(range(len(texts)))
    got = jaccard_join.components(docs_of(spark, texts, ids), 3, (90, 100)).collect()
    assert sorted(map(tuple, got)) == sorted(groups_brute(ids, texts, 3, 90, 100))


@pytest.mark.parametrize("star", [1, 10**6])
def test_jaccard_stars_and_direct_pairs_alike(spark, monkeypatch, star):
    monkeypatch.setattr(jaccard_join, "STAR", star)
    texts = hard_corpus(3)
    ids = list(range(len(texts)))
    got = jaccard_join.components(docs_of(spark, texts, ids), 3, (80, 100)).collect()
    assert sorted(map(tuple, got)) == sorted(groups_brute(ids, texts, 3, 80, 100))


def test_jaccard_unrelated_texts_are_not_brought_together(spark, monkeypatch):
    """Segments that are empty in unrelated texts make pairs, but no texts travel for these."""
    draw = random.Random(8)
    texts = [" ".join(draw.choice("abcdefghijklmnop") * 3 + str(draw.randrange(99)) for _ in range(60)) for _ in range(400)]
    compared, verify = [], jaccard_join.verify

    def counted(pairs, *args, **kwargs):
        compared.append(pairs.count())
        return verify(pairs, *args, **kwargs)

    monkeypatch.setattr(jaccard_join, "verify", counted)
    ids = list(range(len(texts)))
    got = jaccard_join.components(docs_of(spark, texts, ids), 5, (80, 100)).collect()
    assert {r.component_id for r in got} == set(ids)
    assert sum(compared) < 20


@pytest.mark.parametrize("outsiders", [0, 5, 512])
def test_jaccard_outsiders_by_sketches_and_by_differences_alike(spark, monkeypatch, outsiders):
    monkeypatch.setattr(jaccard_join, "STAR", 1)
    monkeypatch.setattr(jaccard_join, "OUTSIDERS", outsiders)
    texts = hard_corpus(6)
    ids = list(range(len(texts)))
    got = jaccard_join.components(docs_of(spark, texts, ids), 3, (80, 100)).collect()
    assert sorted(map(tuple, got)) == sorted(groups_brute(ids, texts, 3, 80, 100))


def test_jaccard_no_differences_of_few_outsiders(spark, monkeypatch):
    """Unrelated texts that share a bucket with a hub are ruled out by sketches."""
    monkeypatch.setattr(jaccard_join, "STAR", 1)
    draw = random.Random(8)
    shared = " ".join(f"s{k}" for k in range(30))
    texts = [shared + " " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) for _ in range(60)]
    differing, verify = [], jaccard_join.verify

    def counted(pairs, texts, shingle, diff=False):
        if diff:
            differing.append(pairs.count())
        return verify(pairs, texts, shingle, diff)

    monkeypatch.setattr(jaccard_join, "verify", counted)
    ids = list(range(len(texts)))
    got = jaccard_join.components(docs_of(spark, texts, ids), 5, (80, 100)).collect()
    assert {r.component_id for r in got} == set(ids)
    assert not differing


def test_jaccard_many_outsiders_are_never_paired(spark, monkeypatch):
    """Unrelated texts that share a passage: pairs would grow with the square of their number."""
    monkeypatch.setattr(jaccard_join, "STAR", 1)
    draw = random.Random(12)
    shared = " ".join(f"s{k}" for k in range(30))
    texts = [shared + " " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) for _ in range(120)]
    texts += [texts[0] + " one", texts[1] + " two"]
    paired, sketched, exact = [], jaccard_join.sketched_pairs, jaccard_join.outsider_pairs

    def counted(members, *args):
        paired.extend((r.outs, r.all) for r in members.selectExpr("sig", "cast(out as int) o").groupBy("sig").agg(F.sum("o").alias("outs"), F.count("o").alias("all")).collect())
        return sketched(members, *args)

    def differing(members, *args):
        assert members.count() < 10
        return exact(members, *args)

    monkeypatch.setattr(jaccard_join, "sketched_pairs", counted)
    monkeypatch.setattr(jaccard_join, "outsider_pairs", differing)
    ids = list(range(len(texts)))
    got = jaccard_join.components(docs_of(spark, texts, ids), 5, (80, 100)).collect()
    assert sorted(map(tuple, got)) == sorted(groups_brute(ids, texts, 5, 80, 100))
    assert all(outs <= 16 for outs, _ in paired)


@pytest.mark.parametrize("more", [0, 0.5, 3])
def test_jaccard_members_that_may_be_similar_meet(spark, monkeypatch, more):
    monkeypatch.setattr(jaccard_join, "MORE", more)
    draw = random.Random(13)
    passage = [f"p{k}" for k in range(20)]
    texts = [passage + [f"h{k}" for k in range(60)]]
    for i in range(30):
        base = passage + [f"u{i}x{k}" for k in range(draw.randint(40, 90))]
        texts += [base, edited(base, draw.randint(0, 12), draw)] if i % 3 == 0 else [base]
    sets = sets_brute([" ".join(t) for t in texts], 2)
    rows, schema = [], "hub long, cls long, n long, root long, out boolean, size long, overlap long"
    most = lambda n: int(n * 20 / 180)
    for i, own in enumerate(sets[1:], 1):
        size, top = len(own ^ sets[0]), most(len(own) + int(len(own) * 100 / 80))
        rows.append((-5, i, len(own), i, True, size, max(1, size - top)))
    members = spark.createDataFrame(rows, schema)
    stored = [(i or -5, bytearray(" ".join(t).encode())) for i, t in enumerate(texts)]
    stored = spark.createDataFrame(stored, "cls long, text binary")
    left = {r.cls for r in jaccard_join.meeting(members, stored, 2).collect()}
    similar = {
        i for i in range(1, len(sets)) for j in range(1, len(sets))
        if i != j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    }
    assert similar and similar <= left
    assert len(left) < 25 or not more


def test_jaccard_unsettled_members_by_plain_search(spark):
    draw = random.Random(14)
    verified, roots, want = [], [(0, 0)], {}
    sizes = [draw.randrange(1, 400) for _ in range(120)]
    outs = [draw.random() < 0.3 for _ in sizes]
    for c, (size, out) in enumerate(zip(sizes, outs), 1):
        verified.append((0, c, 0, size, 50))
        if not out:
            roots.append((c, 0))
    for c, (size, out) in enumerate(zip(sizes, outs), 1):
        rest = [s for k, (s, o) in enumerate(zip(sizes, outs), 1) if k != c and (out or o)]
        if any(abs(s - size) <= 12 for s in rest):
            want[c] = out
    verified = spark.createDataFrame(verified, "a long, b long, common long, total long, n_b long")
    found = jaccard_join.unsettled(verified, spark.createDataFrame(roots, "id long, root long"), (80, 100))
    assert {r.cls: r.out for r in found.collect()} == want
    assert "rowframe, 1, unboundedfollowing" not in found._jdf.queryExecution().toString().lower()


def test_jaccard_batches_of_texts_are_small(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, "10000")
    for rows, within in ((before, "1024"), ("100", "100"), ("0", "1024")):
        spark.conf.set(name, rows)
        with jaccard_join.small_batches(spark):
            assert spark.conf.get(name) == within
        assert spark.conf.get(name) == rows
    spark.conf.set(name, before)


def test_sketches_never_part_similar_sets():
    draw = random.Random(9)
    for _ in range(300):
        n, edits = draw.randrange(1, 400), draw.randrange(0, 60)
        words = [f"w{draw.randrange(500)}" for _ in range(n)]
        pair = [" ".join(words).encode(), " ".join(edited(words, edits, draw)).encode()]
        doc, token = jaccard_join.shingle_sets(pair, 3)
        sizes = jaccard_join.fingerprints(doc, token, 2)[0]
        one, two = (set(token[doc == k].tolist()) for k in (0, 1))
        sketches = jaccard_join.sketches(doc, token, sizes)
        similar = 80 * len(one | two) <= 100 * len(one & two)
        assert jaccard_join.may_be_similar(*sketches, (80, 100)) or not similar
    assert not jaccard_join.may_be_similar(b"\x09" * 8, b"\x00\x02" * 8, (80, 100))
    assert jaccard_join.may_be_similar(b"", b"\x09" * 8, (80, 100))


def test_jaccard_outsiders_meet_at_rare_differences_only(spark, monkeypatch):
    written = []

    def kept(df):
        written.append(df.cache())
        return written[-1]

    monkeypatch.setattr(jaccard_join, "materialize", kept)
    schema = "hub long, cls long, n long, root long, out boolean, size long, overlap long"
    # 40 members differ from their hub in 3 tokens that all have and in 20 of their own
    own = {c: [1000 * c + i for i in range(20)] for c in range(1, 41)}
    own[40] = own[1][:19] + [99]
    members = spark.createDataFrame([(0, c, 100, c, c <= 20, 23, 18) for c in own], schema)
    diffs = [(0, c, [-3, -2, -1] + tokens) for c, tokens in own.items()]
    differences = spark.createDataFrame(diffs, "a long, b long, diff array<long>")
    pairs = jaccard_join.outsider_pairs(members, differences, (90, 100)).collect()
    assert [tuple(r) for r in pairs] == [(40, 1)]
    assert {r.cls for r in written[0].collect()} == {1, 40}


def test_jaccard_keep_one(spark):
    texts = ["a b c d e f g", "A b c d e f g", None, None, "x y z x y z", "a b c d e f g"]
    docs = docs_of(spark, texts, [7, 3, 4, 4, 5, 3])
    kept = jaccard_join.keep_one(docs, 3, (80, 100))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 4, 5]
    assert jaccard_join.keep_one(docs.limit(0)).count() == 0
    assert jaccard_join.components(docs.limit(0)).count() == 0


def test_bands_bound_differences():
    for num, den in ((9, 10), (4, 5)):
        bands = jaccard_join.Bands((num, den))
        bands.extend(400)
        for small in range(1, 300):
            for large in range(small, bands.partner(small) + 1):
                common = -(-num * (small + large) // (num + den))
                band = max(k for k, low in enumerate(bands.low) if low <= small)
                assert small + large - 2 * common < bands.segments[band]


def test_connected(spark):
    draw = random.Random(5)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    root = {x: x for pair in links for x in pair}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = {r.id: r.root for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k not in loops}


# --- shuffled shards -------------------------------------------------------------------------------
def test_shuffled_shards(spark):
    texts = [None, "", "é"] + ["same text"] * 120 + [f"text {i}" * (i % 7) for i in range(200)]
    docs = docs_of(spark, texts, [None, *[1] * 50, *range(51, len(texts))])
    rows = shuffle_shards.shard(docs, shards=16, seed=3, bucket_bytes=500).toPandas()
    assert len(rows) == len(texts)
    sizes = rows.groupby("shard").size()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 1
    for _, own in rows.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert sorted(rows["text"].fillna("-")) == sorted(t if t is not None else "-" for t in texts)
    assert sorted(rows["size"]) == sorted(1 + len((t or "").encode()) for t in texts)
    again = shuffle_shards.shard(docs, shards=16, seed=3, bucket_bytes=500).toPandas()
    key = ["shard", "slot"]
    assert rows.sort_values(key)["text"].tolist() == again.sort_values(key)["text"].tolist()
    other = shuffle_shards.shard(docs, shards=16, seed=4, bucket_bytes=500).toPandas()
    assert rows.sort_values(key)["text"].tolist() != other.sort_values(key)["text"].tolist()
    assert shuffle_shards.shard(docs.limit(0)).count() == 0
    few = shuffle_shards.shard(docs.limit(3), shards=16)
    path = shuffle_shards.write_shards(few)
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("size", [1024, 2048])
def test_self_similar_words_are_different_words(spark, size):
    """One-word texts that clash under hashes by powers of one factor modulo 2**64."""
    ones = [bin(i).count("1") % 2 for i in range(size)]
    texts = ["".join("ab"[i] for i in ones), "".join("ba"[i] for i in ones), "".join("ab"[i] for i in ones)]
    found = jaccard_join.components(docs_of(spark, texts, [1, 2, 3]), 3, (90, 100)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (2, 2), (3, 1)]
