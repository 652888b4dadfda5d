"""Chat formatting, WARC archives, web-page texts and the pipeline."""

import base64
import hashlib
import random
import time

import pytest

from wellspring.llm import chat, html_blocks, html_extract, warc

TURNS = "conv_id long, turn long, role string, text string, turns string, pos string"


# --- chat ------------------------------------------------------------------------------------------
def chat_brute(rows):
    none = lambda x: (x is not None, x) if x is not None else (False, 0)
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((none(turn), role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha(whole), len(loss), sha(loss))
    return out


def test_chat_round_trip(spark):
    draw = random.Random(1)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "s>", "/INST]", " ", "\n", "é🙂", "ok", "$1", "<\\s>", "[\\\\INST]"]
    rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    for conv in range(60):
        for turn in range(draw.randint(1, 7)):
            role = draw.choice(["user", "assistant", "system", "assistant", None, "<s>x</s>[/INST] "])
            text = draw.choice([None, "".join(draw.choices(parts, k=draw.randint(0, 8)))])
            rows += [(conv, turn, role, text)] * draw.choice([1, 1, 1, 2])
    rows += [(None, 0, "user", "x"), (70, None, "assistant", "y"), (70, 1, "assistant", "z")]
    turns = spark.createDataFrame([(*r, "t", "p") for r in rows], TURNS)
    examples = chat.format_examples(turns)
    got = chat.digests(examples)
    assert {r.conv_id: tuple(r)[1:5] for r in got.collect()} == chat_brute(rows)
    for row in examples.collect():
        assert len([r for r in examples.columns]) == 7
        if row.loss_start is not None:
            assert row.formatted.endswith(row.formatted[row.loss_start : row.loss_start + row.loss_length] + "</s>")
    assert chat.digests(chat.format_examples(turns.limit(0))).count() == 0


def test_chat_example_per_reply(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    found = sorted(chat.format_examples(spark.createDataFrame([(*r, "", "") for r in rows], TURNS)).collect())
    part = lambda role, text: f"<s>[INST] {role} [/INST] {text}</s>"
    first = part("user", "a") + part("assistant", "b")
    second = first + part("user", "c") + part("assistant", "d")
    assert [r.formatted for r in found] == [first, second, second + part("user", "e")]
    assert [r.formatted[r.loss_start : r.loss_start + r.loss_length] for r in found[:2]] == ["b", "d"]
    assert found[2].loss_start is None


# --- WARC ------------------------------------------------------------------------------------------
PAGES = "page_id long, url string, html string, payload string, line string"


def record(kind, length, page_id, body):
    return (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{page_id}>\r\n"
        f"Content-Length: {length}\r\n\r\n{body}"
    )


@pytest.mark.parametrize("split", ["128m", "64b", "1000b"])
def test_warc_round_trip(spark, split):
    fake = record("response", 3, 999, "abc\r\n\r\n")
    texts = [
        None, "", "plain", "plain", "WARC/1.0\r\n", "x" + fake + fake, fake[:-4], "ends so\r\n\r\n", "\r\n\r\n",
        "WARC/1.0\r\nContent-Length: 99999999\r\n\r\n", "é🙂" * 50 + "WARC/1.0\r\n" * 30, record("response", 0, 5, ""),
        "a" + "b\r\n" * 3000, fake * 40, "plain",
    ]
    rows = [(i, f"http://x/{i} y", t, "p", "l") for i, t in enumerate(texts)] + [(None, None, "alone", "", ""), (3, "again", "plain", "", "")]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    path = warc.write_archives(warc.records(pages), file_records=4)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read_archives(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = []
    for key, _, text, *_ in rows:
        same = [k for k, _, t, *_ in rows if (t or "") == (text or "") and k is not None]
        first = min(same, default=None)
        kind = "revisit" if first is not None and key is not None and first != key else "response"
        raw = (text or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((kind, key, first if kind == "revisit" else None, digest, len(raw), (text or "") if kind == "response" else ""))
    found = [(r.record_type, r.page_id, r.refers_to, r.payload_digest, r.payload_length, r.payload) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_warc_of_nothing(spark):
    pages = spark.createDataFrame([], PAGES)
    assert warc.read_archives(spark, warc.write_archives(warc.records(pages))).count() == 0


# --- web pages ---------------------------------------------------------------------------------------
PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href='/x'>Home</a></li></ul></nav><div class=\"ad\">Buy now</div>"
    "<article><h1>Title &amp; more</h1><p><b>First\n  part</b> of<br>it &eacute;<p>Second</article>"
    "<footer>&copy; someone</footer></body></html>"
)


@pytest.mark.parametrize(
    "page, want",
    [
        ("<html><head><title>T</title><body><article><p>Text", ["Text"]),
        ("<head><meta charset=x><title>T</title><p>one<p>two", ["one", "two"]),
        ("<head><title>T</title>text at once", ["text at once"]),
        ("<title>never closed<p>text", ["never closed", "text"]),
        ("<p>a<svg><title>x</title><p>b", ["a", "b"]),
        ("<object>x<object>y</object>z</object><p>b", ["b"]),
        ("<iframe src=x><p>b", ["b"]),
        ("<iframe><p>x</iframe><p>b", ["b"]),
        ("<svg/><p>b</p><svg>x</svg>", ["b"]),
        ("<div data-x=it's>b</div><i>c</i>", ["b", "c"]),
        ("<div title='a>b' id=\"x>y\">b</div>", ["b"]),
        ("<p title=\"never closed>a<p>b", ["a", "b"]),
        ("a<!-- <p> -->b<!-- never closed <p>c", ["ab"]),
        ("<SCRIPT>x</Script ><p>b<style>never closed", ["b"]),
        ("a < b & 3<4<p>c <b", ["a < b & 3<4", "c"]),
        ("<!doctype html><?xml x?></3><p>b</p>", ["b"]),
    ],
)
def test_blocks_of_odd_pages(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


@pytest.mark.parametrize(
    "part", ["<a ", "<a x=\"", "<svg>", "<svg><svg ", "<!", "<!--", "</p ", "<object></object>", "<p a='", "<title>", "&lt;<", "<template><b>"]
)
def test_hostile_pages_take_linear_time(part):
    page = part * (1_000_000 // len(part))
    start = time.process_time()
    html_blocks.blocks(page)
    assert time.process_time() - start < 5


def test_blocks():
    found = html_blocks.blocks(PAGE)
    assert [b.text for b in found] == ["Home", "Buy now", "Title & more", "First part of it é", "Second", "© someone"]
    assert found[1].path[-2:] == ("div", ".ad") and "article" in found[4].path
    assert html_blocks.blocks("") == []
    assert [b.text for b in html_blocks.blocks("no markup < here")] == ["no markup < here"]
    assert html_blocks.blocks("<script>never closed <p>text") == []


def test_labeller_on_held_out_layouts():
    draw = random.Random(3)
    mains = [" ".join(draw.choices(["alpha", "beta", "gamma", "delta", "of", "the"], k=draw.randint(5, 60))) for _ in range(60)]
    others = [" ".join(draw.choices(["home", "next", "buy", "login", "now"], k=draw.randint(1, 4))) for _ in range(30)]
    pages = [html_extract.made_page(mains, others, draw) for _ in range(60)]
    model = html_extract.train(pages, made=200, epochs=12)
    right = total = 0
    for _ in range(150):
        own = html_blocks.blocks(html_extract.made_page(mains, others, draw))
        (kept,) = html_extract.label(model, [html_blocks.features(own)])
        right += sum(html_extract.rule_label(b) == k for b, k in zip(own, kept))
        total += len(own)
    assert right / total > 0.95


def test_extract(spark):
    rows = [(i, f"u{i}", PAGE, "p", "l") for i in range(20)] + [(20, None, None, "", ""), (None, "u", PAGE, "", "")]
    pages = spark.createDataFrame(rows, PAGES)
    got = html_extract.extract(pages).collect()
    text = "Title & more\nFirst part of it é\nSecond"
    assert sorted(map(str, map(tuple, got))) == sorted(str((r[0], r[1], text if r[2] else "")) for r in rows)
    assert html_extract.extract(pages.limit(0)).count() == 0
