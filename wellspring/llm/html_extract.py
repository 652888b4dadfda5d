"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. A bidirectional LSTM (numpy) reads for each its hashed tag path
and hashed words, forward and backward over the whole page, and labels it as article or not;
article blocks are joined by line feeds in page order.

The labeller is trained on a bounded sample of the input's own pages (``SAMPLE_PAGES``, those with
the least hashes of their ids). Blocks of the sample are labelled by the names in their tag paths
(article and main against navigation, footers, adverts, forms, comments, ...), and their texts are
also set into pages of other layouts, so that names the input lacks are known as well.

Defined results: a null or empty html, or a page without an article, gives an empty text; null
ids and urls are kept; repeated rows give repeated rows; an empty table gives an empty table (its
labeller is trained on made layouts alone); other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.html_blocks import DIMS, Block, blocks, features

#: Most pages that the labeller is trained on, and layouts made from their texts.
SAMPLE_PAGES = 150
MADE_PAGES = 300
#: Blocks of a training page that are read; labelling reads all blocks of every page.
TRAINING_BLOCKS = 60
HIDDEN = 12
EPOCHS = 14
#: Padded blocks that are labelled at once.
CELLS = 20_000

# Names in tag paths that mark what is not the article.
ASIDE = (
    "nav header footer aside form menu sidebar ad ads advert advertisement banner sponsor sponsored "
    "promo comment comments respond reply disqus notice cookie consent gdpr alert breadcrumb "
    "breadcrumbs pagination pager share sharing social related recommended newsletter subscribe "
    "signup login search popup modal widget toolbar copyright masthead navbar topbar tags meta"
).split()
MAIN = "article main content post entry story body text".split()


def rule_label(block: Block) -> bool:
    """Label of a training block by the names in its path; the innermost telling name decides."""
    article = "article" in block.path or "main" in block.path
    for name in reversed(block.path):
        plain = name.lstrip(".")
        if plain == "header" and article:
            continue
        if plain in ASIDE:
            return False
        if plain in ("article", "main") or (name[0] == "." and plain in MAIN):
            return True
    return False


def _tagged(inside: str, name: str, rng: random.Random) -> str:
    """``inside`` in an element that says ``name`` by its tag, class or id."""
    tags = {"nav", "header", "footer", "aside", "form", "article", "main"}
    kind = rng.random()
    if name in tags and kind < 0.6:
        return f"<{name}>{inside}</{name}>"
    tag = rng.choice(["div", "div", "section", "ul" if "<li>" in inside else "div"])
    key = "id" if kind < 0.75 else "class"
    more = rng.choice(["", "", " box", " block", " inner", f" {name}-list", f" site-{name}"])
    return f'<{tag} {key}="{name}{more}">{inside}</{tag}>'


def made_page(mains: list[str], others: list[str], rng: random.Random) -> str:
    """A page of some layout. ``mains`` are paragraphs of articles, ``others`` short texts."""
    pick = lambda: rng.choice(others)

    def aside() -> str:
        name = rng.choice(ASIDE)
        form = rng.random()
        if form < 0.35:
            inside = "".join(f'<li><a href="#">{pick()}</a></li>' for _ in range(rng.randint(1, 6)))
            inside = f"<ul>{inside}</ul>"
        elif form < 0.7:
            texts = [rng.choice(mains) if rng.random() < 0.5 else pick() for _ in range(rng.randint(1, 3))]
            inside = "".join(f"<p>{t}</p>" for t in texts)
        else:
            inside = pick() if rng.random() < 0.5 else rng.choice(mains)
        return _tagged(inside, name, rng)

    body = [f"<p>{rng.choice(mains)}</p>" for _ in range(rng.randint(1, 8))]
    if rng.random() < 0.7:
        body.insert(0, f"<h1>{pick()}</h1>")
    for _ in range(rng.randint(0, 2)):
        body.insert(rng.randint(0, len(body)), rng.choice([f"<h2>{pick()}</h2>", f"<ul><li>{pick()}</li></ul>", f"<blockquote>{pick()}</blockquote>"]))
    if rng.random() < 0.3:
        body.insert(rng.randint(1, len(body)), aside())
    name = "article" if rng.random() < 0.5 else rng.choice(MAIN)
    parts = [aside() for _ in range(rng.randint(0, 3))] + [_tagged("".join(body), name, rng)]
    parts += [aside() for _ in range(rng.randint(0, 4))]
    whole = "".join(parts)
    if rng.random() < 0.3:
        whole = f'<div class="wrapper">{whole}</div>'
    return f"<html><body>{whole}</body></html>"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one logistic output a block."""

    def __init__(self, rng: np.random.Generator, hidden: int = HIDDEN):
        self.hidden = hidden
        scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.weights = {
            **{f"w{d}": 0.5 * scale(DIMS, 4 * hidden) for d in "fb"},
            **{f"u{d}": scale(hidden, 4 * hidden) for d in "fb"},
            **{f"b{d}": np.repeat(np.array([0, 1, 0, 0], np.float32), hidden) for d in "fb"},
            "o": scale(2 * hidden, 1),
            "c": np.zeros(1, np.float32),
        }

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """One direction over ``x`` (time, pages, features); padding leaves the state as it is."""
        w, n = self.weights, self.hidden
        h = c = np.zeros((x.shape[1], n), np.float32)
        outs, kept = np.zeros((x.shape[0], x.shape[1], n), np.float32), [None] * x.shape[0]
        into = x @ w["w" + d] + w["b" + d]
        for t in range(x.shape[0]) if d == "f" else range(x.shape[0] - 1, -1, -1):
            z = into[t] + h @ w["u" + d]
            i, f, o = (_sigmoid(z[:, k * n : (k + 1) * n]) for k in range(3))
            g = np.tanh(z[:, 3 * n :])
            new = f * c + i * g
            tanh = np.tanh(new)
            on = mask[t][:, None]
            kept[t] = (h, c, i, f, o, g, tanh, on)
            c = np.where(on, new, c)
            h = np.where(on, o * tanh, h)
            outs[t] = h
        return outs, kept

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, d)[0] for d in "fb"], axis=2)
        return (both @ self.weights["o"])[:, :, 0] + self.weights["c"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.weights, self.hidden
        runs = {d: self._run(x, mask, d) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        error = (_sigmoid((both @ w["o"])[:, :, 0] + w["c"]) - y) * mask / mask.sum()
        error = error[:, :, None].astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        grads["o"], grads["c"] = np.einsum("tbh,tbo->ho", both, error), error.sum((0, 1))
        back = error @ w["o"].T
        for k, d in enumerate("fb"):
            own = back[:, :, k * n : (k + 1) * n]
            dh = dc = np.zeros((x.shape[1], n), np.float32)
            dz_all = np.zeros((x.shape[0], x.shape[1], 4 * n), np.float32)
            for t in range(x.shape[0] - 1, -1, -1) if d == "f" else range(x.shape[0]):
                h, c, i, f, o, g, tanh, on = runs[d][1][t]
                dh = dh + own[t]
                dnew = np.where(on, dc + dh * o * (1 - tanh**2), 0)
                dz = np.concatenate(
                    [dnew * g * i * (1 - i), dnew * c * f * (1 - f), np.where(on, dh, 0) * tanh * o * (1 - o), dnew * i * (1 - g**2)],
                    axis=1,
                )
                dz_all[t] = dz
                grads["u" + d] += h.T @ dz
                dc = np.where(on, dnew * f, dc)
                dh = np.where(on, dz @ w["u" + d].T, dh)
            grads["w" + d] = np.einsum("tbd,tbz->dz", x, dz_all, optimize=True)
            grads["b" + d] = dz_all.sum((0, 1))
        return grads


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    most = max(map(len, pages))
    x, mask = np.zeros((most, len(pages), DIMS), np.float32), np.zeros((most, len(pages)), bool)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, True
    return x, mask


def train(pages: list[str], seed: int = 0, made: int = MADE_PAGES, epochs: int = EPOCHS) -> Labeller:
    """A labeller for ``pages`` (a bounded sample) and for layouts made from their texts."""
    rng, draw = random.Random(seed), np.random.default_rng(seed)
    parsed = [own for page in pages if (own := blocks(page)[:TRAINING_BLOCKS])]
    mains = [b.text.replace("<", " ") for own in parsed for b in own if rule_label(b)] or ["one two three four five"]
    others = [b.text.replace("<", " ") for own in parsed for b in own if not rule_label(b)] or ["six seven"]
    others += [" ".join(t.split()[: rng.randint(1, 8)]) for t in mains[:200]]
    parsed += [blocks(made_page(mains, others, rng))[:TRAINING_BLOCKS] for _ in range(made)]
    rows = [(features(own), np.array([rule_label(b) for b in own], np.float32)) for own in parsed if own]
    model = Labeller(draw)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(epochs):
        order = sorted(range(len(rows)), key=lambda i: (len(rows[i][0]) // 8, draw.random()))
        batches = [order[k : k + 32] for k in range(0, len(order), 32)]
        for b in draw.permutation(len(batches)):
            own = [rows[i] for i in batches[b]]
            x, mask = _padded([f for f, _ in own])
            y = np.zeros(mask.shape, np.float32)
            for k, (_, label) in enumerate(own):
                y[: len(label), k] = label
            step += 1
            for key, grad in model.gradients(x, mask, y).items():
                grad = np.clip(grad, -1, 1)
                first[key] = 0.9 * first[key] + 0.1 * grad
                second[key] = 0.999 * second[key] + 0.001 * grad**2
                rate = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                model.weights[key] -= rate * first[key] / (np.sqrt(second[key]) + 1e-8)
    return model


def label(model: Labeller, pages: list[np.ndarray]) -> list[np.ndarray]:
    """For each page whether each block is part of the article; pages of like length go together."""
    out: list[np.ndarray] = [np.zeros(len(p), bool) for p in pages]
    order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
    group: list[int] = []
    for k, i in enumerate(order):
        group.append(i)
        following = order[k + 1] if k + 1 < len(order) else None
        if following is None or (len(group) + 1) * len(pages[following]) > CELLS:
            x, mask = _padded([pages[j] for j in group])
            found = model.scores(x, mask) > 0
            for column, j in enumerate(group):
                out[j] = found[: len(pages[j]), column]
            group = []
    return out


def extract_texts(model: Labeller, pages: list[str]) -> list[str]:
    parsed = [blocks(page) for page in pages]
    kept = label(model, [features(own) for own in parsed])
    return ["\n".join(b.text for b, k in zip(own, keep) if k) for own, keep in zip(parsed, kept)]


def sample_pages(pages: DataFrame, n: int) -> list[str]:
    """At most ``n`` html texts, those whose ids hash lowest; only their ids are sorted."""
    order = F.xxhash64("page_id")
    chosen = pages.select("page_id").where("page_id IS NOT NULL").orderBy(order, "page_id").limit(n)
    # ``chosen`` has at most ``n`` ids
    found = pages.join(F.broadcast(chosen.distinct()), "page_id").where("html IS NOT NULL")
    return sorted(r[0] for r in found.select("html").limit(n).collect())


def extract(pages: DataFrame, sample: int = SAMPLE_PAGES, seed: int = 0) -> DataFrame:
    """``page_id, url, text`` of every page."""
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    model = train(sample_pages(narrow, sample), seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = extract_texts(model, part.column(2).to_pylist())
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    rows = narrow.withColumn("html", F.coalesce("html", F.lit("")))
    return rows.mapInArrow(run, "page_id long, url string, text string")
