"""Web pages as sequences of text blocks with their tag paths."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

# HTML elements by their part in the layout.
RAW = "script style title".split()
HIDDEN = "noscript template svg math iframe object canvas".split()
HEAD = set("head base link meta".split()) | set(RAW) | set(HIDDEN)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the key closes an open element of the values.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"},
}
for _tag in "article aside div dl footer form h1 h2 h3 h4 h5 h6 header main nav ol section table ul".split():
    CLOSES[_tag] = {"p"}

_TAG = re.compile(r"<(/?)([a-z][a-z0-9:-]*)", re.IGNORECASE)
# a quote opens a value only behind an equals sign; no part is tried twice
_ATTRIBUTES = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>")
_ENDS = {tag: re.compile(rf"<(/?){tag}(?![a-z0-9:-])[^<>]*+>?", re.IGNORECASE) for tag in RAW + HIDDEN}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")

PATH_DIMS, WORD_DIMS, OTHER_DIMS = 192, 32, 4
DIMS = PATH_DIMS + WORD_DIMS + OTHER_DIMS


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int = 0


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    stack: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    links: int = 0
    linked: int = 0

    def add(self, raw: str) -> None:
        if raw:
            self.texts.append(raw)
            if self.links:
                self.linked += len(raw)

    def flush(self) -> None:
        if self.texts:
            raw = "".join(self.texts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                path = tuple(t for _, names in self.stack for t in names)
                self.blocks.append(Block(text, path, self.linked))
        self.texts, self.linked = [], 0

    def open(self, tag: str, attributes: str) -> None:
        closes = CLOSES.get(tag)
        while closes and self.stack and self.stack[-1][0] in closes:
            self.stack.pop()
        names = [tag]
        if attributes:
            for found in _NAMES.finditer(attributes):
                names += ["." + w for w in _WORD.findall((found[1] or found[2] or found[3] or "").lower())]
        self.stack.append((tag, tuple(names)))

    def close(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return


def _behind(page: str, tag: str, at: int) -> int | None:
    """Where an unseen element whose content begins at ``at`` ends; None if nothing closes it."""
    depth, last = 1, None
    for found in _ENDS[tag].finditer(page, at):
        if found[1]:
            depth, last = depth - 1, found.end()
        elif tag in HIDDEN:
            depth += 1
        if not depth:
            break
    return last


def _markup(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``start, end, tag, closing, attributes`` of all markup, the tag empty for comments and elements
    whose content is not shown. What is left open at the end of the page: a script or a style sheet
    takes the rest, and so do a comment and a tag; other elements are taken as if they were not
    there. The time grows with the length of the page, whatever stands in it."""
    at, unclosed = page.find("<"), set()
    while at >= 0:
        found = _TAG.match(page, at)
        end = at + 1
        if found:
            rest = _ATTRIBUTES.match(page, found.end())
            if not rest:
                yield at, len(page), "", False, ""
                return
            end, tag, attributes = rest.end(), found[2].lower(), rest[1]
            if found[1] or tag not in _ENDS or tag in unclosed or (tag in HIDDEN and attributes.endswith("/")):
                yield at, end, tag, bool(found[1]), attributes
            else:
                behind = _behind(page, tag, end)
                if behind is None:
                    unclosed.add(tag)
                    behind = len(page) if tag in ("script", "style") else end
                yield at, behind, tag, True, ""
                end = behind
        elif page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            end = close + 3 if close >= 0 else len(page)
            yield at, end, "", False, ""
        elif page.startswith(("<!", "<?", "</"), at):
            close = page.find(">", at)
            end = close + 1 if close >= 0 else len(page)
            yield at, end, "", False, ""
        at = page.find("<", end)


def blocks(page: str) -> list[Block]:
    """Text blocks in page order: white space runs are one blank, ends are trimmed, character
    references decoded. Block-level tags end a block, inline ones and line breaks do not. The head
    ends at its end tag, or at a tag or text that cannot stand in it."""
    out, at, in_head = _Page(), 0, False
    for start, end, tag, closing, attributes in _markup(page):
        if start > at:
            in_head = in_head and page[at:start].isspace()
            out.add(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "head":
            in_head = not closing
        elif in_head and tag in HEAD:
            continue
        else:
            in_head = False
        if tag in _ENDS:  # closed or passed over
            continue
        if tag in INLINE:
            if tag == "a":
                out.links = max(0, out.links + (-1 if closing else 1))
            elif tag == "br":
                out.texts.append(" ")
            continue
        out.flush()
        if closing:
            out.close(tag)
        elif tag not in VOID and not attributes.endswith("/"):
            out.open(tag, attributes)
    if at < len(page):
        out.add(page[at:])
    out.flush()
    return out.blocks


_BUCKETS: dict[str, int] = {}


def _bucket(name: str) -> int:
    found = _BUCKETS.get(name)
    if found is None:
        if len(_BUCKETS) > 100_000:
            _BUCKETS.clear()
        found = _BUCKETS[name] = zlib.crc32(name.encode("utf-8", "surrogatepass"))
    return found


def features(page: list[Block]) -> np.ndarray:
    """One row a block: hashed tag path, hashed words, length, share of links, place."""
    out = np.zeros((len(page), DIMS), np.float32)
    last: tuple[tuple[str, ...], list[int]] = (), []
    for i, block in enumerate(page):
        if block.path != last[0]:
            last = block.path, [_bucket(name) % PATH_DIMS for name in block.path]
        out[i, last[1]] = 1
        words = block.text.split(" ")
        hashed = np.bincount([_bucket(w) % WORD_DIMS for w in words], minlength=WORD_DIMS)
        out[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = hashed / len(words)
        out[i, -4:] = (
            min(np.log1p(len(words)) / 5, 2),
            min(block.linked / len(block.text), 1),
            i / len(page),
            1,
        )
    return out
