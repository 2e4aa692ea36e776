"""Main text of HTML pages by consensus paths of hosts.

1. Each page is cut into elements; containers get a score from the text in their blocks: in full to the block's
   parent, half to the next, links counting against it. A container's path is its chain of tags with
   their classes, digits generalised.
2. The pages of a host vote in Spark on paths, each with the share of its score a path has there; counts are
   added up before the shuffle, so a host with most pages is no burden to one task.
3. Every page is extracted again from the elements on its host's winning path; a page without such an element
   falls back to its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are left out by tag, role and
class anywhere in the page; see ``_without_named`` for classes that don't leave out.

Defined results: null and empty pages, and pages without text outside what is left out, give the empty text;
unclosed and wrongly nested tags end where an enclosing element ends; a page without a host votes as the
host ""; repeated rows each give a row. Other columns of the input are not read.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm.common import table, texts_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|select|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)[^>]*>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# A start tag of the key ends an open element of these.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LEFT_OUT = frozenset("nav header footer aside form button dialog menu search head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets related recommended ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert popup modal newsletter subscribe "
    "signup login share sharing social comment comments commentlist respond reply replies disqus form pagination pager toolbar".split()
)
MAIN = frozenset("article main".split())
# "has-sidebar" tells what else is on the page.
STATES = frozenset("has with no without not is hide show".split())


@dataclass
class Element:
    tag: str
    path: str
    parent: int
    out: bool
    named: int = 0
    score: float = 0.0


def _labels(attributes: str) -> tuple[list[str], str, bool]:
    words, role, hidden = [], "", False
    if attributes.strip(" /"):
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
            if name == "class" or name == "id":
                words += value.lower().split() if name == "class" else ["#" + value.lower()] if value else []
            elif name == "role":
                role = value.lower()
            elif name == "hidden":
                hidden = True
            elif value.lower() == "articlebody":
                role = role or "main"
    return words, role, hidden


def _named(words: list[str]) -> int:
    """2 if a class or id is one of ``WORDS``, 1 if such a word is a part of one, else 0."""
    named = 0
    for w in words:
        parts = [x for x in re.split(r"[^a-z]+", w) if x]
        if len(parts) == 1 and parts[0] in WORDS:
            return 2
        named |= any(x in WORDS and not (k and parts[k - 1] in STATES) for k, x in enumerate(parts))
    return int(named)


def _without_named(elements: list[Element], blocks: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Mark what is left out by its name, and return the other blocks.

    Articles and main elements are not left out so, nor those with only a part of such a name that hold most of the text. If
    nothing would remain, names don't count on the page.
    """
    size = [0] * len(elements)
    for k, text, _ in blocks:
        size[k] += len(text)
    for i in range(len(elements) - 1, 0, -1):
        size[elements[i].parent] += size[i]
    out = [e.out for e in elements]
    for i, e in enumerate(elements[1:], 1):
        main = e.tag in MAIN or e.path.endswith(".main")
        out[i] = e.out or out[e.parent] or not main and (e.named == 2 or e.named == 1 and 2 * size[i] < size[0])
    if kept := [b for b in blocks if not out[b[0]]]:
        for e, o in zip(elements, out):
            e.out = o
        return kept
    return blocks


def parse(page: str) -> tuple[list[Element], list[tuple[int, str, int]]]:
    """The block elements of a page, and its blocks of text: (element, text, characters in links)."""
    elements = [Element("", "", -1, False)]
    stack, blocks, parts, linked, in_link = [0], [], [], 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text and not elements[stack[-1]].out:
            blocks.append((stack[-1], text, linked))
        parts.clear()
        linked = 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            linked += (m.start() - at) * bool(in_link)
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        closing = m[2] or m[5]
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag == "br":
            parts.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        in_link = 0
        if closing:
            open_tags = [elements[i].tag for i in stack]
            if tag in open_tags[1:]:
                del stack[len(open_tags) - 1 - open_tags[::-1].index(tag) :]
            continue
        if elements[stack[-1]].tag == "p" or re.fullmatch("h[1-6]", elements[stack[-1]].tag) and re.fullmatch("h[1-6]", tag):
            stack.pop()
        while elements[stack[-1]].tag in ENDS.get(tag, ()):
            stack.pop()
        if tag in VOID:
            continue
        words, role, hidden = _labels(m[4] or "")
        named = 0 if tag in ("html", "body") else _named(words)
        out = elements[stack[-1]].out or tag in LEFT_OUT or role in ROLES or hidden
        name = tag + "".join(sorted("." + re.sub(r"\d+", "0", w) for w in words if w[0] != "#")) + (".main" if role == "main" else "")
        elements.append(Element(tag, elements[stack[-1]].path + ">" + name, stack[-1], out, named))
        stack.append(len(elements) - 1)
    if at < len(page):
        parts.append(page[at:])
    flush()
    return elements, _without_named(elements, blocks)


def scored(page: str) -> tuple[list[Element], list[tuple[int, str, int]]]:
    """``parse`` with the scores of containers."""
    elements, blocks = parse(page)
    for k, text, linked in blocks:
        worth = max(0.0, len(text) + 10 - 2.0 * linked)
        e = k if elements[k].tag in ("", "html", "body", "div", "section", "article", "main") and elements[k].parent < 1 else elements[k].parent
        share = 1.0
        while e > 0 and share > 0.2:
            bonus = 4.0 if elements[e].tag in MAIN or elements[e].path.endswith(".main") else 1.0
            elements[e].score += worth * share * bonus
            e, share = elements[e].parent, share / 2
        if e == 0 and share == 1.0:
            elements[0].score += worth
    return elements, blocks


def votes(page: str) -> dict[str, float]:
    """Path to share of the page's score."""
    elements, _ = scored(page)
    total = sum(e.score for e in elements)
    out: dict[str, float] = {}
    for e in elements:
        if e.score > 0:
            out[e.path] = out.get(e.path, 0.0) + e.score / total
    return out


def extract(page: str, path: str | None) -> str:
    """Blocks of the elements on ``path``, of the page's best container if it has none there."""
    elements, blocks = scored(page)
    roots = {i for i, e in enumerate(elements) if e.path == path and not e.out}
    inside = _inside(elements, roots)
    text = [t for k, t, _ in blocks if inside[k]]
    if not text and blocks:
        best = max(range(len(elements)), key=lambda i: (elements[i].score, -i))
        inside = _inside(elements, {best})
        text = [t for k, t, _ in blocks if inside[k]]
    return "\n".join(text)


def _inside(elements: list[Element], roots: set[int]) -> list[bool]:
    inside: list[bool] = []
    for i, e in enumerate(elements):
        inside.append(i in roots or e.parent >= 0 and inside[e.parent])
    return inside


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of every host that has any; of equal ones the shortest, then the first."""

    def voted(batches):
        for batch in batches:
            rows = [(h, p, v) for h, page in zip(batch.column("host").to_pylist(), texts_of(batch.column("html"))) for p, v in votes(page).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["host", "path", "vote"])

    exact = F.sum(F.col("vote").cast("decimal(24,12)")).alias("votes")
    counted = pages.select("host", "html").mapInArrow(voted, "host string, path string, vote double").groupBy("host", "path").agg(exact)
    first = F.min_by("path", F.struct(-F.col("votes"), F.length("path"), F.col("path")))
    return counted.groupBy("host").agg(first.alias("path"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", host_of("url"))

    def extracted(batches):
        for batch in batches:
            texts = [extract(h, p) for h, p in zip(texts_of(batch.column("html")), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    # Spark broadcasts the paths of hosts only while they are small, and splits a large host if it has to shuffle.
    joined = rows.join(winning_paths(rows), "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")


def op3_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op3_host_consensus": op3_host_consensus}
ORACLE: dict[str, str] = {}
