"""Operator 6: the main text of an HTML page by its maximum-scoring region.

A page is a sequence of text runs and tags. Each word of a run has a weight, mostly positive, by
where it stands; each tag has a negative one. One linear scan finds the contiguous region with
the largest sum; its text, without the page's furniture, is the result. The weights are log odds
counted over labelled pages, those that mark their content with one ``article`` element: words in
and out of it by block and link, for pages with such an element and, apart, as if it weren't there,
for pages without.
"""

from __future__ import annotations

import html as _html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .base import prepare

#: Labelled pages that weights are counted over, at most.
LABELLED = 2000
#: Classes of tokens, about: what counts are smoothed by.
CLASSES = 40
#: Elements by kind, and words in a class, id or role that mark page furniture.
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup
option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("aside button dialog fieldset footer header menu nav".split())
MARKS = frozenset("""ad ads adsbox advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment
comments complementary consent contentinfo cookie cookies disqus footer form header login masthead menu modal nav navbar
navigation newsletter notice notices notification pager pagination popup promo promotion related replies reply respond
search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget""".split())
TALK = frozenset("comment comments disqus replies reply respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - {"br"}

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)
    |<svg(?=[\s/>])(?:[^>"']++|"[^"]*"|'[^']*')*+(?<=/)>
    |<(script|style|template|noscript|iframe|textarea|title|svg|select|xmp|noembed|noframes)(?=[\s/>]|$)[^>]*(?:>(?:.*?</\1\s*>|.*)|$)
    |<[!?][^>]*(?:>|$)
    |<(/?)([a-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|$)
    |</?[a-z][^>]*(?:>|$)
    |</[^a-z>][^>]*(?:>|$)""", re.S | re.I | re.X)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _marked(attributes: str) -> str:
    """What the attributes make of an element: "hidden", "talk" or "mark" (page furniture by a word
    of TALK or MARKS), or ""."""
    found = ""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "hidden"
        if name == "style":
            if "display:none" in value.replace(" ", "").lower():
                return "hidden"
        elif name != "aria-hidden":
            words = {w.lower() for w in _WORD.findall(value)}
            found = "talk" if words & TALK else found or ("mark" if words & MARKS else "")
    return found


def _frames(tags: list[str], parents: list[int], marked: list[str], gone: list[bool], runs: list, top: int) -> set[int]:
    """The marked elements below ``top`` that are no furniture but frames of its text: they hold most
    of its words and its first heading, or more than nine tenths of its words (those for comments: all)."""
    if not any(marked):
        return set()
    words, below = [0] * len(tags), [e == top for e in range(len(tags))]
    for kind, value, e in runs:
        if kind == "text" and not gone[e]:
            words[e] += len(value.split())
    for e in range(len(tags) - 1, 0, -1):
        words[parents[e]] += words[e]
    for e in range(1, len(tags)):
        below[e] = below[e] or below[parents[e]]
    heading, over = next((e for e in range(1, len(tags)) if below[e] and not gone[e] and tags[e] in HEADINGS and words[e]), 0), set()
    while heading:
        over.add(heading)
        heading = parents[heading]
    share = lambda e: words[e] / words[top]
    return {e for e in range(1, len(tags)) if marked[e] and below[e] and e != top and words[e] and (
        share(e) > 0.5 and e in over or share(e) > 0.9 and (marked[e] != "talk" or share(e) == 1))}


def parse(page: str) -> list[tuple[str, str, bool | None, str, bool]]:
    """The page as (kind, value, inside, block, link): kind is "text" or "tag" (value: its name);
    inside tells whether it stands in an article or main element, None on a page without;
    furniture, scripts, styles and comments are left out."""
    tags, parents, furniture, marked, holds, runs = ["#"], [0], [False], [""], [False], []
    stack, at, seen_article = [0], 0, 0

    def text(value: str) -> None:
        if value:
            runs.append(("text", value, stack[-1]))

    def close(name: str, stop: frozenset = frozenset()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if tags[stack[k]] == name:
                del stack[k:]
                return
            if tags[stack[k]] in stop:
                return

    for m in _TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        name = m.group(3)
        if name is None:
            continue
        name = name.lower()
        if m.group(2):
            runs.append(("tag", name, stack[-1]))
            close(name)
            continue
        if name in CLOSES_P:
            close("p", BLOCKS - {"p"})
        if name == "li":
            close("li", frozenset(("ul", "ol", "menu")))
        if name not in VOID and not m.group(4).endswith("/"):
            tags.append(name)
            parents.append(stack[-1])
            furniture.append(name in FURNITURE)
            first = name in ("article", "main") and not seen_article
            mark = "" if first or name in ("html", "body", "main") else _marked(m.group(4))
            marked.append(mark or ("mark" if name == "form" else ""))
            holds.append(False)
            stack.append(len(tags) - 1)
            if name in ("article", "main"):
                if not seen_article:
                    for e in stack:
                        holds[e] = True
                seen_article = seen_article or stack[-1]
        runs.append(("tag", name, stack[-1]))
    text(page[at:])
    # what marks itself as furniture yet holds the first article is a frame of the page
    gone = [False]
    for e in range(1, len(tags)):
        gone.append(gone[parents[e]] or (furniture[e] or marked[e] == "hidden") and not holds[e])
    frames = _frames(tags, parents, [m if m != "hidden" else "" for m in marked], gone, runs, seen_article)
    out, inside, block, link = [False], [False], ["#"], [False]
    for e in range(1, len(tags)):
        p = parents[e]
        out.append(out[p] or gone[e] or marked[e] != "" and not holds[e] and e not in frames)
        inside.append(inside[p] or tags[e] in ("article", "main"))
        block.append(tags[e] if tags[e] in BLOCKS else block[p])
        link.append(link[p] or tags[e] == "a")
    return [(kind, value, inside[e] if seen_article else None, block[e], link[e])
            for kind, value, e in runs if not out[e]]


def _group(block: str) -> str:
    return "h" if re.fullmatch("h[1-6]", block) else block if block in ("p", "li", "td", "div", "blockquote", "pre") else "other"


def _classes(kind: str, value: str, inside: bool | None, block: str, link: bool) -> tuple[str, str]:
    """A token's class on a page with an article, and on one without."""
    if kind == "tag":
        return (f"tag {value if value in BLOCKS else 'inline'}",) * 2
    place = f"{_group(block)} {'link' if link else 'plain'}"
    return f"word {'in' if inside else 'out'} {place}", f"word any {place}"


def _default(name: str) -> float:
    kind, *rest = name.split(" ")
    if kind == "tag":
        return -0.3
    if rest[0] != "any":
        return 4.0 if rest[0] == "in" else -4.0
    return -1.0 if rest[2] == "link" else 1.0 if rest[1] in ("p", "h", "blockquote", "pre") else 0.2


def _count(batches):
    for b in batches:
        counts: dict[str, list[int]] = {}
        for page in b["html"]:
            tokens = parse(page or "")
            if not any(t[2] for t in tokens):
                continue
            for kind, value, inside, block, link in tokens:
                n = 1 if kind == "tag" else len(value.split())
                for name in dict.fromkeys(_classes(kind, value, inside, block, link)):
                    counts.setdefault(name, [0, 0])[0 if inside else 1] += n
        yield pd.DataFrame([(k, *v) for k, v in counts.items()], columns=["name", "inside", "outside"])


def fit(pages: DataFrame, most: int = LABELLED) -> dict[str, float]:
    """Weights by class, from at most ``most`` labelled pages chosen by a hash of page_id.

    The result has one entry per class, a number fixed by the code whatever the pages hold.
    """
    prepare(pages.sparkSession)
    ids = (pages.where(F.lower("html").contains("<article")).select("page_id")
           .orderBy(F.xxhash64("page_id"), "page_id").limit(most).select(F.col("page_id").alias("_id")).distinct())
    counted = (pages.select("page_id", "html").join(F.broadcast(ids), F.col("page_id") == F.col("_id"), "left_semi")
               .select("html").mapInPandas(_count, "name string, inside bigint, outside bigint")
               .groupBy("name").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect())
    total_in, total_out = (CLASSES / 2 + sum(r[c] for r in counted) for c in "io")
    weights = {}
    for r in counted:
        odds = math.log((r["i"] + 0.5) / total_in) - math.log((r["o"] + 0.5) / total_out)
        if r["name"].startswith("tag"):
            weights[r["name"]] = min(-0.1, max(-1.0, odds))
        elif r["name"].startswith("word in"):
            weights[r["name"]] = max(0.5, min(4.0, odds))
        else:
            weights[r["name"]] = max(-4.0, min(4.0, odds))
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The text of the page's best region; empty where no word scores above zero."""
    tokens = parse(page or "")
    best, best_from, best_to, total, start = 0.0, 0, 0, 0.0, 0
    for k, (kind, value, inside, block, link) in enumerate(tokens):
        name = _classes(kind, value, inside, block, link)[inside is None]
        weight = weights.get(name, _default(name))
        score = weight if kind == "tag" else weight * len(value.split())
        if total <= 0 and score > 0:
            total, start = 0.0, k
        total += score
        if total > best or total == best and best_to and start == best_from:
            best, best_from, best_to = total, start, k + 1
    parts, block_text = [], []
    for kind, value, *_ in tokens[best_from:best_to]:
        if kind == "text":
            block_text.append(_html.unescape(value))
        elif value in BLOCKS:
            parts.append("".join(block_text))
            block_text = []
    parts.append("".join(block_text))
    return " ".join(" ".join(p.split()) for p in parts if not p.isspace() and p)


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A null or empty html, and a page without content, give an empty text. Repeated rows are each
    extracted; other columns are ignored. Without ``weights`` they are counted over ``pages``.
    """
    prepare(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    weights = fit(pages) if weights is None else weights

    def run(batches):
        for b in batches:
            text = [main_text(p, weights) for p in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": text,
                                "n_chars": [len(t) for t in text]})

    return pages.withColumn("page_id", F.col("page_id").cast("long")).mapInPandas(
        run, "page_id bigint, url string, text string, n_chars bigint")
