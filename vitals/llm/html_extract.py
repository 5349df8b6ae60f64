"""Operator 10: main text of web pages by consensus host paths.

1. Each page's containers (elements that hold blocks of text) are scored: letters of text in them that is neither
   boilerplate nor link, more for article-like tags and names, less for every level they lie above the text.
2. Spark sums the scores of each generalised path (tags with the first class or id, digits taken out) by host; the
   path with the largest sum wins. Scores are combined map-side, so a hot host costs no more than another.
3. Each page is read again and its text taken from the containers on its host's winning path; a page without such
   a container uses its own best one, and its body if it has none.

Boilerplate is left out by tag (menus, headers, footers, asides, forms, scripts, styles ...) and by the
words in class, id and role (advert, cookie, comment, share ...). Character references are decoded, white space
inside a block becomes one space, blocks are joined by two newlines.

Reading a page takes time in proportion to its length, however it is broken: a tag whose quoted value never ends is cut at
its first ``>``, and quotes count no more on the rest of that page; after the last ``>`` all is text; steps of a path beyond
``PATH_CHARS`` characters are folded into a digest, so deep nesting costs no more per level.

Cases: null or empty html gives the empty text; null url is a host of its own; unclosed, stray and badly nested tags
are read as browsers roughly do; ties between paths go to the smaller path; repeated rows and page_ids are each
extracted; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import prepare, rows_batches, stage

# FIXED VALUES: tag and name lists
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
DROP = frozenset("head nav header footer aside form script style noscript template iframe svg button select option textarea menu dialog object canvas audio video input label".split())
CONTAINERS = frozenset("article main section div td body".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
INLINE_ENDS = frozenset("a abbr b bdi bdo cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
JUNK = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert[^\W\d_]*+|adsense|sponsor[^\W\d_]*+|promo[^\W\d_]*+|banner|cookies?|consent|gdpr|notices?|notification|alert|popup|modal|overlay|newsletter|subscribe|signup|login"
    r"|sidebar|side|rail|widget[^\W\d_]*+|related|recommend[^\W\d_]*+|share|sharing|social|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|footer|header|masthead|topbar|comments?|replies|reply|respond|disqus|tags|skip)"
    r"(?:$|[-_\s\d])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
GOOD = re.compile(r"article|content|main|post|entry|story|text|body", re.I)
# end of fixed values

OPEN = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|([!?]))")
#: The rest of a tag; possessive, so it is read once whether it ends or not.
REST = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
ATTRIBUTE = re.compile(r"(?<![^\s=\"'/>])([^\s=\"'/>]++)\s*+=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
SPACE = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")
#: Longer paths go on from a digest of what they have.
PATH_CHARS = 400


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): _html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(text)} if "=" in text else {}


def step(tag: str, attrs: dict[str, str]) -> str:
    """A generalised path step: the tag with its first class, or id, without digits."""
    name = (attrs.get("class", "").split() or attrs.get("id", "").split() or [""])[0]
    return f"{tag}.{DIGITS.sub('', name)}" if name else tag


def is_junk(tag: str, attrs: dict[str, str]) -> bool:
    if tag in DROP or attrs.get("role", "").lower() in ROLES or attrs.get("aria-hidden") == "true" or "hidden" in attrs:
        return True
    return tag not in ("html", "body", "article", "main") and any(JUNK.search(attrs[k]) for k in ("class", "id") if k in attrs)


def below(path: str, step_: str) -> str:
    """The path of a step under ``path``."""
    if len(path) > PATH_CHARS:
        path = "~" + xxhash.xxh3_128_hexdigest(path)
    return f"{path}>{step_}" if path else step_


def read(page: str) -> tuple[list[tuple[str, int]], list[tuple[str, int, str, int, int]]]:
    """Blocks (text, letters outside links) in page order and containers (path, depth, last step, first block, end block)."""
    blocks: list[tuple[str, int]] = []
    containers: list[tuple[str, int, str, int, int]] = []
    stack: list[list] = []  # [tag, path, last step, first block, is container, hides its content]
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    shut: list[int] = []  # places of blocks in the stack
    words: list[str] = []
    linked = hidden = links = at = 0
    last, quotes = page.rfind(">"), True

    def close_block():
        nonlocal linked
        text = SPACE.sub(" ", "".join(words)).strip()
        words.clear()
        if text:
            blocks.append((text, max(0, len(text) - linked)))
        linked = 0

    def say(text):
        nonlocal linked
        if text and not hidden:
            text = _html.unescape(text)
            words.append(text)
            if links:
                linked += len(text.strip())

    def pop():
        nonlocal hidden, links
        tag, path, name, first, box, hides = stack.pop()
        opened[tag].pop()
        hidden -= hides
        links -= tag == "a"
        if tag in BLOCKS:
            shut.pop()
            close_block()
        if box and len(blocks) > first:
            containers.append((path, len(stack), name, first, len(blocks)))

    while at < len(page):
        m = OPEN.search(page, at)
        # an open comment needs no end, all else ends at a later ">"
        if not m or (m.end() > last and not m[1]):
            say(page[at:])
            break
        say(page[at : m.start()])
        if m[1]:  # comment
            end = page.find("-->", m.start() + 4)
            at = len(page) if end < 0 else end + 3
            continue
        rest = REST.match(page, m.end()) if quotes and not m[4] else None
        quotes = quotes and (m[4] is not None or rest is not None)
        at = rest.end() if rest else page.find(">", m.end()) + 1
        if m[4]:
            continue
        tag, inside = m[3].lower(), page[m.end() : at - 1]
        if m[2]:
            if opened.get(tag):
                # an inline end tag doesn't close blocks around it
                if tag in INLINE_ENDS and shut and shut[-1] > opened[tag][-1]:
                    continue
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag in BLOCKS:
                close_block()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = len(page) if not end else end.end()
            continue
        if tag in BLOCKS:
            close_block()
            # blocks end an open paragraph, items end open items of the same list
            ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
            if shut and (stack[shut[-1]][0] == "p" or stack[shut[-1]][0] in ends):
                at_block = shut[-1]
                while len(stack) > at_block:
                    pop()
        if tag in VOID or inside.endswith("/"):
            if tag == "br" or tag == "hr":
                words.append(" ")
            continue
        attrs = attributes(inside)
        hides, name = int(is_junk(tag, attrs)), step(tag, attrs)
        opened.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            shut.append(len(stack))
        stack.append([tag, below(stack[-1][1] if stack else "", name), name, len(blocks), tag in CONTAINERS and not hidden and not hides, hides])
        hidden += hides
        links += tag == "a"
    close_block()
    while stack:
        pop()
    return blocks, containers


def scores(page: str) -> list[tuple[str, float]]:
    """(generalised path, score) of a page's containers."""
    blocks, containers = read(page)
    letters = np.concatenate([[0], np.cumsum([n for _, n in blocks])]) if blocks else np.zeros(1)
    best: dict[str, float] = {}
    for path, depth, last, a, b in containers:
        weight = 1.0 + 0.5 * last.startswith(("article", "main")) + 0.2 * bool("." in last and GOOD.search(last))
        best[path] = best.get(path, 0.0) + float(letters[b] - letters[a]) * weight * (1 + 0.02 * depth)
    return list(best.items())


def extract(page: str, path: str | None) -> str:
    """The text of the containers on ``path``, else of the page's best path, else of the whole page."""
    blocks, containers = read(page)
    spans = [(a, b) for p, _, _, a, b in containers if p == path]
    if not spans:
        ranked = sorted(scores(page), key=lambda s: (-s[1], s[0]))
        spans = [(a, b) for p, _, _, a, b in containers if ranked and p == ranked[0][0]] or [(0, len(blocks))]
    chosen = sorted({i for a, b in spans for i in range(a, b)})
    return "\n\n".join(blocks[i][0] for i in chosen)


def host_of(column: str = "url"):
    return F.lower(F.regexp_extract(F.col(column), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _vote(batches):
    """Scores of paths by host, combined per batch."""

    def rows():
        for batch in batches:
            total: dict[tuple, list] = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for path, score in scores(page or ""):
                    got = total.setdefault((host, path), [0, 0])
                    got[0] += round(score)
                    got[1] += 1
            for (host, path), (score, n) in total.items():
                yield host, path, score, n

    return rows_batches(rows(), pa.schema([("host", pa.string()), ("path", pa.string()), ("score", pa.int64()), ("pages", pa.int64())]))


_OUT_PA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _extract(batches):
    def rows():
        for batch in batches:
            for page_id, url, page, path in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "path")), strict=True):
                yield page_id, url, extract(page or "", path)

    return rows_batches(rows(), _OUT_PA, 200)


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, path: the path with the largest score on each host; one row per host."""
    votes = pages.select(host_of().alias("host"), "html").mapInArrow(_vote, "host string, path string, score long, pages long")
    summed = votes.groupBy("host", "path").agg(F.sum("score").alias("score"))
    return summed.groupBy("host").agg(F.min_by("path", F.struct(-F.col("score"), F.col("path"))).alias("path"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page row."""
    prepare(pages.sparkSession)
    won = stage(winning_paths(pages), "html-paths").withColumnRenamed("host", "h")
    rows = pages.select("page_id", "url", "html", host_of().alias("host"))
    joined = rows.join(won, F.col("host").eqNullSafe(F.col("h")), "left")
    return joined.select("page_id", "url", "html", "path").mapInArrow(_extract, "page_id long, url string, text string")
