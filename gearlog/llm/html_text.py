"""Main text of web pages by line-block distribution.

Markup becomes a list of blocks (one line of text each) with a weight: characters
outside links. Menus, headers, footers, sidebars, notices, adverts, forms and reader
comments give no text. Sums of weights over sliding windows of lines rise at a surge
point, the first window that is dense for its page, and fall back at dive points,
where a whole window is links. Text from the surge on is kept, without the links
from a dive to the next text. Where the page's article or main element holds its
densest window, the text is what these elements hold; an article's own header is text.
Headings, leads and bylines before the surge belong to it, back to the last dive.

Cases: null or empty html gives an empty text; a page without text outside links
gives an empty text; unclosed tags end where their container ends, unclosed
comments and scripts reach to the end of the page; very long pages are read once,
linearly; repeated rows are repeated; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

#: Elements of HTML by what they do to text.
HIDDEN = ("script", "style", "noscript", "template", "svg", "iframe", "object", "head", "title", "textarea", "select", "math", "canvas")
NOISE = ("nav", "footer", "aside", "form", "header", "menu", "dialog", "button")
BLOCKS = ("address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Words of class, id and role names that mark what is not the article.
NOISE_NAMES = ("ad", "ads", "adv", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "search", "share", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget")

#: First and last parts that such a name may have (site-footer, ad-slot).
NAME_PREFIXES = ("site", "page", "main", "top", "bottom", "post", "global", "primary", "secondary")
NAME_SUFFIXES = ("area", "banner", "bar", "block", "box", "buttons", "form", "links", "list", "menu", "section", "slot", "unit", "widget")
#: Words that name the article itself (a name ends with what it names: sidebar-content is
#: content, article-comments are comments), and words that only say how something is.
CONTENT_NAMES = ("article", "body", "content", "contents", "entry", "main", "post", "story", "text")
STATE_NAMES = ("active", "closed", "disabled", "enabled", "has", "hide", "is", "no", "not", "off", "on", "open", "show", "with", "without")
#: Elements that hold the article, whatever their names say.
ROOTS = ("html", "body", "main", "article")
#: Elements whose end tag may be left out, and the start tags that end them.
_CELLS = ("td", "th", "tr", "tbody", "thead", "tfoot")
ENDED_BY = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",), "td": _CELLS, "th": _CELLS, "tr": _CELLS[2:], "tbody": _CELLS[3:], "thead": _CELLS[3:], "tfoot": _CELLS[3:], "p": tuple(set(BLOCKS) - {"legend", "option", "html", "body"})}

_HIDDEN, _NOISE, _BLOCKS, _VOID, _NAMES = map(frozenset, (HIDDEN, NOISE, BLOCKS, VOID, NOISE_NAMES))
_CONTENT, _STATE = frozenset(CONTENT_NAMES), frozenset(STATE_NAMES)
_RAW = frozenset({"script", "style", "textarea", "title", "noscript", "iframe", "template"})
_TAG = re.compile(
    r"<(?:!--(?P<c>.*?)(?:-->|\Z)|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>|[!?][^>]*>)",
    re.S,
)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)
_SPACES = re.compile(r"\s+")

#: Lines per window, and the weight at which a window counts as dense on any page (on
#: pages of short lines, half of the densest window's weight does).
WINDOW, DENSE = 3, 90


def _noise_name(token: str) -> bool:
    if token in _NAMES:
        return True
    parts = token.replace("_", "-").split("-")
    if len(parts) > 1 and parts[0] in NAME_PREFIXES:
        parts = parts[1:]
    if len(parts) > 1 and parts[-1] in NAME_SUFFIXES:
        parts = parts[:-1]
    return len(parts) == 1 and parts[0] in _NAMES


def _noise_class(token: str) -> bool:
    """Class names are made of words on purpose, so any noise word in one counts; ids are
    often made from headings and must be such a name as a whole."""
    if _noise_name(token):
        return True
    parts = token.replace("_", "-").split("-")
    if not _STATE.isdisjoint(parts):
        return False
    return parts[-1] in _NAMES or _CONTENT.isdisjoint(parts) and not _NAMES.isdisjoint(parts)


def _noisy(element: str, attrs: str) -> bool:
    if not attrs or element in ROOTS:
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id", "role"):
            if any(map(_noise_class if name == "class" else _noise_name, value.split())):
                return True
        elif name == "hidden" or name == "aria-hidden" and value.strip() == "true":
            return True
        elif name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int, bool]]:
    """(text, weight without links, inside the article) of each block."""
    out: list[tuple[str, int, bool]] = []
    stack: list[tuple[str, int]] = []  # open elements that matter: name, kind
    NOISE_KIND, ARTICLE, LINK, PLAIN = 1, 2, 3, 0
    noise = article = link = 0
    text: list[str] = []
    plain = 0  # characters of the block outside links

    def leave(i: int) -> None:
        nonlocal noise, article, link
        for _, kind in stack[i:]:
            noise -= kind == NOISE_KIND
            article -= kind == ARTICLE
            link -= kind == LINK
        del stack[i:]

    def end_before(name: str) -> None:  # elements that this start tag ends
        last = None
        for i in range(len(stack) - 1, -1, -1):
            if name in ENDED_BY.get(stack[i][0], ()):
                last = i
            elif stack[i][0] in _BLOCKS:
                break
        if last is not None:
            leave(last)

    def close() -> None:
        nonlocal plain
        if text:
            s = _SPACES.sub(" ", html.unescape("".join(text))).strip()
            if s:
                out.append((s, min(len(s), plain), bool(article)))
            text.clear()
        plain = 0

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        end = m.start() if m else size
        if end > at and not noise:
            piece = page[at:end]
            text.append(piece)
            if not link:
                plain += len(piece.strip())
        if not m:
            break
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            if name in _BLOCKS:
                close()
            elif name == "br":
                text.append(" ")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    leave(i)
                    break
                open_name, kind = stack[i]
                if open_name in ("article", "main") or kind == NOISE_KIND and open_name in _BLOCKS and open_name not in ENDED_BY:
                    break  # a stray end tag doesn't close its container
            continue
        if name in _BLOCKS:
            close()
            if noise:
                end_before(name)
        elif name == "br":
            text.append(" ")
        if name in _RAW:  # skip to its end, markup inside is text
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else (size if name in ("script", "style") else at)
            continue
        if name in _VOID or m["attrs"].endswith("/"):
            continue
        noisy = name in _HIDDEN and name != "head" or name in _NOISE
        if name == "header" and any(n == "article" and kind == ARTICLE for n, kind in stack):
            noisy = False  # an article's own title
        if noisy or _noisy(name, m["attrs"]):
            stack.append((name, NOISE_KIND))
            noise += 1
        elif name in ("article", "main"):
            stack.append((name, ARTICLE))
            article += 1
        elif name == "a":
            if link:  # links don't nest: an open one ends here
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][1] == LINK:
                        del stack[i]
                        link -= 1
                        break
            stack.append((name, LINK))
            link += 1
        elif name in _BLOCKS and name not in ("p", "li"):
            stack.append((name, PLAIN))
    close()
    return out


def _windows(weights: list[int]) -> list[int]:
    return [sum(weights[i : i + WINDOW]) for i in range(len(weights))]


def main_text(page: str | None) -> str:
    """Blocks from the surge point on, without dives, joined by empty lines."""
    if not page:
        return ""
    found = blocks(page)
    inside, outside = ([w for _, w, a in found if a is own] for own in (True, False))
    if inside and max(_windows(inside)) >= max(_windows(outside), default=0):
        return "\n\n".join(t for t, _, a in found if a)
    weights = [w for _, w, _ in found]
    sums = _windows(weights)
    dense = min(DENSE, max(sums, default=0) / 2)
    # surge: a dense window that starts with text, and text goes on after it
    start = next((i for i, w in enumerate(weights) if w and sums[i] >= dense), len(found))
    back = start  # text before the surge is of one piece with it up to the last dive
    while back and back > start - WINDOW + 1 and not weights[back - 1] or back and weights[back - 1]:
        back -= 1
        if weights[back]:
            start = back
    kept: list[str] = []
    links: list[str] = []  # link-only blocks since the last text
    for t, w, _ in found[start:]:
        if not w:
            links.append(t)
            continue
        if len(links) < WINDOW:  # else a dive: a whole window without text
            kept += links
        links = []
        kept.append(t)
    return "\n\n".join(kept)


def extract(pages: DataFrame, keys: list[str], html_col: str = "html") -> DataFrame:
    """``keys``, text (empty if none) and n_chars of every page."""
    kept = pages.select(*keys, html_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[: len(keys)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [main_text(p) for p in b.column(len(keys)).to_pylist()]
            columns = [b.column(i) for i in range(len(keys))]
            columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "text", "n_chars"])

    return kept.mapInArrow(run, f"{schema}, text string, n_chars long")
