"""Main text of HTML pages by minimum-cut labelling of their text blocks.

1. A page is cut into blocks: the text between block-level tags, with the open
   elements around it. Comments, scripts, styles, heads and form controls are no text.
2. Each block gets log-odds of being content, a sum of what the elements around
   it say (semantic tags and roles, and the names in ``class`` and ``id``) and of a logistic
   model of the text itself (length, links, sentence marks, kind of block). Tags, roles and
   names that stand for boilerplate alone ("sidebar", "cookie-notice") weigh more than any text; content
   tags, and names that an article's sections have too ("related", "legal"), weigh less; a word
   that is only part of a name ("related-work") weighs least. The model is fitted on the blocks of a sample of an expected
   ``SAMPLE_PAGES`` pages (twice as many at most, ``PAGE_EXAMPLES`` blocks of each) whose elements leave
   no doubt; without enough of both kinds ``DEFAULT_WEIGHTS`` stand in.
3. Log-odds become terminal capacities. Neighbouring blocks, and blocks with
   the same parent, are tied by edges whose capacity halves with every step to
   their nearest common ancestor, and falls where only one of the two is marked
   as boilerplate. The minimum cut labels the blocks.

Character references are decoded, white space in a block becomes one space, and
the content blocks are joined in page order by one line feed.

Edge cases: a null or empty page, or one without text, gives an empty text; an
element that is never closed ends with its parent; a comment or script that is
never closed runs to the end of the page; repeated rows repeat; pages of any length are whole (a page, its
blocks and its graph take some 20 times its bytes); other columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicast.llm.common import chunks
from indicast.llm.mincut import label

SAMPLE_PAGES = 2000
MIN_EXAMPLES = 30

# HTML's element kinds, and words of classes and ids.
NO_TEXT = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "select",
           "textarea", "button", "option", "datalist", "canvas", "audio", "video", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
         "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
         "tbody", "td", "tfoot", "th", "thead", "tr", "ul"} | NO_TEXT
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "menu", "dialog"}
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
                     "menu", "menubar", "form", "status", "toolbar"}
# Names that stand for boilerplate alone, and words that also name sections of an article.
FIRM_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "breadcrumb", "breadcrumbs", "comment", "comments",
    "commentlist", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav",
    "navbar", "navigation", "newsletter", "notification", "overlay", "pager", "pagination", "popup", "sidebar", "signup",
    "sitemap", "sponsor", "sponsored", "sponsors", "subscribe", "toolbar", "topbar", "widgets"}
LOOSE_WORDS = {
    "alert", "banner", "copyright", "disclaimer", "feedback", "foot", "form", "legal", "notice", "notices", "promo",
    "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "skip", "social",
    "teaser", "widget"}
HEADER_WORDS = {"header", "head", "top"}
CONTENT_WORDS = {"article", "content", "entry", "main", "post", "story", "text"}
# Words that name a part of the layout beside another word.
LAYOUT_WORDS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "column", "container", "global", "holder",
    "inner", "item", "items", "left", "links", "list", "outer", "page", "panel", "posts", "primary", "right", "row",
    "secondary", "section", "site", "stories", "wrap", "wrapper"}
COMMENT_TITLES = {"comments", "reader comments", "leave a comment", "leave a reply", "kommentare", "commentaires",
                  "comentarios"}

_TAG = re.compile(r"<(?:!--(?:.*?-->|.*)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[!?/][^>]*>)", re.S)
_LOOSE = re.compile(r"(/?)([a-zA-Z][^\s/>]*)([^>]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "title", "textarea", "noscript", "iframe")}

#: What the elements around a block say, as log-odds: content (tags, roles, names), boilerplate (tags, roles, firm
#: names), a name of a loose word, a name with such a word among others, the same for words of content, hidden.
INSIDE, OUTSIDE, LOOSE, HINT_OUT, HINT_IN, HIDDEN = 2.5, -6.0, -3.5, -1.5, 1.0, -30.0
#: The text model's log-odds are kept within this: it can outvote names and content tags.
TEXT_LIMIT = 4.0
TIE, MARKED = 2.0, 0.25
#: Blocks of one page that the text model is fitted to, at most.
PAGE_EXAMPLES = 200


@dataclass
class Element:
    tag: str
    parent: Element | None
    depth: int
    cue: int = 0  # 1 in content, -1 in boilerplate, -2 hidden, 0 unknown
    firm: bool = False  # boilerplate that no class word inside can turn
    odds: float = 0.0  # log-odds of content that the elements around give


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _attributes(raw: str) -> dict[str, str]:
    """Names (lower case) and values of a tag's attributes; of a repeated name the first."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), next((v for v in m.groups()[1:] if v is not None), ""))
    return out


def _names(found: dict[str, str]) -> tuple[set[str], float]:
    """What the names in ``class`` and ``id`` stand for (``firm``, ``loose``, ``header``, ``content``,
    ``comment``), and log-odds of the words that are only parts of other names."""
    kinds: set[str] = set()
    hint = 0.0
    for name in (*found.get("class", "").split(), *found.get("id", "").split()):
        words = _WORD.findall(_CAMEL.sub(" ", name).lower())
        told = [w for w in words if w not in LAYOUT_WORDS]
        if not told:
            continue
        out = [w for w in told if w in FIRM_WORDS or w in LOOSE_WORDS]
        if len(out) == len(told):  # nothing else is in the name
            kinds.add("firm" if any(w in FIRM_WORDS for w in told) else "loose")
            if "comment" in told or "comments" in told:
                kinds.add("comment")
        elif all(w in HEADER_WORDS for w in told):
            kinds.add("header")
        elif all(w in CONTENT_WORDS for w in told):
            kinds.add("content")
        elif out:
            hint += HINT_OUT
        elif any(w in CONTENT_WORDS for w in told):
            hint += HINT_IN
    return kinds, hint


def _cue(tag: str, attributes: str, parent: Element) -> tuple[int, bool, float]:
    cue, firm, odds = parent.cue, parent.firm, parent.odds
    if cue == -2:
        return cue, True, odds
    kinds: set[str] = set()
    hint, role = 0.0, ""
    if attributes:
        found = _attributes(attributes)
        if "hidden" in found and found["hidden"].lower() != "until-found" or found.get("aria-hidden", "").lower() == "true" \
                or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
            return -2, True, HIDDEN
        role = found.get("role", "").lower()
        kinds, hint = _names(found)
    page = tag in ("body", "html")
    if tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES:
        return -1, True, OUTSIDE
    if tag in CONTENT_TAGS or role in ("main", "article"):
        if kinds & {"firm", "loose"}:
            return -1, True, OUTSIDE
        return (cue, firm, odds) if firm else (1, False, INSIDE)
    if tag == "form":
        return -1, cue == 1, OUTSIDE
    if "firm" in kinds and not page:
        return -1, True, OUTSIDE
    if (tag == "header" or "header" in kinds) and cue != 1 and not page:
        return -1, tag == "header", OUTSIDE
    if "loose" in kinds and not page and not firm:
        return (0 if cue == 1 else cue), False, odds + LOOSE
    if not firm and "content" in kinds and cue != 1:
        return 1, False, INSIDE
    return cue, firm, odds + (0.0 if firm or page else hint)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    root = Element("", None, 0)
    open_now, now = root, Block(root)
    out: list[Block] = []
    silent = links = 0  # open elements without text, open links
    count: dict[str, int] = {}  # open elements by tag
    at, size = 0, len(page)

    def say(text: str) -> None:
        if not silent and text:
            now.parts.append(text)
            if links:
                now.linked += len(text)

    def flush(element: Element) -> None:
        nonlocal now
        if now.parts:
            raw = "".join(now.parts)
            now.text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if now.text:
                now.linked = min(now.linked, len(raw)) / len(raw)
                out.append(now)
        now = Block(element)

    def close(to: Element) -> None:
        """End all elements down to and including ``to``."""
        nonlocal open_now, silent, links
        node = open_now
        while True:
            silent -= node.tag in NO_TEXT
            links -= node.tag == "a"
            count[node.tag] -= 1
            if node is to:
                break
            node = node.parent
        open_now = to.parent

    def find(tags: set[str], stop: set[str]) -> Element | None:
        if not any(count.get(t) for t in tags):
            return None
        node = open_now
        while node.parent is not None:
            if node.tag in tags:
                return node
            if node.tag in stop:
                return None
            node = node.parent
        return None

    while at < size:
        low = page.find("<", at)
        if low < 0:
            say(page[at:])
            break
        if low > at:
            say(page[at:low])
        m = _TAG.match(page, low)
        if m is None:
            m = _LOOSE.match(page, low + 1)  # a stray quote in a tag, or no tag at all
            if m is None:
                say("<")
                at = low + 1
                continue
            at = m.end() + 1
        else:
            at = m.end()
            if m[2] is None:
                continue
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if closing:
            if tag == "p" and find({"p"}, set()) is None:
                flush(open_now)
                continue
            to = find({tag}, {"td", "th", "table", "body"} - {tag} if tag not in BLOCK else {"body"} - {tag})
            if to is not None:
                inner = open_now
                breaks = tag in BLOCK
                while not breaks and inner is not to:
                    breaks = inner.tag in BLOCK
                    inner = inner.parent
                if breaks:
                    flush(open_now)
                close(to)
                if breaks:
                    now = Block(open_now)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCK:
            flush(open_now)
            if tag != "p" and tag in NO_TEXT:
                pass
            else:
                p = find({"p"}, {"table", "td", "th", "button"})
                if p is not None:
                    close(p)
            if tag in CLOSES:
                old = find(CLOSES[tag], SCOPE.get(tag, set()))
                if old is not None:
                    close(old)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            if tag in BLOCK:
                now = Block(open_now)
            continue
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, at)
            at = size if end is None else end.end()
            now = Block(open_now)
            continue
        if tag == "body":
            head = find({"head"}, set())
            if head is not None:
                close(head)
        open_now = Element(tag, open_now, open_now.depth + 1, *_cue(tag, attributes, open_now))
        silent += tag in NO_TEXT
        links += tag == "a"
        count[tag] = count.get(tag, 0) + 1
        if tag in BLOCK:
            now = Block(open_now)
    flush(root)
    _comment_titles(out)
    return out


def _comment_titles(found: list[Block]) -> None:
    """Blocks that follow a heading such as "Comments" under its parent are comments."""
    homes: dict[int, int] = {}  # parents of such headings, with the first one's place
    for i, b in enumerate(found):
        if b.element.tag in ("h2", "h3", "h4", "h5") and b.text.lower().strip(" :0123456789()") in COMMENT_TITLES:
            homes.setdefault(id(b.element.parent), i)
    if not homes:
        return
    since: dict[int, int] = {}  # for each element, the first such place around it

    def first(element: Element) -> int:
        path = []
        while element is not None and id(element) not in since:
            path.append(element)
            element = element.parent
        at = len(found) if element is None else since[id(element)]
        for e in reversed(path):
            at = min(at, homes.get(id(e), len(found)))
            since[id(e)] = at
        return at
    for i, b in enumerate(found):
        if i >= first(b.element):
            b.element = Element(b.element.tag, b.element.parent, b.element.depth, -1, True, OUTSIDE)


FEATURES = ["one", "log_words", "linked", "stops", "capitals", "digits", "heading", "paragraph", "item", "cell"]
#: Used when a sample has too few clear examples of either kind.
DEFAULT_WEIGHTS = [-2.0, 0.9, -4.0, 3.0, -1.0, -2.0, 1.0, 1.0, -0.3, -0.3]
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def features(found: list[Block]) -> np.ndarray:
    rows = []
    for b in found:
        words, n, tag = b.text.count(" ") + 1, len(b.text), b.element.tag
        stops = b.text.count(".") + b.text.count(",") + b.text.count("?") + b.text.count("!")
        short = b.text if n < 2000 else b.text[:1000] + b.text[-1000:]  # only these two rates look at a part
        capitals = sum(map(str.isupper, short)) if words < 40 else 0
        digits = sum(map(str.isdigit, short)) if words < 40 else 0
        rows.append((1.0, np.log1p(min(words, 200)), b.linked, min(1.0, stops / words), capitals / n, digits / n,
                     tag in HEADINGS, tag in ("p", "blockquote", "pre"), tag in ("li", "dd", "dt"), tag in ("td", "th")))
    return np.array(rows, float).reshape(-1, len(FEATURES))


def log_odds(found: list[Block], weights: np.ndarray) -> list[float]:
    text = np.clip(features(found) @ weights, -TEXT_LIMIT, TEXT_LIMIT) if found else []
    return [float(t) + b.element.odds for t, b in zip(text, found)]


def _distance(a: Element, b: Element) -> int:
    """Steps from the deeper of the two to their nearest common ancestor."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def ties(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbouring blocks and between siblings that others part;
    weaker where an element marks only one of the two as boilerplate."""
    out = []

    def tie(i: int, j: int, w: float) -> tuple[int, int, float]:
        apart = (found[i].element.cue < 0) != (found[j].element.cue < 0)
        return i, j, w * (MARKED if apart else 1.0)
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        home = b.element.parent or b.element
        if i:
            out.append(tie(i - 1, i, TIE * 0.5 ** max(0, _distance(found[i - 1].element, b.element) - 2)))
        j = last.get(id(home))
        if j is not None and j != i - 1:
            out.append(tie(j, i, TIE / 2))
        last[id(home)] = i
    return out


def main_text(page: str, weights: np.ndarray) -> str:
    found = blocks(page)
    unary = log_odds(found, weights)
    if all(u > 0 for u in unary) or all(u < 0 for u in unary):
        chosen = [u > 0 for u in unary]
    else:
        chosen = label(unary, ties(found))
    return "\n".join(b.text for b, yes in zip(found, chosen) if yes)


def _examples(batches):
    for part in chunks(batches, "html"):
        rows, marks = [np.empty((0, len(FEATURES)))], []
        for page in part.column("html").to_pylist():
            clear = [b for b in blocks(page or "") if b.element.cue in (1, -1)]
            clear = clear[::-(-len(clear) // PAGE_EXAMPLES) or 1]
            rows.append(features(clear))
            marks += [b.element.cue > 0 for b in clear]
        x = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays([pa.array(marks, pa.bool_())] + [pa.array(x[:, j]) for j in range(x.shape[1])],
                                         ["content", *FEATURES])


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights of the text model, from the blocks whose elements leave no doubt."""
    total = pages.count()
    share = F.xxhash64("page_id", "url", "html").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    sample = pages.filter(share * total < sample_pages).select("html").limit(2 * sample_pages)
    schema = "content boolean, " + ", ".join(f"{name} double" for name in FEATURES)
    # Equal rows are counted, so that no page's length matters.
    rows = sample.mapInArrow(_examples, schema).groupBy("content", *[F.round(c, 2).alias(c) for c in FEATURES]).agg(
        F.count("*").cast("double").alias("n")).toPandas().sort_values(["content", *FEATURES])
    y, n = rows["content"].to_numpy(bool).astype(float), rows["n"].to_numpy()
    if min(n[y == 1].sum(), n[y == 0].sum()) < MIN_EXAMPLES:
        return np.array(DEFAULT_WEIGHTS)
    x = rows[FEATURES].to_numpy(float)
    n = np.where(y == 1, n / n[y == 1].sum(), n / n[y == 0].sum()) * 1000  # both kinds weigh the same
    prior, pull = np.array(DEFAULT_WEIGHTS), 5.0
    w = prior.copy()
    for _ in range(25):  # Newton steps towards the best fit near the default weights
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + pull * (w - prior)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _extract(model):
    def run(batches):
        weights = model.value
        for part in chunks(batches, "html"):
            texts = [main_text(page, weights) if page else "" for page in part.column("html").to_pylist()]
            rest = [n for n in part.schema.names if n != "html"]
            yield pa.RecordBatch.from_arrays([part.column(n) for n in rest] + [pa.array(texts, pa.string())],
                                             rest + ["text"])
    return run


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``page_id, url, text`` for every row of ``pages(page_id, url, html)``."""
    pages = pages.select("page_id", "url", "html")
    model = pages.sparkSession.sparkContext.broadcast(fit(pages) if weights is None else np.asarray(weights))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.mapInArrow(_extract(model), f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
