"""Main text of web pages by a tree-structured graphical model (operator 9).

A page's block elements form a tree; each is content or not. Node potentials
are weights of features (tag, words in class, id and role, text and link
counts), parent-child potentials tie a block to the one that holds it.
Sum-product messages, once upward and once downward, give each block's
marginal; the text of blocks above one half is the main text.

The weights are fitted on labelled pages: pages that mark their article
themselves. The fit starts from PRIOR and is drawn towards it, so that features
which the labelled pages do not show keep a sensible weight.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched

#: Labelled pages that the fit takes at most, and bytes of one at most.
TRAIN_PAGES, TRAIN_BYTES = 300, 200_000
STEPS, RATE, PULL = 12, 0.5, 0.02

SILENT = frozenset("script style noscript template head title textarea select option button iframe canvas "
                   "svg audio video datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt "
                   "mroot mover munder munderover mstyle semantics".split())
#: Start tags that may stand in a head; any other one ends it, with or without </head>.
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title head html".split())
#: Elements whose content stays in them, up to their own end tag.
RAW = frozenset("script style title textarea noscript template".split())
#: Start tags that end an open element of these names (up to the nearest scope).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table td th article section main aside nav header footer form div body html".split())
WORDS = re.compile("[a-z]+")
SPLIT = re.compile("(?<=[a-z])(?=[A-Z])")
GROUPS = {
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner adsense",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar tabs skip",
    "frame": "header footer masthead foot copyright colophon legal imprint",
    "side": "sidebar aside widget related recommended recommendations trending popular tags share sharing social "
            "follow newsletter subscribe subscription signup author bio",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog paywall disclaimer toast",
    "form": "form login search searchbox register contact",
    "comment": "comment comments commentlist reply replies discussion disqus responses respond reader",
    "content": "article content post entry story main body text maincontent articlebody blog prose",
}
GROUP_OF = {word: group for group, text in GROUPS.items() for word in text.split()}
ROLES = {"navigation": "menu", "banner": "frame", "contentinfo": "frame", "complementary": "side", "search": "form",
         "dialog": "notice", "alert": "notice", "alertdialog": "notice", "main": "content", "article": "content"}
#: Log-odds of content that the fit starts from. "in:" features speak of the words
#: in class, id and role; tags of the element; the rest of its own text.
PRIOR = {
    "article": 9.0, "main": 7.0, "nav": -9.0, "header": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0,
    "dialog": -9.0, "menu": -9.0, "address": -3.0, "fieldset": -9.0, "p": 1.0, "heading": 0.5, "list": -0.5,
    "quote": 1.0, "table": 0.0, "figure": 0.5, "wrapper": 0.0, "other": 0.0, "loose": 0.0, "page": -4.0,
    "in:ad": -9.0, "in:menu": -9.0, "in:frame": -9.0, "in:side": -9.0, "in:notice": -9.0, "in:form": -9.0,
    "in:comment": -12.0, "in:content": 5.0, "hidden": -12.0,
    "many words": 2.0, "some words": 0.5, "mostly links": -3.0, "sentence": 0.5,
}
KINDS = {"p": "p", "blockquote": "quote", "pre": "quote", "table": "table", "figure": "figure", "html": "wrapper",
         "body": "wrapper", "div": "wrapper", "section": "wrapper", "ul": "list", "ol": "list", "dl": "list",
         **{f"h{i}": "heading" for i in range(1, 7)}}
#: Features that name a block as something other than content.
MARKS = frozenset(["nav", "header", "footer", "aside", "form", "dialog", "menu", "fieldset", "hidden",
                   *(f"in:{g}" for g in GROUPS if g != "content")])
#: Log potentials of unlike (parent, child) labels; alike ones have 0. A block follows
#: the one that holds it: hardly ever is there content in a marked block, sooner in
#: an unmarked one of no content; content may well hold marked blocks.
RISE, RISE_IN_MARKED, FALL, FALL_OF_MARKED = -2.0, -12.0, -5.0, -0.5


class Tree(HTMLParser):
    """Blocks of a page in page order: parent, features, and the runs of text."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.feats = [-1], [["page"]]
        self.size, self.linked, self.last = [0], [0], [""]
        self.runs: list[tuple[int, list[str]]] = []  # block, pieces
        self.open: list[tuple[str, int]] = [("html", 0)]  # element, its block
        self.silent = self.links = 0
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if self.silent and tag not in IN_HEAD:
            self.end_head()
        if tag in ("html", "body"):
            return
        if tag in VOID:
            self.write(" ")
            return
        if self.silent:
            if tag in SILENT:
                self.open.append((tag, -1))
                self.silent += 1
            return
        names = named(attrs)
        block = tag not in INLINE or any(n != "in:content" for n in names)
        if tag not in INLINE and tag not in SILENT:
            self.pop_to({"p"}, SCOPES)
        if tag in ENDS:
            self.pop_to(ENDS[tag], SCOPES - ENDS[tag])
        if tag in SILENT:
            self.open.append((tag, -1))
            self.silent += 1
            return
        if tag == "a":
            self.links += 1
        at = self.open[-1][1]
        if block:
            at = self.add(at, [KINDS.get(tag, tag if tag in PRIOR else "other"), *names])
        self.open.append((tag, at))

    def add(self, parent, feats):
        self.parent.append(parent)
        self.feats.append(feats)
        self.size.append(0)
        self.linked.append(0)
        self.last.append("")
        return len(self.parent) - 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "svg", "iframe"):
            self.handle_endtag(tag)

    def end_head(self):
        """End an open head, unless one of RAW is open in it."""
        at = next((i for i in range(1, len(self.open)) if self.open[i][0] == "head"), 0)
        if at and not any(name in RAW for name, _ in self.open[at + 1:]):
            while len(self.open) > at:
                self.pop()

    def pop_to(self, tags, scopes):
        """End the nearest open element of ``tags``, unless a scope is nearer."""
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name in tags:
                while len(self.open) > i:
                    self.pop()
                return
            if name in scopes:
                return

    def pop(self):
        tag, at = self.open.pop()
        if at < 0:
            self.silent -= 1
        elif tag == "a":
            self.links -= 1

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.write(" ")
        found = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i][0] == tag), 0)
        if found and (not self.silent or self.open[found][1] < 0):
            if tag in INLINE and any(self.open[i][0] in SCOPES or self.open[i][0] == "p"
                                     for i in range(found + 1, len(self.open))):
                return  # a stray end of formatting that blocks have passed
            while len(self.open) > found:
                self.pop()

    def handle_data(self, data):
        if self.silent and data.strip():
            self.end_head()
        self.write(data)

    def write(self, data):
        if self.silent:
            return
        at = self.open[-1][1]
        if at == 0:  # text straight in the page is a block of its own
            if self.runs and self.feats[self.runs[-1][0]] == ["loose"]:
                at = self.runs[-1][0]
            elif not data.strip():
                return
            else:
                at = self.add(0, ["loose"])
        if not self.runs or self.runs[-1][0] != at:
            self.runs.append((at, []))
        self.runs[-1][1].append(data)
        if data.strip():
            n = len(data.split())
            self.size[at] += n
            if self.links:
                self.linked[at] += n
            self.last[at] = data

    def blocks(self) -> list[list[str]]:
        """All features of each block."""
        for feats, n, linked, last in zip(self.feats, self.size, self.linked, self.last):
            if n:
                feats += ["many words"] if n >= 15 else ["some words"] if n >= 5 else []
                if 2 * linked > n:
                    feats.append("mostly links")
                if last.rstrip()[-1:] in ".!?…。！？":
                    feats.append("sentence")
        return self.feats


def named(attrs) -> list[str]:
    """Features of the words in class, id and role, and of being hidden."""
    out = set()
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            out.add("hidden")
        elif not value:
            continue
        elif name in ("class", "id"):
            found = {GROUP_OF[w] for w in WORDS.findall(SPLIT.sub(" ", value).lower()) if w in GROUP_OF}
            bad = found - {"content"}
            out |= {f"in:{g}" for g in (bad or found)}
        elif name == "role" and value in ROLES:
            out.add(f"in:{ROLES[value]}")
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            out.add("hidden")
    return sorted(out)


def log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def marginals(parent: list[int], feats: list[list[str]], weights: dict[str, float]) -> list[float]:
    """Log-odds of content of each node of a tree (parents come first): messages
    from the leaves up, then from the root down."""
    n = len(parent)
    up, sent = [sum(map(weights.__getitem__, f)) for f in feats], [0.0] * n
    marked = [not MARKS.isdisjoint(f) for f in feats]
    rise = [RISE_IN_MARKED if marked[p] else RISE for p in parent]
    fall = [FALL_OF_MARKED if m else FALL for m in marked]
    for i in range(n - 1, 0, -1):
        sent[i] = log_sum(fall[i], up[i]) - log_sum(0.0, rise[i] + up[i])
        up[parent[i]] += sent[i]
    for i in range(1, n):
        held = up[parent[i]] - sent[i]
        up[i] += log_sum(rise[i], held) - log_sum(0.0, held + fall[i])
    return up


def labelled(tree: Tree) -> list[int] | None:
    """Labels of a page that marks its article: blocks in <article> or <main> but
    not in a block marked as something else. None: the page does not."""
    out: list[int] = []
    for parent, feats in zip(tree.parent, tree.feats):
        held = out[parent] if parent >= 0 else 0
        own = set(feats)
        out.append(-1 if held < 0 or own & MARKS else 1 if held or own & {"article", "main"} else 0)
    return [max(0, y) for y in out] if 1 in out else None


def fit(pages: list[str]) -> dict[str, float]:
    """Weights that make the labels of the labelled ones of ``pages`` likely: gradient
    steps on the exact marginals, drawn towards PRIOR."""
    trees = [t for t in map(Tree, pages) if labelled(t) is not None]
    weights = dict(PRIOR)
    data = [(t.parent, t.blocks(), labelled(t)) for t in trees]
    nodes = sum(len(p) for p, _, _ in data)
    for _ in range(STEPS if nodes else 0):
        step = dict.fromkeys(weights, 0.0)
        for parent, feats, labels in data:
            odds = marginals(parent, feats, weights)
            for f, y, o in zip(feats, labels, odds):
                error = y - 1 / (1 + math.exp(-max(-30.0, min(30.0, o))))
                for name in f:
                    step[name] += error
        for name, value in step.items():
            weights[name] += RATE * (value * 30 / nodes - PULL * (weights[name] - PRIOR[name]))
    return weights


def main_text(page: str, weights: dict[str, float]) -> str:
    tree = Tree(page)
    odds = marginals(tree.parent, tree.blocks(), weights)
    texts = (" ".join("".join(pieces).split()) for at, pieces in tree.runs if odds[at] > 0)
    return " ".join([t for t in texts if t])


def sample(pages: DataFrame, html_col: str) -> list[str]:
    """Up to TRAIN_PAGES different pages that mark an article, by hash of the page:
    first the least hashes (small rows of each task), then their pages."""
    html = F.col(html_col)
    rows = (pages.where(html.rlike("(?i)<(article|main)\\b") & (F.octet_length(html) <= TRAIN_BYTES))
            .select(html.alias("html"), F.xxhash64(html).alias("place")))
    least = [r.place for r in rows.groupBy("place").count().orderBy("place").limit(TRAIN_PAGES).collect()]
    return [r.html for r in rows.where(F.col("place").isin(least)).dropDuplicates(["place"]).orderBy("place").collect()]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            weights: dict[str, float] | None = None) -> DataFrame:
    """Per row: page_id, url, text (empty if none), n_chars. Null html is an empty
    page; repeated rows give repeated results; without labelled pages the weights
    are PRIOR. Other columns are ignored."""
    weights = weights or fit(sample(pages, html_col))

    @F.arrow_udf(T.StringType())
    def run(html: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py() or "", weights) for x in html], pa.string())

    return (batched(pages).select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                         run(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
