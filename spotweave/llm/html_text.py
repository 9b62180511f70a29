"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A tolerant parser turns a page into block-level nodes and text blocks.  Each node has features of its
subtree (length and density of text, share of linked text), its attribute tokens, depth and siblings.
Boosted trees give the chance that a node holds main text; decoding then takes the most likely set of
nodes in which no node is chosen without its parent, so that an ancestor and a descendant never
contradict each other.  The trees are trained at the start on ``labelled_pages()``, made by rule.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTROLS = frozenset("input button select textarea label".split())
HIDDEN = frozenset("script style head title noscript template iframe button select textarea label".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
BLOCK = frozenset("html body div section article main aside nav header footer p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary fieldset legend hgroup center form".split())
CLOSES_P = BLOCK - {"html", "body"}
#: Elements that end an open one: the group of the open one, and what bounds the search for it.
SCOPES = {
    "p": ({"p"}, {"td", "th", "table", "li", "div", "section", "article", "main", "aside", "blockquote", "figure", "button"}),
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
}
SCOPE_OF = {"li": "li", "dt": "dt", "dd": "dt", "tr": "tr", "td": "td", "th": "td"}
SCOPE_NAMES = tuple(SCOPES)
# For each element the scopes in which a search stops at it.
STOPS = {name: tuple(i for i, scope in enumerate(SCOPE_NAMES) if name in SCOPES[scope][0] | SCOPES[scope][1]) for name in BLOCK | HIDDEN}
# Attribute tokens by what they speak for.
TOKENS = {
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion adsense banner-ad",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar pagination pager tabs skip",
    "edge": "header footer masthead branding colophon copyright legal logo site-header site-footer bottom",
    "side": "sidebar aside widget related recommended rail secondary trending popular recent tags share social author-box more",
    "notice": "notice cookie cookies consent alert banner popup modal gdpr subscribe newsletter paywall signup disclaimer",
    "comment": "comment comments reply replies respond discussion disqus feedback reviews",
    "main": "content main article post entry story body text page-content article-body post-body entry-content prose hentry",
}
GROUP_OF = {t: i for i, words in enumerate(TOKENS.values()) for t in words.split()}
TAGS = "p li ul ol div section article main aside nav header footer h1 h2 h3 h4 blockquote pre table td tr figure figcaption dl dd dt".split()
TAG_OF = {t: i + 1 for i, t in enumerate(TAGS)}

MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)|<[!?][^>]*+>?", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


class Page:
    """Nodes in page order (tag, parent, tokens, form controls) and text blocks (node, pieces).

    Any end tag and any implied end takes a constant time, so that a page takes a time in proportion to its length.
    """

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.groups, self.hidden = ["#page"], [-1], [0], [False]
        self.linked, self.controls = [0], [0]
        self.blocks: list[tuple[int, list[str]]] = []
        self.stack = [("#page", 0)]
        self.places: dict[str, list[int]] = {}  # of each open name, its places in the stack
        self.nearest = [(0,) * len(SCOPE_NAMES)]  # of each open element and scope, where a search stops
        self.anchor = 0
        self.current: list[str] | None = None
        at = 0
        for m in MARKUP.finditer(source):
            if m.start() < at:
                continue
            if m.start() > at:
                self.text(source[at : m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                self.end(name)
            else:
                self.start(name, m[3] or "")
                if name in RAW and not (m[3] or "").endswith("/"):
                    close = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
                    at = close.end() if close else len(source)
                    self.end(name)
        if at < len(source):
            self.text(source[at:])

    def text(self, piece: str) -> None:
        node = self.stack[-1][1]
        if self.hidden[node]:
            return
        if self.current is None:
            self.current = []
            self.blocks.append((node, self.current))
        self.current.append(piece)
        if self.anchor:
            self.linked[node] += len(piece.strip())

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            if self.current is not None:
                self.current.append(" ")
            return
        if name in CONTROLS:
            self.controls[self.stack[-1][1]] += 1
        if name in VOID:
            return
        if name not in BLOCK and name not in HIDDEN:
            self.anchor += name == "a"
            return
        if name in CLOSES_P:
            self.close("p")
        if name in SCOPE_OF:
            self.close(SCOPE_OF[name])
        parent = self.stack[-1][1]
        group = 0
        if "=" in attributes:
            for m in ATTRIBUTE.finditer(attributes):
                value = (m[1] or m[2] or m[3] or "").lower()
                for token in value.split():
                    found = [token] if token in GROUP_OF else WORDS.findall(token)
                    for t in found:
                        if t in GROUP_OF:
                            group |= 1 << GROUP_OF[t]
        self.tags.append(name)
        self.parents.append(parent)
        self.groups.append(group)
        self.hidden.append(self.hidden[parent] or name in HIDDEN)
        self.linked.append(0)
        self.controls.append(0)
        place = len(self.stack)
        near = list(self.nearest[-1])
        for scope in STOPS[name]:
            near[scope] = place
        self.nearest.append(tuple(near))
        self.places.setdefault(name, []).append(place)
        self.stack.append((name, len(self.tags) - 1))
        if not self.hidden[-1]:  # what isn't seen parts no block
            self.current, self.anchor = None, 0

    def drop(self, place: int) -> None:
        """Ends the open elements from a place in the stack on."""
        if not self.hidden[self.stack[place][1]]:
            self.current, self.anchor = None, 0
        for name, _ in self.stack[place:]:
            self.places[name].pop()
        del self.stack[place:], self.nearest[place:]

    def close(self, scope: str) -> None:
        """Ends the innermost open element of a scope, unless a bound is nearer."""
        place = self.nearest[-1][SCOPE_NAMES.index(scope)]
        if place and self.stack[place][0] in SCOPES[scope][0]:
            self.drop(place)

    def end(self, name: str) -> None:
        if name not in BLOCK and name not in HIDDEN:
            if name == "a" and self.anchor:
                self.anchor -= 1
        elif places := self.places.get(name):
            self.drop(places[-1])

    def texts(self) -> list[tuple[int, str]]:
        """Blocks that have text: references decoded, white space made single blanks, trimmed."""
        out = []
        for node, pieces in self.blocks:
            text = "".join(pieces)
            if "&" in text:
                text = html.unescape(text)
            if text := " ".join(text.split()):
                out.append((node, text))
        return out


N_FEATURES = 16 + 2 * len(TOKENS)


def features(page: Page, texts: list[tuple[int, str]]) -> np.ndarray:
    """A row of numbers for each node."""
    n = len(page.tags)
    own, stops, linked, paragraphs, count, controls = [0] * n, [0] * n, list(page.linked), [0] * n, [1] * n, list(page.controls)
    for node, text in texts:
        own[node] += len(text)
        stops[node] += text.count(". ") + text.count(", ") + text.endswith(".")
        if page.tags[node] == "p":
            paragraphs[node] += 1
    direct = list(own)
    children, order, depth, above = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        p = page.parents[i]
        order[i] = children[p]
        children[p] += 1
        depth[i] = depth[p] + 1
        tag = page.tags[i]
        above[i] = above[p] | page.groups[i] | (1 << len(TOKENS) if tag in ("article", "main") else 0)
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        own[p] += own[i]
        stops[p] += stops[i]
        linked[p] += linked[i]
        paragraphs[p] += paragraphs[i]
        count[p] += count[i]
        controls[p] += controls[i]
    whole = max(own[0], 1)
    out = np.zeros((n, N_FEATURES), np.float32)
    parents = np.maximum(page.parents, 0)
    total, kids = np.array(own, float), np.array(children)
    out[:, 0] = [TAG_OF.get(t, 0) for t in page.tags]
    out[:, 1] = np.log1p(total)
    out[:, 2] = np.minimum(np.array(linked) / np.maximum(total, 1), 1)
    out[:, 3] = total / whole
    out[:, 4] = np.log1p(total / np.array(count))
    out[:, 5] = np.array(stops) * 100 / np.maximum(total, 1)
    out[:, 6] = np.log1p(paragraphs)
    out[:, 7] = np.log1p(direct)
    out[:, 8] = depth
    out[:, 9] = kids[parents]
    out[:, 10] = order
    out[:, 11] = total / np.maximum(total[parents], 1)
    out[:, 12] = out[parents, 0]
    out[:, 13] = (np.array(above) >> len(TOKENS)) & 1
    out[:, 14] = controls
    out[:, 15] = np.array(controls) * 100 / np.maximum(total, 1)
    groups, seen = np.array(page.groups), np.array(above)
    for k in range(len(TOKENS)):
        out[:, 16 + k] = (groups >> k) & 1
        out[:, 16 + len(TOKENS) + k] = (seen >> k) & 1
    return out


class Boosted:
    """Gradient-boosted trees of fixed depth for the logistic loss, on binned features."""

    def __init__(self, rounds: int = 50, depth: int = 4, rate: float = 0.25, bins: int = 48) -> None:
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        n, m = x.shape
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(m)]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], 1)
        width = self.bins + 1
        flat = binned + np.arange(m) * width
        inner, leaves = (1 << self.depth) - 1, 1 << self.depth
        self.feature, self.cut = np.zeros((self.rounds, inner), np.int64), np.full((self.rounds, inner), np.inf, np.float32)
        self.leaf = np.zeros((self.rounds, leaves))
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score = np.full(n, self.base)
        for r in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            gradient, weight, node = y - p, p * (1 - p), np.zeros(n, np.int64)
            for level in range(self.depth):
                size = 1 << level
                key = ((node - (size - 1))[:, None] * (m * width) + flat).ravel()
                g = np.bincount(key, np.repeat(gradient, m), size * m * width).reshape(size, m, width).cumsum(2)
                h = np.bincount(key, np.repeat(weight, m), size * m * width).reshape(size, m, width).cumsum(2)
                all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
                gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                gain[(h < 1e-3) | (all_h - h < 1e-3)] = 0
                best = gain.reshape(size, -1).argmax(1)
                for k in range(size):
                    j, b = divmod(int(best[k]), width)
                    if gain[k, j, b] > 1e-6 and b < len(self.cuts[j]):
                        self.feature[r, size - 1 + k], self.cut[r, size - 1 + k] = j, self.cuts[j][b]
                chosen = self.feature[r, node]
                node = 2 * node + 1 + (x[np.arange(n), chosen] > self.cut[r, node])
            at = node - inner
            self.leaf[r] = self.rate * np.bincount(at, gradient, leaves) / (np.bincount(at, weight, leaves) + 1)
            score += self.leaf[r][at]
        return self

    def chance(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for r in range(self.rounds):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[r, node]] > self.cut[r, node])
            score += self.leaf[r][node - ((1 << self.depth) - 1)]
        return 1 / (1 + np.exp(-score))


def decode(parents: list[int], hidden: list[bool], chance: np.ndarray) -> list[bool]:
    """The most likely choice of nodes in which each chosen node's parent is chosen; hidden nodes never are."""
    p = np.clip(chance, 1e-4, 1 - 1e-4)
    no = np.log(1 - p).tolist()
    yes = np.log(p).tolist()
    n = len(parents)
    for i in range(n):
        if hidden[i]:
            yes[i] = -1e9
    without = list(no)
    for i in range(n - 1, 0, -1):
        without[parents[i]] += without[i]
        yes[parents[i]] += max(yes[i], without[i])
    chosen = [False] * n
    chosen[0] = True
    for i in range(1, n):
        chosen[i] = chosen[parents[i]] and yes[i] > without[i]
    return chosen


def labelled_pages(n: int = 260, seed: int = 5) -> list[tuple[str, str]]:
    """Pages made by rule, each with its main text; the text of main blocks is marked by how it is made."""
    rng = np.random.default_rng(seed)

    def choose(*options: str) -> str:
        return options[rng.integers(len(options))]

    def word() -> str:
        return "".join("etaoinshrdlu"[i] for i in rng.integers(0, 12, rng.integers(2, 9)))

    def sentence(low: int, high: int) -> str:
        words = [word() for _ in range(rng.integers(low, high))]
        if rng.random() < 0.25:
            words = [w + choose("***", "&&&", "$$$", "%%%", "") for w in words]
        if len(words) > 6 and rng.random() < 0.5:
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + "."

    def prose(sentences: int) -> str:
        return " ".join(sentence(3, 18) for _ in range(sentences))

    def links(k: int) -> str:
        items = [f'<a href="/{word()}">{word()}</a>' for _ in range(k)]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if rng.random() < 0.7 else " | ".join(items)

    def mark(tag: str, tokens: str) -> tuple[str, str]:
        token = choose(*tokens.split())
        return (f'<{tag} {choose("class", "id")}="{token}">' if rng.random() < 0.85 else f"<{tag}>"), f"</{tag}>"

    made = []
    for _ in range(n):
        main: list[str] = []

        def block(tag: str, text: str) -> str:
            main.append(html.unescape(" ".join(text.split())))
            text = html.escape(text, quote=False)
            if rng.random() < 0.1:
                text = choose("<svg><path d='M0'/></svg>", "<script>x()</script>", "<object></object>") + text
            return f"<{tag}>{text}</{tag}>" if tag != "p" or rng.random() < 0.8 else f"<p><b>{text}<br>"

        def boiler() -> str:
            kind = rng.integers(9)
            if kind == 0:
                a, b = mark(choose("nav", "div", "ul"), TOKENS["menu"])
                return a + links(rng.integers(3, 9)) + b
            if kind == 1:
                a, b = mark(choose("header", "div"), TOKENS["edge"])
                return a + choose(f"<h2>{word()}</h2>", f"<p>{prose(1)}</p>", links(3)) + b
            if kind == 2:
                a, b = mark(choose("aside", "div", "section"), TOKENS["side"])
                return a + f"<h3>{word()} {word()}</h3>" + choose(links(4), f"<p>{prose(rng.integers(1, 4))}</p>") + b
            if kind == 3:
                a, b = mark("div", TOKENS["notice"])
                return a + f"<p>{prose(rng.integers(1, 3))}</p>" + choose("", f'<a href="#">{word()}</a>') + b
            if kind in (4, 5):
                return f'<div class="{choose(*TOKENS["ad"].split())}">' + choose(prose(rng.integers(1, 6)), f"<p>{prose(rng.integers(1, 5))}</p>") + "</div>"
            if kind == 6:
                hint = choose("", f"<p>{prose(rng.integers(1, 3))}</p>", f"<h3>{word()}</h3>", f"<div>{sentence(2, 9)}</div>")
                fields = "".join(choose(f"<label>{word()}</label><input name=q>", f"<p>{word()} <input></p>", f"<div><select><option>{word()}</option></select></div>", "<textarea></textarea>") for _ in range(rng.integers(1, 5)))
                return f'<form action="/s">{hint}{fields}<button>{word()}</button></form>'
            if kind == 7:
                return "<nav>" + links(rng.integers(3, 9)) + "</nav>"
            return f"<script>var t='</p>';track({rng.integers(99)});</script>"

        def comments() -> str:
            a, b = mark(choose("section", "div", "ol"), TOKENS["comment"])
            if ">" == a[-1] and "=" not in a:
                a = f'<section class="{choose("comments", "discussion")}">'
                b = "</section>"
            return a + "".join(f'<div class="{choose("comment", "reply", "comment-body")}"><p>{prose(rng.integers(1, 5))}</p></div>' for _ in range(rng.integers(1, 5))) + b

        body = []
        if rng.random() < 0.9:
            title = sentence(2, 14)
            body.append(block("h1", title if rng.random() < 0.3 else title.rstrip(".")))
        for _ in range(rng.integers(1, 14)):
            kind = rng.random()
            if kind < 0.78:
                body.append(block("p", choose(prose(rng.integers(1, 7)), prose(rng.integers(1, 7)), prose(rng.integers(1, 4)), word(), word() + ".", prose(rng.integers(7, 30)))))
            elif kind < 0.84:
                body.append(block(choose("h2", "h3"), sentence(2, 9).rstrip(choose(".", "!"))))
            elif kind < 0.9:
                body.append("<ul>" + "".join(block("li", sentence(2, 12).rstrip(choose(".", "!"))) for _ in range(rng.integers(2, 5))) + "</ul>")
            elif kind < 0.95:
                body.append("<blockquote>" + block("p", prose(2)) + "</blockquote>")
            else:
                body.append(boiler())
        if rng.random() < 0.25:
            body.append(comments())
        style = rng.integers(5)
        a, b = [("<article>", "</article>"), ("<main>", "</main>"), mark("div", TOKENS["main"]), (f'<article class="{choose(*TOKENS["main"].split())}"><div>', "</div></article>"), ('<main><div class="content">', "</div></main>")][style]
        before = "".join(boiler() for _ in range(rng.integers(0, 5)))
        after = "".join(boiler() for _ in range(rng.integers(0, 4))) + (comments() if rng.random() < 0.2 else "")
        if rng.random() < 0.8:
            after += choose(f"<footer>&copy; {word()}.org &middot; {prose(rng.integers(1, 3))}</footer>", f'<div id="footer"><p>{prose(1)}</p>{links(3)}</div>')
        wrap = choose("%s", "%s", "%s", '<div id="page">%s</div>', '<div id="page">%s</div>', '<div class="wrapper"><div>%s</div></div>', '<form method="post" action="page"><input type="hidden" name="state">%s</form>')
        page = f"<!DOCTYPE html><html><head><title>{word()}</title><style>p{{margin:0}}</style></head><body>" + wrap % (before + a + "".join(body) + b + after) + "</body></html>"
        made.append((page, "\n".join(main)))
    return made


@cache
def train() -> Boosted:
    """Trees from the labelled pages; a node is positive if its subtree has a block of the main text."""
    xs, ys = [], []
    for source, main in labelled_pages():
        page = Page(source)
        texts = page.texts()
        wanted, holds = set(main.split("\n")), np.zeros(len(page.tags), bool)
        for node, text in texts:
            if text in wanted:
                while node >= 0 and not holds[node]:
                    holds[node] = True
                    node = page.parents[node]
        seen = ~np.array(page.hidden)
        xs.append(features(page, texts)[seen])
        ys.append(holds[seen])
    return Boosted().fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def extract(sources: list[str], model: Boosted) -> list[str]:
    """Main text of each page: the chosen nodes' blocks in page order, joined by line feeds."""
    pages = [Page(s) for s in sources]
    texts = [p.texts() for p in pages]
    rows = [features(p, t) for p, t in zip(pages, texts)]
    chance = model.chance(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for page, blocks, x in zip(pages, texts, rows):
        chosen = decode(page.parents, page.hidden, chance[at : at + len(x)])
        at += len(x)
        out.append("\n".join(text for node, text in blocks if chosen[node]))
    return out


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    Forms are ordinary nodes with their controls as features, so that a form around a whole page hides nothing;
    controls and labels themselves are never text.  Formulas, drawings and other inline elements part no block.
    A null or empty page, or one without main text, gives an empty text.  Repeated rows give equal texts;
    other columns are not read.  A page is parsed as a whole, however long.
    """
    model = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                texts = extract([x or "" for x in part.column(2).to_pylist()], model)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(source).alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
