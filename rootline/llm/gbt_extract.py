"""Main-text extraction by gradient-boosted trees over DOM nodes (operator 1).

Every node gets features of its subtree's density, its attribute tokens, depth, siblings and place (html_dom.py); the
trees give each node a likelihood of being part of the article, and hierarchical decoding chooses the most likely set
of nodes in which no chosen node lies below a dropped one.  The trees are fitted here on pages that a generator writes
with known articles in many layouts: with and without article elements, with menus, headers, footers, sidebars,
notices, adverts, forms, comments, link lists, unclosed and broken markup.

Scripts, styles, templates, frames, drawings (svg), text areas and titles are not text; formulas and what objects, canvases and noscript
elements hold is, in the line where it stands.  Defined results: a null, empty or text-free page gives an empty text;
markup may be cut off anywhere; repeated rows and rows without page_id give a row each; a very long page is read whole;
extra columns, whatever their names, are ignored; the rows of a page table are handled one by one and nothing is shuffled.
"""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .html_dom import Page, decode, statistics
from .shared import Sent, documents

TEXTS = "page_id long, url string, text string, n_chars long"
MARK = ""


class Trees:
    """Boosted regression trees for a binary target on binned features: logistic loss, second-order leaf values."""

    def __init__(self, rounds: int = 45, depth: int = 5, bins: int = 48, rate: float = 0.2, least: float = 8.0, ridge: float = 2.0):
        self.rounds, self.depth, self.bins, self.rate, self.least, self.ridge = rounds, depth, bins, rate, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        n, width = x.shape
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)
        cell = binned + np.arange(width) * self.bins
        self.bias = float(np.log(y.mean() / (1 - y.mean())))
        margin = np.full(n, self.bias)
        size = 2 ** (self.depth + 1) - 1
        self.column, self.cut, self.leaf = (np.zeros((self.rounds, size), k) for k in (np.int64, np.float32, np.float64))
        self.cut += np.inf
        for r in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            for level in range(self.depth + 1):
                base, count = 2**level - 1, 2**level
                gs, hs = np.bincount(node - base, g, count), np.bincount(node - base, h, count)
                self.leaf[r, base : base + count] = -gs / (hs + self.ridge)
                if level == self.depth:
                    break
                place = ((node - base)[:, None] * (width * self.bins) + cell).ravel()
                gb, hb = (np.bincount(place, np.repeat(w, width), count * width * self.bins).reshape(count, width, self.bins).cumsum(axis=2) for w in (g, h))
                gr, hr = gs[:, None, None] - gb, hs[:, None, None] - hb
                gain = gb**2 / (hb + self.ridge) + gr**2 / (hr + self.ridge) - (gs**2 / (hs + self.ridge))[:, None, None]
                gain[(hb < self.least / 4) | (hr < self.least / 4)] = -1
                for j, e in enumerate(self.edges):
                    gain[:, j, len(e) :] = -1
                best = gain.reshape(count, -1).argmax(axis=1)
                for k in range(count):
                    j, b = divmod(int(best[k]), self.bins)
                    if gain[k, j, b] > 1e-6:
                        self.column[r, base + k], self.cut[r, base + k] = j, self.edges[j][b]
                node = 2 * node + 1 + (x[np.arange(n), self.column[r, node]] >= self.cut[r, node])
            margin += self.rate * self.leaf[r, node]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.bias), np.arange(len(x))
        for r in range(self.rounds):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.column[r, node]] >= self.cut[r, node])
            out += self.rate * self.leaf[r, node]
        return out


class Writer:
    """Pages with a known article; every piece of its text starts with MARK."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.letters = ["ka", "lo", "ti", "re", "men", "sta", "vor", "qui", "en", "ou", "th", "ing", "er", "na", "é", "ü", "ción", "schaft", "il", "po"]

    def some(self, low: int, high: int) -> str:
        words = ["".join(self.r.choices(self.letters, k=self.r.randint(1, 4))) for _ in range(self.r.randint(low, high))]
        for i in range(len(words)):
            if self.r.random() < 0.08:
                words[i] += self.r.choice([",", ".", ";"])
        if self.r.random() < 0.1:
            words[self.r.randrange(len(words))] += self.r.choice([" &amp;", "&quot;", " &#8211;", "&nbsp;"])
        text = " ".join(words).capitalize()
        return text + "." if self.r.random() < 0.8 else text

    def named(self, *names: str) -> str:
        name = self.r.choice(names)
        extra = "".join(self.r.choices("abcdefgh", k=3))
        return self.r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {extra}"', f' class="{extra}-{name}"', f" class={name}"])

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{i}">{self.some(1, 3)}</a>' for i in range(self.r.randint(low, high))]
        style = self.r.random()
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return (" | " if style < 0.8 else " ").join(items)

    def paragraph(self) -> str:
        text = self.some(1, 8) if self.r.random() < 0.25 else self.some(8, 120)
        if self.r.random() < 0.25:
            words = text.split(" ")
            i = self.r.randrange(len(words))
            tag = self.r.choice(["b", "em", "i", "strong", "a href='/x'", "code", "span", "sup", "math", "object", "noscript", "canvas"])
            if self.r.random() < 0.1:
                words[i] += self.r.choice(["<script>var b='<p>';</script>", "<svg><text>x</text></svg>", "<style>b{}</style>"])
            words[i] = f"<{tag}>{MARK}{words[i]}</{tag.split()[0]}>"
            text = " ".join(words)
        return MARK + text

    def body(self) -> str:
        out, style, furniture = [], self.r.random(), self.r.random()
        if self.r.random() < 0.8:
            out.append(f"<h1>{MARK}{self.some(2, 10)}</h1>")
        for _ in range(self.r.choice([0, 1, 2, 3, 4, 6, 8, 12, 20, 30])):
            kind = self.r.random()
            if kind < 0.06:
                out.append(f"<h{(k := self.r.randint(2, 4))}>{MARK}{self.some(1, 6)}</h{k}>")
            elif kind < 0.10:
                tag = self.r.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(f"<li>{self.paragraph()}" + "</li>" * (self.r.random() < 0.8) for _ in range(self.r.randint(2, 6))) + f"</{tag}>")
            elif kind < 0.13:
                out.append(f"<blockquote><p>{self.paragraph()}</p></blockquote>")
            elif kind < 0.16:
                out.append(f"<table><tr><td>{self.paragraph()}</td><td>{self.paragraph()}</td></tr></table>" if self.r.random() < 0.5 else f"<pre>{self.paragraph()}</pre>")
            elif kind < 0.22 and furniture < 0.5:
                out.append(self.piece(inside=True))
            elif kind < 0.34 and style < 0.5:
                out.append(f"<p><b>{self.paragraph()}<br>")
            elif style < 0.85:
                out.append(f"<p>{self.paragraph()}" + "</p>" * (self.r.random() < 0.9))
            else:
                out.append(f"<div>{self.paragraph()}</div>")
        return "".join(out) or f"<p>{self.paragraph()}</p>"

    def piece(self, inside: bool = False) -> str:
        """A piece of page furniture."""
        kind = self.r.choice(["ad", "ad", "share", "related", "notice", "form", "caption"] if inside else ["ad", "ad", "sidebar", "notice", "form", "comments", "comments", "related", "share", "crumbs", "byline"])
        tag = self.r.choice(["div", "div", "section", "aside"])
        if kind == "ad":
            text = self.r.choice([self.some(3, 40), f"<p>{self.some(3, 40)}</p>", f'<a href="/ad">{self.some(2, 12)}</a>', f"<p>{self.some(3, 30)}</p><p>{self.some(3, 30)}</p>"])
            return f"<{tag}{self.named('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'banner', 'ad-slot')}>{text}</{tag}>"
        if kind == "sidebar":
            tag = self.r.choice(["aside", "div", "section"])
            inner = "".join(self.r.choice([f"<h3>{self.some(1, 4)}</h3>{self.links(3, 9)}", f"<p>{self.some(5, 50)}</p>"]) for _ in range(self.r.randint(1, 4)))
            return f"<{tag}{self.named('sidebar', 'side', 'widget', 'rail', 'secondary')}>{inner}</{tag}>"
        if kind == "notice":
            return f"<{tag}{self.named('notice', 'cookie', 'cookie-banner', 'consent', 'alert', 'gdpr', 'popup')}>{self.r.choice(['', '<p>'])}{self.some(6, 50)}{self.r.choice(['', '<button>' + self.some(1, 2) + '</button>'])}</{tag}>"
        if kind == "form":
            return f"<form{self.r.choice(['', self.named('search', 'newsletter', 'subscribe', 'login', 'contact')])}><label>{self.some(1, 6)}</label><input type=text><p>{self.some(2, 25)}</p><select><option>{self.some(1, 2)}<option>{self.some(1, 2)}</select><button>{self.some(1, 3)}</button></form>"
        if kind == "comments":
            one = lambda: self.r.choice([f"<li><b>{self.some(1, 2)}</b><p>{self.some(4, 70)}</p></li>", f"<div class=comment><span>{self.some(1, 3)}</span><p>{self.some(4, 70)}</p></div>", f"<article class=\"comment\"><p>{self.some(4, 70)}</p></article>"])
            return f"<{tag}{self.named('comments', 'comment-list', 'responses', 'discussion comments', 'disqus')}><h3>{self.some(1, 3)}</h3>{''.join(one() for _ in range(self.r.randint(1, 8)))}</{tag}>"
        if kind == "related":
            return f"<{tag}{self.named('related', 'recommended', 'related-posts', 'more')}><h4>{self.some(1, 3)}</h4>{self.links(2, 7)}</{tag}>"
        if kind == "share":
            return f"<{tag}{self.named('share', 'social', 'share-buttons')}>{self.links(2, 5)}</{tag}>"
        if kind == "crumbs":
            return f"<{self.r.choice(['nav', 'div'])}{self.named('breadcrumb', 'breadcrumbs', 'pagination')}>{self.links(2, 4)}</div>"
        if kind == "caption":
            return f"<figure><img src=x></figure><{tag}{self.named('toolbar', 'widget', 'newsletter', 'promo')}><p>{self.some(3, 25)}</p></{tag}>"
        return f"<div{self.named('byline', 'meta', 'tags')}>{self.some(2, 8)}</div>"

    def page(self) -> str:
        r, body = self.r, self.body()
        wrap = r.random()
        if wrap < 0.45:
            body = f"<article{r.choice(['', '', self.named('post', 'story', 'entry')])}>{body}</article>"
        elif wrap < 0.6:
            body = f"<main>{body}</main>"
        elif wrap < 0.85:
            body = f"<div{self.named('content', 'article-body', 'post', 'main', 'entry-content', 'story', 'text')}>{body}</div>"
        elif wrap < 0.9:
            body = f"<table><tr><td>{self.links(3, 8)}</td><td>{body}</td></tr></table>"
        elif wrap < 0.95:
            body = f"<div>{body}</div>"
        if r.random() < 0.2:
            body = f"<main>{body}{self.piece() if r.random() < 0.4 else ''}</main>"
        elif r.random() < 0.25:
            body = f"<div{self.named('wrapper', 'container', 'page', 'layout')}>{body}{self.piece() if r.random() < 0.5 else ''}</div>"
        before, after = [], []
        if r.random() < 0.7:
            nav = f"<nav{r.choice(['', self.named('menu', 'nav')])}>{self.links(3, 10)}</nav>" if r.random() < 0.7 else f"<div{self.named('nav', 'menu', 'topnav', 'navbar')}>{self.links(3, 10)}</div>"
            before.append(f"<header{r.choice(['', self.named('header', 'masthead')])}><p>{self.some(1, 6)}</p>{nav}</header>" if r.random() < 0.35 else nav)
        elif r.random() < 0.5:
            before.append(f"<{(t := r.choice(['header', 'div']))}{self.named('header', 'masthead', 'site-header')}><h2>{self.some(1, 4)}</h2>{self.some(1, 10)}</{t}>")
        if r.random() < 0.1:
            before.insert(0, f"<noscript>{r.choice(['', '<p>'])}{self.some(3, 12)}</noscript>")
        for _ in range(r.choice([0, 1, 1, 2])):
            before.append(self.piece())
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            after.append(self.piece())
        if r.random() < 0.85:
            tag = r.choice(["footer", "footer", "div"])
            after.append(f"<{tag}{self.named('footer', 'site-footer', 'bottom') if tag == 'div' or r.random() < 0.3 else ''}>&copy; {self.some(1, 12)}{r.choice(['', ' &middot; ' + self.some(3, 30), self.links(2, 6)])}</{tag}>")
        if r.random() < 0.3:
            before.insert(0, f"<!-- {self.some(1, 5)} -->")
        head = f"<!DOCTYPE html><html><head><title>{self.some(1, 8)}</title><style>p{{margin:0}}</style><script>var a='<p>';</script></head><body>" if r.random() < 0.9 else ""
        source = head + "".join(before) + body + "".join(after) + ("</body></html>" if r.random() < 0.8 else "")
        if r.random() < 0.05:
            source = source[: int(len(source) * r.uniform(0.6, 1))]
        return source


def written_pages(count: int, seed: int) -> list[str]:
    writer = Writer(seed)
    return [writer.page() for _ in range(count)]


def article_of(source: str) -> str:
    """The marked text of a written page, as extraction should return it."""
    page = Page(source, {})
    out, run = [], []
    for item in page.stream:
        if item is None:
            block = " ".join("".join(run).replace(MARK, "").split())
            if MARK in "".join(run) and block:
                out.append(block)
            run = []
        else:
            run.append(item[1])
    return "\n".join(out)


def train(count: int = 700, seed: int = 20) -> Trees:
    pages = [Page(x, {}) for x in written_pages(count, seed)]
    labels = []
    for page in pages:
        label = np.zeros(len(page.parent), bool)
        for item in page.stream:
            if item is not None and MARK in item[1]:
                node = item[0]
                while node >= 0 and not label[node]:
                    label[node] = True
                    node = page.parent[node]
        labels.append(label)
    x, _ = statistics(pages)
    return Trees().fit(x, np.concatenate(labels).astype(float))


def extract(pages: DataFrame, model: Trees | None = None, group: int = 200) -> DataFrame:
    """page_id, url, text and n_chars of every page; model: fitted trees, else they are fitted first."""
    shared = Sent(pages.sparkSession, model or train())

    def rows(batches):
        trees, seen = shared.load(), {}
        for batch in batches:
            sources = batch.column(2)
            for lo in range(0, batch.num_rows, group):
                part = sources.slice(lo, group).to_pylist()
                read = [Page(x or "", seen) for x in part]
                x, first = statistics(read)
                margin = trees.margin(x)
                yes, no = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
                texts = [p.text(decode(p.parent, yes[first[i] : first[i + 1]], no[first[i] : first[i + 1]])) for i, p in enumerate(read)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, group), batch.column(1).slice(lo, group), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(rows, TEXTS)


def op1_gbt_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(documents(spark, sf_dir, "pages"))
