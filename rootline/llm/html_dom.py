"""A forgiving HTML reader for main-text extraction: nodes in document order, their text, and per-node statistics."""

import html
import re

import numpy as np

# Element groups of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br canvas cite code data del dfn em font i img ins kbd label map mark noscript object picture q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
MATH = frozenset("math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mpadded mphantom mfenced msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe svg textarea title annotation annotation-xml noembed noframes".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
FENCES = frozenset("table ul ol dl body html div section article main aside nav header footer form".split())
# Tags in an order from page furniture to running text; others stand with div.
TAG_ORDER = "head nav footer aside header menu form fieldset button select input option label iframe figure ul ol dl li dt dd a img table tbody tr td th center div section body html span small main article blockquote pre code em i b strong q figcaption h6 h5 h4 h3 h2 h1 p".split()
TAG_CODE = {t: i for i, t in enumerate(TAG_ORDER)}
TAG_CODE |= {t: TAG_CODE["span"] for t in sorted(INLINE - set(TAG_CODE))}
# Parts of class, id and role names that tell furniture from content.
FURNITURE = re.compile(r"nav|menu|foot|head(?!line)|masthead|side|aside|\bads?\b|\bad[-_]|[-_]ads?\b|advert|sponsor|promo|banner|comment|respond|disqus|reply|share|social|relat|recommend|cookie|notice|consent|gdpr|popup|modal|overlay|alert|form|search|login|signup|subscri|newsletter|breadcrumb|crumb|pagin|pager|widget|tool|copyright|legal|\btags?\b|meta|byline|toc|skip|hidden|print|rating|vote")
CONTENT = re.compile(r"article|content|main|post|entry|story|text|body|prose|page|chapter|blog|read")

# possessive throughout: a tag that never ends is given up at the next "<", so broken markup costs no backtracking
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^a-zA-Z>][^>]*+>?|<[!/]?[a-zA-Z][^\s/<>\"']*+(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<[!/]?[a-zA-Z][^<>]*+(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[a-zA-Z][^\s/>]*")


def _flags(attributes: str, seen: dict) -> tuple[int, int, int]:
    got = seen.get(attributes)
    if got is None:
        names = " ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower()
        got = (bool(FURNITURE.search(names)), bool(CONTENT.search(names)), bool(re.search(r"\bhidden\b|display\s*:\s*none", attributes, re.I)))
        if len(seen) < 50_000:
            seen[attributes] = got
    return got


class Page:
    """nodes: parallel lists in document order; node 0 is the page.  stream: (node, text) pairs and None at block edges."""

    __slots__ = ("parent", "end", "code", "depth", "own_bad", "own_good", "up_bad", "up_good", "chars", "links", "marks", "words", "runs", "at", "stream", "size")

    def __init__(self, source: str, seen: dict):
        self.size = max(1, len(source))
        self.parent, self.end, self.code, self.depth, self.at = [-1], [0], [TAG_CODE["html"]], [0], [0]
        self.own_bad, self.own_good, self.up_bad, self.up_good = [0], [0], [0], [0]
        self.chars, self.links, self.marks, self.words, self.runs = [0], [0], [0], [0], [0]
        self.stream: list = []
        self._read(source, seen)

    def _text(self, node: int, text: str, linked: bool) -> None:
        if "&" in text:
            text = html.unescape(text)
        if text.isspace():
            self.stream.append((node, " "))
            return
        self.stream.append((node, text))
        n = len(text)
        self.chars[node] += n
        self.links[node] += n * linked
        self.marks[node] += text.count(",") + text.count(".")
        self.words[node] += text.count(" ") + 1
        self.runs[node] += 1

    def _read(self, source: str, seen: dict) -> None:
        stack, names, last, anchors = [0], ["#"], 0, 0
        opened: dict[str, int] = {}
        stream, parent, end = self.stream, self.parent, self.end
        find = TOKEN.search
        while True:
            m = find(source, last)
            if m is None:
                if last < len(source):
                    self._text(stack[-1], source[last:], anchors > 0)
                break
            if m.start() > last:
                self._text(stack[-1], source[last : m.start()], anchors > 0)
            token, last = m.group(), m.end()
            if token[1] in "!?" or token.startswith("<!--"):
                continue
            closing = token[1] == "/"
            named = NAME.match(token, 2 if closing else 1)
            if named is None:
                continue
            name = named.group().lower()
            if name in MATH:  # a formula is text of the element that it stands in
                continue
            if closing:
                if name not in INLINE and name not in RAW:
                    stream.append(None)
                if opened.get(name):
                    while len(stack) > 1:
                        node, top = stack.pop(), names.pop()
                        opened[top] -= 1
                        end[node] = len(parent)
                        anchors -= top == "a"
                        if top == name:
                            break
                continue
            block = name not in INLINE and name not in RAW  # a skipped element does not part the text around it
            if block:
                stream.append(None)
                if opened.get("p"):  # a block ends an open paragraph, with whatever stands open in it
                    k = len(names) - 1 - names[::-1].index("p")
                    if not FENCES.intersection(names[k + 1 :]):
                        while len(stack) > k:
                            node, top = stack.pop(), names.pop()
                            opened[top] -= 1
                            end[node] = len(parent)
                            anchors -= top == "a"
                if name in CLOSES:
                    k = len(names) - 1
                    while k > 0 and names[k] not in CLOSES[name] and (names[k] in INLINE or names[k] == "p"):
                        k -= 1
                    while k > 0 and names[k] in CLOSES[name]:
                        while len(stack) > k:
                            node, top = stack.pop(), names.pop()
                            opened[top] -= 1
                            end[node] = len(parent)
                            anchors -= top == "a"
                        k -= 1
            if name in RAW:
                if not token.endswith("/>"):
                    close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(source, last)
                    last = close.end() if close else len(source)
                continue
            if name == "br":
                stream.append((stack[-1], " "))
            rest = token[named.end() : -1]
            bad, good, hidden = _flags(rest, seen) if "=" in rest or "hidden" in rest else (0, 0, 0)
            up, node = stack[-1], len(parent)
            parent.append(up)
            end.append(node + 1)
            self.code.append(TAG_CODE.get(name, TAG_CODE["div"]))
            self.depth.append(len(stack))
            self.at.append(m.start())
            self.own_bad.append(bad + 2 * hidden)
            self.own_good.append(good)
            self.up_bad.append(self.up_bad[up] + (self.own_bad[up] > 0) + (self.code[up] <= TAG_CODE["form"]))
            self.up_good.append(self.up_good[up] + (self.own_good[up] > 0))
            for x in (self.chars, self.links, self.marks, self.words, self.runs):
                x.append(0)
            if name not in VOID and not (token.endswith("/>") and name not in INLINE):
                stack.append(node)
                names.append(name)
                opened[name] = opened.get(name, 0) + 1
                anchors += name == "a"
        for node in stack:
            end[node] = len(parent)
        stream.append(None)

    def text(self, keep) -> str:
        """The text of kept nodes: white space inside a block as one space, blocks joined by one newline."""
        blocks, run = [], []
        for item in self.stream:
            if item is None:
                if run:
                    block = " ".join("".join(run).split())
                    if block:
                        blocks.append(block)
                    run = []
            elif keep[item[0]]:
                run.append(item[1])
        return "\n".join(blocks)


FEATURES = "tag, tag above, furniture name, content name, furniture above, content above, depth, siblings, place among them, subtree chars, own chars, link share, marks a char, words a run, subtree nodes, chars a node, paragraphs, paragraph share, list share, start, end, share of page, share of parent, best sibling share, link share above, headings".split(", ")


def statistics(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all nodes of all pages, and the index of each page's first node (one more than pages)."""
    first = np.concatenate([[0], np.cumsum([len(p.parent) for p in pages])])
    flat = lambda name: np.fromiter((x for p in pages for x in getattr(p, name)), np.float64, first[-1])
    page = np.repeat(np.arange(len(pages)), np.diff(first))
    parent = flat("parent").astype(np.int64) + first[page]
    root = first[:-1]
    parent[root] = root
    end = flat("end").astype(np.int64) + first[page]
    here = np.arange(first[-1])
    code, chars = flat("code"), flat("chars")

    def below(x):
        total = np.concatenate([[0], np.cumsum(x)])
        return total[end] - total[here]

    sub, links, nodes = below(chars), below(flat("links")), (end - here).astype(float)
    paragraphs, items = below((code == TAG_CODE["p"]) * 1.0), below((code == TAG_CODE["li"]) * 1.0)
    heads = below((code >= TAG_CODE["h6"]) & (code <= TAG_CODE["h1"]))
    marks, words, runs = below(flat("marks")), below(flat("words")), below(flat("runs"))
    size = np.array([p.size for p in pages], float)[page]
    siblings = np.bincount(parent, minlength=first[-1])[parent]
    order = np.lexsort((here, parent))
    place = np.empty(first[-1])
    start = np.flatnonzero(np.concatenate([[True], parent[order][1:] != parent[order][:-1]]))
    place[order] = np.arange(len(order)) - np.repeat(start, np.diff(np.concatenate([start, [len(order)]])))
    best = np.zeros(first[-1])
    child = np.delete(here, root)
    np.maximum.at(best, parent[child], sub[child])
    share = links / np.maximum(1, sub)
    columns = [
        code, code[parent], flat("own_bad"), flat("own_good"), flat("up_bad"), flat("up_good"), flat("depth"), siblings, place / np.maximum(1, siblings), np.log1p(sub), np.log1p(chars), share, marks / np.maximum(1, sub),
        words / np.maximum(1, runs), np.log1p(nodes), sub / nodes, np.log1p(paragraphs), paragraphs / nodes, items / nodes, flat("at") / size, np.concatenate([flat("at"), [0]])[np.minimum(end, first[-1])] / size * (end < first[page + 1]) + (end >= first[page + 1]),
        sub / np.maximum(1, sub[root[page]]), sub / np.maximum(1, sub[parent]), sub / np.maximum(1, best[parent]), share[parent], heads,
    ]
    return np.stack(columns, axis=1).astype(np.float32), first


def decode(parent: list[int], yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    """The most likely choice of nodes in which every chosen node's parent is chosen too.

    yes, no: log likelihoods of content and of furniture by node.  Dropping a node drops its whole subtree, so no
    descendant can contradict an ancestor; the best such choice is found from the leaves up.
    """
    n = len(parent)
    take, drop = yes.tolist(), no.tolist()
    for i in range(n - 1, 0, -1):
        p = parent[i]
        take[p] += take[i] if take[i] > drop[i] else drop[i]
        drop[p] += drop[i]
    keep = np.zeros(n, bool)
    keep[0] = take[0] > drop[0]
    for i in range(1, n):
        keep[i] = keep[parent[i]] and take[i] > drop[i]
    return keep
