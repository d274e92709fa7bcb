"""Main text of web pages by a tree-structured graphical model (operator 7).

A page is parsed into its tree of block elements.  Each node has a hidden state, content or
boilerplate; node potentials come from the tag, the hints in tag, class, id and role (own and
inherited), the amount of own text and the share of link text; an edge potential ties each node
to its parent.  Messages pass from the leaves up and from the root down (sum-product), which is
exact on a tree, and the text of nodes whose content marginal exceeds one half is kept.

Training counts states, features and parent-child pairs over labelled pages, added up by Spark;
only the table of counts (bounded by the features, see ``FEATURES``) reaches the driver.  The
labelled pages are a bounded sample (``train_pages``, least URL hashes) of pages whose document
is known: a text block is content when it belongs to that document's text.  ``PRIOR`` adds one
invented observation per kind of hint, so that hints never seen in training still count.

Hints are read from whole names, weak ones give way to names that speak for content, a form around
most of the page and the header of an article are no hint at all, and an article or main inside a
weakly hinted element starts anew; what stands in comments, footers or sidebars stays there.

Cases: null html is empty and gives an empty text; unclosed, stray and upper-case tags, comments
and cut-off markup are read as browsers do, in one pass; a page without any tag is one block;
repeated rows give a row each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import stash
from lacuna.llm.urls import shown_document

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

# fixed values: element names of HTML by how they are read
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template noscript title svg math iframe object canvas select textarea button head".split())
RAW = frozenset("script style title textarea iframe noscript template".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr br img""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dt dd""".split())
CLOSES_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPE = frozenset("ul ol dl table html body article section main aside nav div".split())
KNOWN = frozenset("body article main section div p h1 h2 h3 h4 h5 h6 li ul ol blockquote pre td table nav header footer aside form figure figcaption dl dd dt".split())

# fixed values: words in tags, classes, ids and roles that speak against or for content
AGAINST = frozenset("""ad ads advert advertisement adverts aside alert banner breadcrumb breadcrumbs button captcha comment
comments complementary consent contentinfo cookie cookies copyright dialog disqus footer form header legal login masthead menu
modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion recommended related replies
reply respond rss search share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar widget""".split())
AGAINST_STEMS = ("adsby", "adslot", "adunit", "advert", "breadcrumb", "comment", "cookie", "footer", "menu", "navig", "newsletter", "promo", "sidebar", "social", "sponsor", "subscri")
#: of these, names that hold whatever other names an element has
STRONG = frozenset("""ad ads aside comment comments complementary contentinfo disqus footer nav navbar navigation recommended related
replies reply respond sponsor sponsored""".split())
STRONG_STEMS = tuple(x for x in AGAINST_STEMS if x != "menu")
FOR = frozenset("article main post entry story content body text page".split())
#: first parts of names that tell of another element
MODIFIERS = frozenset("has hide is no show with without".split())

LENGTHS = (0, 2, 5, 10, 20, 40)
FEATURES = ("tag", "hint", "inherited", "words", "links")
#: tags follow from where they stand (list items are mostly seen in menus), so they count for a little less
WEIGHT = {"tag": 0.9}
#: one invented observation (feature, value, state) of each kind that hints stand for, for hints that no
#: labelled page shows
PRIOR = [("inherited", "against", 0, 1.0), ("inherited", "for", 1, 1.0), ("hint", "against", 0, 1.0), ("hint", "for", 1, 1.0),
         ("words", "6", 1, 1.0), ("words", "0", 0, 1.0), ("links", "all", 0, 1.0), ("links", "few", 1, 1.0),
         ("edge", "0", 0, 1.0), ("edge", "1", 1, 1.0), ("state", "", 0, 1.0), ("state", "", 1, 1.0)]


def name_hint(name: str) -> str:
    """What one class, id or role says, as a whole: "has-sidebar" is no sidebar."""
    parts = [x.lower() for x in NAME.findall(name)]
    if not parts or parts[0] in MODIFIERS:
        return "none"
    if any(p in STRONG or p.startswith(STRONG_STEMS) for p in parts):
        return "strong"
    if any(p in AGAINST for p in parts):
        return "against"
    return "for" if any(p in FOR for p in parts) else "none"


def hint_of(tag: str, attrs: str) -> str:
    """for, none, against or strong (against, whatever stands beside it) of an element by its tag and names.
    A weak name against meets a name for: neither; on an article or main it yields to the tag."""
    if tag in ("body", "html"):
        return "none"
    said = {name_hint(x) for m in ATTR.finditer(attrs) for x in (m[2] or m[3] or m[4] or "").split()}
    said.add("strong" if tag in STRONG else "against" if tag in AGAINST else "for" if tag in FOR else "none")
    if "strong" in said:
        return "strong"
    if "for" in said and "against" in said:
        return "for" if tag in ("article", "main") else "none"
    return "against" if "against" in said else "for" if "for" in said else "none"


class Page:
    """Block tree of a page: per node parent, tag, hints, own words and link words; and blocks,
    each a list of (node, text) runs."""

    def __init__(self, source: str):
        self.parent, self.tag, self.hint, self.inherited, self.words, self.links = [-1], ["html"], ["none"], ["none"], [0], [0]
        self.blocks: list[list[tuple[int, str]]] = [[]]
        self._read(source)
        self._settle()
        self.blocks = [b for b in self.blocks if any(t.strip() for _, t in b)]

    def _settle(self):
        """Hints that need the whole page, and what is inherited: strong hints by all below, weak ones
        up to the next article or main."""
        below = list(self.words)
        for i in range(len(below) - 1, 0, -1):
            below[self.parent[i]] += below[i]
        sections = [False] * len(below)  # inside an article or main
        above = ["none"] * len(below)
        for i in range(1, len(below)):
            up, tag, hint = self.parent[i], self.tag[i], self.hint[i]
            if hint == "against" and (tag == "form" and 2 * below[i] > below[0] or tag == "header" and sections[up]):
                hint = "none"
            sections[i] = sections[up] or tag in ("article", "main")
            anew = tag in ("article", "main") and hint == "for"
            above[i] = "strong" if "strong" in (hint, above[up]) else hint if hint != "none" and (anew or above[up] != "against") else above[up]
            self.hint[i] = "against" if hint == "strong" else hint
            self.inherited[i] = "against" if above[i] == "strong" else above[i]

    def _node(self, parent, tag, hint):
        self.parent.append(parent)
        self.tag.append(tag if tag in KNOWN else "other")
        self.hint.append(hint)
        self.inherited.append("none")
        self.words.append(0)
        self.links.append(0)
        return len(self.parent) - 1

    def _read(self, source):
        stack = [("html", 0, False)]  # (tag, node, block element)
        at, links, paragraphs = 0, 0, 0

        def text(s):
            if s:
                s = html.unescape(s)
                node = stack[-1][1]
                n = len(s.split())
                self.words[node] += n
                self.links[node] += n if links else 0
                self.blocks[-1].append((node, s))

        def pop_to(depth):
            nonlocal links, paragraphs
            for tag, _, block in stack[depth:]:
                links -= tag == "a"
                paragraphs -= tag == "p"
                if block and self.blocks[-1]:
                    self.blocks.append([])
            del stack[depth:]

        while True:
            m = TOKEN.search(source, at)
            if m is None:
                text(source[at:])
                return
            text(source[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag, block = m[2].lower(), m[2].lower() not in INLINE
            if m[1]:
                depth = len(stack) - 1
                while depth and stack[depth][0] != tag:
                    if not block and stack[depth][2]:  # an inline end tag doesn't leave its block
                        depth = 0
                        break
                    depth -= 1
                if depth:
                    pop_to(depth)
                if block and self.blocks[-1]:
                    self.blocks.append([])
                continue
            if tag in SKIPPED:
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)" + (r"|(?=<body\b)" if tag == "head" else ""), re.I).search(source, at)
                at = end.end() if end else (len(source) if tag in RAW else at)
                continue
            if tag == "br":
                text(" ")
                continue
            if tag in CLOSES_P and paragraphs:
                depth = max(i for i, s in enumerate(stack) if s[0] == "p")
                pop_to(depth)
            if tag in CLOSES_LIKE:
                depth = len(stack) - 1
                while depth and stack[depth][0] not in CLOSES_LIKE[tag] and stack[depth][0] not in SCOPE:
                    depth -= 1
                if depth and stack[depth][0] in CLOSES_LIKE[tag]:
                    pop_to(depth)
            if block and self.blocks[-1]:
                self.blocks.append([])
            if tag in VOID or m[3].endswith("/") and not block:
                continue
            hint = hint_of(tag, m[3])
            node = stack[-1][1]
            if block or hint in ("against", "strong"):
                node = self._node(node, tag, hint)
            links += tag == "a"
            paragraphs += tag == "p"
            stack.append((tag, node, block))

    def features(self):
        """Per node the values of FEATURES; link shares are of all text below a node."""
        words, links = list(self.words), list(self.links)
        for i in range(len(words) - 1, 0, -1):
            words[self.parent[i]] += words[i]
            links[self.parent[i]] += links[i]
        out = []
        for i in range(len(words)):
            share = links[i] / words[i] if words[i] else 0.0
            out.append((self.tag[i], self.hint[i], self.inherited[i], str(sum(self.words[i] > x for x in LENGTHS)),
                        "all" if share > 0.9 else "most" if share > 0.5 else "few"))
        return out


def flat(s: str) -> str:
    return " ".join(s.split())


def observe(page: Page, truth: str, counts: dict):
    """Adds a labelled page: a block is content when the document's lines hold it (or begin with
    it, for a title), a node when most of the words below it are."""
    lines = [flat(x) for x in truth.split("\n")]
    whole, exact = flat(truth), set(lines)
    good, all_words = [0] * len(page.parent), [0] * len(page.parent)
    for b in page.blocks:
        t = flat("".join(x for _, x in b))
        n = max(1, len(t.split()))
        is_content = t in exact or (n > 3 and (whole.startswith(t) or any(x.startswith(t) for x in lines)))
        for node in {i for i, _ in b}:
            good[node] += n * is_content
            all_words[node] += n
    for i in range(len(good) - 1, 0, -1):
        good[page.parent[i]] += good[i]
        all_words[page.parent[i]] += all_words[i]
    state = [int(2 * g > w) for g, w in zip(good, all_words)]
    for i, values in enumerate(page.features()):
        if not all_words[i]:
            continue
        keys = [(f, v, state[i]) for f, v in zip(FEATURES, values)] + [("state", "", state[i])]
        if page.parent[i] >= 0:
            keys.append(("edge", str(state[page.parent[i]]), state[i]))
        for k in keys:
            counts[k] = counts.get(k, 0) + 1


class Model:
    """Log potentials from counts, smoothed by one observation per value."""

    def __init__(self, counts: dict):
        total: dict = {}
        for (f, v, s), n in counts.items():
            key = (f, v) if f == "edge" else (f, s)
            total[key] = total.get(key, 0) + n
        sizes: dict = {}
        for f, v, _ in counts:
            sizes.setdefault(f, set()).add(v)
        self.feature = {}
        for f in FEATURES:
            for v in sizes.get(f, ()):
                self.feature[f, v] = WEIGHT.get(f, 1.0) * np.array([
                    np.log((counts.get((f, v, s), 0) + 1) / (total.get((f, s), 0) + len(sizes[f]) + 1)) for s in (0, 1)])
        self.edge = np.array([[np.log((counts.get(("edge", str(p), s), 0) + 1) / (total.get(("edge", str(p)), 0) + 2)) for s in (0, 1)] for p in (0, 1)])
        n = [counts.get(("state", "", s), 0) + 1 for s in (0, 1)]
        self.root = np.log(np.array(n) / sum(n))
        self._cache: dict = {}

    def node(self, values) -> np.ndarray:
        got = self._cache.get(values)
        if got is None:
            got = sum((self.feature.get(k, np.zeros(2)) for k in zip(FEATURES, values)), np.zeros(2))
            self._cache[values] = got = (float(got[0]), float(got[1]))
        return got

    def marginals(self, page: Page) -> list[float]:
        """P(content) of each node: messages to the root, then back."""
        n, parent = len(page.parent), page.parent
        own = [self.node(v) for v in page.features()]
        (e00, e01), (e10, e11) = self.edge.tolist()
        b0, b1 = [x[0] for x in own], [x[1] for x in own]
        b0[0], b1[0] = float(self.root[0]), float(self.root[1])
        up = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            m = (_add(b0[i] + e00, b1[i] + e01), _add(b0[i] + e10, b1[i] + e11))
            up[i] = m
            b0[parent[i]] += m[0]
            b1[parent[i]] += m[1]
        for i in range(1, n):
            p0, p1 = b0[parent[i]] - up[i][0], b1[parent[i]] - up[i][1]
            b0[i] += _add(p0 + e00, p1 + e10)
            b1[i] += _add(p0 + e01, p1 + e11)
        return [1.0 / (1.0 + np.exp(min(700.0, x - y))) for x, y in zip(b0, b1)]

    def text(self, source: str) -> str:
        page = Page(source)
        content = self.marginals(page)
        blocks = (flat("".join(t for i, t in b if content[i] > 0.5)) for b in page.blocks)
        return "\n".join(x for x in blocks if x)


def _add(x: float, y: float) -> float:
    """log(exp x + exp y)."""
    top = max(x, y)
    return top + float(np.log1p(np.exp(min(x, y) - top)))


def train(labelled: DataFrame) -> Model:
    """``labelled``: html, truth (text of the page's document)."""
    def count(batches):
        counts: dict = {}
        for b in batches:
            for at in range(0, b.num_rows, 64):
                for h, t in zip(b.column("html").slice(at, 64).to_pylist(), b.column("truth").slice(at, 64).to_pylist()):
                    observe(Page(h), t, counts)
        cols = list(zip(*((f, v, s, float(n)) for (f, v, s), n in counts.items()))) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.float64()))],
                                         ["f", "v", "s", "n"])

    got = (labelled.filter("html is not null and truth is not null").select("html", "truth")
           .mapInArrow(count, "f string, v string, s int, n double").groupBy("f", "v", "s").agg(F.sum("n").alias("n")).collect())
    counts = {(f, v, s): n for f, v, s, n in got}
    for f, v, s, n in PRIOR:
        counts[f, v, s] = counts.get((f, v, s), 0.0) + n
    return Model(counts)


def labelled_sample(pages: DataFrame, documents: DataFrame, train_pages: int = 2000) -> DataFrame:
    """The pages of least URL hash whose URL names a document: html, truth."""
    named = pages.select("html", shown_document(F.col("url")).alias("shown"), F.xxhash64("url").alias("h")).filter("shown is not null")
    # a documented bound on what the model is fitted to; hashes first, so no task holds many pages
    picked = named.select("h").distinct().orderBy("h").limit(train_pages)
    some = stash(named.join(F.broadcast(picked), "h").groupBy("h").agg(F.min("html").alias("html"), F.min("shown").alias("shown")))
    docs = documents.select("doc_id", F.col("text").alias("truth"))
    return some.join(docs.join(F.broadcast(some.select(F.col("shown").alias("doc_id")).distinct()), "doc_id"),
                     F.col("shown") == F.col("doc_id")).select("html", "truth")


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [m.text(h or "") for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
