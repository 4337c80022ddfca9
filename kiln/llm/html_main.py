"""Main text of web pages by site style trees.

Pages of one host share templates. Each page is parsed into a tree of styled
block elements (tag, class and id, digits left out) with its text as leaves;
merging the trees of a host's distinct pages gives its style tree, whose nodes
are paths from the root.

1. *Presentation.* The children of a node, as a sequence of styles, differ from
   page to page or not: the entropy of these sequences over the pages, relative
   to the largest possible one, is the node's own importance.
2. *Content.* The same entropy of a leaf's text. Text that is the same on page
   after page has none. Nodes on fewer than ``PAGES`` pages count as important.
3. *Branches.* Bottom-up, a node with ``l`` different sequences weighs
   ``(1 - DECAY^l)`` of its own importance and ``DECAY^l`` of its children's, each
   by its share of the node's text.
4. *Priors.* Names lower weights: navigation, footers, asides, forms and headers
   outside the article, and class or id names that say furniture (``furniture``
   tells them from names that only mention it, such as ``has-sidebar``). A branch
   that holds the article (or main) element is not lowered, and nothing is
   removed for a name alone unless the name is plain. Where the article holds a
   good part of the page's text, what stands beside it weighs little.
5. *Removal*, on each page: leaves of low weight, and branches of low importance
   unless they hold a good part of the page's important text (a wrapper around
   all is not removed for its static parts). Inside an article only text that
   many pages repeat literally goes (``ARTICLE_*``).

Pages whose blocks are all equal count once, so copies of an article do not make
it look like a template.

*Scale.* Nodes are counted per (host, path); no host is gathered. Importance goes
up level by level in joins of that table (at most ``LEVELS``: deeper elements
belong to their ancestor there). Pages look up their low nodes by (host, set of
paths), of which there are about as many as templates.

Null or empty html gives an empty text; malformed html is read as far as it goes;
very long pages are parsed whole, in linear time; repeated rows give one result
each; ties do not arise; other columns travel in ``doc``, so no name can clash;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.components import _written

#: Pages a node needs before its entropy counts.
PAGES = 5
#: Weight below which leaves and branches go.
LOW = 0.2
#: The part of children's importance with one sequence of styles.
DECAY = 0.9
#: Inside an article: pages, and the entropy below which a leaf goes.
ARTICLE_PAGES, ARTICLE_ENTROPY = 20, 0.05
#: Weights of plain furniture, of names that say furniture among other words, and
#: of what stands beside an article with at least ``SHARE`` of the text.
PLAIN, MIXED, BESIDE, SHARE = 0.1, 0.6, 0.15, 1 / 3
#: Part of the page's important text that a low branch may take with it.
SMALL = 0.2
#: Depth of the style trees.
LEVELS = 32

# HTML element names and the words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table
tbody td tfoot th thead tr ul""".split())
WEIGHTLESS = frozenset("""script style noscript template button select option textarea iframe object svg canvas head title
audio video map input label""".split())
ASIDE = frozenset("nav footer aside menu dialog".split())
LOWERED = ASIDE | {"form", "fieldset", "header"}
MAIN = frozenset({"article", "main"})
CLOSED_BY = {"p": BLOCK - {"body", "html"}, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}),
             "dd": frozenset({"dt", "dd"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
             "tr": frozenset({"tr", "tbody", "tfoot", "thead"}), "option": frozenset({"option"})}
SCOPE = frozenset({"table", "article", "section", "div", "ul", "ol", "dl", "body", "html", "main", "nav", "aside", "footer"})
FURNITURE = frozenset("""ad ads adv advert adverts advertisement advertising adsense adsbygoogle banner sponsor sponsored
promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login
social share sharing sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead comment
comments disqus reply replies respond related recommended recommendations widget widgets toolbar copyright hidden teaser teasers
""".split())
# Words that go with furniture without changing it, and words that deny it.
NEUTRAL = frozenset("""box wrapper wrap container list block area section panel item items link links bar top bottom left right
site page main global primary secondary button buttons icons form inner outer content posts articles stories header title
row col column group text js id""".split())
DENIED = frozenset("no non not has have with without free hide off".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HOST = re.compile(r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")
TORN = re.compile(r"<[A-Za-z/!?][^<>]*$")


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def furniture(names: str) -> float:
    """Weight of an element by one class or id attribute: ``PLAIN`` if a name
    consists of furniture words (and neutral ones), ``MIXED`` if it ends in one
    among other words, else 1. A name that denies the word says nothing."""
    weight = 1.0
    for name in names.split():
        words = [w.lower() for w in WORD.findall(name)]
        said = [w in FURNITURE for w in words]
        if not any(said) or not DENIED.isdisjoint(words):
            continue
        plain = all(f or w in NEUTRAL for f, w in zip(said, words)) and (said[0] or said[-1])
        weight = min(weight, PLAIN if plain else MIXED if said[-1] else 1.0)
    return weight


class Node:
    """One path of a page's tree."""
    __slots__ = ("path", "up", "depth", "weight", "aside", "article", "kids", "chars", "content", "main")

    def __init__(self, path, up, depth, weight, aside, article):
        self.path, self.up, self.depth, self.weight, self.aside, self.article = path, up, depth, weight, aside, article
        self.kids: list[str] = []              # styles of its children, in order
        self.chars, self.content, self.main = 0, None, False


class Page(HTMLParser):
    """Tree of one page: ``nodes`` by path, ``blocks`` (leaf, text) in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = [Node(0, -1, 0, 1.0, False, False)]
        self.at: dict[int, int] = {0: 0}
        self.stack: list[tuple[str, int, bool]] = []            # tag, node, weightless
        self.open: dict[str, int] = {}
        self.blocks: list[tuple[int, str]] = []
        self.buffer: list[str] = []
        self.place: int | None = None
        self.mains: list[int] = []

    def node(self, style: str, up: int, weight=1.0, aside=False, article=False) -> int:
        above = self.nodes[up]
        path = xxhash.xxh64_intdigest(f"{above.path}/{style}")
        if path not in self.at:
            self.at[path] = len(self.nodes)
            self.nodes.append(Node(path, up, above.depth + 1, weight, aside or above.aside, article or above.article))
        return self.at[path]

    def flush(self):
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                up = self.place
                leaf = self.node("#text", up)
                self.nodes[up].kids.append("#text")
                n = self.nodes[leaf]
                n.content = n.content or xxhash.xxh64()
                n.content.update(text + "\n")
                k = leaf
                while k >= 0:
                    self.nodes[k].chars += len(text)
                    k = self.nodes[k].up
                self.blocks.append((leaf, text))
            self.buffer = []
        self.place = None

    def pop(self):
        tag, node, _ = self.stack.pop()
        self.open[tag] -= 1
        if tag in BLOCK or node != (self.stack[-1][1] if self.stack else 0):
            self.flush()

    def close_implied(self, tag):
        for old, closers in CLOSED_BY.items():
            if tag in closers and self.open.get(old):
                for k in range(len(self.stack) - 1, -1, -1):
                    name = self.stack[k][0]
                    if name == old:
                        while len(self.stack) > k:
                            self.pop()
                        break
                    if name in SCOPE:
                        break

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
        self.close_implied(tag)
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        _, up, dead = self.stack[-1] if self.stack else ("", 0, False)
        node, here = up, self.nodes[up]
        dead = dead or tag in WEIGHTLESS
        words, weight, main = [], 1.0, tag in MAIN
        for name, value in attrs:
            value = value or ""
            if name in ("class", "id"):
                words += WORD.findall(value)
                if tag not in ("html", "body"):
                    weight = min(weight, furniture(value))
            elif name == "role" and value.lower() in ROLES:
                weight = min(weight, PLAIN)
            elif name == "role" and value.lower() in ("main", "article") or name == "itemprop" and value == "articleBody":
                main = True
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                dead = True
        main = main and weight == 1.0
        if not dead and (tag in BLOCK or weight < 1.0) and here.depth < LEVELS:
            self.flush()                        # a lowered inline element is a block of its own
            if tag in LOWERED and not (tag == "header" and here.article):
                weight = min(weight, PLAIN)
            style = f"{tag}.{' '.join(words).lower()}.{weight:g}.{main:d}"
            here.kids.append(style)
            node = self.node(style, up, weight, tag in ASIDE, main)
        if main and not dead:
            self.mains.append(node)
        self.stack.append((tag, node, dead))
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        if not self.open.get(tag):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                while len(self.stack) > k:
                    self.pop()
                return

    def handle_data(self, data):
        _, node, dead = self.stack[-1] if self.stack else ("", 0, False)
        if not dead:
            if self.place is None:
                self.place = node
            self.buffer.append(data)

    def packed(self) -> dict:
        """What ``kept`` needs of the tree."""
        n = self.nodes
        return {"paths": [_signed(x.path) for x in n], "ups": [x.up for x in n], "weights": [x.weight for x in n],
                "asides": [k for k, x in enumerate(n) if x.aside], "leaves": sorted({k for k, _ in self.blocks}),
                "mains": self.mains, "places": [k for k, _ in self.blocks], "texts": [t for _, t in self.blocks]}

    @classmethod
    def unpacked(cls, tree: dict) -> Page:
        page = cls()
        page.nodes = [Node(p % (1 << 64), u, 0, w, False, False) for p, u, w in zip(tree["paths"], tree["ups"], tree["weights"])]
        for k in tree["asides"]:
            page.nodes[k].aside = True
        for k in tree["leaves"]:
            page.nodes[k].content = True
        page.mains, page.blocks = tree["mains"], list(zip(tree["places"], tree["texts"]))
        return page

    def chain(self, k: int):
        while k > 0:
            yield k
            k = self.nodes[k].up

    def article_nodes(self) -> set[int]:
        """Nodes of the article: those under no furniture, if there are any."""
        found = [m for m in self.mains if not self.nodes[m].aside]
        clean = [m for m in found if all(self.nodes[k].weight > PLAIN for k in self.chain(self.nodes[m].up))]
        for m in clean or found:
            for k in self.chain(m):
                self.nodes[k].main = True
        return set(clean or found)

    def kept(self, low: dict[int, tuple[float, int]]) -> list[tuple[int, bool, str]]:
        """Blocks that stay, given the importance and pages of the host's low
        nodes: ``(leaf's path, in the article, text)``."""
        mains, nodes = self.article_nodes(), self.nodes
        inside = [False] * len(nodes)
        prior = [1.0] * len(nodes)
        for k in range(1, len(nodes)):                          # parents come first
            n = nodes[k]
            inside[k] = k in mains or inside[n.up]
            prior[k] = min(prior[n.up], n.weight if not n.main else 1.0)
        plain = sum(len(t) for k, t in self.blocks if prior[k] > PLAIN)
        beside = mains and sum(len(t) for k, t in self.blocks if prior[k] > PLAIN and inside[k]) >= SHARE * plain

        def weight(k):
            imp, pages = low.get(nodes[k].path, (1.0, 0))
            if inside[k]:
                return prior[k] * (0.0 if imp < ARTICLE_ENTROPY and pages >= ARTICLE_PAGES else 1.0)
            return prior[k] * imp * (BESIDE if beside else 1.0)

        heavy = [weight(k) >= LOW for k, _ in self.blocks]
        mass = [0] * len(nodes)
        for (k, text), h in zip(self.blocks, heavy):
            for j in self.chain(k) if h else ():
                mass[j] += len(text)
        whole = sum(len(t) for (_, t), h in zip(self.blocks, heavy) if h)
        cut = [False] * len(nodes)
        for k in range(1, len(nodes)):
            n = nodes[k]
            gone = n.path in low and n.content is None and not n.main and not inside[k] and mass[k] <= SMALL * whole
            cut[k] = gone or cut[n.up]
        return [(nodes[k].path, inside[k], t) for (k, t), h in zip(self.blocks, heavy) if h and not cut[k]]


def parse(html: str | None) -> Page:
    page = Page()
    if html:
        page.feed(TORN.sub("", html))
        page.close()
        page.flush()
    return page


def blocks_of(html: str | None) -> list[tuple[int, bool, str]]:
    """Blocks that stay of a page of which its host tells nothing."""
    return parse(html).kept({})


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _shape(page: Page) -> int:
    """The set of paths of a page."""
    return _signed(xxhash.xxh64_intdigest(" ".join(map(str, sorted(n.path for n in page.nodes if n.chars)))))


TREE = pa.struct([(n, pa.list_(pa.string() if n == "texts" else pa.float64() if n == "weights" else pa.int64()))
                  for n in ("paths", "ups", "weights", "asides", "leaves", "mains", "places", "texts")])
NODES = "array<struct<path:bigint,up:bigint,depth:int,leaf:boolean,key:bigint,share:double>>"


def main_text(pages: DataFrame, html_col: str = "html", url_col: str = "url", carry: list[str] | None = None) -> DataFrame:
    """Rows ``(doc, text)``: ``doc`` a struct of the input columns (or those
    in ``carry``), ``text`` the main text, its blocks joined by an empty
    line."""
    cols = [F.col(f"`{c}`") for c in (carry if carry is not None else pages.columns)]
    src = pages.select(F.struct(*cols).alias("doc"), F.col(html_col).alias("html"), F.col(url_col).alias("url"))
    kind = dict(src.dtypes)["doc"]
    low = low_nodes(src)

    def trees(batches):
        for batch in batches:
            made = [parse(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array([host_of(u) for u in batch.column("url").to_pylist()], pa.string()),
                 pa.array([_shape(p) for p in made], pa.int64()), pa.array([p.packed() for p in made], TREE)],
                ["doc", "host", "shape", "tree"])

    def cleaned(batches):
        for batch in batches:
            texts = []
            for tree, found in zip(batch.column("tree"), batch.column("low")):
                known = {x["path"] % (1 << 64): (x["imp"], x["m"]) for x in found.as_py() or ()}
                texts.append("\n\n".join(t for _, _, t in Page.unpacked(tree.as_py()).kept(known)))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], ["doc", "text"])

    tree = "struct<" + ",".join(f"{f.name}:array<{'string' if f.name == 'texts' else 'double' if f.name == 'weights' else 'bigint'}>"
                                for f in TREE) + ">"
    parsed = src.mapInArrow(trees, f"doc {kind}, host string, shape long, tree {tree}")
    return parsed.join(low, ["host", "shape"], "left").select("doc", "tree", "low").mapInArrow(cleaned, f"doc {kind}, text string")


def low_nodes(src: DataFrame) -> DataFrame:
    """``(host, shape, low)`` from ``src(html, url)``: the low nodes (path,
    importance, pages) among each set of paths that pages of a host have."""
    def count(batches):
        node = pa.struct([("path", pa.int64()), ("up", pa.int64()), ("depth", pa.int32()), ("leaf", pa.bool_()),
                          ("key", pa.int64()), ("share", pa.float64())])
        for batch in batches:
            out = []
            for html, url in zip(batch.column("html"), batch.column("url")):
                page = parse(html.as_py())
                if not page.blocks:
                    continue
                rows = []
                for n in page.nodes:
                    if n.chars:
                        up = page.nodes[n.up] if n.up >= 0 else None
                        key = n.content.intdigest() if n.content else xxhash.xxh64_intdigest("\n".join(n.kids))
                        rows.append({"path": _signed(n.path), "up": _signed(up.path) if up else None, "depth": n.depth,
                                     "leaf": n.content is not None, "key": _signed(key), "share": n.chars / up.chars if up else 1.0})
                whole = xxhash.xxh64_intdigest("\n".join(f"{page.nodes[k].path} {t}" for k, t in page.blocks))
                out.append((host_of(url.as_py()), _signed(whole), _shape(page), rows))
            if out:
                host, whole, shape, rows = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(whole, pa.int64()), pa.array(shape, pa.int64()),
                                                  pa.array(rows, pa.list_(node))], ["host", "page", "shape", "nodes"])

    seen = _written(src.select("html", "url").mapInArrow(count, f"host string, page long, shape long, nodes {NODES}")
                    .dropDuplicates(["host", "page"]), "page-trees")
    each = seen.select("host", F.explode("nodes").alias("n")).select("host", "n.*")
    counts = each.groupBy("host", "path", "up", "depth", "leaf", "key").agg(F.count(F.lit(1)).alias("c"), F.sum("share").alias("s"))
    m, e = F.sum("c"), F.sum(F.col("c") * F.log(F.col("c")))
    own = F.when(m < PAGES, 1.0).otherwise((F.log(m) - e / m) / F.log(m))
    tree = _written(counts.groupBy("host", "path", "up", "depth", "leaf").agg(
        m.alias("m"), own.alias("own"), F.count(F.lit(1)).alias("l"), F.sum("s").alias("s")), "style-tree")
    deepest = tree.agg(F.max("depth")).first()[0]
    done, below = [], None
    for d in range(deepest if deepest is not None else -1, -1, -1):
        level = tree.filter(F.col("depth") == d)
        if below is None:
            level = level.withColumn("kids", F.lit(0.0))
        else:
            kids = below.groupBy("host", F.col("up").alias("path")).agg(F.sum(F.col("s") * F.col("imp")).alias("kids"))
            level = level.join(kids, ["host", "path"], "left")
        rest = F.pow(F.lit(DECAY), F.col("l"))
        imp = F.when(F.col("leaf") | (F.col("m") < PAGES), F.col("own")).otherwise(
            (1 - rest) * F.col("own") + rest * F.coalesce("kids", F.lit(0.0)) / F.col("m"))
        below = _written(level.select("host", "path", "up", "m", "s", imp.alias("imp")), f"style-level-{d}")
        done.append(below.filter(F.col("imp") < LOW).select("host", "path", "m", "imp"))
    if not done:
        return src.sparkSession.createDataFrame([], "host string, shape long, low array<struct<path:bigint,imp:double,m:bigint>>")
    found = reduce(lambda a, b: a.unionByName(b), done)
    paths = seen.groupBy("host", "shape").agg(F.first("nodes.path").alias("paths")).select("host", "shape", F.explode("paths").alias("path"))
    return _written(paths.join(found, ["host", "path"]).groupBy("host", "shape").agg(
        F.collect_list(F.struct("path", "imp", "m")).alias("low")), "style-low")
