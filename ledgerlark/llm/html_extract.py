"""Main text of web pages: site templates are removed by hashing element subtrees, counting them per host, and deleting
those that recur on many pages of a host; then the article's blocks are joined.

What is boilerplate is decided in this order: recurring subtrees (templates); elements whose tag, role or hidden state says so
(`nav`, `footer`, role=navigation ...); outside articles, lists and boxes of links; and containers whose class or id is made of
nothing but words for such parts (`cookie-notice`, not `share-price` or `search-results-discussion`); text blocks only if it is
made of words for adverts. A word that an article may use itself (`cookies`, `related`) counts inside one only for a box of links
or of something to press.

A page is parsed into a flat element table by one regular expression; void elements, implied ends (`p`, `li`, ...), comments,
raw text elements and unclosed tags are handled as browsers do, as far as text is concerned. The same parse serves both
passes, so no tree leaves a task: between them only (host, subtree hash) counts are shuffled, pre-aggregated by task.
"""

from __future__ import annotations

import html as html_lib
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, saved
from .url_filter import url_host

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|([a-zA-Z_:][-\w:.]*)", re.S)
SPACE = re.compile(r"\s+")

# Fixed values of HTML: elements by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
#: What a start tag ends if it is open, up to the nearest of the second set.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"}),
}
#: Elements that are never the article's text.
DROPPED = frozenset("head nav footer aside form button select input menu dialog svg canvas object audio video map".split()) | RAW
#: Roles of what is never the article's text.
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words for such parts in a class or id, and words that may stand beside them.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar rail related recommended "
    "notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments disqus respond reply replies pagination pager "
    "toolbar widget widgets skip".split())
NEUTRAL = frozenset("page site main top bottom left right box slot wrapper container area block list section bar inner outer unit links the thread reader readers user users post posts button buttons icons form item items media".split())
#: Marks of adverts, which count for blocks of text too.
ADVERTS = frozenset("ad ads advert adverts advertisement advertisements sponsored".split())
#: Marks that an article may use of its own matter. Alone in a class or id inside an article they decide nothing; the box goes if it
#: is links for half of its text at least, or has something to press.
OPEN = frozenset("cookie cookies related recommended share sharing social".split())
CONTROLS = frozenset("button input form select textarea".split())
#: Marks that hold for `article` elements too: comments and adverts are often articles of their own.
NESTED = frozenset("ad ads advert advertisement promo sponsored related comment comments reply replies".split())
#: Blocks of text: inside an article they are no templates, and marked by a class or id only as adverts.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption caption".split())
NEVER = frozenset("html head body article main".split())
LINK_BOXES = frozenset("ul ol menu div section table dl p".split())
ROOTS = ("article", "main")


class Page:
    """Elements in document order, as parallel lists: tag, parent, marked, last (one after the last descendant); and the text
    runs as (element, text) or (element, None) where a line ends."""

    def __init__(self, source: str | None):
        self.tag, self.parent, self.marked, self.last, self.attributes = ["#root"], [-1], [False], [0], [""]
        self.runs: list[tuple[int, str | None]] = []
        self.open: list[int] = []  # inside an article, with a mark that decides nothing alone
        open_: list[int] = [0]
        at, source = 0, source or ""
        search = TOKEN.search
        while m := search(source, at):
            if m.start() > at:
                self.runs.append((open_[-1], source[at : m.start()]))
            at = m.end()
            name = m[2] or m[5]
            if name is None:  # comment, declaration
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._close(open_, name)
                continue
            attributes = (m[3] or m[6] or "").strip()
            self._imply(open_, name)
            me = len(self.tag)
            self.tag.append(name)
            self.parent.append(open_[-1])
            self.attributes.append(attributes)
            mark = name in DROPPED or bool(attributes) and self._is_marked(name, attributes)
            if mark == "open":
                mark = not any(self.tag[a] in ROOTS for a in open_)
                if not mark:
                    self.open.append(me)
            self.marked.append(mark)
            self.last.append(me + 1)
            if name in BLOCKS or name == "br":
                self.runs.append((me, None))
            if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b", re.I).search(source, at)
                stop = end.start() if end else len(source)
                if stop > at:
                    self.runs.append((me, source[at:stop]))
                at = stop
            open_.append(me)
        if at < len(source):
            self.runs.append((open_[-1], source[at:]))
        while open_:
            self.last[open_.pop()] = len(self.tag)
        for e in self.open:
            self.marked[e] = self._is_box(e)

    def _is_box(self, e: int) -> bool:
        """Whether an element is links for half of its text at least, or has something to press."""
        if any(self.tag[k] in CONTROLS for k in range(e + 1, self.last[e])):
            return True
        text = linked = 0
        for k, run in self.runs:
            if run and e <= k < self.last[e]:
                n = len(run.strip())
                text += n
                while k > e and self.tag[k] != "a":
                    k = self.parent[k]
                linked += n if k > e else 0
        return 2 * linked >= text > 0

    def _pop(self, open_: list[int]) -> None:
        e = open_.pop()
        self.last[e] = len(self.tag)
        if self.tag[e] in BLOCKS:
            self.runs.append((self.parent[e], None))

    def _close(self, open_: list[int], name: str) -> None:
        for k in range(len(open_) - 1, 0, -1):
            t = self.tag[open_[k]]
            if t == name:
                while len(open_) > k:
                    self._pop(open_)
                return
            if name not in BLOCKS and t in BLOCKS:  # an inline end tag doesn't close blocks
                return

    def _imply(self, open_: list[int], name: str) -> None:
        ended, within = ENDS.get(name, (None, None))
        if name in ENDS_P:
            for k in range(len(open_) - 1, 0, -1):
                t = self.tag[open_[k]]
                if t == "p":
                    while len(open_) > k:
                        self._pop(open_)
                    break
                if t in BLOCKS:
                    break
        if ended:
            k = len(open_) - 1
            while k > 0 and self.tag[open_[k]] not in within:
                if self.tag[open_[k]] in ended:
                    while len(open_) > k:
                        self._pop(open_)
                k = min(k, len(open_)) - 1

    @staticmethod
    def _is_marked(name: str, attributes: str) -> bool | str:
        """Whether the attributes say so; `open` if they only may."""
        found: bool | str = False
        for m in ATTRIBUTE.finditer(attributes):
            key, value = (m[1] or m[3]).lower(), (m[2] or "").strip("\"'")
            if key == "hidden" or key == "aria-hidden" and "true" in value:
                return True
            if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                return True
            if name in ("html", "body", "main"):
                continue
            if key == "role" and value.strip().lower() in ROLES:
                return True
            if key in ("class", "id"):
                marks = ADVERTS if name in TEXT_BLOCKS else NESTED if name == "article" else MARKS
                for one in value.split():
                    said = {w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", one).lower()) if w}
                    if said & marks and said <= (ADVERTS if name in TEXT_BLOCKS else MARKS) | NEUTRAL:
                        if len(said) == 1 and said <= OPEN:
                            found = "open"
                        else:
                            return True
        return found

    def roots(self, hidden: list[bool]) -> list[int]:
        """The article: of the `article` elements that aren't inside another one, the largest and its siblings; the `main` around
        them, if most of its text is outside them; without an article `main`, else the body, else all."""
        size = [0] * (len(self.tag) + 1)
        for e, text in self.runs:
            if text and not hidden[e]:
                size[e] += len(text.strip())
        total = [0]
        for n in size:
            total.append(total[-1] + n)
        weight = lambda e: total[self.last[e]] - total[e]
        mains = [e for e in range(1, len(self.tag)) if self.tag[e] == "main" and not hidden[e]]
        articles = [e for e in range(1, len(self.tag)) if self.tag[e] == "article" and not hidden[e] and not any(self.tag[a] == "article" for a in self._above(e))]
        if articles:
            best = max(articles, key=lambda e: (weight(e), -e))
            found = [e for e in articles if self.parent[e] == self.parent[best]]
            around = next((a for a in self._above(best) if self.tag[a] == "main"), None)
            if around is not None and 2 * sum(map(weight, found)) < weight(around):
                return [around]
            return found
        if mains:
            return [max(mains, key=lambda e: (weight(e), -e))]
        return [next((e for e in range(1, len(self.tag)) if self.tag[e] == "body"), 0)]

    def link_boxes(self, inside: list[bool]) -> set[int]:
        """Outside articles: lists and boxes with three links or more whose text is links for four fifths at least."""
        text, linked, links = ([0] * len(self.tag) for _ in range(3))
        in_link = [False]
        for e in range(1, len(self.tag)):
            in_link.append(in_link[self.parent[e]] or self.tag[e] == "a")
        for e, run in self.runs:
            if run and self.tag[e] not in RAW:
                n = len(run.strip())
                text[e] += n
                linked[e] += n if in_link[e] else 0
        for e in range(len(self.tag) - 1, 0, -1):
            p = self.parent[e]
            text[p] += text[e]
            linked[p] += linked[e]
            links[p] += links[e] + (self.tag[e] == "a")
        return {e for e in range(1, len(self.tag)) if self.tag[e] in LINK_BOXES and not inside[e] and links[e] >= 3 and 5 * linked[e] >= 4 * text[e] > 0}

    def _inside(self) -> list[bool]:
        inside = [False]
        for e in range(1, len(self.tag)):
            inside.append(inside[self.parent[e]] or self.tag[e] in ROOTS)
        return inside

    def _hidden(self, deleted: frozenset[int] | set[int]) -> list[bool]:
        hidden = [False]
        for e in range(1, len(self.tag)):
            p = self.parent[e]
            own = self.marked[e] or e in deleted
            if self.tag[e] == "header" and not own:  # a page header; an article's own heading block stays
                own = not any(self.tag[a] in ROOTS for a in self._above(e))
            hidden.append(hidden[p] or own)
        return hidden

    def _above(self, e: int):
        while (e := self.parent[e]) > 0:
            yield e

    def subtrees(self) -> dict[int, int]:
        """Hash of each candidate subtree: tag, attributes, text and all below. Inside an article only containers are
        candidates, so a sentence that many articles share is no template; outside all elements are."""
        parts: list[list[str]] = [[] for _ in self.tag]
        inside = self._inside()
        for e, text in self.runs:
            if text is not None and (t := SPACE.sub(" ", text).strip()):
                parts[e].append(t)
        hashes: dict[int, int] = {}
        length = [0] * len(self.tag)
        for e in range(len(self.tag) - 1, 0, -1):
            body = "\x1f".join([self.tag[e], self.attributes[e], *parts[e]]).encode()
            key = zlib.crc32(body) | zlib.adler32(body) << 32
            length[e] += sum(map(len, parts[e]))
            hashes[e] = hashes.get(e, 0)
            value = (key ^ (hashes[e] * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
            value = (value ^ (value >> 29)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
            hashes[e] = value
            p = self.parent[e]
            if p > 0:
                hashes[p] = (hashes.get(p, 0) * 0x100000001B3 + value) & 0xFFFFFFFFFFFFFFFF
                length[p] += length[e]
        return {e: h for e, h in hashes.items() if length[e] and self.tag[e] not in RAW | NEVER and not (inside[e] and (self.tag[e] in TEXT_BLOCKS or self.tag[e] not in BLOCKS))}

    def text(self, deleted: frozenset[int] | set[int] = frozenset()) -> str:
        """Blocks of the article in page order, without marked elements and deleted subtrees."""
        gone = {*deleted, *self.link_boxes(self._inside())}
        hidden = self._hidden(gone)
        roots = self.roots(hidden)
        kept = [False] * len(self.tag)
        for r in roots:
            kept[r : self.last[r]] = [True] * (self.last[r] - r)
        blocks, run = [], []
        for e, text in self.runs:
            if not kept[e]:
                if run and text is None:
                    blocks.append("".join(run))
                    run = []
                continue
            if text is None:
                blocks.append("".join(run))
                run = []
            elif not hidden[e] or roots == [0] and e == 0:
                run.append(html_lib.unescape(text))
        blocks.append("".join(run))
        return " ".join(b for b in (SPACE.sub(" ", x).strip() for x in blocks) if b)


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def page_hash(source: str | None) -> int:
    own = (source or "").encode("utf-8", "replace")
    return signed(zlib.crc32(own) | zlib.adler32(own) << 32)


def template_counts(pages: DataFrame, html: str = "html", most: int = 10) -> DataFrame:
    """(site, subtree, pages_with): on how many different pages of a site a subtree occurs. A task sends up to `most` pages of a
    subtree, which is all that has to be known; copies of a page are one page, else its text would be a template of its copies."""

    def run(batches):
        import pyarrow as pa

        seen: dict[tuple[int, int], set[int]] = {}

        def send():
            rows = [(*k, p) for k, met in seen.items() for p in met]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)] or [pa.array([], pa.int64())] * 3, ["site", "subtree", "page"])

        for batch in batches:
            for site, source in zip(batch.column("site").to_pylist(), batch.column(html)):
                source = source.as_py()
                page = page_hash(source)
                for h in set(Page(source).subtrees().values()):
                    if len(met := seen.setdefault((site, signed(h)), set())) < most:
                        met.add(page)
            if len(seen) > 50_000:
                yield send()
        yield send()

    met = mapped(pages.select("site", html), run, "site long, subtree long, page long").distinct()
    return met.groupBy("site", "subtree").agg(F.count("*").alias("pages_with"))


def find_templates(rows: DataFrame, html: str, least_pages: int, share: float) -> DataFrame:
    """(site, subtree) of the templates of rows (site, html), as a written table."""
    sizes = rows.select("site", F.xxhash64(html).alias("page")).distinct().groupBy("site").agg(F.count("*").alias("pages"))
    counted = template_counts(rows, html, max(2, least_pages)).where("pages_with >= 2")
    wanted = F.least(F.lit(least_pages), F.greatest(F.lit(2), F.ceil(share * F.col("pages"))))
    return saved(counted.join(sizes, "site").where(F.col("pages_with") >= wanted).select("site", "subtree"), "templates")


def extract(pages: DataFrame, url: str = "url", html: str = "html", least_pages: int = 10, share: float = 0.5, most_templates: int = 1_000_000, templates: bool = True) -> DataFrame:
    """pages (without html) with text and n_chars; columns of these names are replaced.

    A subtree outside articles, or a container inside one, is a site template if it occurs on `least_pages` different pages of
    its host, however large; on a host too small for that, on `share` of its different pages, two at least. Null html is empty;
    without any text the result is an empty string. Pages without a host form one host. Up to `most_templates` templates (16
    bytes each) are broadcast; beyond, each page's own subtrees are joined with them, in rows of their own, so neither a
    large host nor a template that is on all of its pages meets in one task. templates=False leaves that step out.
    """
    added = ["text", "n_chars"]
    names = [c for c in pages.columns if c not in added]
    rows = pages.select(*names, F.xxhash64(url_host(F.col(url))).alias("__site"), F.col(html).cast("string").alias("__html"))
    kept = [f for f in rows.schema.fields if f.name in names and f.name != html]
    schema = pages.select(*(f.name for f in kept)).schema.add("text", "string").add("n_chars", "long")

    def emit(batch, of_row):
        import pyarrow as pa

        texts = []
        for i, source in enumerate(batch.column("__html")):
            page = Page(source.as_py())
            texts.append(page.text(of_row(i, page)))
        return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*(f.name for f in kept), *added])

    sited = rows.select(F.col("__site").alias("site"), F.col("__html").alias("html"))
    found = find_templates(sited, "html", least_pages, share) if templates else None
    if found is None or found.count() <= most_templates:
        held = np.array([(r["site"], r["subtree"]) for r in found.collect()] if found is not None else [], np.int64).reshape(-1, 2)
        held = held[np.lexsort((held[:, 1], held[:, 0]))]
        shared = pages.sparkSession.sparkContext.broadcast(held)

        def run(batches):
            sites, trees = shared.value[:, 0], shared.value[:, 1]
            own: dict[int, frozenset[int]] = {}  # of the sites of one batch
            for batch in batches:
                own.clear()
                of = batch.column("__site").to_pylist()

                def gone(i, page, of=of):
                    a, b = np.searchsorted(sites, of[i], "left"), np.searchsorted(sites, of[i], "right")
                    if a == b:
                        return frozenset()
                    known = own.get(of[i])
                    if known is None:
                        known = own[of[i]] = frozenset(trees[a:b].tolist())
                    return {e for e, h in page.subtrees().items() if signed(h) in known}

                yield emit(batch, gone)

        return mapped(rows, run, schema)

    def subtrees(batches):
        import pyarrow as pa

        for batch in batches:
            out = [(site, a, b, signed(h)) for site, a, b, source in zip(*(batch.column(c).to_pylist() for c in ("site", "a", "b", "html"))) for h in set(Page(source).subtrees().values())]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)] or [pa.array([], pa.int64())] * 4, ["site", "a", "b", "subtree"])

    keys = [F.xxhash64(F.lit(k), "__site", "__html").alias(f"__{k}") for k in "ab"]  # a page is named by its content
    rows = rows.withColumns({"__a": keys[0], "__b": keys[1]})
    spread = 16  # a template of a third of all pages is dealt to so many tasks, beyond what Spark splits by itself
    own = mapped(rows.select(F.col("__site").alias("site"), F.col("__a").alias("a"), F.col("__b").alias("b"), F.col("__html").alias("html")), subtrees, "site long, a long, b long, subtree long")
    own = own.distinct().withColumn("salt", F.pmod("a", F.lit(spread)))
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)).cast("array<long>")))
    known = own.join(salted, ["site", "subtree", "salt"]).groupBy(F.col("a").alias("__a"), F.col("b").alias("__b")).agg(F.collect_set("subtree").alias("__known"))  # a page's own subtrees

    def run_joined(batches):
        for batch in batches:
            lists = batch.column("__known")

            def gone(i, page, lists=lists):
                known = set(lists[i].as_py() or ())
                return {e for e, h in page.subtrees().items() if signed(h) in known} if known else frozenset()

            yield emit(batch, gone)

    return mapped(rows.join(known, ["__a", "__b"], "left"), run_joined, schema)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", "n_chars")
