"""Operator 4: main text of HTML pages by removing site templates.

A page's region is its article (else main element, else body) without elements
whose tag or class names them as something else. The subtree of every element in
it (tags, classes and text, not link targets) is hashed, and Spark counts per host
on how many pages of different main text each subtree occurs.

What recurs may be the site's template or a passage that pages copied from each
other. They are told apart by what stands beside them: a template stands among
text of the page's own, a copied passage among copies. A page's own text is that
of elements recurring on fewer than ``MIN_PAGES`` pages; a page of which it is
less than half is mostly a copy and says nothing about templates. A container
subtree found on ``TEMPLATE_PAGES`` other pages is a template and cut from every
page of the host, be it on all or a thousandth of them. Containers are what pages
are put together from: inside an article sections, and lists, tables and the like
that have a class or id. Prose (paragraphs, headings, quotations, leaf elements
that stand beside two others of their tag and class) may be a quoted passage, and is a
template only on ``PROSE_PAGES`` pages and ``PROSE_SHARE`` of the host's pages.

The templates are broadcast while they are fewer than ``MAX_BROADCAST``; beyond
that each page is joined with the templates among its own subtrees.

Not found: a template on fewer pages, one longer than the page's own text on every
page, and a bare paragraph on part of a host's pages.

Defined cases: a null html is empty and gives an empty text; a null url belongs
to the host ''; repeated rows each get their own result, and pages of the same main
text count once; text that is no markup is one block; pages of any length are read
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator, Set

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import staged

MIN_PAGES, TEMPLATE_PAGES = 3, 8
PROSE_PAGES, PROSE_SHARE = 20, 0.8
MAX_BROADCAST = 200_000
TEXT, CONTAINER, PART = 0, 1, 2

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe noembed noframes xmp textarea title svg math template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
SECTION = frozenset("div section center".split())
LIST = frozenset("ul ol dl table figure details address".split())
DROP = frozenset("head nav footer aside form button select input menu dialog fieldset object canvas audio video search".split())
#: Words in a class, id or role that name something other than the article.
DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer masthead topbar toolbar pagination pager "
    "comment comments disqus discussion replies share sharing social related recommended recommendations newsletter subscribe signup login search "
    "complementary contentinfo".split())
#: Start tags that end an open element of the second set, up to one of the third.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
         "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_TEXT_ENDS = BLOCK - {"body", "html", "head", "li", "dd", "dt", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}


class Page:
    """Elements in page order, and pieces of text with the element each stands in.

    ``piece`` holds (element, text, new block?); an element ends before
    ``last[e]``, the number of the first element after its subtree.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.names, self.hidden, self.last = ["#page"], [-1], [""], [False], [0]
        self.piece: list[tuple[int, str, bool]] = []
        stack, at, broken, lower = [0], 0, True, None
        for m in _TAG.finditer(source):
            if m.start() < at:  # inside raw text
                continue
            if m.start() > at:
                self.piece.append((stack[-1], source[at:m.start()], broken))
                broken = False
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == name:
                        self._close(stack, k)
                        break
                broken |= name in BLOCK
                continue
            if name in _TEXT_ENDS:
                self._end(stack, {"p"}, {"button", "table", "td", "th", "caption", "object"})
            if name in _ENDS:
                self._end(stack, *_ENDS[name])
            broken |= name in BLOCK
            if name == "br":
                self.piece.append((stack[-1], " ", broken))
                broken = False
            if name in RAW and not m.group(3).endswith("/"):
                lower = source.lower() if lower is None else lower
                end = lower.find("</" + name, at) if len(lower) == len(source) else source.find("</" + name, at)
                close = source.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else len(source)
                continue
            if name in VOID or m.group(3).endswith("/") and name not in BLOCK:
                continue
            attributes = m.group(3)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.names.append(" ".join("".join(x) for x in _NAMES.findall(attributes)).lower() if "=" in attributes else "")
            self.hidden.append(bool(attributes) and bool(_HIDDEN.search(attributes)))
            self.last.append(0)
            stack.append(len(self.tag) - 1)
        if at < len(source):
            self.piece.append((stack[-1], source[at:], broken))
        self._close(stack, 0)

    def _close(self, stack: list[int], k: int) -> None:
        for e in stack[k:]:
            self.last[e] = len(self.tag)
        del stack[k:]

    def _end(self, stack: list[int], names: set[str], stop: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[k]]
            if name in names:
                self._close(stack, k)
                return
            if name in stop:
                return

    def hashes(self) -> list[int]:
        """Of each element's subtree; 0 for one without text."""
        parts: list[list[str]] = [[] for _ in self.tag]
        by_element: dict[int, list[str]] = {}
        for e, text, _ in self.piece:
            by_element.setdefault(e, []).append(text)
        out = [0] * len(self.tag)
        for e in range(len(self.tag) - 1, -1, -1):  # children come after their parent
            text = " ".join(" ".join(by_element.get(e, ())).split())
            inner = parts[e]
            if text or inner:
                content = "\x01".join([self.tag[e], self.names[e], text, *reversed(inner)])
                h = hashlib.blake2b(content.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                out[e] = int.from_bytes(h, "little", signed=True)
                if e:
                    parts[self.parent[e]].append(h.hex())
        return out

    def body(self) -> tuple[list[bool], list[bool]]:
        """Of each element: inside an article (else main), and dropped by its tag or names (or an ancestor's)."""
        n = len(self.tag)
        dropped, inside = [False] * n, [False] * n
        for e in range(1, n):
            p = self.parent[e]
            named = self.names[e] and not DROP_NAMES.isdisjoint(_PART.findall(self.names[e])) and self.tag[e] not in ("body", "html", "article", "main")
            dropped[e] = dropped[p] or self.tag[e] in DROP or self.hidden[e] or bool(named)
        for container in ("article", "main"):
            for e in range(1, n):
                inside[e] = inside[self.parent[e]] or (not dropped[e] and (self.tag[e] == container or container == "main" and "main" in self.names[e].split()))
            if any(inside):
                break
        for e in range(1, n):  # a page's header, not an article's
            dropped[e] = dropped[e] or dropped[self.parent[e]] or self.tag[e] == "header" and not inside[e]
        return inside, dropped

    def text(self, template: Set[int]) -> str:
        """Blocks of the main text; ``template``: hashes of subtrees to cut."""
        inside, gone = self.body()
        if template:
            hashes = self.hashes()
            for e in range(1, len(self.tag)):
                holds_main = not inside[e] and any(inside[e:self.last[e]])
                gone[e] = gone[e] or gone[self.parent[e]] or hashes[e] in template and not holds_main
        only = any(i and not g for i, g in zip(inside, gone))
        blocks: list[list[str]] = []
        broken = True
        for e, value, new in self.piece:
            broken |= new
            if gone[e] or only and not inside[e]:
                broken = True
                continue
            if broken or not blocks:
                blocks.append([])
            broken = False
            blocks[-1].append(value)
        joined = (" ".join(_decoded("".join(b)).split()) for b in blocks)
        return "\n\n".join(b for b in joined if b)

    def subtrees(self) -> dict[int, tuple[int, int]]:
        """Of each hash in the region: characters of text directly in its elements, and TEXT, CONTAINER or PART."""
        inside, dropped = self.body()
        article = any(inside)
        hashes, own, prose = self.hashes(), [0] * len(self.tag), [False] * len(self.tag)
        for e, text, _ in self.piece:
            own[e] += len("".join(text.split()))
        leaf = [True] * len(self.tag)
        alike: Counter[tuple[int, str, str]] = Counter()
        for e in range(len(self.tag) - 1, 0, -1):
            alike[self.parent[e], self.tag[e], self.names[e]] += 1
            if self.tag[e] in BLOCK:
                leaf[self.parent[e]] = False
        found: dict[int, tuple[int, int]] = {}
        for e in range(1, len(self.tag)):
            tag, named = self.tag[e], bool(self.names[e])
            text = tag in PROSE or leaf[e] and (alike[self.parent[e], tag, self.names[e]] > 2 or article and not named)
            prose[e] = prose[self.parent[e]] or text
            if not hashes[e] or dropped[e] or article and not inside[e]:
                continue
            if text and tag in BLOCK and not prose[self.parent[e]]:
                kind = TEXT
            elif not prose[e] and tag not in ("article", "main") and (tag in SECTION or "-" in tag or tag in LIST and (named or not article)):
                kind = CONTAINER
            else:
                kind = PART
            chars, known = found.get(hashes[e], (0, PART))
            found[hashes[e]] = (chars + own[e], min(kind, known))
        return found

    def main_text(self) -> str:
        return self.text(frozenset())


def _decoded(text: str) -> str:
    if "&" not in text:
        return text
    return text.replace("&amp;", "&") if text.count("&") == text.count("&amp;") else html.unescape(text)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def subtrees(pages: DataFrame) -> DataFrame:
    """_host, _k1, _k2, main (a hash of the main text), parts (hash, own, kind) of every row of _host, _k1, _k2 and _html."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            main, parts = [], []
            for source in part.column("_html").to_pylist():
                page = Page(source or "")
                main.append(_digest(page.main_text()))
                parts.append([{"hash": h, "own": own, "kind": kind} for h, (own, kind) in sorted(page.subtrees().items())])
            yield pa.RecordBatch.from_arrays(
                [part.column("_host"), part.column("_k1"), part.column("_k2"), pa.array(main, pa.int64()),
                 pa.array(parts, pa.list_(pa.struct([("hash", pa.int64()), ("own", pa.int64()), ("kind", pa.int32())])))],
                names=["_host", "_k1", "_k2", "main", "parts"])

    return pages.mapInArrow(task, "_host string, _k1 long, _k2 long, main long, parts array<struct<hash:long,own:long,kind:int>>")


def templates(seen: DataFrame) -> DataFrame:
    """_host, hash: the templates of each host, of what ``subtrees`` gives."""
    pages = seen.groupBy("_host", "main").agg(F.min_by("parts", F.struct("_k1", "_k2")).alias("parts"))
    parts = staged(pages.select("_host", "main", F.inline("parts")), "op4-parts")
    sizes = seen.groupBy("_host").agg(F.count_distinct("main").alias("pages"))
    counts = staged(parts.groupBy("_host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_PAGES), "op4-counts")
    recurs = F.col("n").isNotNull()
    candidate = (F.col("kind") == CONTAINER) & (F.col("n") > TEMPLATE_PAGES) | (F.col("kind") == TEXT) & (F.col("n") >= PROSE_PAGES)
    on_page = (parts.join(counts, ["_host", "hash"], "left").groupBy("_host", "main")
               .agg(F.sum("own").alias("chars"), F.sum(F.when(~recurs, F.col("own")).otherwise(0)).alias("own"),
                    F.collect_list(F.when(candidate, F.struct("hash", "kind"))).alias("found")))  # at most a page's elements
    among_own = (on_page.filter(2 * F.col("own") >= F.col("chars")).select("_host", F.inline("found"))
                 .groupBy("_host", "hash").agg(F.count("*").alias("n"), F.min("kind").alias("kind")))
    container = (F.col("kind") == CONTAINER) & (F.col("n") > TEMPLATE_PAGES)
    prose = (F.col("kind") == TEXT) & (F.col("n") >= PROSE_PAGES) & (F.col("n") >= PROSE_SHARE * F.col("pages"))
    return among_own.join(sizes, "_host").filter(container | prose).select("_host", "hash")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    result = T.StructType([T.StructField("page_id", pages.schema[page_id].dataType), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    html_ = F.col(source)
    src = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"), host_of(F.col(url)).alias("_host"),
                       F.xxhash64(html_).alias("_k1"), F.xxhash64(html_, F.lit("_")).alias("_k2"), html_.alias("_html"))
    seen = staged(subtrees(src.select("_host", "_k1", "_k2", "_html")), "op4-subtrees")
    found = staged(templates(seen), "op4-templates")

    def rows(part: pa.RecordBatch, cut: list[Set[int]]) -> pa.RecordBatch:
        texts = [Page(s or "").text(c) for s, c in zip(part.column("_html").to_pylist(), cut)]
        return pa.RecordBatch.from_arrays([part.column("_id"), part.column("_url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          names=result.names)

    few = found.limit(max_broadcast + 1).collect()
    if len(few) <= max_broadcast:
        known: dict[str, set[int]] = {}
        for r in few:
            known.setdefault(r["_host"], set()).add(r["hash"])
        shared = pages.sparkSession.sparkContext.broadcast(known)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _slices(batches):
                yield rows(part, [shared.value.get(h, set()) for h in part.column("_host").to_pylist()])

        return src.mapInArrow(task, result)

    page = ["_host", "_k1", "_k2"]
    held = seen.groupBy(*page).agg(F.first("parts.hash").alias("hashes")).select(*page, F.explode("hashes").alias("hash"))
    cuts = held.join(found, ["_host", "hash"]).groupBy(*page).agg(F.collect_list("hash").alias("_cut"))  # at most a page's elements

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            yield rows(part, [set(c or ()) for c in part.column("_cut").to_pylist()])

    return src.join(cuts, page, "left").select("_id", "_url", "_html", "_cut").mapInArrow(joined, result)
