"""Main text of web pages by equivalence-class template deduction.

A token is an element with its path (names and classes from the root), or a
text block with the path of its element. Over the pages of a host each token has
an occurrence vector: how often it stands on each page. Vectors are compared by
a fingerprint, the XOR of a hash of page and count over all pages, which is
summed before the shuffle, so a host with a third of all pages is a few rows per
task. Pages of a host with the same text are one page here, or copies of an
article would make it a template. Tokens with one vector are an equivalence
class. A class is judged whole: it is valid if it is on at least half of its
host's pages, once on each at most, and some element of it lies in elements of
valid classes only (paths nest). An element of a valid class that lies in a
repeated one leaves the class. The valid classes are the host's template; their
elements bound the slots, and their texts are taken out of the slots. So a text
that pages share by chance, as a heading, stays: no element has its vector.

The main slot is the article (or main) of the template with the most text. On a
host without one it is found going down from the page: what an element holds of
text that isn't the template's is its own; an element with more text of the
template, or set apart, than own is the template's (a menu with a counter in it)
unless most of its parent's own text is in it. While one element alone holds all own text of its
parent, that is gone into; the slot is where own text stands beside own text, so
headings, leads and lists beside the body stay, and the template's elements in
it are left out. Pages join to their host's main slot; pages are salted, and the
few template rows copied, so a large host is dealt to many tasks. A page that
lacks the slot, or is of a host without a template, goes by its own article, main
or body. A page whose text is all template keeps it.

Null pages are empty. Null hosts are one host. Repeated pages each get their row.
Pages are parsed whole, however long. Without pages the result is empty. Columns
of pages other than the three are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import materialize
from pennant.llm.words import mix

SALTS = 16
#: Share of a host's pages that a valid class is on.
SUPPORT = 0.5
#: A host with fewer different pages has no template texts: too little shows what its pages share.
LEAST_PAGES = 4

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe select".split())
APART = frozenset("nav header footer aside form button dialog menu".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open one of their kind.
SIBLINGS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: A block element ends an open paragraph.
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "head", "html", "body"}
#: Words in a class, id or role that mark an element outside an article as no part of it.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs pagination pager "
    "sidebar aside widget header masthead footer foot copyright comment comments disqus replies respond newsletter subscribe subscription signup login".split()
)
#: Names (a class or role, or its first word before words of layout) that mark a container inside an article as no part of it.
INNER_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsored comment comments disqus cookie cookies consent breadcrumb breadcrumbs navbar navigation pagination newsletter sidebar".split())
LAYOUT_WORDS = frozenset("area banner bar block body bottom box center container content count form frame group header inner item items label left link links list message notice outer panel post right row section slot space text thread title top unit wrap wrapper".split())
CONTAINERS = frozenset("div ul ol".split())
#: Elements of the text itself, whose id names what they tell of.
HEADED = frozenset("section h1 h2 h3 h4 h5 h6".split())
MAIN_WORDS = frozenset("article main post entry story content".split())

#: Quotes count only after an equals sign; a stray or open one is a character like others.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:"[^"]*"|'[^']*')|=)*+)>""")
_ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_WORD = re.compile(r"[a-zA-Z]+")
_SPACE = re.compile(r"\s+")


def _named(attributes: str) -> tuple[str, frozenset[str], frozenset[str], frozenset[str]]:
    """Classes as part of a path (numbers dropped), words of class and role, words of the id, first words of each class and role that only words of layout follow."""
    if "=" not in attributes:
        return "", frozenset(), frozenset(), frozenset()
    label, words, of_id, first = "", set(), set(), set()
    for key, value in _ATTRIBUTE.findall(attributes):
        found = _WORD.findall(value.lower())
        if key.lower() == "id":
            of_id.update(found)
            continue
        words.update(found)
        first.update(x[0] for x in map(_WORD.findall, value.lower().split()) if x and all(w in LAYOUT_WORDS for w in x[1:]))
        if key.lower() == "class":
            label = "." + "-".join(found)
    return label, frozenset(words), frozenset(of_id), frozenset(first)


class Page:
    """Elements of a page in order: their paths, and the text blocks with the element each lies in."""

    def __init__(self, source: str):
        self.paths, self.parent, self.apart, self.main, self.inner = [""], [-1], [False], [False], [False]
        self.blocks: list[tuple[int, str]] = []
        self._pieces: list[str] = []
        stack = [("", 0)]
        block_of = 0

        def flush() -> None:
            text = _SPACE.sub(" ", html.unescape("".join(self._pieces))).strip()
            if text:
                self.blocks.append((block_of, text))
            self._pieces = []

        at, n = 0, len(source)
        while at < n:
            lt = source.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                if not self._pieces:
                    block_of = stack[-1][1]
                self._pieces.append(source[at:lt])
            if lt == n:
                break
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            tag = _TAG.match(source, lt)
            if tag is None:
                end = source.find(">", lt) if source[lt + 1 : lt + 2] in ("!", "?", "/") else -1
                if end >= 0:
                    at = end + 1
                elif re.match(r"</?[a-zA-Z!?]", source[lt : lt + 3]):
                    at = n  # a tag that the page ends in
                else:
                    self._pieces.append("<")
                    at = lt + 1
                continue
            at, name = tag.end(), tag[2].lower()
            if tag[1]:
                if any(x == name for x, _ in stack):
                    if name in BLOCK:
                        flush()
                    while stack.pop()[0] != name:
                        pass
                elif name == "p":
                    flush()
                continue
            if name in BLOCK:
                flush()
                ends = SIBLINGS.get(name, ()) + (("p",) if name in ENDS_P else ())
                self._close(stack, ends)
            if name == "br":
                self._pieces.append(" ")
            if name in VOID:
                continue
            label, words, of_id, first = _named(tag[3])
            up = stack[-1][1]
            self.parent.append(up)
            self.paths.append(f"{self.paths[up]}>{name}{label}")
            article = name in ("article", "main")
            self.main.append(article or bool((words | of_id) & MAIN_WORDS and name in ("div", "section", "td")))
            if self.inner[up]:
                marked = name in CONTAINERS and bool(first & INNER_WORDS)
            else:
                marked = name == "noscript" or not article and name not in ("html", "body") and bool((words if name in HEADED else words | of_id) & APART_WORDS)
            # The header of an article is its own, that of a page isn't.
            self.apart.append(self.apart[up] or (name in APART and not (name == "header" and self.inner[up])) or name in RAW or marked)
            self.inner.append(self.inner[up] or (self.main[-1] and not self.apart[-1]))
            if name in RAW:
                end = re.compile(f"</{name}", re.IGNORECASE).search(source, at)
                at = n if end is None else end.start()
                close = source.find(">", at)
                at = n if close < 0 else close + 1
            elif not tag[3].endswith("/"):
                stack.append((name, len(self.paths) - 1))
        flush()

    @staticmethod
    def _close(stack: list[tuple[str, int]], ends: tuple[str, ...]) -> None:
        """End the open elements of these names that no container stands between."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in ends:
                del stack[k:]
                return
            if stack[k][0] in ("div", "article", "section", "main", "body", "td", "th", "table", "ul", "ol", "dl", "blockquote") and stack[k][0] not in ends:
                return

    def marks(self) -> list[int]:
        """For each block the hash of its text and path, 0 where it is set apart."""
        return [0 if self.apart[of] else int.from_bytes(hashlib.blake2b(f"{self.paths[of]}\0{text}".encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) for of, text in self.blocks]

    def key(self) -> int:
        """Hash of all text that isn't set apart."""
        text = "\0".join(text for of, text in self.blocks if not self.apart[of])
        return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)

    def texts(self) -> list[tuple[str, int, int, int]]:
        """Path, mark, times and characters of each different text that isn't set apart."""
        found = Counter((self.paths[of], mark, len(text)) for mark, (of, text) in zip(self.marks(), self.blocks, strict=True) if mark)
        return [(path, mark, n, n * size) for (path, mark, size), n in found.items()]

    def counts(self) -> dict[str, tuple[int, int, int]]:
        """By path: elements, characters of text in it that isn't set apart, and of text that is."""
        size, rest = [0] * len(self.paths), [0] * len(self.paths)
        for of, text in self.blocks:
            (rest if self.apart[of] else size)[of] += len(text)
        for k in range(len(self.paths) - 1, 0, -1):
            size[self.parent[k]] += size[k]
            rest[self.parent[k]] += rest[k]
        times, held, aside = Counter(self.paths[1:]), Counter(), Counter()
        for k in range(1, len(self.paths)):
            held[self.paths[k]] += 0 if self.apart[k] else size[k]
            aside[self.paths[k]] += rest[k]
        return {p: (times[p], held[p], aside[p]) for p in times}

    def _inside(self, chosen: set[int], shared: frozenset[int], left_out: frozenset[str]) -> str:
        within = [0 in chosen] * len(self.paths)
        for k in range(1, len(self.paths)):
            within[k] = (k in chosen or within[self.parent[k]]) and self.paths[k] not in left_out
        found = [k for k, (of, _) in enumerate(self.blocks) if within[of] and not self.apart[of]]
        if shared:
            marks = self.marks()
            found = [k for k in found if marks[k] not in shared] or found
        return "\n\n".join(self.blocks[k][1] for k in found)

    def text(self, slot: str | None, shared: frozenset[int] = frozenset(), left_out: frozenset[str] = frozenset()) -> str:
        """Blocks of the main slot ("": the page), or of the page's own article where the slot is absent, without the template's texts and elements."""
        at = {k for k in range(1, len(self.paths)) if slot and self.paths[k] == slot and not self.apart[k]}
        if slot == "":
            at = {0}
        if not at:
            left_out = frozenset()
            at = {k for k in range(1, len(self.paths)) if self.main[k] and not self.apart[k]}
            strict = {k for k in at if re.search(r">(article|main)(\.[a-z-]*)?$", self.paths[k])}
            at = strict or at or {0}
        return self._inside(at, shared, left_out)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


TOKENS = "host string, key long, tokens array<struct<path: string, mark: long, fp: long, times: long, size: long, aside: long>>"
_TOKEN = pa.struct([("path", pa.string()), ("mark", pa.int64()), ("fp", pa.int64()), ("times", pa.int64()), ("size", pa.int64()), ("aside", pa.int64())])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By page its tokens: elements have mark 0, texts a mark and the path of their element."""
    for batch in batches:
        keys, rows = [], []
        for source in batch.column(1).to_pylist():
            page = Page(source)
            found = [(path, 0, n, size, aside) for path, (n, size, aside) in page.counts().items()]
            found += [(path, mark, n, size, 0) for path, mark, n, size in page.texts()]
            key = page.key()
            times = np.array([x[2] for x in found], np.uint64)
            prints = mix(np.array([key & (1 << 64) - 1], np.uint64) + (times << np.uint64(32))).view(np.int64).tolist()
            keys.append(key)
            rows.append([{"path": path, "mark": mark, "fp": fp, "times": n, "size": size, "aside": aside} for (path, mark, n, size, aside), fp in zip(found, prints, strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(rows, pa.list_(_TOKEN))], names=["host", "key", "tokens"])


def templates(pages: DataFrame) -> DataFrame:
    """pages: host, html. Tokens of each host's template: host, path, mark, class_id, pages, all, and its characters of text in place (size) and set apart (aside)."""
    # Written, as both the hosts' totals and the vectors read it, and a page is parsed once for them.
    different = materialize(pages.select("host", "html").mapInArrow(_tokens, TOKENS).groupBy("host", "key").agg(F.min("tokens").alias("tokens")), "tokens")
    tokens = different.select("host", F.inline("tokens"))
    vectors = tokens.groupBy("host", "path", "mark").agg(F.expr("bit_xor(fp)").alias("fp"), F.count("*").alias("pages"), F.sum("times").alias("times"), F.sum("size").alias("size"), F.sum("aside").alias("aside"))
    total = different.groupBy("host").agg(F.count("*").alias("all"))
    wide = vectors.join(total, "host").filter((F.col("pages") >= F.lit(SUPPORT) * F.col("all")) & (F.col("times") == F.col("pages")))
    wide = materialize(wide.withColumn("class_id", F.xxhash64("fp", "pages")), "classes")
    # Nesting: all paths above an element are elements of valid classes as well.
    elements = wide.filter("mark = 0")
    depth = F.size(F.split("path", ">")) - 1
    above = elements.select("host", "path", F.explode(F.sequence(F.lit(1), depth)).alias("k")).select("host", "path", F.expr("substring_index(path, '>', k + 1)").alias("up"))
    held = above.join(elements.select("host", F.col("path").alias("up")), ["host", "up"], "left_semi").groupBy("host", "path").agg(F.count("*").alias("nested"))
    nested = elements.join(held, ["host", "path"]).filter(F.col("nested") == depth)
    texts = wide.filter((F.col("mark") != 0) & (F.col("all") >= LEAST_PAGES)).join(nested.select("host", "class_id"), ["host", "class_id"], "left_semi")
    cols = ["host", "path", "mark", "class_id", "pages", "all", "size", "aside"]
    return nested.select(cols).unionByName(texts.select(cols))


SLOTS = "host string, slot string, left_out array<string>"


def _slot(template: pd.DataFrame) -> tuple[str, list[str]]:
    """template: path, size, own, shared, strict of a host's elements. The main slot ("": the page), and the template's elements in it."""
    strict = template[template["strict"] & (template["size"] > 0)]
    if len(strict):
        return max(zip(strict["size"], strict["path"], strict=True))[1], []
    own, shared = (dict(zip(template["path"], template[c], strict=True)) for c in ("own", "shared"))
    below: dict[str, list[str]] = {}
    for path in own:
        below.setdefault(path.rpartition(">")[0], []).append(path)
    at, left_out = "", []
    while children := [c for c in below.get(at, []) if own[c] > 0]:
        most = max(children, key=lambda c: (own[c], c))
        held = sum(own[c] for c in children)
        content = [c for c in children if shared[c] <= own[c] or (c == most and 2 * own[c] > held)]
        left_out = sorted(set(children) - set(content))
        if len(content) != 1 or (at and own[at] > held):
            break
        at, left_out = content[0], []
    return at, left_out


def _slots(template: pd.DataFrame) -> pd.DataFrame:
    slot, left_out = _slot(template)
    return pd.DataFrame({"host": [template["host"].iloc[0]], "slot": [slot], "left_out": [left_out]})


def main_slots(template: DataFrame) -> DataFrame:
    """host, slot: where each host's pages have their main text ("": anywhere); left_out: elements of the template in it; shared: marks of the template's texts."""
    texts = template.filter("mark != 0")
    shared = texts.groupBy("host").agg(F.sort_array(F.collect_set("mark")).alias("shared"))
    depth = F.size(F.split("path", ">")) - 1
    above = texts.filter(depth > 0).select("host", "size", "path", F.explode(F.sequence(F.lit(1), depth)).alias("k"))
    held = above.groupBy("host", F.expr("substring_index(path, '>', k + 1)").alias("path")).agg(F.sum("size").alias("shared"))
    rows = template.filter("mark = 0").join(held, ["host", "path"], "left").withColumn("shared", F.coalesce("shared", F.lit(0)))
    strict = F.col("path").rlike(r">(article|main)(\.[a-z-]*)?$")
    # One host's template is as large as a page's tree, not as the host.
    rows = rows.select("host", "path", "size", (F.col("size") - F.col("shared")).alias("own"), (F.col("shared") + F.col("aside")).alias("shared"), strict.alias("strict"))
    return rows.groupBy("host").applyInPandas(_slots, SLOTS).join(shared, "host", "left")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)
        out = [Page(source).text(slot, frozenset(shared or ()), frozenset(left_out or ())) for source, slot, shared, left_out in rows]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"host": host(F.col("url")), "page": F.xxhash64("page_id", "url", "html")})
    slots = main_slots(materialize(templates(rows), "template")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod("page", F.lit(SALTS)).cast("int")).join(slots, ["host", "salt"], "left")
    out = dealt.select("page_id", "url", "html", "slot", "shared", "left_out").mapInArrow(_texts, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
