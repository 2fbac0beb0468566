"""Main text of web pages, by a style tree for each site and the roles that pages declare.

The element trees of a host's pages are merged: elements of equal path (tags, classes and ids from the body down, digits unified) are
one node. A node knows how its pages present it (which children, in which order) and what they say in it. The importance of a node
is the entropy of both over its pages, as a share of what that many different pages would have: a menu that looks and reads alike on
all pages has 0, one that differs on every page 1. A branch of a page whose nodes all have low importance is cut.

Counts of presentations and contents are grouped aggregations, combined where pages are read, so that a host may own any share of
them. The tree judges every page, inside its article too: a block that the articles of a host repeat is none of their text. Copies of
one article count once there. A page alone on its host gives no evidence about what matters, so what a page declares is looked at as
well: what the tree leaves of its article or main element is the text if it has one, and elements that are menus, headers, footers,
sidebars, notices, adverts, forms, scripts or reader comments by tag, role or name never count. Headings and marks inside lines belong
to their article or block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.llm.repeats import enclosed, opened
from tablekeeper.llm.words import chunks

#: A node with less importance is low, if at least so many pages bear witness.
LOW, EVIDENCE = 0.3, 8
ADDED = ["_main", "_n_chars", "_tree_cuts"]

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, and those that are never text of the page.
RAW = frozenset("script style textarea title iframe noembed noframes".split())
NEVER = RAW | frozenset("head noscript template svg object canvas audio video select datalist button".split())
CHROME = frozenset("nav header footer aside form menu dialog search".split())
MAIN = frozenset("article main".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
MAIN_ROLES = frozenset("main article".split())
#: Words in classes and ids that name a part beside the text.
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget notice notices cookie cookies consent gdpr alert popup modal "
    "overlay newsletter subscribe signup login form search share sharing social related pagination pager toolbar copyright".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
#: What a head may hold; anything else ends it.
HEAD = frozenset("title meta link style script base noscript template".split())
#: Of these an article inside makes no difference.
CLOSED = frozenset("nav aside footer menu dialog search".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math nobr q rb rp rt rtc ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag closes of itself, within these borders.
P_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul li dt dd".split()
)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
BORDERS = frozenset("table td th button object template body html".split())

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?i)(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS = re.compile(r"\d+")


@lru_cache(maxsize=1 << 12)
def described(tag: str, rest: str) -> tuple[str, int]:
    """An opening tag's name in the tree and its declared role: 0 none, 1 beside the text, 2 the text, 3 reader comments."""
    found = {k.lower(): a or b or c for k, a, b, c in reversed(ATTRIBUTE.findall(rest))} if rest else {}
    classes, own = html.unescape(found.get("class", "")).split(), html.unescape(found.get("id", ""))
    roles, part = set(found.get("role", "").lower().split()), found.get("itemprop", "")
    names = {w.lower() for c in (*classes, own) for w in NAME_WORD.findall(c)}
    signature = DIGITS.sub("0", f"{tag}.{' '.join(sorted(classes))}#{own}")
    if tag in ("html", "body"):
        return tag, 0
    if part == "comment" or (names & COMMENT_NAMES if tag not in MAIN else set(classes) & COMMENT_NAMES):
        return signature, 3
    if tag in MAIN or roles & MAIN_ROLES or part == "articleBody":
        return signature, 2
    if tag in NEVER or tag in CHROME or roles & CHROME_ROLES or names & CHROME_NAMES:
        return signature, 1
    return signature, 0


@lru_cache(maxsize=1 << 16)
def hashed(parent: int, signature: str) -> int:
    """A signed 64-bit name of the path, from its parent's."""
    return int.from_bytes(blake2b(f"{parent} {signature}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class Page:
    """The elements of a page in order of their opening tags, and its text in pieces."""

    def __init__(self, source: str):
        self.parent, self.tag, self.signature, self.role = [-1], ["html"], ["html"], [0]
        #: (element, text before character references are decoded); the text of a border between blocks is a space.
        self.pieces: list[tuple[int, str]] = []
        self._read(source)
        self._settle()

    def _read(self, source: str) -> None:
        stack, open_tags = [0], {"html": 1}
        pieces, at = self.pieces, 0

        def close(depth: int) -> None:
            while len(stack) > depth:
                gone = stack.pop()
                tag = self.tag[gone]
                open_tags[tag] -= 1
                if tag not in INLINE:
                    pieces.append((gone, " "))

        def close_nearest(tags, borders) -> None:
            for depth in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[depth]]
                if tag in tags:
                    close(depth)
                    return
                if tag in borders:
                    return

        while True:
            found = TOKEN.search(source, at)
            if found is None:
                pieces.append((stack[-1], source[at:]))
                break
            if found.start() > at:
                text = source[at : found.start()]
                if self.tag[stack[-1]] == "head" and not text.isspace():
                    close(len(stack) - 1)
                pieces.append((stack[-1], text))
            at = found.end()
            tag = found["tag"] or found["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if found["end"] or found["end2"]:
                if tag == "br":
                    pieces.append((stack[-1], " "))
                elif open_tags.get(tag) and tag not in ("html", "body"):
                    depth = len(stack) - 1
                    while self.tag[stack[depth]] != tag:
                        depth -= 1
                    close(depth)
                continue
            if tag in ("html", "body"):
                if tag == "html" or open_tags.get("body"):
                    continue  # at most one of each
                close(1)
            if self.tag[stack[-1]] == "head" and tag not in HEAD:
                close(len(stack) - 1)
            if tag in P_ENDS and open_tags.get("p"):
                close_nearest(("p",), BORDERS)
            if tag in IMPLIED:
                while any(open_tags.get(t) for t in IMPLIED[tag][0]):
                    before = len(stack)
                    close_nearest(*IMPLIED[tag])
                    if len(stack) == before:
                        break
            rest = found["rest"] or found["rest2"] or ""
            if tag in VOID:
                if tag not in INLINE and tag != "img":
                    pieces.append((stack[-1], " "))
                continue
            signature, role = described(tag, rest)
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.signature.append(signature)
            self.role.append(role)
            stack.append(len(self.parent) - 1)
            open_tags[tag] = open_tags.get(tag, 0) + 1
            if tag not in INLINE:
                pieces.append((stack[-1], " "))
            if tag in RAW:
                end = re.compile(rf"(?i)</{tag}(?=[\s/>]|\Z)").search(source, at)
                at = end.start() if end else len(source)

    def _settle(self) -> None:
        """`beside`: elements in a part beside the text; `inside`: in the page's article, if there is one with text."""
        parent, n = self.parent, len(self.parent)
        role = self.role
        holds = [False] * n
        for k in range(n - 1, 0, -1):
            # An article in what a name calls a header, or in a form around the page, is the article nonetheless.
            if role[k] == 1 and holds[k] and self.tag[k] not in CLOSED:
                role[k] = 0
            if role[k] == 2 or (holds[k] and role[k] == 0):
                holds[parent[k]] = True
        self.beside, self.inside = [False] * n, [False] * n
        for k in range(1, n):
            up = parent[k]
            self.beside[k] = self.beside[up] or role[k] in (1, 3)
            self.inside[k] = self.inside[up] or role[k] == 2
        self.article = any(self.inside[k] and not self.beside[k] and not t.isspace() for k, t in self.pieces if t)

    def keys(self) -> list[int]:
        out = [0]
        for k in range(1, len(self.parent)):
            out.append(hashed(out[self.parent[k]], self.signature[k]))
        return out

    def judged(self, k: int) -> bool:
        """The tree has no say on what is never text, nor, inside the article, on headings and marks by themselves."""
        tag = self.tag[k]
        return tag not in NEVER and not (self.article and self.inside[k] and (tag in HEADINGS or tag in INLINE))

    def said(self, keep: list[bool]) -> str:
        return " ".join("".join([html.unescape(t) for k, t in self.pieces if keep[k]]).split())

    def declared(self) -> list[bool]:
        return [i and not b for i, b in zip(self.inside, self.beside, strict=True)]

    def features(self) -> Iterator[tuple[int, int, int, int]]:
        """(node, 0, presentation, copy) and (node, 1, content, copy) for each node of this page. Copy names the article; 0 outside of it."""
        keys = self.keys()
        copy = (hashed(2, self.said(self.declared())) or 1) if self.article else 0
        copies: dict[int, int] = {}
        styles: dict[int, list[str]] = {}
        texts: dict[int, list[str]] = {}
        for k in range(1, len(keys)):
            if self.judged(k):
                styles.setdefault(keys[k], [])
                copies[keys[k]] = copy if self.inside[k] else 0
                around = styles.get(keys[self.parent[k]])
                if around is not None and around[-1:] != [self.signature[k]]:
                    around.append(self.signature[k])
        block = list(range(len(keys)))
        for k in range(1, len(keys)):
            if self.article and self.inside[k] and self.tag[k] in INLINE:
                block[k] = block[self.parent[k]]
        for k, text in self.pieces:
            at = block[k]
            if keys[at] in styles and text and not text.isspace() and self.judged(at):
                texts.setdefault(keys[at], []).append(text)
        for key, parts in styles.items():
            yield key, 0, hashed(0, "|".join(parts)), copies[key]
        for key, parts in texts.items():
            yield key, 1, hashed(1, " ".join(" ".join(parts).split())), copies[key]

    def text(self, low: frozenset[int]) -> tuple[str, int]:
        """The main text, and how many branches the tree cut."""
        parent, n = self.parent, len(self.parent)
        cut, cuts = [False] * n, 0
        if low:
            keys = self.keys()
            marks = [self.article and self.inside[k] and self.tag[k] in INLINE for k in range(n)]
            # A mark goes with its block; only a block in it that stays keeps it.
            branch = [marks[k] or (self.judged(k) and keys[k] in low) for k in range(n)]
            for k in range(n - 1, 0, -1):
                if not branch[k] and self.tag[k] not in NEVER:
                    branch[parent[k]] = False
            for k in range(1, n):
                own = branch[k] and not marks[k]
                cut[k] = cut[parent[k]] or own
                cuts += own and not cut[parent[k]]
        if self.article:
            declared = self.declared()
            text = self.said([d and not c for d, c in zip(declared, cut, strict=True)])
            return (text, cuts) if text else (self.said(declared), 0)
        text = self.said([not c and not b for c, b in zip(cut, self.beside, strict=True)])
        return (text, cuts) if text else (self.said([not b for b in self.beside]), 0)


def host_of(url: Column) -> Column:
    """The host in lower case, without user and port; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def style_tree(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """`host`, `node`, `pages`, `presentation`, `content` (null: no text), `importance` of each node of each host's tree.

    Pages without a host belong to no tree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            hosts, nodes, kinds, values, copies = [], [], [], [], []
            for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for node, kind, value, copy in Page(text).features():
                    hosts.append(host)
                    nodes.append(node)
                    kinds.append(kind)
                    values.append(value)
                    copies.append(copy)
            columns = [pa.array(hosts, pa.string()), pa.array(nodes, pa.int64()), pa.array(kinds, pa.int32()), pa.array(values, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(copies, pa.int64())], names=["host", "node", "kind", "value", "copy"])

    sited = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{source}`").cast("string").alias("html"))
    seen = sited.filter("host <> '' AND html IS NOT NULL").mapInArrow(run, "host string, node long, kind int, value long, copy long")
    each = seen.groupBy("host", "node", "kind", "value", "copy").agg(F.count("*").alias("n"))
    # Equal articles are one witness, whatever their number; a page counts as often as it occurs elsewhere.
    counted = each.groupBy("host", "node", "kind", "value").agg(F.sum(F.when(F.col("copy") == 0, F.col("n")).otherwise(1)).alias("n"))
    m, spread = F.sum("n"), F.sum(F.col("n") * F.log("n"))
    entropy = F.when(m == 1, 1.0).otherwise((F.log(m) - spread / m) / F.log(m))
    each = counted.groupBy("host", "node", "kind").agg(m.alias("m"), F.greatest(entropy, F.lit(0.0)).alias("entropy"))
    style, said = F.col("kind") == 0, F.col("kind") == 1
    nodes = each.groupBy("host", "node").agg(
        F.max(F.when(style, F.col("m"))).alias("pages"),
        F.max(F.when(style, F.col("entropy"))).alias("presentation"),
        F.max(F.when(said, F.col("entropy"))).alias("content"),
    )
    return nodes.withColumn("importance", F.greatest("presentation", "content"))


def main_text(
    pages: DataFrame, url: str = "url", source: str = "html", low: float = LOW, evidence: int = EVIDENCE
) -> DataFrame:
    """All columns, and `_main` the page's main text (empty if none), `_n_chars` its code points, `_tree_cuts` the branches
    that the tree of its host found low.

    Character references are decoded; white space, by Unicode, becomes one space; blocks are joined by one space. A page with an
    article or main element (or one of that role) that holds text beside its menus and comments has that as its text, without low
    branches. Any other page has what is left of it without declared parts and low branches; if those branches are all it has, as on
    a host of copies, they stay. A node is low below `low` of importance on `evidence` pages of the host or more. A null page is empty; a null url, or one
    without a host, has no tree. Markup need not be well formed. Repeated pages count as often as they occur, copies of an article
    once for what is inside it. Columns of `pages` named like
    an added one are replaced by it. An empty table gives no rows.
    """
    docs = enclosed(pages, url, source).withColumn("_host", host_of(F.col("_doc")))
    tree = style_tree(pages.select(F.col(f"`{url}`").alias("url"), F.col(f"`{source}`").alias("html")))
    # Eight bytes for each low path of a host; digits in names are unified, so a path is a template's, not a page's.
    lows = tree.filter((F.col("importance") < low) & (F.col("pages") >= evidence)).groupBy("host").agg(F.collect_list("node").alias("_low"))
    joined = docs.join(lows, F.col("_host") == F.col("host"), "left").drop("host", "_host")
    schema = T.StructType(
        [f for f in joined.schema.fields if f.name != "_low"]
        + [T.StructField("_main", T.StringType()), T.StructField("_n_chars", T.LongType()), T.StructField("_tree_cuts", T.LongType())]
    )
    names = [f.name for f in schema.fields[:-3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            texts = batch.column("_text").cast(pa.large_string()).to_pylist()
            found = [Page(t or "").text(_set(lows)) for t, lows in zip(texts, batch.column("_low"), strict=True)]
            mains = [t for t, _ in found]
            columns = [batch.column(c) for c in names]
            columns += [pa.array(mains, pa.string()), pa.array([len(t) for t in mains], pa.int64()), pa.array([c for _, c in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *ADDED])

    return opened(joined.mapInArrow(run, schema), pages, url, source, ADDED)


def _set(lows: pa.Scalar) -> frozenset[int]:
    return frozenset(np.asarray(lows.values).tolist()) if lows.is_valid else frozenset()
