"""Main text of web pages by wrapper induction: DOM trees of a host's pages are aligned by simple tree matching."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise
from ledgerline.llm.url_filter import split_url

#: Elements without content, elements whose start ends an open one of the same group, and elements that end a block. Fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
BLOCKS = set(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead
title tr ul""".split()
)
#: A start of one of these ends an open paragraph.
ENDS_P = BLOCKS - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend", "body", "html", "head", "title"}
#: Elements that never hold main text, and words of class, id and role that mark page furniture. Fixed values.
FURNITURE = set("nav aside footer form script style noscript template iframe svg button select textarea head title object canvas dialog".split())
MARKS = set(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus
footer gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay pagination popup promo promotion related replies
respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets""".split()
)
#: Marks of boxes with what readers wrote: main text only where the page has no other.
READERS = set("comment comments commentlist disqus replies respond".split())
#: What a head may hold; anything else ends it, as in HTML.
IN_HEAD = set("html head title meta link base script style noscript template".split())
#: Elements that hold sentences of the text itself. Fixed values.
PROSE = set("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre article main".split())
#: Deeper elements are hung to their ancestor of this depth; their text stays.
DEEPEST = 150
CONTAINERS = ("article", "main")
#: Boxes that make a page's layout. Fixed values.
LAYOUT = set("header footer nav main article section aside div form".split())


class Node:
    """``soft``: furniture by a mark, role or as a form only, which may hold main text after all: "box" or "readers"."""

    __slots__ = ("tag", "label", "path", "furniture", "soft", "children", "depth")

    def __init__(self, tag: str, label: str, path: str, furniture: bool, depth: int, soft: str = ""):
        self.tag, self.label, self.path, self.furniture, self.depth, self.soft = tag, label, path, furniture, depth, soft
        self.children: list[Node | str] = []


def _marks(attrs: list[tuple[str, str | None]]) -> tuple[str, set[str], str]:
    """Class or id without digits, its words, and the role."""
    own = dict(attrs)
    name = own.get("class") or own.get("id") or ""
    both = f"{own.get('class') or ''} {own.get('id') or ''}"
    words = {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", both)}
    return re.sub(r"\d+", "", name).strip(), words, (own.get("role") or "").lower()


class _Builder(HTMLParser):
    """A tree of any markup: what is never closed ends with its parent or where HTML says."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", "", "", False, 0)
        self.open = [self.root]

    def _close_to(self, index: int) -> None:
        del self.open[index:]

    def _end_head(self) -> None:
        for i in range(1, len(self.open)):
            if self.open[i].tag == "head":
                # a title, script or template in the head holds anything
                if all(n.tag not in FURNITURE for n in self.open[i + 1 :]):
                    self._close_to(i)
                return

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD:
            self._end_head()
        if tag in ENDS_P:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == "p":
                    self._close_to(i)
                    break
                if self.open[i].tag in BLOCKS:
                    break
        if tag in CLOSES:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in CLOSES[tag]:
                    self._close_to(i)
                    if tag != "tr":
                        break
                elif self.open[i].tag in ("ul", "ol", "dl", "table", "select", "menu"):
                    break
        parent = self.open[-1]
        name, words, role = _marks(attrs) if attrs else ("", (), "")
        furniture = tag in FURNITURE or bool(words and not MARKS.isdisjoint(words)) or role in ("navigation", "banner", "contentinfo", "complementary", "search", "form")
        if tag in ("html", "body", "main"):
            furniture = False
        soft = "" if not furniture or tag in FURNITURE - {"form"} else "readers" if words and not READERS.isdisjoint(words) else "box"
        label = f"{tag}.{name}" if name else tag
        node = Node(tag, label, f"{parent.path}/{label}", furniture, parent.depth + 1, soft)
        parent.children.append(node)
        if tag not in VOID and node.depth < DEEPEST:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._close_to(i)
                return

    def handle_data(self, data):
        if not data.isspace():
            self._end_head()
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


# -- wrapper induction


class Shape:
    """A node for matching: neighbours with one label are taken together, so trees stay small."""

    __slots__ = ("label", "path", "furniture", "text", "children")

    def __init__(self, nodes: list[Node]):
        self.label, self.path, self.furniture = nodes[0].label, nodes[0].path, nodes[0].furniture
        self.text = " ".join(" ".join(c for n in nodes for c in n.children if isinstance(c, str)).split())
        self.children: list[Shape] = []
        run: list[Node] = []
        for child in (c for n in nodes for c in n.children if isinstance(c, Node)):
            if run and child.label != run[-1].label:
                self.children.append(Shape(run))
                run = []
            run.append(child)
        if run:
            self.children.append(Shape(run))


def match(a: Shape, b: Shape, pairs: list[tuple[Shape, Shape]] | None = None) -> int:
    """Simple tree matching: the most nodes that can be paired, parents with parents and in order. Appends the pairs."""
    if a.label != b.label:
        return 0
    n, m = len(a.children), len(b.children)
    score = [[0] * (m + 1) for _ in range(n + 1)]
    inner: dict[tuple[int, int], tuple[int, list]] = {}
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            best = max(score[i][j + 1], score[i + 1][j])
            if x.label == y.label:
                own: list[tuple[Shape, Shape]] = []
                inner[i, j] = match(x, y, own), own
                best = max(best, score[i][j] + inner[i, j][0])
            score[i + 1][j + 1] = best
    if pairs is not None:
        pairs.append((a, b))
        i, j = n, m
        while i and j:
            if (i - 1, j - 1) in inner and score[i][j] == score[i - 1][j - 1] + inner[i - 1, j - 1][0]:
                pairs.extend(inner[i - 1, j - 1][1])
                i, j = i - 1, j - 1
            elif score[i][j] == score[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return score[n][m] + 1


# -- extraction


class Line(NamedTuple):
    """A line of text: the blocks that hold it, and what of ``soft`` furniture and of CONTAINERS and headers it is in."""

    holders: tuple[Node, ...]
    text: str
    soft: tuple[Node, ...]
    inside: frozenset[str]

    @property
    def path(self) -> str:
        return self.holders[-1].path


def _lines(node: Node, at: tuple[Node, ...], soft: tuple[Node, ...], inside: frozenset[str], out: list[Line], line: list[str]) -> None:
    def end(holders: tuple[Node, ...], held: tuple[Node, ...], within: frozenset[str], parts: list[str]) -> None:
        if text := " ".join("".join(parts).split()):
            out.append(Line(holders, text, held, within))
        parts.clear()

    for child in node.children:
        if isinstance(child, str):
            line.append(child)
            continue
        block = child.tag in BLOCKS
        if block:
            end(at, soft, inside, line)
        if child.furniture and not child.soft:
            continue
        within = inside | {child.tag} if child.tag in (*CONTAINERS, "header") else inside
        if block or child.soft:
            holders, held, own = (*at, child), (*soft, child) if child.soft else soft, []
            _lines(child, holders, held, within, out, own)
            end(holders, held, within, own)
        else:
            _lines(child, at, soft, within, out, line)


def lines_of(tree: Node) -> list[Line]:
    """All lines of a page but those of elements that never hold main text."""
    out, line = [], []
    _lines(tree, (tree,), (), frozenset(), out, line)
    if text := " ".join("".join(line).split()):
        out.append(Line((tree,), text, (), frozenset()))
    return out


def _hash(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _key(*parts: str) -> str:
    return str(_hash(*parts))


def _skeleton(node: Node, out: set[str]) -> set[str]:
    """Paths of the page's boxes: pages with the same ones are of one layout."""
    for child in node.children:
        if isinstance(child, Node) and (child.soft or not child.furniture):
            if child.tag in LAYOUT:
                out.add(child.path)
            _skeleton(child, out)
    return out


def _layout(tree: Node) -> str:
    return _key(*sorted(_skeleton(tree, set())))


def layout_of(html: str | None) -> int:
    """The number of a page's layout."""
    return int(_layout(parse(html)))


def _is_box(path: str) -> bool:
    """A named element that is not prose: template on every host, even if most of its text is the same on all pages."""
    tag, dot, _ = path.rsplit("/", 1)[-1].partition(".")
    return bool(dot) and tag not in PROSE


def is_template(times, pages_with_path, pages):
    """A line is template if it is on at least 90 percent of the pages that have its path, and on three pages and a hundredth at
    least of ``pages``: the host's, or those of the layout for a line that is counted per layout."""
    return (times >= 3) & (100 * times >= pages) & (10 * times >= 9 * pages_with_path)


def varies_enough(constant, total):
    """Near copies of one page look like template to the last sentence: at least a quarter of a host's text must vary."""
    return 4 * (total - constant) >= total


def _main_boxes(lines: list[Line]) -> set[Node]:
    """Soft furniture that holds the page's article or most of its text."""
    total = sum(len(x.text) for x in lines)
    weight, holds, free = Counter(), set(), False
    for x in lines:
        contained = not x.inside.isdisjoint(CONTAINERS)
        free |= contained and not x.soft
        for box in x.soft:
            weight[box] += len(x.text)
            if contained:
                holds.add(box)

    def main(box: Node) -> bool:
        if box.soft == "readers":
            return weight[box] == total
        return not free and (3 if box in holds else 2) * weight[box] >= total

    return {box for box in weight if main(box)}


def _region(lines: list[Line]) -> tuple[Node, ...]:
    """The smallest node that holds all lines and is no prose itself, with its ancestors."""
    region = lines[0].holders
    for x in lines:
        n = min(len(region), len(x.holders))
        region = region[: next((k for k in range(n) if region[k] is not x.holders[k]), n)]
    while region[-1].tag in PROSE and region[-1].tag not in CONTAINERS:
        region = region[:-1]
    return region


def content(lines: list[Line], constant: list[bool]) -> tuple[list[Line], tuple[Node, ...]] | None:
    """The lines of the region that varies, and the region: the smallest node that holds all varying text outside furniture.

    Lines that are constant go outside the region, whatever their tag; in it, if they are no prose or their part of it
    is a box without varying text. Where the region is the body, it reaches from its first to its last varying line.
    None if nothing varies."""
    varies = [x for x, same in zip(lines, constant, strict=True) if not same]
    boxes = _main_boxes(varies)
    kept = [(x, same) for x, same in zip(lines, constant, strict=True) if boxes.issuperset(x.soft)]
    at = [k for k, (_, same) in enumerate(kept) if not same]
    if not at:
        return None
    region = _region([kept[k][0] for k in at])
    n, last = len(region), region[-1]
    first, end = (at[0], at[-1]) if last.tag in ("", "html", "body") else (0, len(kept))
    alive = {x.holders[n] for x, same in kept if not same and x.holders[:n] == region and len(x.holders) > n}

    def stays(k: int, x: Line, same: bool) -> bool:
        if not same:
            return True
        if x.holders[:n] != region or not first <= k <= end or x.holders[-1].tag not in PROSE:
            return False
        return len(x.holders) <= n + 1 or x.holders[n] in alive

    return [x for k, (x, same) in enumerate(kept) if stays(k, x, same)], region


def induce(pages: list[str]) -> dict:
    """The wrapper of a host from some of its pages: ``template``, key -> text of the lines of any tag that are the same on
    the pages, ``roots``, the path of the smallest node of the first page that holds all its other lines outside
    furniture, and ``whole``: that region is the content.

    The first page is aligned with each other one by simple tree matching; lines of nodes that were paired are counted.
    Copies count once. With fewer than three pages the wrapper is empty; where less than a quarter of the text varies,
    only named boxes are template and no region is told."""
    trees = [parse(p) for p in dict.fromkeys(pages)]
    if len(trees) < 3:
        return {"template": {}, "roots": []}
    first, met, times = Shape([trees[0]]), Counter(), Counter()
    read = [lines_of(t) for t in trees]
    for tree, found in zip(trees, read, strict=True):
        pairs: list[tuple[Shape, Shape]] = []
        match(first, Shape([tree]), pairs)
        paired = {x.path for x, _ in pairs}
        met.update({x.path for x in found} & paired)
        times.update({(x.path, x.text) for x in found if x.path in paired})
    same = {x for x, n in times.items() if is_template(n, met[x[0]], len(trees))}
    lengths = [(len(x.text), (x.path, x.text) in same) for found in read for x in found]
    whole = varies_enough(sum(n for n, c in lengths if c), sum(n for n, _ in lengths))
    same = {x for x in same if whole or _is_box(x[0])}
    found = content(read[0], [(x.path, x.text) in same for x in read[0]]) if whole else None
    return {"template": {_key("", *x): x[1] for x in sorted(same)}, "roots": [found[1][-1].path] if found else [], "whole": whole}


def extract(html: str | None, wrapper: dict | None = None) -> str:
    """The main text of a page: its blocks, each with white space as single blanks, joined by line feeds.

    Where the host's wrapper tells template from varying text, that is the region that varies (see ``content``). Else it
    is the page's main element, else its articles, else the whole body without page headers. Furniture is left out;
    forms and boxes with a mark of furniture are content where they hold the page's article or most of its text. A
    page of nothing but template keeps it."""
    tree = parse(html)
    lines = lines_of(tree)
    if template := (wrapper or {}).get("template"):
        layout = _layout(tree)
        constant = [_key("", x.path, x.text) in template or _key(layout, x.path, x.text) in template for x in lines]
    else:
        constant = [False] * len(lines)
    if (wrapper or {}).get("whole") and (found := content(lines, constant)):
        return "\n".join(x.text for x in found[0])
    if not (wrapper or {}).get("whole") and not all(constant):
        lines = [x for x, same in zip(lines, constant, strict=True) if not same]
    boxes = _main_boxes(lines)
    lines, found = [x for x in lines if boxes.issuperset(x.soft)], []
    for tag in reversed(CONTAINERS):
        found = found or [x for x in lines if tag in x.inside]
    found = found or [x for x in lines if "header" not in x.inside]
    return "\n".join(x.text for x in found)


ENTRIES = "host string, draw long, layout long, path array<long>, line array<long>, chars array<long>, wide array<boolean>, box array<boolean>"


def page_entries(html: str) -> tuple[int, list[tuple[int, int, int, bool, bool]]]:
    """The page's layout, and what it counts for: (path, line, characters, wide, box), once each, in its host (wide) and in its layout.

    Line 0 stands for the path itself, path 0 for the page."""
    tree = parse(html)
    layout = _layout(tree)
    found = {(x.path, x.text) for x in lines_of(tree)}
    out = []
    for scope, wide in (("", True), (layout, False)):
        out.append((0, 0, sum(len(text) for _, text in found), wide, False))
        paths = {path: (_hash(scope, path), _is_box(path)) for path, _ in found}
        out += [(path, 0, 0, wide, box) for path, box in paths.values()]
        out += [(paths[path][0], _hash(scope, path, text), len(text), wide, paths[path][1]) for path, text in found]
    return int(layout), out


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch = batch.drop_duplicates(["host", "draw"])
        read = [page_entries(h) for h in batch["html"]]
        columns = [[np.array(c) for c in zip(*found, strict=True)] for _, found in read]
        names = ("path", "line", "chars", "wide", "box")
        yield pd.DataFrame({"host": batch["host"], "draw": batch["draw"], "layout": [r[0] for r in read], **{n: [c[k] for c in columns] for k, n in enumerate(names)}})


def _layouts(html: pd.Series) -> pd.Series:
    return pd.Series([layout_of(h) for h in html], dtype="int64")


def _extractor():
    def read(wrapper: str | None, own: str | None) -> dict | None:
        if not isinstance(wrapper, str):
            return None
        found = json.loads(wrapper)
        return found | {"template": frozenset(found["template"]).union(json.loads(own) if isinstance(own, str) else ())}

    @F.pandas_udf("string")
    def extracted(html: pd.Series, wrapper: pd.Series, own: pd.Series) -> pd.Series:
        keys = list(zip(wrapper, own, strict=True))
        wrappers = {k: read(*k) for k in set(keys)}
        return pd.Series([extract(h, wrappers[k]) for h, k in zip(html, keys, strict=True)], dtype=object)

    return extracted


def learn_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """Wrappers of all hosts of three or more different pages, learned from all of them, as JSON: (of_host, several, wrapper), and what
    the layouts of hosts with several have besides, (in_host, of_layout, own).

    Every page is counted, copies once: (host, path, line) and (host, layout, path, line) with partial sums, so that no
    task has a host's pages. A line is template by its share of the pages with its path, in the host or in its layout,
    however rare that is. Pages of one layout have the same boxes and so need no search for the best match; nodes are
    told by their paths. A wrapper has at most 100 times the lines of a page, since a line has to be on a hundredth of
    the pages of its host or layout."""
    host, _ = split_url(F.col(url_col))
    rows = pages.select(host.alias("host"), F.col(html_col).cast("string").alias("html")).where("host <> '' AND html <> ''").withColumn("draw", F.xxhash64("html"))
    entries = rows.mapInPandas(_entries, ENTRIES).dropDuplicates(["host", "draw"])
    entries = entries.select("host", "layout", F.explode(F.arrays_zip("path", "line", "chars", "wide", "box")).alias("e")).select("host", F.when(~F.col("e.wide"), F.col("layout")).alias("layout"), "e.*")
    counts = entries.groupBy("host", "layout", "path", "line", "box").agg(F.count("*").alias("times"), F.sum("chars").alias("chars"))
    counts = materialise(counts.where("line = 0 OR times >= 3"), "op9-counts")
    sizes = counts.where("path = 0 AND line = 0 AND times >= 3").select(F.col("host").alias("of_host"), F.col("layout").alias("of_layout"), F.col("times").alias("pages"), F.col("chars").alias("total"))
    hosts = sizes.where("of_layout IS NULL")
    met = counts.where("path <> 0 AND line = 0").select(F.col("host").alias("met_host"), F.col("path").alias("met_path"), F.col("times").alias("met"))
    lines = counts.where("line <> 0").join(met.hint("merge"), (F.col("host") == F.col("met_host")) & (F.col("path") == F.col("met_path")))
    lines = lines.join(sizes.hint("merge"), (F.col("host") == F.col("of_host")) & F.col("layout").eqNullSafe(F.col("of_layout")))
    same = lines.where(is_template(F.col("times"), F.col("met"), F.col("pages"))).select("host", "layout", F.col("line").cast("string").alias("line"), "chars", "box")
    same = same.groupBy("host", "layout").agg(F.collect_set("line").alias("every"), F.collect_set(F.when(F.col("box"), F.col("line"))).alias("boxes"), F.sum("chars").alias("constant"))
    same = materialise(same, "op9-same")

    def constant(scope: Column) -> Column:
        return F.coalesce(F.sum(F.when(scope, F.col("constant"))), F.lit(0))

    wide = F.col("layout").isNull()
    shares = same.groupBy("host").agg(F.greatest(constant(wide), constant(~wide)).alias("constant"), F.max(F.when(wide, F.struct("every", "boxes"))).alias("wide"))
    # where one layout has all pages of the host, its lines are the host's
    largest = sizes.where("of_layout IS NOT NULL").groupBy(F.col("of_host").alias("largest_of")).agg(F.max("pages").alias("largest"))
    found = hosts.join(shares, F.col("of_host") == F.col("host"), "left").join(largest, F.col("of_host") == F.col("largest_of"), "left")
    found = found.withColumns({"whole": varies_enough(F.coalesce("constant", F.lit(0)), F.col("total")), "several": F.coalesce(F.col("largest"), F.lit(0)) < F.col("pages")})

    def template(of: str = "") -> Column:
        return F.coalesce(F.when(F.col("whole"), F.col(f"{of}every")).otherwise(F.col(f"{of}boxes")), F.array().cast("array<string>"))

    found = materialise(found.select("of_host", "whole", "several", F.to_json(F.struct(template("wide.").alias("template"), "whole")).alias("wrapper")), "op9-wrappers")
    own = same.where(~wide).join(found.where("several").select("of_host", "whole"), F.col("host") == F.col("of_host")).select(F.col("host").alias("in_host"), F.col("layout").alias("of_layout"), F.to_json(template()).alias("own"))
    return found.select("of_host", "several", "wrapper"), materialise(own, "op9-layouts")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text (empty if none), n_chars.

    Wrappers are learned per host from all its pages and joined back by host, and by layout within the host; then every page is read whole, on its
    own. Hosts of one or two different pages, pages without a host and null urls are read without a wrapper. Null and
    empty html gives an empty text. Repeated rows are read each; an empty table gives an empty result. Where the
    wrappers are too many to broadcast, the pages move once by host; adaptive execution splits a host with a third of
    all pages, since both sides are plain scans.
    """
    wrappers, layouts = learn_wrappers(pages, url_col, html_col)
    host, _ = split_url(F.col(url_col))
    layout = F.pandas_udf(_layouts, "long")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    rows = rows.join(wrappers, F.col("host") == F.col("of_host"), "left").withColumn("layout", layout(F.when(F.col("several"), F.col("html"))))
    rows = rows.join(layouts, (F.col("host") == F.col("in_host")) & (F.col("layout") == F.col("of_layout")), "left")
    rows = rows.select("id", "url", _extractor()("html", "wrapper", "own").alias("text"))
    return rows.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))
