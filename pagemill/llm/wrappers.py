"""HTML extraction by union-free wrappers, one per host.

A page is read as a tree of blocks and texts.  The pages of a host are aligned one after the other:
children of one label that follow each other become a repeated group, those that only some pages
have become optional, and texts that differ become slots.  A text that stands at the same place of
its path on every page, counted from the first or the last text there, is constant; copies of a
page are one page as evidence for that.  The wrapper, with the text volume of its
nodes, says which of its paths hold the main text; every page is then read along those paths.

Wrappers are folded in the tasks that read the pages, then by salted host and last by host, so a
host with most of the pages never meets in one task.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import cut_lineage, narrow_side, rows_of

#: Hosts whose wrappers a task holds before it passes them on.
HELD_HOSTS = 2_000
#: Salts of the first merge of a host's wrappers.
SALTS = 32
#: Distinct pages from which a text that never changes counts as part of the template.
TEMPLATE_PAGES = 5
#: Blocks nested deeper than this count as part of the block around them.
MAX_DEPTH = 150
#: Share of its characters in links from which a block of an unnamed region is a menu.
MENU = 0.6

# Element classes of HTML and the words by which pages name their furniture.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img picture".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
NOT_TEXT = frozenset(
    "head script style noscript template iframe object embed canvas svg audio video map dialog nav "
    "footer aside form button select textarea input fieldset menu title xmp noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos "
    "promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer masthead "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login comment comments disqus replies reply respond related recommended "
    "recommendations share sharing social widget widgets toolbar pagination pager search form copyright".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text: no region by themselves, as a heading or a list may stand beside them.
RUNNING = frozenset("p pre blockquote ul ol dl".split()) | HEADINGS
CONTENT = frozenset("article post entry story content body main text".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: tag -> (tags that an opening one closes, tags beyond which it does not look)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Block:
    """An element with its children: blocks, and texts as (text, characters in links)."""

    __slots__ = ("tag", "label", "words", "children", "main", "heading", "chars", "links")

    def __init__(self, tag: str, label: str, words: frozenset):
        self.tag, self.label, self.words = tag, label, words
        self.children: list = []
        self.main = tag in ("article", "main") or "role=main" in words
        self.heading = tag in HEADINGS
        self.chars = self.links = 0


@lru_cache(maxsize=4096)
def _label(tag: str, attributes: str) -> tuple[str, frozenset]:
    """(label of the wrapper, words of class, id and role)."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    names = [re.sub(r"\d+", "", name) for name in (found.get("class", "") + " " + found.get("id", "")).split()]
    words = {word.lower() for name in names for word in _WORDS.findall(name)}
    role = found.get("role", "").lower()
    if role:
        words.add(f"role={role}")
    return ".".join([tag, *sorted(filter(None, {*names, role}))]).replace("/", ""), frozenset(words)


def parse(html: str) -> Block:
    """The block tree of a page; scripts, styles and comments are left out as they are read."""
    root = Block("", "", frozenset())
    stack, text, links, in_link, at, end, deepest = [root], [], 0, 0, 0, len(html), 0
    places: dict[str, list[int]] = {}  # where in the stack the blocks of a tag are

    def innermost(tags):
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def close(depth):
        for block in stack[depth:]:
            places[block.tag].pop()
        del stack[depth:]

    def flush():
        nonlocal links
        if text:
            words = " ".join(unescape("".join(text)).split())
            if words:
                stack[-1].children.append((words, min(links, len(words))))
            text.clear()
        links = 0

    while at < end:
        found = _TOKEN.search(html, at)
        piece = html[at : found.start() if found else end]
        if piece:
            text.append(piece)
            links += len(piece) if in_link else 0
        if not found:
            break
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, closing = tag.lower(), found[1] or found[4]
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        if closing:
            if (depth := innermost((tag,))) > 0:
                close(depth)
                in_link = 0
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE).search(html, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P and stack[-1].tag == "p":
            close(len(stack) - 1)
        if tag in CLOSES:
            closes, stops = CLOSES[tag]
            if (depth := innermost(closes)) > innermost(stops):
                close(depth)
        block = Block(tag, *_label(tag, found[3] or found[6] or ""))
        stack[-1].children.append(block)
        places.setdefault(tag, []).append(len(stack))
        stack.append(block)
        deepest = max(deepest, len(stack))
    flush()
    _spread(root)
    if deepest > MAX_DEPTH + 1:
        _flatten(root)
    return root


def _flatten(root: Block) -> None:
    """Give what blocks below ``MAX_DEPTH`` hold to the block around them; furniture stays a block."""
    level = [root]
    for _ in range(MAX_DEPTH):
        level = [child for block in level for child in block.children if isinstance(child, Block)]
    for block in level:
        children, waiting = [], block.children[::-1]
        while waiting:
            child = waiting.pop()
            if isinstance(child, Block) and not is_furniture(child):
                waiting += child.children[::-1]
            else:
                children.append(child)
        block.children = children


def _spread(root: Block) -> None:
    """Tell every block what it holds: a main element, a heading, characters, and those in links."""
    order, stack = [], [root]
    while stack:
        block = stack.pop()
        order.append(block)
        stack += [child for child in block.children if isinstance(child, Block)]
    for block in reversed(order):
        for child in block.children:
            if isinstance(child, Block):
                block.main = block.main or child.main
                block.heading = block.heading or child.heading
                block.chars += child.chars
                block.links += child.links
            else:
                block.chars += len(child[0])
                block.links += child[1]


def is_furniture(block: Block) -> bool:
    """Menus, headers, footers, sidebars, notices, adverts, forms, comments and the like.

    What holds an article or main element is not furniture, whatever it is called; a header with
    a heading is the title of what it heads.
    """
    if block.main or block.tag in ("", "html", "body"):
        return block.tag == "head"
    if block.tag in NOT_TEXT or block.words & FURNITURE:
        return True
    if block.tag == "header" or "header" in block.words:
        return not block.heading
    return any(word[5:] in ROLES for word in block.words if word.startswith("role="))


# --- wrappers: [label, pages, characters, link characters, constant, repeated, content, children, seen]
# constant: of a text, (checksum, place) of what every page has there, or None if nothing
# seen: of a text, digests of distinct pages that have it, at most TEMPLATE_PAGES, the smallest

_LABEL, _PAGES, _CHARS, _LINKS, _CONSTANT, _REPEATED, _KIND, _CHILDREN, _SEEN = range(9)


def _placed(root: Block) -> list[tuple[Block, int, str, str, list[str]]]:
    """(block, index in it, path, text, constants) of the texts outside furniture, in page order.

    The constants name a text by its checksum and its place among the texts of its path, once
    counted from the first and once from the last.
    """
    found, times = [], Counter()
    stack: list[tuple] = [(root, -1, "/")]
    while stack:
        block, index, path = stack.pop()
        if index >= 0:
            found.append((block, index, path, times[path]))
            times[path] += 1
            continue
        for i in range(len(block.children) - 1, -1, -1):
            child = block.children[i]
            if not isinstance(child, Block):
                stack.append((block, i, path))
            elif not is_furniture(child):
                stack.append((child, -1, f"{path}/{child.label}"))
    out = []
    for block, index, path, place in found:
        text = block.children[index][0]
        code = zlib.crc32(text.encode())
        out.append((block, index, path, text, [f"{code}+{place}", f"{code}-{times[path] - place}"]))
    return out


def wrap(block: Block) -> list:
    """The wrapper of one page's block, without furniture."""
    digest, constants = hashlib.blake2b(digest_size=8), {}
    for home, index, _, text, names in _placed(block):
        digest.update(text.encode() + b"\n")
        constants[id(home), index] = names
    return _wrapped(block, constants, digest.hexdigest())


def _wrapped(block: Block, constants: dict, page: str) -> list:
    children = []
    for index, child in enumerate(block.children):
        if isinstance(child, Block):
            if not is_furniture(child):
                children.append(_wrapped(child, constants, page))
        else:
            text, links = child
            children.append(["#", 1, len(text), links, sorted(constants[id(block), index]), 0, 0, [], [page]])
    children = _folded(children, 1)
    return [
        block.label, 1, sum(c[_CHARS] for c in children), sum(c[_LINKS] for c in children),
        None, 0, _kind(block), children, [],
    ]


def _kind(block: Block) -> int:
    """Rank of a block as a home of main text by its name, the lower the better."""
    if block.tag == "article":
        return 1
    if block.tag == "main" or "role=main" in block.words:
        return 2
    return 3 if block.tag in ("div", "section", "td") and block.words & CONTENT else 4


def _folded(nodes: list[list], pages: int) -> list[list]:
    """Runs of equal labels, of one to three labels at a time, become repeated groups.

    ``pages`` is the number of pages of the block that holds the nodes.
    """
    for period in (1, 2, 3):
        out: list[list] = []
        for node in nodes:
            out.append(node)
            if len(out) >= 2 * period and all(
                out[-k][_LABEL] == out[-k - period][_LABEL] for k in range(1, period + 1)
            ):
                last = out[-period:]
                del out[-period:]
                for k in range(period):
                    merged = merge(out[k - period], last[k], same_pages=pages)
                    merged[_REPEATED] = 1
                    out[k - period] = merged
        nodes = out
    return nodes


def merge(a: list, b: list, same_pages: int = 0) -> list:
    """One wrapper for two of one label; what only one of them has becomes optional.

    ``same_pages`` is given for two nodes of the same pages, so many in all, none of which need
    have both.
    """
    pages = max(a[_PAGES], b[_PAGES]) if same_pages else a[_PAGES] + b[_PAGES]
    constant, seen = _constant(a, b, same_pages)
    return [
        a[_LABEL], pages, a[_CHARS] + b[_CHARS], a[_LINKS] + b[_LINKS], constant,
        a[_REPEATED] | b[_REPEATED], min(a[_KIND], b[_KIND]), _aligned(a[_CHILDREN], b[_CHILDREN], pages, same_pages),
        seen,
    ]


def _constant(a: list, b: list, same_pages: int) -> tuple[list | None, list]:
    """What all pages of two texts have, and distinct pages that have it."""
    # A node that all pages have keeps its own constants when others of these pages join it.
    whole = [node for node in (a, b) if same_pages and node[_PAGES] == same_pages]
    if whole:
        constant = set().union(*(node[_CONSTANT] or () for node in whole))
        seen = [page for node in whole for page in node[_SEEN]]
    else:
        constant = set(a[_CONSTANT] or ()) & set(b[_CONSTANT] or ())
        seen = a[_SEEN] + b[_SEEN]
    return (sorted(constant), sorted(set(seen))[:TEMPLATE_PAGES]) if constant else (None, [])


def _aligned(a: list[list], b: list[list], pages: int, same_pages: int) -> list[list]:
    names_a, names_b = [x[_LABEL] for x in a], [x[_LABEL] for x in b]
    if names_a == names_b:
        return [merge(x, y, same_pages) for x, y in zip(a, b)]
    out = []
    for same, i, j, k, m in SequenceMatcher(None, names_a, names_b, autojunk=False).get_opcodes():
        if same == "equal":
            out += [merge(x, y, same_pages) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += a[i:j] + b[k:m]
    # An optional beside its like is a group that repeats.
    return _folded(out, same_pages or pages)


def rule_of(wrapper: list) -> dict:
    """What to read of a host's pages: ``regions``, paths in order of preference, and ``template``,
    paths of texts that belong to the template, which hold only in regions without a name."""
    named, template, volume = [], [], []
    stack = [(wrapper, "")]
    while stack:
        node, path = stack.pop()
        here = f"{path}/{node[_LABEL]}"
        if node[_KIND] and node[_KIND] < 4 and node[_CHARS]:
            named.append((node[_KIND], -node[_CHARS] / node[_PAGES], here))
        for child in node[_CHILDREN]:
            if child[_LABEL] == "#":
                if child[_CONSTANT] is not None and len(child[_SEEN]) >= TEMPLATE_PAGES:
                    template += [f"{here}/#{constant}" for constant in child[_CONSTANT]]
            else:
                if child[_CHARS] and child[_LINKS] > MENU * child[_CHARS]:
                    template.append(f"{here}/{child[_LABEL]}")
                stack.append((child, here))
    # Without a name: down from the top as long as one child holds most of the running text.
    node, path = wrapper, f"/{wrapper[_LABEL]}"
    while True:
        volume.append(path)
        running = lambda x: x[_CHARS] - x[_LINKS]
        blocks = [child for child in node[_CHILDREN] if child[_LABEL] != "#"]
        best = max(blocks, key=running, default=None)
        if best is None or best[_REPEATED] or best[_LABEL].split(".")[0] in RUNNING:
            break
        if running(best) < 0.6 * max(1, running(node)):
            break
        node, path = best, f"{path}/{best[_LABEL]}"
    ranked = [here for _, _, here in sorted(named)]
    return {"named": list(dict.fromkeys(ranked)), "free": volume[::-1], "template": sorted(set(template))}


def main_text(root: Block, rule: dict) -> str:
    """The main text of a page along the paths of its host's rule."""
    named, free = rule["named"], rule["free"]
    wanted = {path: i for i, path in reversed(list(enumerate([*named, *free])))}
    homes: dict[int, list[tuple[Block, str]]] = {}
    stack: list[tuple[Block, str]] = [(root, "/")]
    while stack:
        block, path = stack.pop()
        if path in wanted:
            homes.setdefault(wanted[path], []).append((block, path))
        for child in reversed(block.children):
            if isinstance(child, Block) and not is_furniture(child):
                stack.append((child, f"{path}/{child.label}"))
    template = frozenset(rule["template"])
    constant = {
        (id(block), index)
        for block, index, path, _, names in (_placed(root) if template else ())
        if any(f"{path}/#{name}" in template for name in names)
    }
    # What belongs to the template goes unless the page has nothing else.
    for skip in (template, frozenset()):
        for place in sorted(homes):
            own = (skip, constant if skip else ()) if place >= len(named) else (None, ())
            texts = [text for home in homes[place] for text in _texts(*home, *own)]
            if texts:
                return " ".join(texts)
    return ""


def _texts(block: Block, path: str, skip: frozenset | None, constant):
    """The texts of a block in page order; ``skip`` names the menus of an unnamed region and
    ``constant`` its template texts."""
    stack: list[tuple] = [(block, path)]
    while stack:
        child, here = stack.pop()
        if not isinstance(child, Block):
            yield child
            continue
        for index in range(len(child.children) - 1, -1, -1):
            inner = child.children[index]
            if isinstance(inner, Block):
                below = f"{here}/{inner.label}"
                menu = skip is not None and (below in skip or inner.links > MENU * inner.chars)
                if not menu and not is_furniture(inner):
                    stack.append((inner, below))
            elif not constant or (id(child), index) not in constant:
                stack.append((inner[0], here))


# --- Spark -----------------------------------------------------------------------------


def _host_wrappers(batches):
    """Fold the task's pages into one wrapper per host."""
    held: dict[str, list] = {}

    def packed():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([_dumped(w) for w in held.values()], pa.string())],
            names=["host", "wrapper"],
        )

    for host, html in rows_of(batches, "host", "html"):
        own = wrap(parse(html or ""))
        held[host] = merge(held[host], own) if host in held else own
        if len(held) >= HELD_HOSTS:
            yield packed()
            held = {}
    yield packed()


def _dumped(wrapper: list) -> str:
    return json.dumps(wrapper, separators=(",", ":"), ensure_ascii=False)


def _fold(pdf):
    wrapper = None
    for raw in sorted(pdf["wrapper"]):
        own = json.loads(raw)
        wrapper = own if wrapper is None else merge(wrapper, own)
    return wrapper


def _merge_salted(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.iloc[:1][["host"]].assign(wrapper=[_dumped(_fold(pdf))])


def _derive(pdf: pd.DataFrame) -> pd.DataFrame:
    wrapper = _fold(pdf)
    return pdf.iloc[:1][["host"]].assign(wrapper=[_dumped(wrapper)], rule=[_dumped(rule_of(wrapper))])


def host_wrappers(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(``host``, ``wrapper``, ``rule``) of every host, from all of its pages."""
    hosts = pages.select(_host(url_column).alias("host"), F.col(html_column).alias("html"))
    partial = hosts.mapInArrow(_host_wrappers, "host string, wrapper string")
    salted = (
        partial.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
        .groupBy("host", "salt")
        .applyInPandas(_merge_salted, "host string, wrapper string")
    )
    return salted.groupBy("host").applyInPandas(_derive, "host string, wrapper string, rule string")


def _host(url_column: str):
    host = F.regexp_extract(F.col(url_column), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


@lru_cache(maxsize=1024)
def _loaded(rule: str) -> dict:
    return json.loads(rule)


def _read(batches):
    for batch in batches:
        texts = [
            main_text(parse(html), _loaded(rule)) if html and rule else ""
            for html, rule in rows_of([batch], "html", "rule")
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(text) for text in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    A null or empty page has the empty text; pages without a host in their address share one
    wrapper; rows that repeat an id are read each; an empty table gives an empty result; other
    columns are ignored; ids are longs.  Rules are a kilobyte or so per host and broadcast only
    below a checked size.
    """
    plain = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html")
    )
    rules = cut_lineage(host_wrappers(plain).select(F.col("host").alias("_host"), "rule"))
    largest = rules.agg(F.max(F.length("rule"))).first()[0] or 0
    joined = plain.join(
        narrow_side(rules, 4 * largest + 64), _host("url") == F.col("_host"), "left"
    ).select("page_id", "url", "html", "rule")
    return joined.mapInArrow(_read, "page_id long, url string, text string, n_chars long")
