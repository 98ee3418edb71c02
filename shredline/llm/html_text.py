"""Main text of pages by a site style tree.

Pages of one host are merged: a node of the tree is a path of tags and classes. What the host's pages have there is a
distribution of looks (the sequence of child elements) and of words (of the node's own text; a paragraph's or heading's with all that is
in it). With m pages that have the node:

* *Presentation* is the entropy of its looks to the base m: near 0 where all pages look alike there.
* *Content* is one minus the mean entropy of its words to the base m, where the entropy of a word on n pages is ``log n``, and the mean is
  over the words of all pages, so that a page number does not make a repeated line important.
* A page's branch takes its importance from both: a leaf has its content; an inner node has ``(1 - d) * presentation + d * mean importance
  of its parts`` with ``d = DECAY ** number of looks``, its own words being a part.

A branch in which every node is less important than ``LEAST_IMPORTANCE`` is removed from the page; in an article or main part, paragraphs and
headings go with a branch that holds them only, since articles have headings in common. Nodes of fewer than ``LEAST_PAGES`` pages are
important. Pages whose article (else main part, else page) has the same text are one page in these counts, so copies tell nothing,
however many there are.

Two things differ on every page and are yet not its article, reader comments and rotating adverts, and a host with few pages has no
entropies; for these, elements that are no article text by their meaning (navigation, forms, scripts) and names count too. A class or id
marks an element if the whole name says so: marks, after an owner and before places at most (post-comments, sidebar-left). In an article or main
part ids do not mark, nor do names of paragraphs, headings and inline elements; a header there is a part of it. Names, roles and forms
never remove the page's article or main part nor what holds it, and on a page without either not what holds most of its text. What
remains of the page's articles (else of its main part, else of its body) is its text.

Counts are sums over pieces that are dealt by node and word together, so a host with a third of all pages is only larger counts.

Text: character references are decoded, white space in a block becomes one space, blocks are trimmed, empty ones go, and
the others are joined by one line feed in page order. ``br`` and table cells are white space in a block.

Defined cases: null and empty pages, and pages without text, have empty text; text without any markup is one block; a
page whose every branch is unimportant keeps those that names do not exclude; an importance that equals the threshold is important; very long
pages are read whole; unclosed, stray and crossed tags are repaired as browsers do for ``p``, ``li``, table parts and unclosed inline
elements; a tag cut off at the end of a page is dropped; repeated rows are each returned; other columns are ignored; a null url is
the host ``''``; no pages give no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, even_keys, expand, mix64, slices, squeeze, table

LEAST_IMPORTANCE, LEAST_PAGES, DECAY = 0.1, 10, 0.9
#: Nodes that are broadcast; more of them meet the pages in a join.
BROADCAST_NODES = 500_000
#: Pages whose words are sorted together, and bytes of pages whose words a counting task has on average.
BATCH_PAGES, SHARD_BYTES = 2048, 16 << 20

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>?|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
#: One attribute of a tag: a whole name, and its value.
_ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+)))?+")
_READ = frozenset("class id role style hidden aria-hidden".split())
_SPACE = re.compile(r"[ \t\n\r\f\v   -     　]+")
_NAMES = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
#: Open elements that a start tag closes, and what it does not look beyond.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "body": ({"head"}, {"html"}),
}
_BARRIER = frozenset("article aside blockquote body div td th li section main table form nav header footer".split())
DROPPED = frozenset("head nav footer aside form script style noscript template iframe svg canvas object button select textarea dialog menu audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal"
    " overlay newsletter subscribe signup login sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer comments comment disqus replies reply"
    " respond toolbar pagination pager masthead topbar copyright social share sharing related recommended tracking".split()
)
#: Parts after a marked first one that leave it what it is.
PLACES = frozenset(
    "area bar block body bottom box col column container content inner item items left links list outer panel primary right secondary section slot"
    " text top unit wrap wrapper".split()
)
#: Parts before a mark that tell whose it is: post-comments, site-footer.
OWNERS = frozenset("article blog entry main page post reader site user".split())
#: Parts of names that tell of a page's state and not of what an element is: no-sidebar, has-banner.
STATES = frozenset("no not has with without is hide hides".split())
#: Elements whose inner elements are parts of their sentences, and no nodes of their own.
SENTENCES = frozenset("p h1 h2 h3 h4 h5 h6".split())
PARTS = frozenset({"article", "main"})


class Node:
    """``drop`` is what the node is by its element or as hidden; ``marked``, by its names, role or being a form."""

    __slots__ = ("tag", "children", "drop", "marked", "key", "kept")

    def __init__(self, tag: str, key: int, drop: bool, marked: bool = False):
        self.tag, self.key, self.drop, self.marked, self.children, self.kept = tag, key, drop, marked, [], True


def mark(name: str) -> bool:
    """Whether a class or id marks an element: all of it, but for an owner before and places after the marks."""
    parts = _NAMES.findall(name)
    if not parts or not STATES.isdisjoint(parts):
        return False
    while len(parts) > 1 and parts[-1] in PLACES:
        parts.pop()
    if len(parts) > 1 and parts[0] in OWNERS:
        parts = parts[1:]
    return MARKED.issuperset(parts)


def parse(page: str, host: str) -> Node:
    """The page as a tree; a node's key stands for its host and path of tags and classes."""
    from xxhash import xxh3_64_intdigest as digest

    root = Node("", digest(host.encode()), False)
    stack, at, n = [root], 0, len(page)
    articles = 0

    def close(to: int) -> None:
        nonlocal articles
        while len(stack) > to:
            articles -= stack.pop().tag in PARTS

    for m in iter(lambda: _TOKEN.search(page, at), None):
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        if name := m[1]:
            name = name.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    close(i)
                    break
                if name not in BLOCK and stack[i].tag in BLOCK:
                    break
            continue
        name, attributes = (m[2], m[3]) if m[2] else (m[4], m[5])
        if not name or not page.endswith(">", m.start(), at):
            continue  # a comment or declaration, or a tag that the end cuts off
        name = name.lower()
        if name in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in _BARRIER:
                    break
        if name in CLOSES:
            closed, beyond = CLOSES[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closed:
                    close(i)
                    break
                if stack[i].tag in beyond:
                    break
        drop, look = name in DROPPED and name != "form" or name == "header" and not articles, name
        marked = name == "form"
        if attributes and ("=" in attributes or "hidden" in attributes.lower()):
            for k, *v in _ATTRIBUTE.findall(attributes):
                k, value = k.lower(), (v[0] or v[1] or v[2]).lower()
                if k not in _READ:
                    continue
                if k == "class" or k == "id":
                    if not articles or k == "class" and name in BLOCK and name not in SENTENCES:
                        marked |= any(map(mark, value.split()))
                    if k == "class":
                        look = f"{name}.{value}"
                elif k == "role":
                    marked |= value in ROLES
                elif k == "style":
                    drop |= "display:none" in value.replace(" ", "")
                else:
                    drop |= value != "false"
        whole = name in ("html", "body")
        node = Node(name, digest(look.encode(), seed=stack[-1].key), drop and not whole, marked and not whole)
        stack[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID:
            stack.append(node)
            articles += name in PARTS
    if at < n:
        stack[-1].children.append(page[at:])
    settle(root)
    return root


def settle(root: Node) -> None:
    """Drops the marked nodes, except the page's article or main part, and what holds it. That is an unmarked one; else the ones under
    fewest marks, articles before main parts; and always an article with more than half of the page's text. On a page
    without either it is every node with more than half of the text."""
    order, todo = [], [(root, None, 0)]  # node, place of its parent, marks from the root
    while todo:
        node, above, marks = todo.pop()
        if node.drop:
            continue
        marks += node.marked
        order.append((node, above, marks))
        todo += [(c, len(order) - 1, marks) for c in node.children if isinstance(c, Node)]
    if not any(node.marked for node, *_ in order):
        return
    size, own = [0] * len(order), [0] * len(order)  # characters under a node; those without marked nodes in it
    for i in range(len(order) - 1, -1, -1):  # children before parents
        node, above, _ = order[i]
        here = sum(len(c) - c.count(" ") - c.count("\n") for c in node.children if isinstance(c, str))
        size[i] += here
        own[i] += here
        if above is not None:
            size[above] += size[i]
            own[above] += 0 if node.marked else own[i]
    parts = {tag: [i for i, (node, *_) in enumerate(order) if node.tag == tag and own[i]] for tag in ("article", "main")}
    every = parts["article"] + parts["main"]
    held = [i for i in parts["article"] if 2 * size[i] > size[0]]
    clear = {i for i in every if not order[i][2]}
    if clear:  # what is marked in a clear article is a part of it
        inside = set()
        for i, (node, above, _) in enumerate(order):
            if above in inside or above in clear and order[above][0].tag == "article":
                inside.add(i)
        held = [i for i in held if i not in inside]
    elif every:
        of = parts["article"] or parts["main"]
        least = min(order[i][2] for i in of)
        held += [i for i in of if order[i][2] == least]
    else:
        held = [i for i in range(len(order)) if 2 * size[i] > size[0]]
    for i in held:
        at = i
        while at is not None and not (at != i and order[at][2] == 0):
            order[at][0].marked = False
            at = order[at][1]
    for node, *_ in order:
        node.drop |= node.marked


def clean(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


class Words:
    """64-bit hashes of words, remembered up to a number of words."""

    def __init__(self, most: int = 300_000):
        from xxhash import xxh3_64_intdigest

        self.digest, self.most, self.known = xxh3_64_intdigest, most, {}

    def __call__(self, text: str) -> list[int]:
        words, known = set(text.split()), self.known
        if len(known) > self.most:
            known.clear()
        for w in words.difference(known):
            known[w] = self.digest(w.encode("utf-8", "surrogatepass"))
        return [known[w] for w in words]


#: Kinds of values at a node: what every page has, a look, a word.
ANY, LOOK, WORD = 0, 1, 2


def own_text(node: Node, whole: bool) -> str:
    """The text of a node without its elements, or with them."""
    if not whole:
        return html.unescape(" ".join(c for c in node.children if isinstance(c, str)))
    out, todo = [], node.children[::-1]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.drop:
            if x.tag in ("br", "img"):
                out.append(" ")
            todo += x.children[::-1]
    return html.unescape("".join(out))


def tree_nodes(root: Node) -> Iterator[tuple[Node, bool, bool, list[Node]]]:
    """The nodes of a page that are in the style tree, parents first: with whether they are in an article or main part, whether their
    text is that of all that is in them, and their child elements in the tree."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        whole = node.tag in SENTENCES
        children = [] if whole else [c for c in node.children if isinstance(c, Node) and c.tag not in RAW and c.tag not in VOID]
        yield node, inside, whole, children
        inside |= node.tag in PARTS
        todo += [(c, inside) for c in children]


def unit_of(root: Node) -> str:
    """What tells a page from its copies: the text of its articles, else of its main part, else of all of it."""
    return "\n".join(t for x in roots(root) for t in blocks(x))


def features(root: Node, words: Words) -> dict[int, tuple[set[int], set[int]]]:
    """The looks and words of a page at each node, as hashes."""
    from xxhash import xxh3_64_intdigest as digest

    seen: dict[int, tuple[set[int], set[int]]] = {}
    for node, _, whole, children in tree_nodes(root):
        looks, own = seen.setdefault(node.key, (set(), set()))
        if children:
            looks.add(digest(" ".join([c.tag for c in children])))
        own.update(words(own_text(node, whole)))
    return seen


def blocks(root: Node) -> list[str]:
    """The texts of the blocks under a node."""
    out, inline, todo = [], [], [root]

    def end() -> None:
        if text := clean("".join(inline)):
            out.append(text)
        inline.clear()

    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            inline.append(x)
        elif x.drop or not x.kept:
            if x.tag in BLOCK:
                end()
        elif x.tag in ("br", "td", "th", "img", "option"):
            inline.append(" ")
            todo += x.children[::-1]
        elif x.tag in BLOCK:
            end()
            todo.append(None)
            todo += x.children[::-1]
        else:
            todo += x.children[::-1]
    end()
    return out


def roots(root: Node) -> list[Node]:
    """The outermost articles that are not dropped, else main parts, else the page."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.drop or not node.kept:
                continue
            if node.tag == wanted:
                found.append(node)
            else:
                todo += [c for c in node.children if isinstance(c, Node)][::-1]
        if any(blocks(x) for x in found):
            return found
    return [root]


def prune(root: Node, known: dict[int, tuple[float, float, float]]) -> None:
    """Takes the branches that are unimportant throughout out of the page. ``known`` has by key the presentation, the content and the
    weight of the parts; other nodes are important."""
    if all(content >= LEAST_IMPORTANCE for _, content, _ in known.values()):
        return  # every branch has a leaf, and that only its content
    order = list(tree_nodes(root))
    importance: dict[int, float] = {}
    low: set[int] = set()
    for node, _, whole, children in reversed(order):  # children before parents
        text = bool(own_text(node, whole).strip())
        telling = [c for c in children if id(c) in importance]
        if not text and not telling:
            low.add(id(node))  # nothing to tell
            continue
        if node.key not in known:
            importance[id(node)], least = 1.0, False
        else:
            look, content, weight = known[node.key]
            parts = [importance[id(c)] for c in telling] + [content] * text
            importance[id(node)] = content if not children else (1 - weight) * look + weight * sum(parts) / len(parts)
            least = importance[id(node)] < LEAST_IMPORTANCE
        if least and all(id(c) in low for c in children):
            low.add(id(node))
    for node, inside, whole, _ in order:
        node.kept = id(node) not in low or whole and inside


def main_text(page: str | None, host: str, known: Callable[[list[int]], dict[int, tuple[float, float, float]]] | None = None) -> str:
    """The text of a page; ``known`` looks up nodes of the host's style tree."""
    root = parse(page or "", host)
    if known is not None:
        found = known([node.key for node, *_ in tree_nodes(root)])
        if found:
            prune(root, found)
            if text := "\n".join(t for x in roots(root) for t in blocks(x)):
                return text
            return main_text(page, host)
    return "\n".join(t for x in roots(root) for t in blocks(x))


_HOST = re.compile(r"://([^/?#]*)")


def host_of(url: str | None) -> str:
    found = _HOST.search(url or "")
    return found[1].lower() if found else ""


class Piece(NamedTuple):
    """Sorted hashes of (node, value) with node, kind and number of pages each, and the units of these pages, as places in ``units``."""

    pair: np.ndarray
    key: np.ndarray
    kind: np.ndarray
    n: np.ndarray
    at: np.ndarray
    units: np.ndarray

    @classmethod
    def unpack(cls, row: dict) -> Piece:
        pair, key, kind, n = expand(row["pairs"], np.uint64, np.uint32, np.uint8, np.uint32)
        return cls(pair, expand(row["keys"], np.uint64)[0][key], kind, n, expand(row["places"], np.uint32)[0], expand(row["units"], np.uint64)[0])


def pieces(pair: np.ndarray, key: np.ndarray, kind: np.ndarray, unit: np.ndarray, shards: int) -> Iterator[dict]:
    """The pages' values cut by ranges of the hash of node and value."""
    order = np.argsort(pair, kind="stable")
    pair, key, kind, unit = pair[order], key[order], kind[order], unit[order]
    shard = (pair >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    cuts = np.searchsorted(shard, np.arange(shards + 1).astype(np.uint64))
    for k in np.flatnonzero(np.diff(cuts)):
        own = slice(cuts[k], cuts[k + 1])
        first = np.flatnonzero(np.concatenate([[True], pair[own][1:] != pair[own][:-1]]))
        n = np.diff(np.concatenate([first, [cuts[k + 1] - cuts[k]]]))
        units, at = np.unique(unit[own], return_inverse=True)
        keys, which = np.unique(key[own][first], return_inverse=True)
        pairs = squeeze(pair[own][first], which.astype(np.uint32), kind[own][first], n.astype(np.uint32))
        yield {"shard": int(k), "pairs": pairs, "keys": squeeze(keys), "places": squeeze(at.astype(np.uint32)), "units": squeeze(units)}


def count_values(rows: pa.Table) -> pa.Table:
    """For each node the pages that have it, and sums over its looks and words, of one range of the hashes. A page that several pieces have counts once."""
    every = [Piece.unpack(r) for r in rows.drop_columns(["task", "shard"]).to_pylist()]
    units, times = np.unique(np.concatenate([p.units for p in every]), return_counts=True)
    repeated = units[times > 1]
    pairs, keys, kinds, counts, again = [], [], [], [], []
    for p in every:
        twice = np.isin(p.units, repeated)[p.at]
        start = np.cumsum(p.n.astype(np.int64)) - p.n
        pairs.append(p.pair)
        keys.append(p.key)
        kinds.append(p.kind)
        counts.append(np.add.reduceat((~twice).astype(np.int64), start))
        again.append(np.stack([np.repeat(p.pair, p.n)[twice], p.units[p.at[twice]]], 1))
    both = np.concatenate(again)
    if len(both):
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        both = both[np.concatenate([[True], (both[1:] != both[:-1]).any(1)])]
        pair, n = np.unique(both[:, 0], return_counts=True)
    pair_, key, kind, count = (np.concatenate(x) for x in (pairs, keys, kinds, counts))
    order = np.argsort(pair_, kind="stable")
    pair_, key, kind, count = pair_[order], key[order], kind[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], pair_[1:] != pair_[:-1]]))
    pair_, key, kind, count = pair_[first], key[first], kind[first], np.add.reduceat(count, first)
    if len(both):
        count[np.searchsorted(pair_, pair)] += n
    order = np.argsort(key, kind="stable")
    key, kind, n = key[order], kind[order], count[order].astype(float)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    logs, look, word = n * np.log(n), kind == LOOK, kind == WORD
    sums = {"pages": n * (kind == ANY), "looks": look, "look_pages": n * look, "look_logs": logs * look, "word_pages": n * word, "word_logs": logs * word}
    return pa.table({"key": pa.array(key[start].view(np.int64)), **{k: pa.array(np.add.reduceat(v.astype(float), start)) for k, v in sums.items()}})


PIECES = pa.schema([("task", pa.int32()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("pairs", "keys", "places", "units"))])
SUMS = ["pages", "looks", "look_pages", "look_logs", "word_pages", "word_logs"]


def style_tree(pages: DataFrame) -> DataFrame:
    """key, presentation, content and weight of the parts for every node of every host's tree that LEAST_PAGES pages or more have."""
    size = pages.agg(F.sum(F.octet_length("html")).alias("n")).first().n or 0
    shards = max(pages.sparkSession.sparkContext.defaultParallelism, -(-size // SHARD_BYTES))
    tasks = even_keys(pages.sparkSession, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        words = Words()
        values: list[int] = []
        parts: list[tuple[int, int, int, int]] = []  # node, kind, unit and number of values
        pages = 0

        def done() -> Iterator[pa.RecordBatch]:
            key, kind, unit, n = (np.array(x, np.uint64) for x in zip(*parts))
            n = n.astype(np.int64)
            key, kind, unit = np.repeat(key, n), np.repeat(kind, n), np.repeat(unit, n)
            pair = mix64(key ^ mix64(np.array(values, np.uint64) * np.uint64(4) + kind))
            # one of equal pages
            same = mix64(pair ^ unit)
            once = np.unique(same, return_index=True)[1] if len(set(x[2] for x in parts)) < pages else slice(None)
            for row in pieces(pair[once], key[once], kind[once].astype(np.uint8), unit[once], shards):
                yield pa.RecordBatch.from_pylist([{**row, "task": int(tasks[row["shard"]])}], PIECES)
            values.clear()
            parts.clear()

        for batch in slices(batches, 256):
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                root = parse(page or "", host_of(url))
                unit = digest(unit_of(root).encode("utf-8", "surrogatepass"))
                for key, (looks, own) in features(root, words).items():
                    values.append(0)
                    values += looks
                    values += own
                    parts += [(key, ANY, unit, 1), (key, LOOK, unit, len(looks)), (key, WORD, unit, len(own))]
                pages += 1
            if pages >= BATCH_PAGES or len(values) > 1_000_000:
                yield from done()
                pages = 0
        if pages:
            yield from done()

    cut = pages.select("url", "html").mapInArrow(run, "task int, shard int, pairs binary, keys binary, places binary, units binary")
    counted = cut.groupBy("task").applyInArrow(lambda t: count_values(t), "key long, " + ", ".join(f"{c} double" for c in SUMS))
    total = counted.groupBy("key").agg(*(F.sum(c).alias(c) for c in SUMS)).where(F.col("pages") >= LEAST_PAGES)
    base = F.log("pages")
    looks = F.when(F.col("look_pages") > 0, (F.log("look_pages") - F.col("look_logs") / F.col("look_pages")) / base).otherwise(0.0)
    content = F.when(F.col("word_pages") > 0, 1 - F.col("word_logs") / F.col("word_pages") / base).otherwise(1.0)
    return total.select("key", looks.alias("presentation"), content.alias("content"), F.pow(F.lit(DECAY), F.col("looks")).alias("weight"))


class Lookup:
    """Nodes by key in sorted arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def __call__(self, keys: list[int]) -> dict[int, tuple[float, float, float]]:
        if not len(self.keys):
            return {}
        wanted = np.array(keys, np.uint64)
        at = np.searchsorted(self.keys, wanted).clip(max=len(self.keys) - 1)
        same = np.flatnonzero(self.keys[at] == wanted)
        return {keys[i]: tuple(v) for i, v in zip(same.tolist(), self.values[at[same]].tolist())}


TEXTS = "page_id long, url string, text string, n_chars long"
VALUES = ["presentation", "content", "weight"]


def extract_text(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    nodes = Workspace(spark).save(style_tree(pages), "style-tree")

    def texts(batch: pa.RecordBatch, known: list[Lookup]) -> pa.RecordBatch:
        out = [main_text(p, host_of(u), x) for u, p, x in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), known)]
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )

    if nodes.count() <= BROADCAST_NODES:
        rows = nodes.select("key", *VALUES).toArrow()
        shared = spark.sparkContext.broadcast(Lookup(rows.column("key").to_numpy().view(np.uint64), np.stack([rows.column(c).to_numpy() for c in VALUES], 1)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield texts(batch, [shared.value] * batch.num_rows)

        return pages.mapInArrow(run, TEXTS)

    def page_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own, keys = [], []
            for uid, url, page in zip(*(batch.column(c).to_pylist() for c in ("uid", "url", "html"))):
                found = {node.key for node, *_ in tree_nodes(parse(page or "", host_of(url)))}
                own += [uid] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array(np.array(keys, np.uint64).view(np.int64))], names=["uid", "key"])

    # equal pages of one host have the same nodes, so one row stands for them
    uid = F.unhex(F.sha2(F.concat_ws("\n", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))), 256))
    named = pages.withColumn("uid", uid)
    own = named.mapInArrow(page_keys, "uid binary, key long").distinct().join(nodes, "key").groupBy("uid").agg(F.collect_list(F.struct("key", *VALUES)).alias("nodes"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            known = [Lookup(np.array([x["key"] for x in own or ()], np.int64).view(np.uint64), np.array([[x[c] for c in VALUES] for x in own or ()])) for own in batch.column("nodes").to_pylist()]
            yield texts(batch, known)

    return named.join(own, "uid", "left").select("page_id", "url", "html", "nodes").mapInArrow(joined, TEXTS)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark, table(spark, sf_dir, "pages"))


QUERIES = {"op3_html_extraction": op3_html_extraction}
ORACLES: dict[str, str] = {}
