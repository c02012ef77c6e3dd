"""HTML extraction by wrapper induction.

Each page becomes a DOM tree, and that a skeleton: block elements with their classes, inline elements folded into them,
repeated siblings (paragraphs, list items, records) as one node. The skeletons of a host's pages are folded into one
template. Two trees are aligned by simple tree matching: children in order, equal labels, the match with the most nodes.
A node with one text on all pages is constant, one whose text differs is a slot.

The template decides what is content. From its top the way leads to the child that holds most of the varying prose, until
no child holds most of it; that node is the content slot, and a page's text is what its aligned node holds. Text in links
counts nothing, bare text in containers a quarter; headings, a declared article and declared asides (navigation, adverts)
shift the weight of a child, they do not decide alone. Inside the slot, constant nodes go, and so do elements that declare
themselves no part of the article (forms, reader comments, scripts). A page that lacks the template's slot is aligned with
itself alone.

A node is constant if two or more different pages have it, most pages of the slot do, and all say the same in it, while the
slot varies. Headings and paragraphs stay: a shared one is text. Pages of a host that share their title and longest paragraph are
copies of each other and count as one, so copies make nothing constant. A page alone on its host has nothing to compare by.

Templates are folded partition by partition, in salted groups, and then by host, so a host with a third of all pages sends
one template for each task. A template keeps the ``MAX_NODES`` nodes that most pages have; what is dropped is no constant.
It goes back to the pages by a join on host, which Spark broadcasts only if the written table's size allows. Skeletons end
at ``MAX_DEPTH``, where the text below counts for its ancestor; pages of any depth are read whole, without recursion.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.cluster import shared_path

#: Groups in which the templates of one host meet first.
SALTS = 16
#: Share of the weight that a child must hold to be the content rather than its parent.
MAIN_SHARE = 0.6
#: Weights of bare text in a container, of a child with a heading, of a declared article, and of a declared aside.
BARE, HEADED, DECLARED, BESIDE = 0.25, 8, 8, 1 / 16
#: Nodes of a template, levels of a skeleton, and containers kept apart below one parent.
MAX_NODES, MAX_DEPTH, MAX_APART = 300, 64, 48
#: Equal containers in a row that count as records of a list.
RECORDS = 8

#: HTML's elements by their role.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul br caption option".split()
)
_ENDS_P = _BLOCK - frozenset("br body html td th tr tbody thead tfoot caption legend option title".split())
_SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "tbody": "tbody thead tr td th", "tfoot": "tbody thead tr td th"}
_SIBLINGS = {k: frozenset(v.split()) for k, v in _SIBLINGS.items()}
_SCOPES = frozenset("table ul ol dl select article section div body html main".split())
_ASIDE = frozenset("head nav footer aside form script style noscript template iframe svg canvas object embed button select option textarea input menu dialog noembed noframes xmp".split())
_ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup share sharing social "
    "related recommended recommendations comment comments reply replies disqus widget toolbar pagination pager login disclaimer alert".split()
)
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_MAIN = frozenset(("article", "main"))
_CONTAINERS = frozenset("address article aside body center details dialog dir div fieldset footer form header hgroup html legend main menu nav section".split())
_SLOTS = _CONTAINERS - frozenset(("header", "hgroup", "legend"))
_HEADINGS = frozenset(("h1", "h2"))
_PROSE = frozenset("h1 h2 h3 p".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<more>(?:\"[^\"]*\"|'[^']*'|[^>\"']++)*+)(?:>|\Z)|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


class Node:
    """An element: its label for alignment, children, own texts as (block, place, text), and whether it declares to be aside."""

    __slots__ = ("aside", "kids", "label", "tag", "texts", "view")

    def __init__(self, tag: str, label: str, aside: bool) -> None:
        self.tag, self.label, self.aside, self.kids, self.texts, self.view = tag, label, aside, [], [], None


@lru_cache(maxsize=20_000)
def _described(tag: str, more: str) -> tuple[str, bool]:
    """Label and whether the element is aside, from its tag and attributes."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(more)} if more else {}
    names = re.findall("[a-z]+", f"{found.get('class', '')} {found.get('id', '')}")
    aside = tag in _ASIDE
    if tag not in ("html", "body", "article", "main"):
        aside = aside or bool(_ASIDE_NAMES & set(names)) or found.get("role") in _ASIDE_ROLES or "hidden" in found
        aside = aside or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    if found.get("role") == "main":
        tag = "main"
    return ".".join((tag, *names)), aside


def parse(page: str | None) -> Node:
    """The DOM of a page, lenient as browsers are about missing end tags."""
    top = Node("", "", False)
    stack, block, at, page = [top], 0, 0, page or ""
    opened: Counter[str] = Counter()  # elements on the stack, so that none is searched in vain

    def close(i: int) -> None:
        opened.subtract(n.tag for n in stack[i:])
        del stack[i:]

    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        if (text := m["text"] or m["data"]) is not None:
            stack[-1].texts.append((block, at, html.unescape(text)))
            continue
        if not (tag := m["tag"]):
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            block += 1
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        ends = _SIBLINGS.get(tag)
        if (tag in _ENDS_P and opened["p"]) or (ends and any(opened[e] for e in ends)):
            for i in range(len(stack) - 1, 0, -1):
                name = stack[i].tag
                if (ends and name in ends) or (name == "p" and tag in _ENDS_P):
                    close(i)
                elif name in _SCOPES:
                    break
        label, aside = _described(tag, m["more"])
        node = Node(tag, label, aside)
        stack[-1].kids.append(node)
        if tag in _RAW:
            ending = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = ending.start() if ending else len(page)
        if tag not in _VOID and not m["more"].endswith("/"):
            stack.append(node)
            opened[tag] += 1
    return top


def squeeze(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


# ---------- skeletons and templates: [label, aside, pages, text, mass, kids], on a page also its elements ----------
# text: checksum of the node's own text, 0 if it has none, -1 if it varies; mass: characters of it outside links, on all pages

LABEL, ASIDE, PAGES, TEXT, MASS, KIDS, NODES = range(7)


def view(node: Node) -> tuple[str, int, list[Node]]:
    """Own text with that of inline elements, its characters outside links, and the block elements and asides below."""
    if node.view is None:
        parts, kids, linked = list(node.texts), [], 0
        todo = [(k, node.tag == "a") for k in reversed(node.kids)]
        while todo:
            kid, link = todo.pop()
            if kid.aside or kid.tag in _BLOCK:
                if kid.tag not in _VOID:
                    kids.append(kid)
                continue
            link = link or kid.tag == "a"
            parts += kid.texts
            linked += sum(len(t) for *_, t in kid.texts) if link else 0
            todo += [(k, link) for k in reversed(kid.kids)]
        own = squeeze([t for *_, t in sorted(parts)]) if parts else ""
        node.view = own, max(0, len(own) - linked), kids
    return node.view


def _tag(t: list) -> str:
    return t[LABEL].split(".", 1)[0]


def _grouped(nodes: list[Node]) -> list[list[Node]]:
    """The children of some siblings, those that repeat each other as one group.

    Text elements meet by label. Containers stay apart unless RECORDS or more in a row have the same label and the same
    labels below them; beyond MAX_APART groups, equal ones meet wherever they stand.
    """
    rows: list[tuple[object, list[Node]]] = []
    for kid in (k for n in nodes for k in view(n)[2]):
        below = frozenset(k.label for k in view(kid)[2]) if kid.tag in _CONTAINERS else None
        key = (kid.label, kid.aside, below)
        if rows and rows[-1][0] == key:
            rows[-1][1].append(kid)
        else:
            rows.append((key, [kid]))
    groups: list[list[Node]] = []
    known: dict[object, list[Node]] = {}
    for key, row in rows:
        if key[2] is not None and len(groups) < MAX_APART:
            groups += [row] if len(row) >= RECORDS else [[n] for n in row]
        elif key in known:
            known[key] += row
        else:
            known[key] = row
            groups.append(row)
    return groups


def skeleton(nodes: list[Node], depth: int = 0) -> list:
    """The skeleton of siblings that count as one node."""
    first, views = nodes[0], [view(n) for n in nodes]
    own = "\n".join(v[0] for v in views)
    mass, kids = sum(v[1] for v in views), []
    if depth < MAX_DEPTH:
        kids = [skeleton(g, depth + 1) for g in _grouped(nodes)]
    else:
        todo = [k for v in views for k in v[2]]
        while todo:
            text, n, more = view(todo.pop())
            own, mass = own + text, mass + n
            todo += more
    text = (zlib.crc32(own.encode("utf-8", "surrogatepass")) or 1) if own.strip() else 0
    return [first.label, first.aside, 1, text, mass, kids, nodes]


def _stored(t: list) -> list:
    """Without the elements of a page."""
    return [*t[:KIDS], [_stored(k) for k in t[KIDS]]]


def face(top: Node) -> str:
    """What copies of a page share: its title, and the longest heading or paragraph that declares no aside."""
    title, best, any_text, todo = "", "", "", [top]
    while todo:
        node = todo.pop()
        text, _, kids = view(node)
        if node.tag in _PROSE:
            best = max(best, text, key=lambda t: (len(t), t))
        any_text = max(any_text, text, key=lambda t: (len(t), t))
        title = title or (text if node.tag == "title" else "")
        todo += [k for k in kids if not k.aside or k.tag == "head"]
    return f"{title}\n{best or any_text}"


def _match(a: list, b: list) -> int:
    """Nodes in the largest match of two trees."""
    return 0 if a[LABEL] != b[LABEL] else 1 + _table(a[KIDS], b[KIDS])[-1][-1]


def _table(left: list, right: list) -> list[list[int]]:
    rows = [[0] * (len(right) + 1)]
    for a in left:
        row, above = [0], rows[-1]
        for j, b in enumerate(right):
            best = max(row[j], above[j + 1])
            if a[LABEL] == b[LABEL]:
                best = max(best, above[j] + _match(a, b))
            row.append(best)
        rows.append(row)
    return rows


def align(left: list, right: list) -> list[tuple[int, int]]:
    """Pairs (index in ``left`` or -1, index in ``right`` or -1) of children, in order."""
    if len(left) == len(right) and all(a[LABEL] == b[LABEL] for a, b in zip(left, right, strict=True)):
        return [(i, i) for i in range(len(left))]
    rows, i, j, pairs = _table(left, right), len(left), len(right), []
    while i or j:
        if i and rows[i][j] == rows[i - 1][j]:
            i -= 1
            pairs.append((i, -1))
        elif j and rows[i][j] == rows[i][j - 1]:
            j -= 1
            pairs.append((-1, j))
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def merge(a: list, b: list) -> list:
    """The template of two trees with equal labels."""
    kids = [a[KIDS][i] if j < 0 else b[KIDS][j] if i < 0 else merge(a[KIDS][i], b[KIDS][j]) for i, j in align(a[KIDS], b[KIDS])]
    return [a[LABEL], a[ASIDE] or b[ASIDE], a[PAGES] + b[PAGES], a[TEXT] if a[TEXT] == b[TEXT] else -1, a[MASS] + b[MASS], kids]


def prune(t: list, most: int = MAX_NODES) -> list:
    """The template's ``most`` nodes that most pages have, those with more text below first. Ancestors outlast their children."""
    ranked: list[tuple[int, int, int]] = []

    def rank(n: list) -> int:
        place = len(ranked)
        ranked.append((0, 0, 0))
        below = n[MASS] + sum(map(rank, n[KIDS]))
        ranked[place] = (-n[PAGES], -below, place)
        return below

    rank(t)
    if len(ranked) <= most:
        return t
    kept, at = {place for *_, place in sorted(ranked)[:most]}, iter(range(len(ranked)))

    def cut(n: list) -> list | None:
        stays = next(at) in kept
        kids = [k for k in map(cut, n[KIDS]) if k is not None]
        return [*n[:KIDS], kids] if stays else None

    return cut(t)


# ---------- extraction ----------


def _weigh(t: list, alone: bool, prose: bool) -> tuple[float, float, bool]:
    """Characters of varying text, the same by its weight in a choice, and whether a varying heading is inside."""
    tag = _tag(t)
    prose = prose or tag not in _CONTAINERS
    own = t[MASS] * (1 if prose else BARE) if alone or t[TEXT] == -1 else 0.0
    mass, headed = own, tag in _HEADINGS and own > 0
    for k in t[KIDS]:
        m, _, h = _weigh(k, alone, prose)
        mass, headed = mass + m, headed or h
    if t[ASIDE]:
        mass, headed = mass * BESIDE, False
    return mass, mass * (HEADED if headed else 1) * (DECLARED if tag in _MAIN else 1), headed


def content_path(t: list) -> list[int]:
    """Child numbers from the top to the content slot."""
    alone, path = t[PAGES] < 2, []
    while True:
        got = [_weigh(k, alone, False) for k in t[KIDS]]
        inner = [i for i, k in enumerate(t[KIDS]) if _tag(k) in _SLOTS and got[i][0] > 0]
        if not inner:
            return path
        best = max(inner, key=lambda i: got[i][1])
        loose = _weigh([*t[:KIDS], []], alone, False)[0] + sum(g[0] for i, g in enumerate(got) if i not in inner)
        others = sum(got[i][1] for i in inner if i != best)
        heads = [i for i, g in enumerate(got) if g[2] and not (i in inner and i != best)]
        if heads and best not in heads:
            return path
        if got[best][1] < MAIN_SHARE * (got[best][1] + others + loose):
            return path
        path.append(best)
        t = t[KIDS][best]


@lru_cache(maxsize=512)
def _wrapper(template: str) -> tuple[list, list[int]]:
    t = json.loads(template)
    return t, content_path(t)


def _slot(own: list, template: list, path: list[int]) -> tuple[list, list] | None:
    """The content slot of a page and of its template, None if the page has no such node."""
    for step in path:
        partner = dict((j, i) for i, j in align(own[KIDS], template[KIDS]) if i >= 0 <= j).get(step)
        if partner is None:
            return None
        own, template = own[KIDS][partner], template[KIDS][step]
    return own, template


def _constants(own: list, template: list, pages: int) -> list[Node]:
    """Elements of the page that say the same on all pages which have them, if most pages do."""
    out = []
    for i, j in align(own[KIDS], template[KIDS]):
        if i >= 0 <= j:
            a, b = own[KIDS][i], template[KIDS][j]
            if b[TEXT] > 0 and b[PAGES] >= 2 and b[PAGES] * 2 >= pages and not b[KIDS] and _tag(b) not in _PROSE:
                out += a[NODES]
            else:
                out += _constants(a, b, pages)
    return out


def _headed(node: Node) -> bool:
    todo = list(node.kids)
    while todo:
        n = todo.pop()
        if n.tag in _HEADINGS:
            return True
        todo += n.kids
    return False


def extract(page: str | None, template: str | None) -> str:
    """The main text: blocks in page order, one on each line. Without template the page is its own."""
    own = skeleton([parse(page)])
    known, path = _wrapper(template) if template else (own, content_path(own))
    found = _slot(own, known, path) or _slot(own, own, content_path(own))
    slot, of_host = found
    varies = of_host[PAGES] >= 2 and _weigh(of_host, False, False)[0] > 0
    gone = {id(n) for n in _constants(slot, of_host, of_host[PAGES])} if varies else set()
    kept: dict[int, list[tuple[int, str]]] = {}
    todo = [(n, True) for n in slot[NODES]]
    while todo:
        node, top = todo.pop()
        if not top:
            if id(node) in gone:
                continue
            if node.tag == "header" or ".header" in node.label:
                if not _headed(node):
                    continue
            elif node.aside:
                continue
        for block, place, text in node.texts:
            kept.setdefault(block, []).append((place, text))
        todo += [(k, False) for k in node.kids]
    return "\n".join(b for _, parts in sorted(kept.items()) if (b := squeeze([text for _, text in sorted(parts)])))


# ---------- Spark ----------


def _by_host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold rows (host, template) sorted by host: a host's template leaves when the next host begins."""

    def out(host: str, tree: list) -> pa.RecordBatch:
        made = json.dumps(tree, separators=(",", ":"))
        return pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([made], pa.string())], ["host", "template"])

    host, tree = None, None
    for b in batches:
        for h, t in zip(b.column(0), b.column(1), strict=True):
            if (name := h.as_py()) == host:
                tree = prune(merge(tree, json.loads(t.as_py())))
                continue
            if host is not None:
                yield out(host, tree)
            host, tree = name, prune(json.loads(t.as_py()))
    if host is not None:
        yield out(host, tree)


def host_of(url_col: str = "url"):  # noqa: ANN201
    """Host of a url: after the first ``://`` up to a slash, question mark, hash or the end; null and others: empty."""
    host = F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, template) of all pages. Pages of a host that are copies of each other (see ``face``) count once."""

    def skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tops = [parse(p.as_py()) for p in b.column(1)]
            marks = [face(t).encode("utf-8", "replace") for t in tops]
            made = [json.dumps(prune(_stored(skeleton([t]))), separators=(",", ":")) for t in tops]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks, pa.binary()), pa.array(made, pa.string())], ["host", "mark", "template"])

    form = "host string, template string"
    made = pages.select(host_of(url_col).alias("host"), F.col(html_col)).mapInArrow(skeletons, "host string, mark binary, template string")
    level = made.groupBy("host", F.xxhash64("mark").alias("_mark")).agg(F.min("template").alias("template"))
    level = level.select("host", "template").sortWithinPartitions("host", "template").mapInArrow(_by_host, form)
    salted = level.withColumn("_salt", F.pmod(F.xxhash64("template"), F.lit(SALTS)))
    level = salted.repartition("host", "_salt").sortWithinPartitions("host", "_salt", "template").select("host", "template").mapInArrow(_by_host, form)
    return level.repartition("host").sortWithinPartitions("host", "template").mapInArrow(_by_host, form)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text (empty if none), n_chars.

    Null pages count as empty. Pages without host share one template. Repeated rows stay; other columns are not read. Elements
    may be nested to any depth, and left open.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "templates")
    templates(pages, url_col, html_col).write.parquet(path)
    known = spark.read.parquet(path)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [extract(p.as_py(), t.as_py()) for p, t in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.string()), pa.array(list(map(len, made)), pa.int64())], ["_id", "_url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"), host_of(url_col).alias("host"))
    joined = rows.join(known, "host", "left").select("_id", "_url", "_html", "template")
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, _url string, text string, n_chars bigint"
    return joined.mapInArrow(of, schema).withColumnsRenamed({"_id": id_col, "_url": url_col})
