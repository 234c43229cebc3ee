"""Main text of web pages by wrappers inferred for each host.

A page is a token stream of tags and text. The wrapper of a host is a regular expression without alternatives over such
tokens: nested elements, repeated groups, optional groups and text slots. It is inferred iteratively: the first page is
the first wrapper; each next one is aligned with it, level by level. A run of one element that differs in length becomes a
repeated group, an element of one side only becomes optional, and a text that differs becomes a slot; a text that never differs
is part of the template. Alignment of wrappers is the same operation, so each
task infers one wrapper a host from its own pages, and the small wrappers are aligned again in a tree of joins by host:
no task ever holds a host's pages, however hot it is. On hosts that have pages without article
mark, Spark also counts every text by its place over all pages.

Extraction aligns a page with its host's wrapper and takes the texts of slots that vary. They are read within the article: where
the host's pages mark one, there, else in the innermost container that holds most of what varies over the host's pages.
Template (texts that never vary, and texts that a share of the host's different pages repeat word for word), link lists outside a
marked article, and elements whose names or classes say menu, header, footer, side bar, notice, advert, form or comment are left out.

Defined cases: null html is empty and has empty text. Null or odd urls share the host ''. Elements left open are
closed as a browser would close them; a tag cut off by the end of the page is dropped. Pages of any length are read whole. Equal
pages count as one, so copies make nothing template; a page that would be all template keeps its text. Repeated rows get equal
texts. Extra columns stay, whatever their names; the result column's is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import any_names, checkpointed, fresh, lower_ascii

#: Text that so many different pages of a host, and such a share of them, repeat word for word at one place of its wrapper
#: belongs to the template.
MIN_PAGES, PAGE_SHARE = 3, 0.1
#: Share of a block's characters in links from which it counts as a link list, outside a marked article.
LINK_SHARE = 0.6
#: Wrappers aligned by one task at a time.
FAN_IN = 64
#: Wrappers of so many bytes in all go out as a broadcast; more are joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: A container with this share of its parent's varying text is where the main text of unmarked pages is looked for.
DOMINANT = 0.7
#: Elements nested deeper add their children, in order, to the one at this depth: no text is lost, and none moves.
MAX_DEPTH = 120

#: Element names by their role in HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head script style noscript template iframe object svg canvas nav footer aside form button select option textarea input dialog menu audio video map math noframes noembed xmp title".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = frozenset("table td th ul ol dl div section article main body html aside nav header footer form select blockquote".split())
#: Words of class and id that name what is left out, and what is the article.
LEFT_OUT = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs sidebar side aside widget widgets header masthead topbar footer foot copyright cookie cookies consent gdpr notice notices alert popup modal overlay comment comments reply replies respond disqus discussion share sharing social related recommended newsletter subscribe subscription signup login search form toolbar pagination pager skip".split())
ARTICLE = frozenset("article post entry story content main body text".split())
#: Of LEFT_OUT, what may be marked up as an article and is none.
TALK = frozenset("comment comments reply replies respond related recommended".split())
#: First words of names that tell a state of an element (no-sidebar, with-header), and last words that only say part.
STATES = frozenset("no not non has have with without is hide show".split())
PARTS = frozenset("area bar box item items link links list panel slot unit".split())
#: Elements that hold the page or its article, whatever their classes say.
KEPT = frozenset("html body main".split())
#: Elements that hold blocks, as against those that are one.
CONTAINERS = frozenset("html body main article section div table tbody tr td center".split())
NOT_WORD = re.compile(r"[^a-z0-9]+")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)", re.S)
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)")
NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    """An element: its tag, its words of class, id and role, and its children; text blocks are nodes of tag ''."""

    __slots__ = ("tag", "words", "children", "text", "links")

    def __init__(self, tag: str, words: frozenset = frozenset(), text: str = "", links: int = 0) -> None:
        self.tag, self.words, self.children, self.text, self.links = tag, words, [], text, links

    @property
    def label(self) -> str:
        return self.tag + ("." + ".".join(sorted(self.words)) if self.words else "")


def names_left_out(value: str) -> frozenset:
    """The words of LEFT_OUT that these names say: whole names, or the last word of a compound that tells no state."""
    found = set()
    for name in value.split():
        words = [w for w in NOT_WORD.split(name.split("--")[0]) if w and not w.isdigit()]
        while len(words) > 1 and words[-1] in PARTS:
            words.pop()
        if words and words[-1] in LEFT_OUT and (len(words) == 1 or words[0] not in STATES):
            found.add(words[-1])
    return frozenset(found)


def words_of(attributes: str) -> frozenset:
    """The words of class, id and role; ``!out`` if they name what is left out, ``!talk`` if that is no article either."""
    found = set()
    for name, *values in NAMES.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "hidden" or (name.lower() == "aria-hidden" and value == "true"):
            found.add("hidden")
        elif name.lower() != "aria-hidden":
            words = (w for w in NOT_WORD.split(value) if w.isalpha())  # names with numbers tell one element, not a slot
            found.update(w for w in words if name.lower() != "id" or w in ARTICLE)  # other ids name one element, not a slot
            if out := names_left_out(value):
                found.add("!out")
                found.update({"!talk"} if out & TALK else ())
    return frozenset(found)


def parse(page: str) -> Node:
    """The page as a tree of block elements; inline elements only join their text."""
    root = Node("html")
    stack, pieces, links, in_link = [root], [], 0, 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal links
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                stack[-1].children.append(Node("", text=text, links=min(links, len(text))))
            pieces.clear()
        links = 0

    def close(names, scopes=SCOPES) -> None:
        """Closes the innermost open element of these names and all within it, but none beyond a scope."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return
            if stack[k].tag in scopes:
                return

    while at < n:
        start = page.find("<", at)
        if start < 0:
            start = n
        if start > at:
            pieces.append(page[at:start])
            if in_link:
                links += start - at
        if start == n:
            break
        m = TOKEN.match(page, start) or LOOSE_TAG.match(page, start)
        if m is None:
            pieces.append("<")
            at = start + 1
            continue
        at = m.end()
        if m.group(2) is None:
            continue
        tag, closing = m.group(2).lower(), m.group(1) == "/"
        if m.group(4) != ">":
            break  # cut off by the end of the page
        if tag == "br":
            pieces.append(" ")
            continue
        words = frozenset() if closing or not m.group(3).strip() else words_of(m.group(3))
        if tag in INLINE and not closing and "!out" not in words and "hidden" not in words:
            in_link += tag == "a"
            continue
        if tag in INLINE and closing and not any(x.tag == tag for x in stack[1:]):
            in_link = max(0, in_link - (tag == "a"))
            continue
        flush()
        if closing:
            close({tag}, frozenset() if tag in SCOPES else SCOPES)
            continue
        if tag in CLOSED_BY:
            close(CLOSED_BY[tag], frozenset("table ul ol dl".split()))
        elif tag not in INLINE:
            close({"p", "h1", "h2", "h3", "h4", "h5", "h6"} if tag in {"h1", "h2", "h3", "h4", "h5", "h6"} else {"p"})
            in_link = 0
        node = Node(tag, words)
        if len(stack) > MAX_DEPTH and tag not in RAW and not left_out(node.label):
            stack.append(stack[-1])
            continue
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID:
            stack.append(node)
    flush()
    return root


def hashed(path: bytes, value: str) -> bytes:
    """Names a label or a text below a path of labels."""
    return blake2b(path + value.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def key_of(path: bytes, text: str) -> int:
    return int.from_bytes(hashed(path, text), "little", signed=True)


def texts_outside(root: Node) -> Iterator[tuple[Node, bytes]]:
    """The text blocks of a page without article mark, in page order, each with the path of labels above it."""
    todo = [(root, b"")]
    while todo:
        x, path = todo.pop()
        if not x.tag:
            yield x, path
        elif x is root or not (left_out(x.label) or x.tag == "header"):
            below = hashed(path, x.label)
            todo.extend((c, below) for c in reversed(x.children))


# A wrapper is [label, optional, repeated, children, text, pages, chars]. Text slots have the label '': text is the hash of a text
# that never varies, else null; pages are the smallest hashes of the pages that have it, MIN_PAGES at most (of the root: of all
# pages), and chars the characters outside links over all pages.


def few(pages: list) -> list:
    return sorted({*pages})[:MIN_PAGES]


def wrapper_of(node: Node, page: int = 0) -> list:
    """A page's own wrapper: each element once; page: its hash."""
    if not node.tag:
        return ["", False, False, [], key_of(b"", node.text), [page], len(node.text) - node.links if node.links <= LINK_SHARE * len(node.text) else 0]
    return [node.label, False, False, [wrapper_of(c, page) for c in node.children], None, [], 0]


def page_wrapper(root: Node, page: str) -> list:
    own = key_of(b"", page)
    out = wrapper_of(root, own)
    out[5] = [own]
    return out


def aligned(a: list, b: list) -> list:
    """The wrapper of what either fits."""
    same = a[4] if a[4] == b[4] else None
    return [a[0], a[1] or b[1], a[2] or b[2], joined(a[3], b[3]), same, few(a[5] + b[5]) if a[5] or b[5] else [], a[6] + b[6]]


def group(parts: list) -> list:
    """One repeated group of what any of the parts fits."""
    out = parts[0]
    for c in parts[1:]:
        out = aligned(out, c)
    return [out[0], out[1], True, *out[3:]]


def runs(labels: list) -> list[tuple[int, int]]:
    """Bounds of the runs of equal labels."""
    cuts = [k for k in range(1, len(labels)) if labels[k] != labels[k - 1]]
    return [*zip([0, *cuts], [*cuts, len(labels)])] if labels else []


def paired(left: list, right: list) -> Iterator[tuple[int | None, int | None]]:
    """An alignment of two lists in order: pairs of places, null where one side has no partner.

    The k-th occurrences of equal labels are partners; of these pairs a longest series that rises on both sides stays. The
    cost is n log n, whatever the lists.
    """
    place, seen = {}, Counter()
    for j, x in enumerate(right):
        place[x, seen[x]] = j
        seen[x] += 1
    seen.clear()
    ends, last, before = [], [], {}
    for i, x in enumerate(left):
        j = place.get((x, seen[x]))
        seen[x] += 1
        if j is not None:
            k = bisect_left(ends, j)
            ends[k:k + 1], last[k:k + 1] = [j], [(i, j)]
            before[i, j] = last[k - 1] if k else None
    chosen, at = [], last[-1] if last else None
    while at:
        chosen.append(at)
        at = before[at]
    i = j = 0
    for x, y in [*reversed(chosen), (len(left), len(right))]:
        yield from ((k, None) for k in range(i, x))
        yield from ((None, k) for k in range(j, y))
        if x < len(left):
            yield x, y
        i, j = x + 1, y + 1


def in_units(labels: list, repeated: set) -> list[tuple[int, int]]:
    """Bounds of the units that are aligned: runs of labels that repeat in groups, single elements of others."""
    return [u for s, e in runs(labels) for u in ([(s, e)] if labels[s] in repeated else [(k, k + 1) for k in range(s, e)])]


def by_runs(left: list, right: list) -> list[tuple[tuple[int, int], tuple[int, int]]] | None:
    """The runs of both lists side by side, if they are of the same labels in the same order."""
    one, two = runs(left), runs(right)
    return [*zip(one, two)] if [left[s] for s, _ in one] == [right[s] for s, _ in two] else None


def joined(a: list, b: list) -> list:
    """Aligned children: runs of equal length one by one, runs that differ in length as repeated groups, the rest optional."""
    if [c[0] for c in a] == [c[0] for c in b] and not any(c[2] for c in a) and not any(c[2] for c in b):
        return [aligned(x, y) for x, y in zip(a, b)]
    repeated = {c[0] for c in (*a, *b) if c[2]}
    a, b = ([group(side[s:e]) if side[s][0] in repeated else side[s] for s, e in in_units([c[0] for c in side], repeated)] for side in (a, b))
    left, right = [c[0] for c in a], [c[0] for c in b]
    out: list = []
    if (pairs := by_runs(left, right)) is not None:
        for (s, e), (x, y) in pairs:
            out += [aligned(p, q) for p, q in zip(a[s:e], b[x:y])] if e - s == y - x else [group(a[s:e] + b[x:y])]
        return out
    alone = []
    for i, j in paired(left, right):
        alone.append(i is None or j is None)
        if alone[-1]:
            c = a[i] if j is None else b[j]
            out.append([c[0], True, *c[2:]])
        else:
            out.append(aligned(a[i], b[j]))
    # An element without partner beside others of its label: that run differs in length.
    return folded([x for s, e in runs([c[0] for c in out]) for x in ([group(out[s:e])] if e - s > 1 and any(alone[s:e]) else out[s:e])])


def folded(children: list) -> list:
    """Series of two or three labels that repeat, where pages differ in their number, as repeated groups."""
    out: list = []
    for child in children:
        out.append(child)
        for period in (2, 3):
            if len(out) >= 2 * period and all(out[-k][0] == out[-k - period][0] for k in range(1, period + 1)) and any(c[1] for c in out[-period:]):
                out[-2 * period :] = [group([out[-2 * period + k], out[-period + k]]) for k in range(period)]
                break
    return out


def left_out(label: str) -> bool:
    tag, *words = label.split(".")
    return tag in DROPPED or (tag not in KEPT and ("hidden" in words or ("!talk" if tag == "article" else "!out") in words))


class Slot:
    """A wrapper element made ready for reading pages: its slots in order, what in them is template, and where the main text is."""

    __slots__ = ("label", "slots", "labels", "repeated", "template", "varies", "mass", "texts", "pages", "main", "region")

    def __init__(self, wrapper: list) -> None:
        self.label, _, self.repeated, children, text, self.pages, chars = wrapper
        self.slots = [Slot(c) for c in children]
        self.labels = [c.label for c in self.slots]
        self.main = self.region = False
        if self.label == "":
            self.template = text is not None and len(self.pages) >= MIN_PAGES
            self.varies, self.mass, self.texts = text is None, 0 if self.template else chars, 1 + self.repeated
            return
        self.template = False
        read = [c for c in self.slots if not (left_out(c.label) or c.label.split(".")[0] == "header")]
        self.varies, self.mass = any(c.varies for c in read), sum(c.mass for c in read)
        self.texts = sum(c.texts for c in read) * (1 + self.repeated)

    def matched(self, nodes: list[Node]) -> list[Slot | None]:
        """The slot of each of a page's children: aligned as wrappers are, extra repeats with the group of their label."""
        labels = [x.label for x in nodes]
        if labels == self.labels:
            return self.slots
        groups = {c.label: c for c in self.slots if c.repeated}
        units = in_units(labels, {*groups})
        theirs = [labels[s] for s, _ in units]
        found: list[Slot | None] = [None] * len(units)
        if (pairs := by_runs(self.labels, theirs)) is not None:
            for (s, e), (a, b) in pairs:
                found[a:b] = [self.slots[min(e - 1, s + k)] for k in range(b - a)]
        else:
            for i, j in paired(self.labels, theirs):
                if i is not None and j is not None:
                    found[j] = self.slots[i]
        return [x or groups.get(label) for x, label, (s, e) in zip(found, theirs, units) for _ in range(s, e)]


def ready(wrapper: list) -> Slot:
    """The wrapper with its article marked: the outermost elements that say so, by name first, by role or class else.

    An article or main element counts within an element that is left out by its class, if there is none elsewhere. Of enough
    different pages, the region of the main text is marked too: down from the root, the container that holds most of what
    varies, as long as it holds more than one text.
    """
    root = Slot(wrapper)
    by_name = lambda tag, words: tag in {"article", "main"}
    for is_main in (lambda tag, words: tag == "article", lambda tag, words: tag == "main" or "main" in words, by_name, lambda tag, words: tag in {"div", "section", "td"} and not ARTICLE.isdisjoint(words)):
        found, todo = [], [root]
        while todo:
            x = todo.pop()
            tag, *words = x.label.split(".")
            within = is_main is by_name and tag not in DROPPED and not {"hidden", "!talk"} & {*words}
            if x is not root and (left_out(x.label) or tag == "header") and not within:
                continue
            if is_main(tag, words):
                found.append(x)
            else:
                todo.extend(x.slots)
        found = [x for x in found if x.texts]
        if found:
            for x in found:
                x.main = True
            break
    if len(root.pages) >= MIN_PAGES:
        x = root
        while inner := next((c for c in x.slots if c.mass >= DOMINANT * x.mass > 0 and c.label.split(".")[0] in CONTAINERS and not left_out(c.label) and not c.repeated and c.texts > 1), None):
            x = inner
        x.region = x is not root
    return root


def marked(root: Node, slots: Slot) -> list[str]:
    """The text blocks of the page's articles by these slots, without template if the article varies."""
    blocks: list[str] = []
    todo: list[tuple[Node, Slot | None]] = [(root, slots)]
    while todo:
        node, slot = todo.pop()
        if slot.main:
            found = list(_texts(node, slot))
            own = [x.text for x, of, _ in found if not (slot.varies and of is not None and of.template)]
            blocks += own or [x.text for x, _, _ in found]
        else:
            todo.extend((c, s) for c, s in reversed([*zip(node.children, slot.matched(node.children))]) if s is not None)
    return blocks


def _texts(node: Node, slot: Slot | None, outside: bool = False) -> Iterator[tuple[Node, Slot | None, bool]]:
    """(text block, its slot, whether it is in the region) below node, in page order; outside articles, headers are left out too."""
    todo = [(node, slot, False)]
    while todo:
        x, of, inside = todo.pop()
        inside = inside or (of is not None and of.region)
        if not x.tag:
            yield x, of, inside
        elif x is node or not (left_out(x.label) or (outside and x.tag == "header")):
            below = of.matched(x.children) if of is not None else [None] * len(x.children)
            todo.extend((c, s, inside) for c, s in reversed([*zip(x.children, below)]))


def extract(page: str, wrapper: Slot | None, templates: frozenset = frozenset()) -> str:
    """The page's main text, read along its host's wrapper, or along its own where the host's article is not in it.

    Without any article: what is in the region of the main text, no template (by its slot, or by templates: keys of such texts at
    their places) and no link list; if that is nothing, the page's own text without link lists.
    """
    root = parse(page)
    blocks = (marked(root, wrapper) if wrapper else []) or marked(root, ready(wrapper_of(root)))
    if not blocks:
        paths = [path for _, path in texts_outside(root)]
        own = [(x, of, inside, path) for (x, of, inside), path in zip(_texts(root, wrapper, True), paths) if x.links <= LINK_SHARE * len(x.text)]
        kept = [(x.text, inside) for x, of, inside, path in own if not (of is not None and of.template) and key_of(path, x.text) not in templates]
        blocks = [text for text, inside in kept if inside] or [text for text, _ in kept] or [x.text for x, *_ in own]
    return "\n\n".join(blocks)


def infer(pages: Iterable[str | None]) -> list | None:
    """The wrapper of these pages, aligned one by one."""
    wrapper = None
    for page in pages:
        own = page_wrapper(parse(page or ""), page or "")
        wrapper = own if wrapper is None else aligned(wrapper, own)
    return wrapper


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^[^:]*(?:://|:(?!//))?([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """One row a host: host, wrapper (JSON), templates (keys of its template texts). Every page takes part."""

    names = ["host", "wrapper", "plain"]
    schema = "host string, wrapper string, plain boolean"

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}
        plain: set[str] = set()
        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = text.as_py() or ""
                root = parse(page)
                own = page_wrapper(root, page)
                found[host] = aligned(found[host], own) if host in found else own
                if host not in plain and not marked(root, ready(own)):
                    plain.add(host)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([json.dumps(w) for w in found.values()], pa.string()), pa.array([h in plain for h in found], pa.bool_())], names=names)

    def join(rows: pa.Table) -> pa.Table:
        whole = None
        for w in map(json.loads, sorted(rows.column("wrapper").to_pylist())):
            whole = w if whole is None else aligned(whole, w)
        return pa.table([pa.array([rows.column("host")[0].as_py()], pa.string()), pa.array([json.dumps(whole)], pa.string()), pa.array([any(rows.column("plain").to_pylist())], pa.bool_())], names=names)

    rows = pages.select(host_of(pages[url]).alias("host"), pages[page].cast("string").alias("page"))
    found = checkpointed(rows.mapInArrow(by_task, schema))
    while (most := found.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        salt = F.pmod(F.xxhash64("wrapper"), F.lit(-(-most // FAN_IN))) if most > FAN_IN else F.lit(0).cast("bigint")
        found = checkpointed(found.groupBy("host", salt.alias("salt")).applyInArrow(join, schema))
    plain = found.where("plain").select("host")
    n, size = plain.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("host")), F.lit(0))).first()
    if not n:
        return found.select("host", "wrapper", F.array().cast("array<bigint>").alias("templates"))
    asked = rows.join(F.broadcast(plain) if size <= BROADCAST_BYTES else plain, "host", "left_semi")
    return checkpointed(found.join(template_texts(asked), "host", "left").select("host", "wrapper", F.coalesce("templates", F.array().cast("array<bigint>")).alias("templates")))


def template_texts(rows: DataFrame) -> DataFrame:
    """rows (host, page) -> host, templates: keys of the texts that enough pages of the host have in one slot.

    Only hosts that have pages without article mark need it. A text counts once a page, and equal pages count as one; all
    texts of all pages count.
    """
    names = ["host", "key", "page"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                hosts, keys, prints = [], [], []
                for host, text in zip(batch.column(0).slice(at, 256).to_pylist(), batch.column(1).slice(at, 256)):
                    page = text.as_py() or ""
                    found = [None, *{key_of(path, x.text) for x, path in texts_outside(parse(page))}]  # null: the page itself
                    hosts += [host] * len(found)
                    keys += found
                    prints += [key_of(b"", page)] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(prints, pa.int64())], names=names)

    counts = checkpointed(rows.mapInArrow(run, "host string, key bigint, page bigint").groupBy("host", "key").agg(F.count_distinct("page").alias("n")).where(F.col("key").isNull() | (F.col("n") >= MIN_PAGES)))
    whole = counts.where("key is null").select("host", F.col("n").alias("pages"))
    often = counts.where("key is not null").join(whole, "host").where(F.col("n") >= PAGE_SHARE * F.col("pages"))
    return often.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("templates"))


@any_names
def main_text(pages: DataFrame, url: str = "url", page: str = "html", text: str = "text", keep_page: bool = False, found: DataFrame | None = None) -> DataFrame:
    """pages with text (by default in place of the page); found: wrappers() of these or other pages of the hosts."""
    found = wrappers(pages, url, page) if found is None else found
    kept = [c for c in pages.columns if c != text and (keep_page or c != page)]
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple[Slot | None, frozenset]] = {}
        for batch in batches:
            texts = []
            for value, own_wrapper, own_templates in zip(*batch.columns[len(kept) :]):
                w = own_wrapper.as_py(), tuple(own_templates.as_py() or ())
                if w not in known:
                    known.clear() if len(known) > 1000 else None
                    known[w] = ready(json.loads(w[0])) if w[0] is not None else None, frozenset(w[1])
                texts.append(extract(value.as_py() or "", *known[w]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string())], names=[*kept, text])

    own, host, wrapper, templates, whole = fresh(pages, "_host", "_wrapper_host", "_wrapper", "_templates", "_page")
    small = found.select(F.col("host").alias(host), F.col("wrapper").alias(wrapper), F.col("templates").alias(templates))
    # Broadcast once measured small: pages then meet their wrappers where they are, and a hot host stays spread.
    size = found.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 8 * F.size("templates")), F.lit(0))).first()[0]
    rows = pages.withColumns({own: host_of(pages[url]), whole: pages[page].cast("string")}).join(F.broadcast(small) if size <= BROADCAST_BYTES else small, F.col(own) == F.col(host), "left")
    schema = ", ".join([f"`{c}` {types[c]}" for c in kept] + [f"`{text}` string"])
    return rows.select(*kept, whole, wrapper, templates).mapInArrow(run, schema)
