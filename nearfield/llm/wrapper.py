"""Main text of web pages by wrapper induction.

Pages of a host are grouped by layout, the labels near the root of their DOM trees. A few distinct pages of each
layout are aligned by simple tree matching into one template tree. Nodes whose text is the same on all of them
may be template, nodes with varying text are slots, and the slots of the main content give the layout's wrapper:
where the content lies, and which texts below it are constant. All pages of the layout are then counted: a text
counts as template only if most of them have it. Every page is aligned with its wrapper and read through it.

Tags, roles and names of class or id are signs, not verdicts: what holds the page's main article, or most of its
text, is never left out by them.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.llm.common import marked, skewed_join, texts_of
from nearfield.scratch import stored

#: Distinct pages of a layout that its wrapper is learned from, at most.
REFERENCES = 6
#: Parts of a layout in which references are ranked first, so that a large one isn't ranked in one task.
PARTS = 64
#: Of the pages of a layout, so many and this share at least have a text that is template.
SUPPORT, SUPPORT_SHARE = 3, 0.6
#: Levels of the tree that make a layout, and levels that are kept at all (deeper elements are flattened).
LAYOUT_DEPTH, DEPTH = 4, 200

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
ENDS_P = BLOCKS - frozenset("body br dd dt head html legend li optgroup option tbody td tfoot th thead title tr".split()) | {"li", "dd", "dt"}
SCOPES = frozenset("html table td th caption object template button body article".split())
CLOSES = {
    "li": ("li", frozenset("ul ol menu".split())),
    "dt": ("dt dd", frozenset(["dl"])),
    "dd": ("dt dd", frozenset(["dl"])),
    "tr": ("tr td th", frozenset("table tbody thead tfoot".split())),
    "td": ("td th", frozenset("tr table".split())),
    "th": ("td th", frozenset("tr table".split())),
    "tbody": ("tbody thead tfoot tr td th", frozenset(["table"])),
    "tfoot": ("tbody thead tfoot tr td th", frozenset(["table"])),
    "option": ("option", frozenset("select optgroup datalist".split())),
}
REPEATED = frozenset("p li dt dd tr td th option br h1 h2 h3 h4 h5 h6 a b i em strong span".split())
SINGLE = 8
# Parts of a page that are not its article, by tag, role, and word of class or id.
NOT_TEXT = frozenset(
    "script style noscript template head nav footer aside form button select textarea iframe svg object embed canvas "
    "dialog menu input".split()
)
NOT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NOT_NAMES = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs footer sidebar aside widget cookie cookies consent gdpr notice alert banner popup modal newsletter "
    "subscribe signup login comment comments disqus reply replies share sharing social related recommended teaser "
    "pagination pager copyright skip".split()
)
OUTSIDE_NAMES = frozenset("header masthead topbar toolbar search form".split())
# Words that say nothing of their own beside such a name, and words that deny it.
GENERIC = frozenset(
    "area article bar block body bottom box button buttons card center column container content el element entry fixed "
    "footer header holder icon icons inner item items js large left link links list main module outer overlay page panel "
    "post posts primary right row secondary section site slot small sticky text thread title top unit view wrap wrapper".split()
)
DENIED = frozenset("has no non not with without free less off hide hidden supports enabled disabled".split())
COMMENTS = frozenset("comment comments disqus reply replies".split())
#: Text that belongs to an article even if all pages share it.
KEPT = frozenset("h1 h2 h3 h4 h5 h6 blockquote q cite".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")


def names_of(tokens: list[str], names: frozenset) -> bool:
    """Whether class and id name such a part: more of their tokens do than say something else.

    A token does if it ends with such a name, or begins with one that only generic words follow; one that
    denies something (``has-sidebar``, ``no-comments``, ``banner-free``) says nothing.
    """
    yes = other = 0
    for token in tokens:
        words = _WORD.findall(token)
        if not words or DENIED & set(words):
            continue
        if words[-1] in names or words[0] in names and GENERIC.issuperset(words[1:]):
            yes += 1
        elif not GENERIC.issuperset(words):
            other += 1
    return yes > other


class Node:
    """An element: ``items`` are its texts and elements in page order, ``size`` the length of all text below it;
    ``kept`` if it holds the page's main article or most of its text."""

    __slots__ = ("tag", "label", "tokens", "role", "items", "size", "kept")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.items, self.tokens, self.role, style = tag, [], [], "", ""
        self.size, self.kept = 0, False
        if attributes and "=" in attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                value = "".join(values).lower()
                if name.lower() == "role":
                    self.role = value.strip()
                else:
                    self.tokens += value.split()
                    style = style or value.split(" ")[0]
        self.label = f"{tag}.{re.sub('[0-9]+', '0', style)}" if style else tag


def _measure(root: Node) -> None:
    """Sets sizes, and marks what holds the largest article or main element, or else most of the text."""
    order = [root]
    for node in order:
        order += [i for i in node.items if type(i) is Node]
    above = {id(i): node for node in order for i in node.items if type(i) is Node}
    for node in reversed(order):
        if node.tag not in RAW:
            node.size += sum(len(i.strip()) for i in node.items if type(i) is str)
            if id(node) in above:
                above[id(node)].size += node.size
    named = [n for n in order if n.tag in ("article", "main") and n.size]
    if named:
        largest = max(named, key=lambda n: n.size)  # of equal ones the outermost
        node = above.get(id(largest))
        while node is not None:
            # what a tag says of a whole part holds against a small article in it, say a teaser
            node.kept = node.tag not in NOT_TEXT and node.role not in NOT_ROLES or largest.size >= 0.25 * root.size
            node = above.get(id(node))
    for node in order:
        if node.size > 0.5 * root.size and node.tag not in NOT_TEXT and not names_of(node.tokens, COMMENTS):
            node.kept = True


def parse(page: str) -> Node:
    """The tree of a page; end tags that are missing or too many are handled as browsers do, roughly."""
    root = Node("#root")
    stack, over = [root], []  # over: open elements beyond DEPTH, whose text goes to the last one within
    at = 0

    def text(start: int, stop: int) -> None:
        if start < stop:
            stack[-1].items.append(page[start:stop])

    def close(tags: str, scopes: frozenset) -> None:
        wanted = tags.split()
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in wanted:
                del stack[depth:]
                return
            if stack[depth].tag in scopes:
                return

    while m := _TAG.search(page, at):
        text(at, m.start())
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1] and tag in over:
            while over.pop() != tag:
                pass
            continue
        if m[1]:
            over.clear()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in ENDS_P:
            close("p", SCOPES)
        if tag in CLOSES:
            close(*CLOSES[tag])
        node = Node(tag, m[3])
        stack[-1].items.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}[\\s/>]", re.IGNORECASE).search(page, at)
            stop = end.start() if end else len(page)
            if tag not in ("script", "style"):
                node.items.append(page[at:stop])
            at = page.find(">", stop) + 1 if end else stop
            at = at or len(page)
        elif tag not in VOID and not (m[3].endswith("/") and tag in ("svg", "path")):  # a slash ends no HTML element
            if len(stack) < DEPTH:
                stack.append(node)
            else:
                over.append(tag)
    text(at, len(page))
    _measure(root)
    return root


def layout_of(root: Node) -> int:
    """A hash of the labels of the page's first levels, without items of text and runs of one label."""
    seen: set[str] = set()
    level = [("", root)]
    for _ in range(LAYOUT_DEPTH):
        below = []
        for path, node in level:
            if node.tag not in NOT_TEXT and node.tag != "article":
                below += [(f"{path}/{i.label}", i) for i in node.items if type(i) is Node and i.tag not in REPEATED]
        seen.update(path for path, n in below if n.size and n.tag not in NOT_TEXT and not names_of(n.tokens, NOT_NAMES))
        level = below
    digest = hashlib.blake2b("\n".join(sorted(seen)).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _own_text(node: Node) -> str:
    return " ".join(entities.unescape("".join(i for i in node.items if type(i) is str)).split())


def _runs(node: Node) -> list[list[Node]]:
    """Child elements in runs: neighbours with one label, if they are items of text (REPEATED) or many
    (more than SINGLE), make one run, others one each."""
    runs: list[list[Node]] = []
    for item in node.items:
        if type(item) is Node:
            if runs and runs[-1][0].label == item.label:
                runs[-1].append(item)
            else:
                runs.append([item])
    out: list[list[Node]] = []
    for run in runs:
        if run[0].tag in REPEATED or len(run) > SINGLE:
            out.append(run)
        else:
            out += [[n] for n in run]
    return out


def is_template(node: Node, in_content: bool) -> bool:
    """Whether its tag, role, class or id says that it is not part of an article."""
    if node.kept and node.tag not in ("script", "style"):
        return False
    if node.tag in NOT_TEXT or node.role in NOT_ROLES:
        return True
    if node.tag in ("html", "body", "main"):
        return False
    if node.tag == "article":
        return names_of(node.tokens, frozenset({"comment", "comments", "teaser", "related", "ad"}))
    if names_of(node.tokens, NOT_NAMES):
        return True
    return not in_content and (node.tag == "header" or names_of(node.tokens, OUTSIDE_NAMES))


# ---- alignment


class Slot:
    """A node of the template tree: how many pages have it, the texts seen there, and its children."""

    __slots__ = ("label", "pages", "texts", "size", "children", "content", "dropped")

    def __init__(self, label: str):
        self.label, self.pages, self.texts, self.size, self.children = label, 0, set(), 0, []
        self.content = self.dropped = False


def matching(slot: Slot, node: Node, memo: dict) -> int:
    """Simple tree matching: the number of pairs of the largest order-keeping matching of the two trees."""
    key = (id(slot), id(node))
    if key not in memo:
        memo[key] = 1 + (_table(slot.children, _runs(node), memo)[-1][-1] if slot.children else 0)
    return memo[key]


def _table(slots: list[Slot], runs: list[list[Node]], memo: dict) -> list[list[int]]:
    table = [[0] * (len(runs) + 1)]
    for slot in slots:
        above, row = table[-1], [0]
        for k, run in enumerate(runs):
            best = max(above[k + 1], row[k])
            if slot.label == run[0].label:
                best = max(best, above[k] + matching(slot, run[0], memo))
            row.append(best)
        table.append(row)
    return table


def aligned(slots: list[Slot], runs: list[list[Node]], memo: dict) -> list[tuple[int | None, int | None]]:
    """Pairs of places in a largest matching, in order; None where one side has nothing."""
    table = _table(slots, runs, memo)
    i, k, pairs = len(slots), len(runs), []
    while i or k:
        if i and k and slots[i - 1].label == runs[k - 1][0].label:
            if table[i][k] == table[i - 1][k - 1] + matching(slots[i - 1], runs[k - 1][0], memo):
                i, k = i - 1, k - 1
                pairs.append((i, k))
                continue
        if k and (not i or table[i][k] == table[i][k - 1]):
            k -= 1
            pairs.append((None, k))
        else:
            i -= 1
            pairs.append((i, None))
    return pairs[::-1]


def merge(slot: Slot, nodes: list[Node]) -> None:
    """Adds one page's run of nodes to the template tree."""
    slot.pages += 1
    for node in nodes:
        own = _own_text(node)
        slot.texts.add(own)
        slot.size += len(own)
        slot.dropped = slot.dropped or is_template(node, True)
        runs, merged = _runs(node), []
        for i, k in aligned(slot.children, runs, {}):
            child = slot.children[i] if i is not None else Slot(runs[k][0].label)
            if k is not None:
                merge(child, runs[k])
            merged.append(child)
        slot.children = merged


def induce(pages: list[str]) -> str:
    """The wrapper of one host as JSON: nested [label, content, constant text or null, children]."""
    root = Slot("#root")
    for page in pages:
        merge(root, [parse(page)])

    def mark(slot: Slot) -> bool:
        """Marks the outermost article or main elements."""
        tag = slot.label.split(".")[0]
        if slot.dropped:
            return False
        if tag in ("article", "main"):
            slot.content = True
            return True
        return any([mark(c) for c in slot.children])

    def varying(slot: Slot) -> int:
        if slot.dropped:
            return 0
        own = slot.size if len(slot.texts) > 1 or slot.pages < 2 else 0
        return own + sum(map(varying, slot.children))

    if not mark(root):  # without such elements, the smallest part that has most of the varying text
        best, total = root, varying(root)
        while total:
            inner = [c for c in best.children if c.label.split(".")[0] not in REPEATED and varying(c) >= 0.8 * total]
            if not inner:
                break
            best = inner[0]
        best.content = True

    def told(slot: Slot, same: bool = False) -> list:
        same = same or slot.content and not varying(slot)  # all pages have one content, which tells nothing about it
        constant = slot.pages > 1 and len(slot.texts) == 1 and not same and slot.label.split(".")[0] not in KEPT
        return [slot.label, slot.content, next(iter(slot.texts)) if constant else None, [told(c, same) for c in slot.children]]

    return json.dumps(told(root), ensure_ascii=False, separators=(",", ":"))


def constants(told: str) -> list[str]:
    """Hashes of the label and text of what a wrapper takes for constant."""

    def walk(x: list) -> Iterator[str]:
        if x[2]:
            yield _sign(x[0], x[2])
        for c in x[3]:
            yield from walk(c)

    return sorted(set(walk(json.loads(told))))


def _sign(label: str, text: str) -> str:
    return hashlib.blake2b(f"{label}\n{text}".encode(), digest_size=12).hexdigest()


def signs_in(root: Node, wanted: set[str], labels: set[str]) -> set[str]:
    """Which of the wanted hashes the page has."""
    found, order = set(), [root]
    for node in order:
        order += [i for i in node.items if type(i) is Node]
        if node.label in labels and (own := _own_text(node)):
            found.add(_sign(node.label, own))
    return found & wanted


def wrapper_of(told: str, confirmed: set[str] | None = None) -> Slot:
    """The wrapper, with the constant texts whose hashes are ``confirmed`` (all, if None)."""

    def build(x: list) -> Slot:
        slot = Slot(x[0])
        slot.content = x[1]
        slot.texts = {x[2]} if x[2] and (confirmed is None or _sign(x[0], x[2]) in confirmed) else set()
        slot.children = [build(c) for c in x[3]]
        return slot

    return build(json.loads(told))


# ---- extraction


def _slots(node: Node, slot: Slot | None) -> dict[int, Slot]:
    """The slots that a node's child elements align with, by their id."""
    if slot is None or not slot.children:
        return {}
    runs = _runs(node)
    pairs = aligned(slot.children, runs, {})
    return {id(n): slot.children[i] for i, k in pairs if i is not None and k is not None for n in runs[k]}


def _collect(node: Node, slot: Slot | None, out: list[str]) -> None:
    """Appends the texts below a content node that its slot doesn't tell to be constant."""
    constant = slot is not None and slot.texts and _own_text(node) in slot.texts
    by_node = _slots(node, slot)
    for item in node.items:
        if type(item) is str:
            if not constant:
                out.append(entities.unescape(item) if "&" in item else item)
        elif not is_template(item, True):
            block = item.tag in BLOCKS
            if block:
                out.append(" ")
            _collect(item, by_node.get(id(item)), out)
            if block:
                out.append(" ")


def _contents(node: Node, slot: Slot) -> list[tuple[Node, Slot]]:
    """The page's nodes that align with the wrapper's content."""
    if slot.content:
        return [(node, slot)]
    found, runs = [], _runs(node)
    for i, k in aligned(slot.children, runs, {}):
        if i is not None and k is not None:
            for n in runs[k]:
                if not is_template(n, False):
                    found += _contents(n, slot.children[i])
    return found


def _named(node: Node, slot: Slot | None) -> list[tuple[Node, Slot | None]]:
    """The page's own outermost article or main elements, and what they align with."""
    if node.tag in ("article", "main"):
        return [(node, slot)]
    by_node = _slots(node, slot)
    return [x for n in node.items if type(n) is Node and not is_template(n, False) for x in _named(n, by_node.get(id(n)))]


def extract(page: str, wrapper: Slot | None) -> str:
    """The main text of one page: what lies in its own article or main elements, or else in the wrapper's
    content, without the texts that the wrapper tells to be constant; where neither is found, all that no
    tag, role or name excludes."""
    root = parse(page)
    contents = _contents(root, wrapper) if wrapper else []
    named = _named(root, wrapper)
    if named and not (contents and {id(n) for n, _ in contents} >= {id(n) for n, _ in named}):
        contents = named
    out: list[str] = []
    for node, slot in contents or [(root, None)]:
        _collect(node, slot, out)
        out.append(" ")
    return " ".join("".join(out).split())


# ---- over tables


def with_host(pages: DataFrame, name: str = "_host") -> DataFrame:
    """The host in lower case, without user and port; empty if there is none."""
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return pages.withColumn(name, F.lower(host))


def with_layout(pages: DataFrame, html: str, name: str = "_layout") -> DataFrame:
    """The layout of each page."""

    @F.pandas_udf("bigint")
    def layouts(column: pd.Series) -> pd.Series:
        return pd.Series([layout_of(parse(page)) for page in column], dtype="int64")

    return pages.withColumn(name, layouts(html))


_GROUP = ["_host", "_layout"]


def wrappers(pages: DataFrame, references: int = REFERENCES) -> DataFrame:
    """_host, _layout, _wrapper and _confirmed of each layout of a host.

    The wrapper is from at most ``references`` distinct pages (those of the smallest hashes); confirmed are
    the hashes of those of its constant texts that most of the layout's distinct pages have (SUPPORT,
    SUPPORT_SHARE), counted over all of them.
    """
    rows = with_host(pages).select("_host", F.coalesce("html", F.lit("")).alias("_html"))
    rows = with_layout(rows, "_html").withColumn("_hash", F.xxhash64("_html"))
    kinds = stored(rows.select(*_GROUP, "_hash").distinct(), "kinds")
    by_hash = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))
    # in parts of each layout first: the second ranking then has PARTS * references rows a layout at most
    few = kinds.withColumn("_part", F.pmod(F.xxhash64("_hash"), F.lit(PARTS)))
    few = few.withColumn("_n", by_hash(*_GROUP, "_part")).where(F.col("_n") <= references)
    few = few.withColumn("_n", by_hash(*_GROUP)).where(F.col("_n") <= references).select(*_GROUP, "_hash")
    few = stored(few, "references")
    hashed = with_host(pages).select("_host", F.coalesce("html", F.lit("")).alias("_html")).withColumn("_hash", F.xxhash64("_html"))
    maybe = marked(hashed, few, {"_host": "_host", "_hash": "_hash"}).where("_set").drop("_set")
    some = maybe.join(few, ["_host", "_hash"]).groupBy(*_GROUP, "_hash").agg(F.first("_html").alias("_html"))

    def learn(group: pa.Table) -> pa.Table:
        order = group.sort_by("_hash")
        told = induce(order.column("_html").to_pylist())
        signs = constants(told)
        labels = sorted(_labels(told))
        return pa.table({"_host": group.column("_host")[:1], "_layout": group.column("_layout")[:1], "_wrapper": [told], "_signs": [signs], "_labels": [labels]}, schema=shape)

    texts = pa.list_(pa.string())
    shape = pa.schema([("_host", pa.string()), ("_layout", pa.int64()), ("_wrapper", pa.string()), ("_signs", texts), ("_labels", texts)])
    learned = some.groupBy(*_GROUP).applyInArrow(learn, "_host string, _layout bigint, _wrapper string, _signs array<string>, _labels array<string>")
    learned = stored(learned, "learned")

    # how many of a layout's pages have each of its constants; layouts without any need no count
    asked = learned.where(F.size("_signs") > 0).select(*_GROUP, "_signs", "_labels")
    sizes = kinds.groupBy(*_GROUP).agg(F.count("*").alias("_pages")).where(F.col("_pages") >= SUPPORT)
    asked = stored(asked.join(sizes, _GROUP), "asked")
    within = skewed_join(hashed, asked.select("_host").distinct(), ["_host"], "left_semi")
    tried = skewed_join(with_layout(within, "_html"), asked, _GROUP).select(*_GROUP, "_hash", "_html", "_signs", "_labels")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, layout, hashes, page, signs, labels = (c.to_pylist() for c in batch.columns)
            found = [sorted(signs_in(parse(p), set(s), set(ls))) for p, s, ls in zip(page, signs, labels, strict=True)]
            at = [k for k, f in enumerate(found) for _ in f]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([host[k] for k in at], pa.string()),
                    pa.array([layout[k] for k in at], pa.int64()),
                    pa.array([hashes[k] for k in at], pa.int64()),
                    pa.array([sign for f in found for sign in f], pa.string()),
                ],
                names=["_host", "_layout", "_hash", "_sign"],
            )

    seen = tried.mapInArrow(count, "_host string, _layout bigint, _hash bigint, _sign string").distinct()
    shares = seen.groupBy(*_GROUP, "_sign").agg(F.count("*").alias("_n"))
    enough = (F.col("_n") >= SUPPORT) & (F.col("_n") >= SUPPORT_SHARE * F.col("_pages"))
    good = shares.join(sizes, _GROUP).where(enough).groupBy(*_GROUP).agg(F.collect_set("_sign").alias("_confirmed"))
    return learned.select(*_GROUP, "_wrapper").join(good, _GROUP, "left")


def _labels(told: str) -> set[str]:
    def walk(x: list) -> Iterator[str]:
        if x[2]:
            yield x[0]
        for c in x[3]:
            yield from walk(c)

    return set(walk(json.loads(told)))


def main_texts(pages: DataFrame, references: int = REFERENCES) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of page_id, url, html (null: empty).

    Empty, broken and repeated pages each give their row; pages without a host share the wrappers of no host.
    Copies of a page count once in what is learned.
    """
    rows = with_host(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")))
    # stored, so that Spark knows its size: few layouts are broadcast, else the pages are shuffled
    learned = stored(wrappers(pages, references), "wrappers")
    joined = skewed_join(with_layout(rows, "html"), learned, _GROUP, "left").drop(*_GROUP)
    fields = [
        *joined.schema.fields[:2],
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    columns = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, Slot] = {}
        for batch in batches:
            texts = []
            for page, told, confirmed in zip(texts_of(batch.column(2)), batch.column(3), batch.column(4), strict=True):
                key = told.as_py(), tuple(sorted(confirmed.as_py() or ()))
                if key[0] and key not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[key] = wrapper_of(key[0], set(key[1]))
                texts.append(extract(page.as_py(), known.get(key)))
            out = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(out, columns)

    return joined.select("page_id", "url", "html", "_wrapper", "_confirmed").mapInArrow(run, T.StructType(fields))
