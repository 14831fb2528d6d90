"""HTML text to a node array: the one Python step of the engine.

``shred_pages`` turns every page row into one row with a ``dom`` column, an array
of nodes in document order. A node knows its own position (``pre``) and that of
its last descendant (``last``), so the subtree of a node is a slice of the array
and everything after this step is built-in Spark expressions without a shuffle.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, fields
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the parser with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE = T.StructType([
    T.StructField("pre", T.IntegerType()),
    T.StructField("last", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("tag", T.StringType()),       # '#document', '#text', '#raw' or an element name
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()),      # readable text nodes only, whitespace collapsed
    T.StructField("raw", T.StringType()),       # text inside script, style, template, rt, rp
])
DOM = T.ArrayType(NODE)

# One output batch is cut when it holds this many nodes or this much HTML, so memory
# follows the page at hand and not the number of rows Spark put in the input batch.
NODES_PER_BATCH = 200_000
CHARS_PER_BATCH = 64_000_000

_MARKUP = re.compile(
    r"<(?:(?P<open>[a-zA-Z][^\s/>]*+)|/(?P<close>[a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|(?P<skip>!--.*?(?:-->|\Z)|[!?/][^>]*+>))", re.S)
_ATTR = re.compile(r"[\s/]*+(?:([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*+))?+)?+)?+")
_ATTR_ENTITY = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*(?:;|(?![=A-Za-z0-9])))")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "title", "textarea")}

_VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
_HEAD = frozenset("base link meta script style title".split())
_RAW_TEXT = frozenset("script style template rt rp".split())
_BLOCK = ("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption "
          "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section "
          "summary table ul").split()
_TABLE_SCOPE = frozenset("table td th caption button object template".split())

# start tag -> (open elements it ends, elements it never looks beyond)
_ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {t: (frozenset(["p"]), _TABLE_SCOPE) for t in _BLOCK}
_ENDS["li"] = (frozenset(["li", "p"]), _TABLE_SCOPE | {"ul", "ol", "menu", "dir"})
_ENDS["dt"] = _ENDS["dd"] = (frozenset(["dt", "dd", "p"]), _TABLE_SCOPE | {"dl"})
_ENDS["td"] = _ENDS["th"] = (frozenset(["td", "th"]), frozenset(["tr", "table"]))
_ENDS["tr"] = (frozenset(["tr", "caption", "colgroup"]), frozenset(["table", "thead", "tbody", "tfoot"]))
for _t in ("thead", "tbody", "tfoot"):
    _ENDS[_t] = (frozenset(["thead", "tbody", "tfoot", "tr", "caption", "colgroup"]), frozenset(["table"]))
_ENDS["option"] = (frozenset(["option"]), frozenset(["select", "optgroup"]))
_ENDS["optgroup"] = (frozenset(["optgroup", "option"]), frozenset(["select"]))
_ENDS["a"] = (frozenset(["a"]), _TABLE_SCOPE)

# Rank of an element against a misplaced end tag: an end tag never reaches past an
# open element of a higher rank. Unlisted elements have rank 100.
_RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180,
         "table": 190, "head": 200, "body": 200, "html": 220, "#document": 999}


# All attributes of a start tag at once, for tags whose attributes nobody reads.
_ATTRS = re.compile(r"(?:[\s/]*+[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+)?+)?+)*+([\s/]*+)")


@dataclass(frozen=True)
class Needs:
    """What an extractor reads of a page; the parser keeps nothing else.

    Kept are elements of ``tags``, those with one of ``classes`` or ``ids``, and scripts whose type matches ``scripts``, with the
    attributes ``attrs`` only; readable text within an element of ``text_in``, and the contents of kept scripts. The nodes left are
    numbered anew, so subtrees are still slices. Needs of several extractors are joined with ``|``.
    """

    tags: frozenset[str] = frozenset()
    classes: frozenset[str] = frozenset()
    ids: frozenset[str] = frozenset()
    attrs: frozenset[str] = frozenset()
    text_in: frozenset[str] = frozenset()
    scripts: frozenset[str] = frozenset()

    def __or__(self, other: Needs) -> Needs:
        return Needs(*[getattr(self, f.name) | getattr(other, f.name) for f in fields(self)])


class _Nodes:
    """Growing columns of the nodes of one batch, and the open elements of one page."""

    def __init__(self, needs: Needs | None = None) -> None:
        self.needs = needs
        if needs:
            self.every_attribute = bool(needs.classes or needs.ids)
            self.script_types = re.compile("|".join(sorted(needs.scripts)), re.I) if needs.scripts else None
        self.offsets = [0]
        self.rows: list[tuple] = []  # parent, level, tag, text, raw
        self.last: list[int] = []
        self.with_attrs: list[int] = []  # rows that have attributes, with how many
        self.n_attrs: list[int] = []
        self.attr_names: list[str] = []
        self.attr_values: list[str] = []
        self.with_classes: list[int] = []
        self.n_classes: list[int] = []
        self.classes: list[str] = []
        self.errors: list[str | None] = []

    def _add(self, tag: str, attrs: dict[str, str] | None = None, text: str | None = None, raw: str | None = None) -> int:
        row, opened = len(self.rows), self.open
        pre = row - self.base
        parent = opened[-1] if opened else None
        if parent is not None and parent < 0:
            parent = ~parent
        self.rows.append((parent, len(opened), tag, text, raw))
        self.last.append(pre)
        if attrs and self.needs:
            attrs = {k: v for k, v in attrs.items() if k in self.needs.attrs}
        if attrs:
            self.with_attrs.append(row)
            self.n_attrs.append(len(attrs))
            self.attr_names.extend(attrs)
            self.attr_values.extend(attrs.values())
            words = attrs["class"].split() if "class" in attrs else None
            if words:
                self.with_classes.append(row)
                self.n_classes.append(len(words))
                self.classes.extend(words)
        return pre

    def _wanted(self, tag: str, attrs: dict[str, str] | None) -> bool:
        needs = self.needs
        if not needs or tag in needs.tags or tag == "#document":
            return True
        if not attrs:
            return False
        if tag == "script" and self.script_types and self.script_types.search(attrs.get("type", "")):
            return True
        return ("class" in attrs and not needs.classes.isdisjoint(attrs["class"].split())) or attrs.get("id") in needs.ids

    def _reads(self) -> bool:
        """Whether the text at hand is wanted; of what is raw, the contents of a kept element are."""
        if not self.needs:
            return True
        if self.names[-1] in _RAW_TEXT:
            return self.open[-1] >= 0
        return self._is_open(self.needs.text_in)

    def _push(self, tag: str, attrs: dict[str, str] | None = None) -> None:
        if self._wanted(tag, attrs):
            self.open.append(self._add(tag, attrs))
        else:  # an element not kept stands for the nearest one that is
            self.open.append(self.open[-1] if self.open[-1] < 0 else ~self.open[-1])
        self.names.append(tag)
        self.count[tag] = self.count.get(tag, 0) + 1

    def _pop_to(self, depth: int) -> None:
        self._flush()
        end = len(self.rows) - self.base - 1
        while len(self.open) > depth:
            kept = self.open.pop()
            if kept >= 0:
                self.last[self.base + kept] = end
            self.count[self.names.pop()] -= 1

    def _is_open(self, tags) -> bool:
        for tag in tags:
            if self.count.get(tag):
                return True
        return False

    def _flush(self) -> None:
        if self.buffer:
            text = self.buffer[0] if len(self.buffer) == 1 else "".join(self.buffer)
            self.buffer = []
            if self.needs and not self._reads():
                return
            if self._is_open(_RAW_TEXT):
                self._add("#raw", raw=text)
            else:
                self._add("#text", text=_collapse(text))

    def _ensure_body(self, attrs: dict[str, str] | None = None) -> None:
        if not self.body:
            if self.count.get("head"):
                self._pop_to(self.names.index("head"))
            if len(self.names) == 1:
                self._push("html")
            self._push("body", attrs)
            self.head = self.body = True

    def _data(self, text: str) -> None:
        if not self.body and self.names[-1] in ("#document", "html", "head"):
            if not text.strip():
                return
            self._ensure_body()
            self._push("p")
        self.buffer.append(text)

    def _start(self, tag: str, attrs: dict[str, str], closed: bool) -> None:
        self._flush()
        if tag in ("html", "body", "head"):
            if tag == "html" and len(self.names) == 1:
                self._push("html", attrs)
            elif tag == "body" and not self.body:
                self._ensure_body(attrs)
            elif tag == "head" and not self.head:
                if len(self.names) == 1:
                    self._push("html")
                self._push("head", attrs)
                self.head = True
            return
        if tag in _HEAD and not self.body:
            if len(self.names) == 1:
                self._push("html")
            if not self.head:
                self._push("head")
                self.head = True
        elif not self.body and self.names[-1] in ("#document", "html", "head"):
            self._ensure_body()
        ends, barrier = _ENDS.get(tag, ((), ()))
        if self._is_open(ends):
            cut, left = None, sum(self.count.get(name, 0) for name in ends)
            for depth in range(len(self.names) - 1, 0, -1):
                name = self.names[depth]
                if name in ends:
                    cut, left = depth, left - 1
                    if not left:
                        break
                elif name in barrier:
                    break
            if cut is not None:
                self._pop_to(cut)
        if closed or tag in _VOID:
            if self._wanted(tag, attrs):
                self._add(tag, attrs)
        else:
            self._push(tag, attrs)

    def _end(self, tag: str) -> None:
        if tag in ("html", "body") or not self.count.get(tag):
            return
        rank = _RANK.get(tag, 100)
        for depth in range(len(self.names) - 1, 0, -1):
            name = self.names[depth]
            if name == tag:
                self._pop_to(depth)
                return
            if _RANK.get(name, 100) > rank:
                return

    def _parse(self, html: str) -> None:
        self.open: list[int] = []
        self.names: list[str] = []
        self.buffer: list[str] = []
        self.count: dict[str, int] = {}
        self.head = self.body = False
        self._push("#document")
        at, end, last_close = 0, len(html), html.rfind(">")
        while at < end:
            # what follows the last ">" cannot be markup
            mark = html.find("<", at) if at < last_close else -1
            if mark != at:
                if not self.needs or not self.body or self._reads():
                    text = html[at:mark] if mark > 0 else html[at:]
                    self._data(unescape(text) if "&" in text else text)
                if mark < 0:
                    break
            found = _MARKUP.match(html, mark)
            kind = found.lastgroup if found else None
            if kind == "open":
                tag = found.group("open").lower()
                if self.needs and not (self.every_attribute or tag in self.needs.tags or tag == "script"):
                    attrs, at, closed = _no_attributes(html, found.end())
                else:
                    attrs, at, closed = _attributes(html, found.end())
                if at:
                    self._start(tag, attrs, closed)
                    if tag in _RAW_END and not closed:
                        stop = _RAW_END[tag].search(html, at)
                        body = html[at:stop.start() if stop else end]
                        if body and (not self.needs or self._reads()):
                            self.buffer.append(unescape(body) if tag in ("title", "textarea") else body)
                        at = stop.start() if stop else end
                    continue
                kind = None
            if kind == "close":
                self._end(found.group("close").lower())
                at = found.end()
            elif kind == "skip":
                self._flush()
                at = found.end()
            else:  # no markup after all
                self._data("<")
                at = mark + 1
        self._pop_to(0)

    def page(self, html: str | None) -> None:
        """Append the nodes of one page; a page that cannot be parsed keeps its error."""
        self.base = len(self.rows)
        error = None
        if html:
            try:
                self._parse(html)
            except Exception as exc:  # the row carries its own error, the job goes on
                error = f"{type(exc).__name__}: {exc}"
                self._forget(self.base)
        self.offsets.append(len(self.rows))
        self.errors.append(error)

    def _forget(self, base: int) -> None:
        """Drop all nodes from row ``base`` on."""
        for owners, sizes, columns in ((self.with_attrs, self.n_attrs, (self.attr_names, self.attr_values)),
                                       (self.with_classes, self.n_classes, (self.classes,))):
            while owners and owners[-1] >= base:
                owners.pop()
                size = sizes.pop()
                for column in columns:
                    del column[len(column) - size:]
        del self.rows[base:], self.last[base:]

    def columns(self) -> tuple[pa.Array, pa.Array]:
        text, n = pa.string(), len(self.rows)
        parent, level, tag, readable, raw = zip(*self.rows) if n else ((),) * 5

        def ends(owners: list[int], sizes: list[int]) -> pa.Array:
            per_row = np.zeros(n + 1, np.int32)
            per_row[np.array(owners, np.int64) + 1] = sizes
            return pa.array(np.cumsum(per_row, dtype=np.int32))

        starts = np.array(self.offsets, np.int32)
        pre = np.arange(n, dtype=np.int32) - np.repeat(starts[:-1], np.diff(starts))
        classes = pa.ListArray.from_arrays(ends(self.with_classes, self.n_classes), pa.array(self.classes, text))
        attrs = pa.MapArray.from_arrays(ends(self.with_attrs, self.n_attrs),
                                        pa.array(self.attr_names, text), pa.array(self.attr_values, text))
        node = pa.StructArray.from_arrays(
            [pa.array(pre), pa.array(self.last, pa.int32()), pa.array(parent, pa.int32()), pa.array(level, pa.int32()),
             pa.array(tag, text), classes, attrs, pa.array(readable, text), pa.array(raw, text)],
            names=NODE.names)
        return pa.ListArray.from_arrays(pa.array(starts), node), pa.array(self.errors, text)


def _collapse(text: str) -> str:
    """Runs of whitespace to one blank; blanks at the ends stay, they separate neighbouring nodes."""
    words = " ".join(text.split())
    if not words:
        return " "
    return (" " if text[0].isspace() else "") + words + (" " if text[-1].isspace() else "")


def _no_attributes(html: str, at: int) -> tuple[None, int, bool]:
    """As ``_attributes``, without reading them."""
    found = _ATTRS.match(html, at)
    return (None, found.end() + 1, found[1].endswith("/")) if html.startswith(">", found.end()) else (None, 0, False)


def _attributes(html: str, at: int) -> tuple[dict[str, str] | None, int, bool]:
    """Attributes of the start tag at ``at``, where the tag ends, and whether it ends in a slash.

    The first of a repeated name counts. A tag that never ends is no tag: its end is 0.
    """
    if html.startswith(">", at):
        return None, at + 1, False
    out: dict[str, str] = {}
    while True:
        found = _ATTR.match(html, at)
        name, double, single, bare = found.groups()
        if name is None:
            end = found.end()
            closed = html.startswith("/", end - 1) and end > at
            return (out, end + 1, closed) if html.startswith(">", end) else (None, 0, False)
        at = found.end()
        value = double or single or bare or ""
        if "&" in value:
            value = _ATTR_ENTITY.sub(lambda m: unescape(m.group()), value)
        out.setdefault(name.lower(), value)


def _shred(batches: Iterator[pa.RecordBatch], needs: Needs | None = None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("html")
        kept = [i for i in range(batch.num_columns) if i != at]
        names = [batch.schema.names[i] for i in kept] + ["dom", "parse_error"]
        html, nodes, start, chars = batch.column(at), _Nodes(needs), 0, 0
        for row in range(batch.num_rows):
            page = html[row].as_py()
            nodes.page(page)
            chars += len(page or "")
            full = len(nodes.rows) >= NODES_PER_BATCH or chars >= CHARS_PER_BATCH
            if full or row + 1 == batch.num_rows:
                rows = batch.slice(start, row + 1 - start)
                yield pa.RecordBatch.from_arrays([rows.column(i) for i in kept] + list(nodes.columns()), names)
                nodes, start, chars = _Nodes(needs), row + 1, 0


def shred_pages(pages: DataFrame, needs: Needs | None = None) -> DataFrame:
    """``(…, html)`` to ``(…, dom, parse_error)``; all other columns pass through.

    With ``needs`` only the nodes that some extractors read are kept; others must not be run on the result.
    """
    schema = T.StructType([f for f in pages.schema.fields if f.name != "html"]
                          + [T.StructField("dom", DOM), T.StructField("parse_error", T.StringType())])
    return pages.mapInArrow(lambda batches: _shred(batches, needs), schema)


def nodes(shredded: DataFrame, key: str = "page_id") -> DataFrame:
    """The node arrays as a relation, one row per element or text node."""
    return (shredded.select(key, F.explode_outer("dom").alias("n"))
            .where(F.col("n.tag") != "#document")
            .select(
                key, "n.pre", "n.last", "n.parent", "n.level",
                F.when(F.col("n.tag").isin("#text", "#raw"), "text").otherwise("elem").alias("kind"),
                F.when(~F.col("n.tag").startswith("#"), F.col("n.tag")).alias("tag"),
                F.col("n.attrs")["id"].alias("id"), F.col("n.classes").alias("classes"),
                F.col("n.attrs").alias("attrs"),
                F.coalesce("n.text", "n.raw").alias("text")))
