"""Navigation of the ``dom`` column: a node's subtree is a slice, its text a join of that slice.

Removed nodes are null in the array, so positions stay valid and a removed node
simply matches nothing. All helpers return SQL text; tests are about a lambda
variable called ``n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let, lit, rx


def descendants(node: str) -> str:
    return f"slice(dom, {node}.pre + 2, {node}.last - {node}.pre)"


def raw_text(node: str) -> str:
    """Contents of a script or style element."""
    return f"array_join({descendants(node)}.raw, '')"


def text(node: str, separator: str) -> str:
    """Readable text of a subtree, whitespace normalised; null without a node.

    Text nodes come with collapsed whitespace, so only blanks that meet at node
    borders are left to merge.
    """
    joined = f"array_join({descendants(node)}.text, '{separator}')"
    merged = let("jt", joined, f"trim(CASE WHEN contains(jt, '  ') THEN regexp_replace(jt, {rx(' {2,}')}, ' ') ELSE jt END)")
    return f"CASE WHEN {node} IS NOT NULL THEN {merged} END"


def tag_in(*tags: str) -> str:
    return "n.tag IN (" + ", ".join(map(lit, tags)) + ")"


def has_class(*names: str) -> str:
    """One of the class names is set on the node."""
    if len(names) == 1:
        test = f"array_contains(n.classes, {lit(names[0])})"
    else:
        test = "arrays_overlap(n.classes, array(" + ", ".join(map(lit, names)) + "))"
    return f"(size(n.classes) > 0 AND {test})"


def attr(name: str, node: str = "n") -> str:
    return f"{node}.attrs[{lit(name)}]"


def attr_is(name: str, *values: str) -> str:
    return f"coalesce({attr(name)} IN (" + ", ".join(map(lit, values)) + "), false)"


def attr_like(name: str, pattern: str) -> str:
    return f"coalesce({attr(name)} RLIKE {rx('(?i)' + pattern)}, false)"


def any_of(*tests: str) -> str:
    return "(" + " OR ".join(f"({t})" for t in tests) + ")"


def select(nodes: str, test: str) -> str:
    """Nodes that pass ``test``, in document order."""
    return f"filter({nodes}, n -> {test})"


def first(nodes: str, test: str) -> str:
    return f"get({select(nodes, test)}, 0)"


def item_rows(pages: DataFrame, key, items: str | Column, pos: str, item: str) -> DataFrame:
    """One row per array item, ``(key…, pos, item)``; pages without items give none.

    The outer form keeps Spark from deriving a size filter that would evaluate the
    whole array expression a second time below the explode.
    """
    keys = [key] if isinstance(key, str) else list(key)
    items = F.expr(items) if isinstance(items, str) else items
    return (pages.select(*keys, F.posexplode_outer(items).alias(pos, item))
            .where(F.col(pos).isNotNull()))


def add(pages: DataFrame, **columns: str) -> DataFrame:
    """Add columns given as SQL text, in one projection."""
    return pages.withColumns({name: F.expr(text) for name, text in columns.items()})
