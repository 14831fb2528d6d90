"""Content container of a page and boilerplate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.functions import dom as D
from corpusloom.functions.text import let
from corpusloom.operators.classify import page_type_needs, with_page_type
from corpusloom.operators.head import with_base
from corpusloom.rules import DEFAULTS, Rules
from corpusloom.sources.shred import NODE, Needs

def content_needs(rules: Rules = DEFAULTS) -> Needs:
    """What the content of a page is found by: its type, containers, boilerplate."""
    return page_type_needs(rules) | Needs(
        tags=frozenset(["main", "article", "body", *rules.boilerplate_tags]), ids=frozenset(rules.boilerplate_ids),
        classes=frozenset([rules.theme_content, rules.entry_content, rules.single_post, *rules.boilerplate_classes]),
        attrs=frozenset(["class", "id", "role"]))


def is_boilerplate(rules: Rules = DEFAULTS) -> str:
    return D.any_of(D.tag_in(*rules.boilerplate_tags), D.has_class(*rules.boilerplate_classes),
                    D.attr_is("id", *rules.boilerplate_ids))


def _main_of() -> str:
    """``main[role=main]``, ``main``, ``article``, ``body``, then the whole document."""
    in_order = [D.tag_in("main") + " AND " + D.attr_is("role", "main"),
                *map(D.tag_in, ("main", "article", "body"))]
    return let("cs", D.select("dom", D.tag_in("main", "article", "body")),
               f"coalesce({', '.join(D.first('cs', test) for test in in_order)}, get(dom, 0))")


def _article_of(rules: Rules) -> str:
    """The four article-body selectors in order, null when none matches."""
    def inside(host_test: str) -> str:
        # hosts and bodies in document order: a body lies in a host if one before it reaches that far
        body = D.has_class(rules.entry_content)
        found = (f"aggregate({D.select('dom', D.any_of(host_test, body))}, struct(-1 AS reach, cast(null AS int) AS at), (acc, n) -> "
                 f"CASE WHEN acc.at IS NOT NULL THEN acc WHEN {body} AND acc.reach >= n.pre THEN struct(acc.reach AS reach, n.pre AS at) "
                 f"WHEN {host_test} THEN struct(greatest(acc.reach, n.last) AS reach, acc.at AS at) ELSE acc END).at")
        return let("at", found, "CASE WHEN at IS NOT NULL THEN get(dom, at) END")

    return let("bs", D.select("dom", D.has_class(rules.theme_content, rules.entry_content)), (
        f"CASE WHEN size(bs) > 0 THEN coalesce({D.first('bs', D.has_class(rules.theme_content))}, "
        f"{inside(D.tag_in('article') + ' AND ' + D.has_class('post'))}, "
        f"{inside(D.has_class(rules.single_post))}, {D.first('bs', D.has_class(rules.entry_content))}) END"))


def with_container(pages: DataFrame, kind: str | None = None, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``container``: by page type, or always the ``main`` / ``article`` choice if ``kind`` says so."""
    if "container" in pages.columns:
        return pages
    main, article = _main_of(), f"coalesce({_article_of(rules)}, {_main_of()})"
    if kind is not None:
        return D.add(pages, container={"main": main, "article": article}[kind])
    return D.add(with_page_type(pages, rules=rules), container=(
        f"CASE WHEN page_type IN ('Article', 'Product') THEN {article} ELSE {main} END"))


def strip_boilerplate(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    """Null every boilerplate subtree below the container in ``dom``.

    Only the topmost boilerplate elements matter; the array is rebuilt from the
    slices between them, so the work is linear in the page. Head nodes and JSON-LD
    are read before, since they may lie inside what is removed.
    """
    if "_stripped" in pages.columns:
        return pages
    ranges = (f"transform({D.select(D.descendants('container'), is_boilerplate(rules))}, "
              "n -> struct(n.pre AS pre, n.last AS last))")
    # The fold carries the last end; ranges are gathered in short lists, so no step copies all of them.
    kind = "array<struct<pre:int,last:int>>"
    topmost = (f"aggregate({ranges}, struct(-1 AS reach, cast(array() AS {kind}) AS some, cast(array() AS array<{kind}>) AS full), (acc, r) -> "
               "CASE WHEN r.pre <= acc.reach THEN acc "
               "WHEN size(acc.some) >= 100 THEN struct(r.last AS reach, array(r) AS some, concat(acc.full, array(acc.some)) AS full) "
               "ELSE struct(r.last AS reach, concat(acc.some, array(r)) AS some, acc.full AS full) END, "
               "acc -> concat(flatten(acc.full), acc.some))")
    piece = let("start", "coalesce(get(cuts, i - 1).last + 1, 0)", (
        "concat(slice(dom, start + 1, c.pre - start), "
        f"array_repeat(cast(null AS {NODE.simpleString()}), c.last - c.pre + 1))"))
    end = "get(cuts, size(cuts) - 1).last"
    rebuilt = let("cuts", topmost, (
        f"CASE WHEN size(cuts) = 0 THEN dom ELSE concat(flatten(transform(cuts, (c, i) -> {piece})), "
        f"slice(dom, {end} + 2, size(dom) - {end} - 1)) END"))
    return D.add(with_container(with_base(pages), rules=rules), dom=rebuilt, _stripped="true")


def with_content(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``_content``, the elements of the container without boilerplate."""
    if "_content" in pages.columns:
        return pages
    elements = D.select(D.descendants("container"), "NOT startswith(n.tag, '#')")
    return D.add(strip_boilerplate(pages, rules), _content=elements)
