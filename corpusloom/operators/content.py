"""Content facts of a page: headings, text blocks, tables, images, links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import dom as D
from corpusloom.functions.text import let, lit, non_empty, normalize_ws, strip
from corpusloom.functions.urls import authority, is_download, make_abs
from corpusloom.operators.classify import of_site
from corpusloom.operators.containers import content_needs, with_content
from corpusloom.operators.head import with_base
from corpusloom.rules import DEFAULTS, Rules
from corpusloom.sources.shred import Needs


def heading_needs(rules: Rules = DEFAULTS) -> Needs:
    """What ``with_headings`` reads."""
    names = frozenset(["h1", "h2", "h3"])
    return content_needs(rules) | Needs(tags=names, text_in=names)


def link_needs(whole_page: bool = False, rules: Rules = DEFAULTS) -> Needs:
    """What ``links`` reads, of the content or of the whole page."""
    anchors = Needs(tags=frozenset(["a"]), attrs=frozenset(["href"]), text_in=frozenset(["a"]))
    return anchors if whole_page else anchors | content_needs(rules)


def tables_of(nodes: str) -> str:
    """Tables among ``nodes`` as rows of cell texts; blank rows and tables without rows are dropped."""
    cells = f"transform({D.select(D.descendants('tr'), D.tag_in('th', 'td'))}, c -> {D.text('c', ' ')})"
    rows = f"filter(transform({D.select(D.descendants('tb'), D.tag_in('tr'))}, tr -> {cells}), r -> exists(r, c -> c <> ''))"
    return f"filter(transform({D.select(nodes, D.tag_in('table'))}, tb -> {rows}), t -> size(t) > 0)"


def _blocks(nodes: str, rules: Rules) -> str:
    """``(text, i, tag)`` of every block long enough, first of equal texts only, in order.

    Only a page that repeats a text is sorted: by (text, position) the first of each
    run of equal texts is the one to keep.
    """
    found = (f"transform({D.select(nodes, D.tag_in('p', 'li', 'blockquote'))}, (n, i) -> "
             f"struct({D.text('n', ' ')} AS text, i AS i, n.tag AS tag))")
    kept = f"filter({found}, b -> length(b.text) >= if(b.tag = 'li', {rules.min_list_item}, {rules.min_block}))"
    firsts = let("s", "array_sort(bs)", "filter(s, (b, i) -> i = 0 OR b.text <> get(s, i - 1).text)")
    by_place = f"transform(array_sort(transform({firsts}, b -> struct(b.i AS i, b AS b))), e -> e.b)"
    return let("bs", kept, f"CASE WHEN size(array_distinct(bs.text)) = size(bs) THEN bs ELSE {by_place} END")


def _links(nodes: str, site_host: str | None, rules: Rules) -> str:
    host = f"lower({lit(site_host)})" if site_host else "lower(base.authority)"
    link = let("a", make_abs("base", strip(D.attr("href"))), (
        f"struct(a AS href, {D.text('n', '')} AS text, CASE WHEN {is_download('a', rules.download_extensions)} THEN 'download' "
        f"WHEN {authority('a')} = {host} THEN 'internal' ELSE 'external' END AS kind)"))
    anchors = D.select(nodes, D.tag_in("a") + " AND " + D.attr("href") + " IS NOT NULL")
    return f"transform({anchors}, n -> {link})"


def _images(nodes: str) -> str:
    source = "coalesce(" + ", ".join(non_empty(D.attr(a)) for a in ("src", "data-src", "data-lazy-src")) + ")"
    image = let("s", source, (f"struct(CASE WHEN s IS NOT NULL THEN {make_abs('base', 's')} END AS src, "
                              f"{normalize_ws(D.attr('alt'))} AS alt)"))
    return f"filter(transform({D.select(nodes, D.tag_in('img'))}, n -> {image}), im -> im.src IS NOT NULL)"


def headings_sql() -> dict[str, str]:
    return {"h1": let("h", D.first("_content", D.tag_in("h1")), D.text("h", "")),
            "headings": (f"transform({D.select('_content', D.tag_in('h2', 'h3'))}, "
                         f"n -> struct(n.tag AS tag, {D.text('n', '')} AS text))")}


def text_blocks_sql(typed: bool, rules: Rules = DEFAULTS) -> str:
    """Texts of the blocks; an article without any gives its whole text."""
    if not typed:
        return f"{_blocks('_content', rules)}.text"
    whole = f"filter(array({D.text('container', ' ')}), t -> t <> '')"
    return let("tb", f"{_blocks('_content', rules)}.text", (
        f"CASE WHEN page_type = 'Article' AND size(tb) = 0 THEN {whole} ELSE tb END"))


def content_sql(site_host: str | None = None, rules: Rules = DEFAULTS) -> dict[str, str]:
    """All content columns of a page, to be added in one projection."""
    return {**headings_sql(), "text_blocks": text_blocks_sql(True, rules), "tables": tables_of("_content"),
            "images": _images("_content"), "links": _links("_content", site_host, rules)}


def with_headings(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``h1`` (first one) and ``headings`` (all h2 and h3, blank ones too)."""
    return pages if "headings" in pages.columns else D.add(with_content(pages, rules), **headings_sql())


def with_text_blocks(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``text_blocks``; with the page type known, articles without blocks give their whole text."""
    if "text_blocks" in pages.columns:
        return pages
    return D.add(with_content(pages, rules), text_blocks=text_blocks_sql("page_type" in pages.columns, rules))


def with_tables(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    return pages if "tables" in pages.columns else D.add(with_content(pages, rules), tables=tables_of("_content"))


def with_images(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    return pages if "images" in pages.columns else D.add(with_content(with_base(pages), rules), images=_images("_content"))


def with_links(pages: DataFrame, site_host: str | None = None, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``links`` (href, text, kind) in document order."""
    if "links" in pages.columns:
        return pages
    return D.add(with_content(with_base(pages), rules), links=_links("_content", site_host, rules))


# Fact tables: one row per item, exploded in place without a shuffle. ``site_origin`` names the one site of a harvest.

def headings(pages: DataFrame, key: str = "page_id", rules: Rules = DEFAULTS, site_origin: str | None = None) -> DataFrame:
    rows = D.item_rows(with_headings(of_site(pages, site_origin, rules), rules), key, "headings", "pos", "h")
    return rows.select(key, "pos", "h.tag", "h.text")


def text_blocks(pages: DataFrame, key: str = "page_id", rules: Rules = DEFAULTS, site_origin: str | None = None) -> DataFrame:
    """``(page_id, block_no, text)``, numbered from 1."""
    rows = D.item_rows(with_text_blocks(of_site(pages, site_origin, rules), rules), key, "text_blocks", "pos", "text")
    return rows.select(key, (F.col("pos") + 1).alias("block_no"), "text")


def table_cells(pages: DataFrame, key: str = "page_id", rules: Rules = DEFAULTS, site_origin: str | None = None) -> DataFrame:
    """``(page_id, table_no, row_no, col_no, text)``, numbered from 1."""
    rows = D.item_rows(with_tables(of_site(pages, site_origin, rules), rules), key, "tables", "t", "rows")
    rows = D.item_rows(rows, (key, "t"), "rows", "r", "cells")
    rows = D.item_rows(rows, (key, "t", "r"), "cells", "c", "text")
    return rows.select(key, *[(F.col(a) + 1).alias(b) for a, b in
                              (("t", "table_no"), ("r", "row_no"), ("c", "col_no"))], "text")


def images(pages: DataFrame, key: str = "page_id", rules: Rules = DEFAULTS, site_origin: str | None = None) -> DataFrame:
    rows = D.item_rows(with_images(of_site(pages, site_origin, rules), rules), key, "images", "pos", "im")
    return rows.select(key, "pos", "im.src", "im.alt")


def links(pages: DataFrame, site_host: str | None = None, whole_page: bool = False,
          key: str = "page_id", rules: Rules = DEFAULTS, site_origin: str | None = None) -> DataFrame:
    """``(page_id, pos, href, text, kind)`` of the content, or of the whole page."""
    if whole_page:
        pages = D.add(with_base(pages), links=_links("dom", site_host, rules))
    else:
        pages = with_links(of_site(pages, site_origin, rules), site_host, rules)
    return D.item_rows(pages, key, "links", "pos", "l").select(key, "pos", "l.href", "l.text", "l.kind")
