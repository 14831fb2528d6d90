"""Head metadata, dates and breadcrumbs; these read the page before boilerplate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.functions import dom as D
from corpusloom.functions import variants as V
from corpusloom.functions.text import first, let, non_empty, normalize_ws, strip
from corpusloom.functions.urls import make_abs, split_url
from corpusloom.operators.jsonld import JSONLD, MARKS
from corpusloom.sources.shred import Needs


#: What ``head.title`` reads, and what the whole of ``head`` reads.
TITLE_NEEDS = Needs(tags=frozenset(["title"]), text_in=frozenset(["title"]))
HEAD_NEEDS = TITLE_NEEDS | Needs(tags=frozenset(["meta", "link"]), attrs=frozenset(["name", "property", "content", "rel", "href"]))


def with_base(pages: DataFrame) -> DataFrame:
    """Add ``base`` (the split final URL all references resolve against), ``jsonld`` and ``_marks``."""
    if "base" in pages.columns:
        return pages
    return D.add(pages, base=split_url("final_url"), jsonld=JSONLD, _marks=MARKS)


def _meta_map(name: str, prefix: str) -> str:
    """Metas ``prefix:…`` with a content, as a map sorted by key; the last one of a key counts.

    Sorted by (key, latest first), the first entry of each run is the one to keep.
    """
    metas = D.select("_marks", f"n.tag = 'meta' AND {D.attr_like(name, f'^{prefix}:')} AND {D.attr('content')} <> ''")
    ranked = (f"array_sort(transform({metas}, (n, i) -> "
              f"struct(lower({D.attr(name)}) AS k, -i AS latest, {D.attr('content')} AS v)))")
    kept = let("r", ranked, "filter(r, (p, i) -> i = 0 OR p.k <> get(r, i - 1).k)")
    return let("h", kept, "CASE WHEN size(h) > 0 THEN map_from_arrays(h.k, h.v) END")


def _meta_content(name: str, pattern: str) -> str:
    """Content of the first meta whose name matches; '' when it has none, null without such a meta."""
    return let("m", D.first("_marks", "n.tag = 'meta' AND " + D.attr_like(name, pattern)),
               f"CASE WHEN m IS NOT NULL THEN {normalize_ws(D.attr('content', 'm'))} END")


def head_sql() -> str:
    link = D.first("_marks", "n.tag = 'link' AND " + D.attr_like("rel", r"\bcanonical\b"))
    canonical = let("c", non_empty(strip(f"{link}.attrs['href']")),
                    f"CASE WHEN c IS NULL THEN final_url ELSE {make_abs('base', 'c')} END")
    title = let("t", D.first("_marks", "n.tag = 'title'"), D.text("t", ""))
    return (f"struct({title} AS title, {canonical} AS canonical, "
            f"{_meta_content('name', '^description$')} AS meta_description, "
            f"{_meta_content('name', 'robots')} AS robots, "
            f"{_meta_map('property', 'og')} AS og, {_meta_map('name', 'twitter')} AS twitter)")


def with_head(pages: DataFrame) -> DataFrame:
    """Add ``head``: title, canonical, meta_description, robots, og, twitter."""
    return pages if "head" in pages.columns else D.add(with_base(pages), head=head_sql())


def dates_sql() -> str:
    def values(*keys: str) -> str:
        members = ", ".join(V.string_member("o", k) for k in keys)
        return f"filter(flatten(transform(jsonld, o -> array({members}))), d -> d IS NOT NULL)"

    def meta(name: str) -> str:
        return non_empty(D.first("_marks", D.tag_in("meta") + " AND " + D.attr_is("property", name)) + ".attrs['content']")

    def pick(found: str, *fallback: str) -> str:
        return let("ds", found, f"coalesce(get(filter(ds, d -> d <> ''), 0), {', '.join(fallback)}, get(ds, 0))")

    published = pick(values("datePublished", "dateCreated"), meta("article:published_time"))
    modified = pick(values("dateModified", "dateUpdated"), meta("article:modified_time"), meta("og:updated_time"))
    return f"struct({published} AS published, {modified} AS modified)"


def with_dates(pages: DataFrame) -> DataFrame:
    """Add ``dates``: published and modified as found, never parsed."""
    return pages if "dates" in pages.columns else D.add(with_base(pages), dates=dates_sql())


def page_dates(pages: DataFrame, key: str = "page_id") -> DataFrame:
    return with_dates(pages).select(key, "dates.published", "dates.modified")


def breadcrumbs_sql() -> str:
    lists = f"filter(jsonld, o -> coalesce({V.string_member('o', '@type')} = 'BreadcrumbList', false))"
    entries = (f"filter({V.items(V.member('o', 'itemListElement'))}, "
               f"i -> {V.is_object('i')} AND coalesce({V.is_object(V.member('i', 'item'))}, false))")
    url = let("u", non_empty(V.string_member("e", "@id")), f"CASE WHEN u IS NOT NULL THEN {make_abs('base', 'u')} END")
    # 0 and false are no names, as the empty string is none
    name = let("nm", V.member("e", "name"), (
        f"CASE WHEN {V.is_string('nm')} THEN cast(nm AS string) WHEN schema_of_variant(nm) = 'BOOLEAN' THEN nullif(cast(nm AS string), 'false') "
        "WHEN coalesce(try_variant_get(nm, '$', 'double'), 1) <> 0 THEN cast(nm AS string) END"))
    entry = let("e", V.member("i", "item"), f"struct({name} AS name, {url} AS url)")
    trails = f"transform({lists}, o -> filter(transform({entries}, i -> {entry}), c -> c.name <> ''))"
    nav = D.first("dom", D.any_of(D.has_class("breadcrumb"),
                                  "n.tag = 'nav' AND " + D.attr_like("aria-label", "breadcrumb")))
    href = D.attr("href")
    anchors = let("nav", nav, (
        f"transform({D.select(D.descendants('nav'), D.tag_in('a'))}, n -> "
        f"struct({D.text('n', '')} AS name, CASE WHEN {href} <> '' THEN {make_abs('base', href)} END AS url))"))
    return (f"coalesce({first(f'filter({trails}, t -> size(t) > 0)')}, filter({anchors}, c -> c.name <> ''), "
            "cast(array() AS array<struct<name:string,url:string>>))")


def with_breadcrumbs(pages: DataFrame) -> DataFrame:
    """Add ``breadcrumbs``: from the first breadcrumb list with named items, else from the page's trail."""
    if "_stripped" in pages.columns and "breadcrumbs" not in pages.columns:
        raise ValueError("breadcrumbs are read before boilerplate removal")
    return pages if "breadcrumbs" in pages.columns else D.add(with_base(pages), breadcrumbs=breadcrumbs_sql())


def breadcrumbs(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per trail entry: ``(page_id, pos, name, url)``."""
    rows = D.item_rows(with_breadcrumbs(pages), key, "breadcrumbs", "pos", "b")
    return rows.select(key, "pos", "b.name", "b.url")
