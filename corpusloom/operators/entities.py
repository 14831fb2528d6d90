"""Article, product and collection branches of a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import dom as D
from corpusloom.functions import variants as V
from corpusloom.functions.text import NO_STRINGS, falsy_coalesce, first, let, lit, non_empty, split_trim, strip
from corpusloom.functions.urls import make_abs
from corpusloom.operators.classify import classify_heading, is_card, of_site
from corpusloom.operators.containers import with_content
from corpusloom.operators.content import tables_of, with_headings, with_images
from corpusloom.operators.head import with_head
from corpusloom.rules import DEFAULTS, Rules

TITLE = falsy_coalesce("head.title", "h1")


def section_extents(nodes: str) -> str:
    """``(pre, last, parent, tag, stop)`` of every h1 to h4: a section reaches to the next such sibling.

    Sorting by (parent, position) puts siblings next to each other, so the end of
    a section is simply the following entry.
    """
    heads = (f"array_sort(transform({D.select(nodes, D.tag_in('h1', 'h2', 'h3', 'h4'))}, "
             "n -> struct(n.parent AS parent, n.pre AS pre, n.last AS last, n.tag AS tag)))")
    return let("hs", heads, (
        "array_sort(transform(hs, (h, i) -> struct(h.pre AS pre, h.last AS last, h.parent AS parent, h.tag AS tag, "
        "CASE WHEN get(hs, i + 1).parent = h.parent THEN get(hs, i + 1).pre "
        "ELSE get(dom, h.parent).last + 1 END AS stop)))"))


def sections_sql(rules: Rules = DEFAULTS) -> str:
    """Classified h2 to h4 headings of products with the texts and tables that belong to them."""
    keyed = (f"filter(transform(filter({section_extents('_content')}, h -> h.tag <> 'h1'), "
             f"h -> struct(h AS h, {classify_heading(D.text('h', ' '), rules.section_patterns)} AS section)), k -> k.section IS NOT NULL)")
    siblings = D.select("slice(dom, k.h.last + 2, k.h.stop - k.h.last - 1)", "n.parent = k.h.parent")
    texts = (f"CASE WHEN {D.tag_in('p', 'li', 'blockquote')} THEN array({D.text('n', ' ')}) "
             f"WHEN {D.tag_in('ul', 'ol')} THEN transform(filter({D.descendants('n')}, d -> d.tag = 'li'), "
             f"d -> {D.text('d', ' ')}) ELSE {NO_STRINGS} END")
    body = let("sibs", siblings, (
        f"struct(k.h.pre AS pre, k.section AS section, filter(flatten(transform(sibs, n -> {texts})), t -> t <> '') AS texts, "
        f"{tables_of('sibs')} AS tables)"))
    return f"CASE WHEN page_type = 'Product' THEN transform({keyed}, k -> {body}) END"


def _section_text(name: str) -> str:
    """Texts of the first heading of a section that has any."""
    hit = f"get(filter(sections, s -> s.section = {lit(name)} AND size(s.texts) > 0), 0)"
    return f"array_join({hit}.texts, '\\n\\n')"


def _spec_tables() -> str:
    """Tables under specification headings, up to and with the first one that has text."""
    reached = let("stop", "get(filter(sp, s -> size(s.texts) > 0), 0).pre",
                  "filter(sp, s -> stop IS NULL OR s.pre <= stop)")
    found = let("sp", "filter(sections, s -> s.section = 'specifications')", f"flatten({reached}.tables)")
    return let("ts", found, "CASE WHEN size(ts) > 0 THEN ts END")


def product_sql() -> str:
    """The product branch, from ``sections``, ``jsonld``, ``h1`` and ``head``."""
    named = (f"filter(transform(filter(jsonld, o -> {V.plain_type('o')} = 'product'), "
             f"o -> {V.string_member('o', 'name')}), m -> m IS NOT NULL)")
    parts = (f"struct({_section_text('specifications')} AS specs, {_section_text('applications_uses')} AS uses, "
             f"{_spec_tables()} AS tables)")
    sections = let("pt", parts, (
        f"struct({_section_text('description')} AS description_of_product, {_section_text('what_is')} AS what_is_product, "
        f"{_section_text('other_names')} AS other_names, struct(pt.specs AS text, pt.tables AS tables) AS specifications, "
        f"pt.uses AS applications_and_uses, {_section_text('packing')} AS packing, pt.uses AS uses_applications, "
        f"pt.tables AS grades_specs, {NO_STRINGS} AS faqs)"))
    return (f"CASE WHEN page_type = 'Product' THEN struct({falsy_coalesce(first(named), 'h1', TITLE)} AS name, "
            f"{sections} AS sections) END")


def with_product(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``product`` for Product pages, null for others."""
    if "product" in pages.columns:
        return pages
    pages = D.add(with_headings(with_head(with_content(pages, rules))), sections=sections_sql(rules))
    return D.add(pages, product=product_sql()).drop("sections")


def _strings(key: str, whole) -> str:
    """A JSON string through ``whole``, or the stripped non-empty strings of a JSON array; over all objects."""
    listed = f"filter(transform({V.items('m')}, x -> {strip(V.as_string('x'))}), x -> x <> '')"
    per_object = let("m", V.member("o", key), (
        f"CASE WHEN {V.is_string('m')} THEN {whole('cast(m AS string)')} WHEN m IS NULL THEN {NO_STRINGS} ELSE {listed} END"))
    return f"flatten(transform(_article_objs, o -> {per_object}))"


def _one_of(key: str, value) -> str:
    """Per object: ``value`` of the member itself, else of the first usable entry when it is an array."""
    per_object = let("m", V.member("o", key), (
        f"coalesce({value('m')}, get(filter(transform({V.items('m')}, x -> {value('x')}), x -> x IS NOT NULL), 0))"))
    return f"filter(transform(_article_objs, o -> {per_object}), x -> x IS NOT NULL)"


def article_inputs_sql(rules: Rules = DEFAULTS) -> dict[str, str]:
    """What the article branch needs from the page: its JSON-LD objects and two kinds of metas.

    Metas inside removed boilerplate no longer count.
    """
    def contents(name: str) -> str:
        kept = f"{D.tag_in('meta')} AND {D.attr_is('property', name)} AND get(dom, n.pre) IS NOT NULL"
        return f"transform({D.select('_marks', kept)}, n -> coalesce({D.attr('content')}, ''))"

    objects = f"filter(jsonld, o -> {V.plain_type('o')} IN ({', '.join(map(lit, rules.article_types))}))"
    return {"_article_objs": f"CASE WHEN page_type = 'Article' THEN {objects} END",
            "_article_tags": f"CASE WHEN page_type = 'Article' THEN {contents('article:tag')} END",
            "_article_section": f"CASE WHEN page_type = 'Article' THEN get({contents('article:section')}, 0) END"}


def article_sql() -> str:
    """The article branch, from its inputs, ``images``, ``h1`` and ``head``."""
    def name_of(v: str) -> str:
        return f"CASE WHEN {V.is_object(v)} THEN {V.string_member(v, 'name')} END"

    def src_of(v: str) -> str:
        return f"CASE WHEN {V.is_object(v)} THEN {V.string_member(v, 'url')} ELSE {V.as_string(v)} END"

    def feature(src: str, alt: str = "cast(null AS string)") -> str:
        return let("f", src, f"CASE WHEN f IS NOT NULL THEN struct(f AS src, {alt} AS alt) END")

    author = let("au", _one_of("author", name_of), "coalesce(get(filter(au, x -> x <> ''), 0), get(au, 0))")
    meta_section = f"CASE WHEN _article_section <> '' THEN array({strip('_article_section')}) ELSE {NO_STRINGS} END"
    categories = _strings("articleSection", lambda s: f"filter(array({strip(s)}), x -> x <> '')")
    meta_tags = f"filter(transform(_article_tags, x -> {strip('x')}), x -> x <> '')"
    usable = ("get(filter(images, im -> NOT startswith(im.src, 'data:') AND NOT contains(lower(im.alt), 'logo') "
              "AND NOT contains(lower(im.alt), 'avatar')), 0)")
    og_image = "coalesce(head.og['og:image'], head.og['og:image:url'])"
    from_content = let("im", usable, feature("im.src", non_empty("im.alt")))
    featured = f"coalesce({feature(first(_one_of('image', src_of)))}, {feature(og_image)}, {from_content})"
    return (f"CASE WHEN page_type = 'Article' THEN struct({falsy_coalesce('h1', TITLE)} AS headline, {author} AS author, "
            f"array_sort(array_distinct(concat({categories}, {meta_section}))) AS categories, "
            f"array_sort(array_distinct(concat({_strings('keywords', split_trim)}, {meta_tags}))) AS tags, "
            f"{featured} AS featured_image) END")


def with_article(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``article`` for Article pages, null for others."""
    if "article" in pages.columns:
        return pages
    inputs = article_inputs_sql(rules)
    pages = D.add(with_images(with_headings(with_head(with_content(pages, rules)))), **inputs)
    return D.add(pages, article=article_sql()).drop(*inputs)


def items_sql(rules: Rules = DEFAULTS) -> str:
    """Cards of collection pages with a link, in document order."""
    excerpt = D.attr_like("class", "(?:excerpt|summary|entry-summary)")
    parts = let("inside", D.descendants("card"), (
        f"struct(card AS card, {D.first('inside', D.tag_in('a') + ' AND ' + D.attr('href') + ' IS NOT NULL')} AS a, "
        f"{D.first('inside', excerpt)} AS excerpt, {D.first('inside', D.tag_in('img'))} AS img)"))
    cards = f"filter(transform({D.select('_content', is_card(rules))}, card -> {parts}), c -> c.a IS NOT NULL)"
    thumb = let("s", non_empty("c.img.attrs['src']"), f"CASE WHEN s IS NOT NULL THEN {make_abs('base', 's')} END")
    item = (f"struct(coalesce({non_empty(D.text('c.a', ''))}, {D.text('c.card', '')}) AS title, "
            f"{make_abs('base', D.attr('href', 'c.a'))} AS url, {D.text('c.excerpt', '')} AS excerpt, "
            f"{thumb} AS thumb, cast(null AS string) AS date)")
    return f"CASE WHEN page_type = 'CollectionPage' THEN transform({cards}, c -> {item}) END"


def collection_sql() -> str:
    """The collection branch, from ``_items``, ``h1`` and ``head``."""
    return (f"CASE WHEN page_type = 'CollectionPage' THEN struct({falsy_coalesce('h1', TITLE)} AS name, "
            "cast(null AS string) AS description, struct(1 AS page, cast(null AS int) AS total_pages) AS pagination, "
            "_items AS items) END")


def with_collection(pages: DataFrame, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``collection`` for CollectionPage pages, null for others."""
    if "collection" in pages.columns:
        return pages
    pages = D.add(with_headings(with_head(with_content(pages, rules))), _items=items_sql(rules))
    return D.add(pages, collection=collection_sql()).drop("_items")


def article_facts(pages: DataFrame, key: str = "page_id", rules: Rules = DEFAULTS, site_origin: str | None = None) -> DataFrame:
    return with_article(of_site(pages, site_origin, rules), rules).select(key, F.explode_outer(F.array("article")).alias("a")).where(
        "a IS NOT NULL").select(key, "a.*")


def product_facts(pages: DataFrame, key: str = "page_id", rules: Rules = DEFAULTS, site_origin: str | None = None) -> DataFrame:
    return with_product(of_site(pages, site_origin, rules), rules).select(key, F.explode_outer(F.array("product")).alias("p")).where(
        "p IS NOT NULL").select(key, "p.name", "p.sections.*")


def collection_items(pages: DataFrame, key: str = "page_id", rules: Rules = DEFAULTS, site_origin: str | None = None) -> DataFrame:
    """``(page_id, pos, title, url, excerpt, thumb)`` of collection pages."""
    rows = D.item_rows(with_collection(of_site(pages, site_origin, rules), rules), key, "collection.items", "pos", "item")
    return rows.select(key, "pos", "item.title", "item.url", "item.excerpt", "item.thumb")
