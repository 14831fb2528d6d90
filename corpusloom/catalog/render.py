"""Site-like pages rendered from table columns, for round-trip checks of the extractors.

Every function maps a table to ``(page_key, url, html)`` row by row (collections
group by a slice of the primary key, at most ``CARDS_PER_PAGE`` rows each), so
rendering scales with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CARDS_PER_PAGE = 1000


def escape(column: str) -> str:
    out = column
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = f"replace({out}, '{raw}', '{entity}')"
    return out


def _page(df: DataFrame, key: str, url: str, head: str, body: str, *keep: str) -> DataFrame:
    html = f"concat('<!DOCTYPE html><html><head>', {head}, '</head><body>', {body}, '</body></html>')"
    return df.selectExpr(*keep, f"{key} AS page_key", f"{url} AS url", f"{html} AS html")


def products(part: DataFrame) -> DataFrame:
    """Four layouts of a product page by ``p_size % 4``."""
    name = "concat(p_name, ' ', p_brand)"
    ld = ("concat('<title>', p_name, ' | shop</title><script type=\"application/ld+json\">{\"@type\":\"Product\",\"name\":\"', "
          f"{name}, '\"}}</script>')")
    layouts = (
        # a description and a table without text under "Specifications"
        "concat('<h2>Description</h2><p>The ', p_name, ' made by ', p_brand, '.</p>"
        "<h2>Specifications:</h2><table><tr><th>Size</th><th>Kind</th></tr><tr><td>', p_size, '</td><td>', p_type, '</td></tr></table>')",
        # a heading with a table only, one with text and table, one that comes too late
        "concat('<h3>Technical Data</h3><table><tr><td>first</td><td>', p_size, '</td></tr></table>"
        "<h3>Grades</h3><p>Grade ', p_type, '</p><table><tr><td>second</td><td>', p_brand, '</td></tr></table>"
        "<h3>Specification</h3><p>late</p><table><tr><td>third</td></tr></table>')",
        # content in a wrapper is not part of the section; lists give one text per item
        "concat('<h2>Overview</h2><div><p>wrapped ', p_name, '</p></div>"
        "<h2>Packing</h2><ul><li>box of ', p_size, '</li><li>', p_type, ' pallet</li></ul>"
        "<h4>Applications and Uses</h4><p>Use <b>', p_name, '</b> daily</p>')",
        # h5 does not end a section, and the first heading with text fills it
        "concat('<h3>What is ', p_name, '?</h3><p>A ', p_name, '.</p><h5>aside</h5><p>By ', p_brand, '.</p>"
        "<h2>Other names</h2><blockquote>', p_type, ' ', p_name, '</blockquote><h2>About</h2><h2>Introduction</h2><p>Hello ', p_brand, '</p>')",
    )
    cases = " ".join(f"WHEN {i} THEN {layout}" for i, layout in enumerate(layouts))
    body = f"concat('<nav><a href=\"/\">home</a></nav><main><h1>', p_name, '</h1>', CASE p_size % 4 {cases} END, '</main>')"
    return _page(part, "p_partkey", "concat('https://shop.example.com/product/', p_partkey)", ld, body)


def articles(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One article per document: JSON-LD, meta tags, one paragraph per line of text."""
    joined = documents.join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left")
    ld = ("concat('<title>', source, ' story ', doc_id, '</title><script type=\"application/ld+json\">{\"@graph\":[{\"@type\":\"Article\",\"author\":{\"name\":\"', "
          "source, '\"},\"keywords\":\"', lang, ', ', source, ', ,', lang, '\",\"articleSection\":[\" ', lang, ' \",7]},{\"@type\":\"WebSite\"}]}</script>')")
    metas = ("CASE WHEN quality IS NULL THEN '' ELSE concat('<meta property=\"article:tag\" content=\"quality-', quality, '\">"
             "<meta property=\"article:section\" content=\"toxic-', toxic, '\">') END")
    body = (f"concat('<header><h1>lost</h1></header><div class=\"x entry-content\"><h1>', source, ' story</h1><p>', "
            f"replace({escape('text')}, '\\n', '</p><p>'), '</p><form><p>Leave a comment, it is read by nobody at all here</p></form></div>')")
    return _page(joined, "doc_id", "concat('https://news.example.com/', lang, '/', doc_id)",
                 f"concat({ld}, {metas})", body)


def blockless_articles(documents: DataFrame) -> DataFrame:
    """Articles whose text sits in a plain division, so the whole container is the only block."""
    ld = "'<script type=\"application/ld+json\">{\"@type\":\"NewsArticle\"}</script>'"
    return _page(documents, "doc_id", "concat('https://flat.example.com/', doc_id)", ld,
                 f"concat('<article><div>', {escape('text')}, '</div></article>')")


def collections(supplier: DataFrame) -> DataFrame:
    """Listing pages per nation and key range, one card per supplier.

    ``s_suppkey`` is the primary key, so a page holds at most ``CARDS_PER_PAGE`` cards.
    Every tenth nation has cards without links; every fifth says it is a collection.
    """
    card = ("concat('<div class=\"card\">', CASE WHEN s_nationkey % 10 = 0 THEN '' ELSE "
            "concat('<a href=\"/s/', s_suppkey, '\">', s_name, '</a>') END, "
            "CASE WHEN s_suppkey % 2 = 0 THEN concat('<p class=\"card-Excerpt\">No ', s_suppkey, '</p>') ELSE '' END, "
            "CASE WHEN s_suppkey % 3 = 0 THEN concat('<img src=\"../i/', s_suppkey, '.png\">') ELSE '<img data-src=\"/lazy.png\">' END, '</div>')")
    pages = (supplier.selectExpr("s_nationkey", f"floor(s_suppkey / {CARDS_PER_PAGE}) AS sheet", "s_suppkey", f"{card} AS card")
             .groupBy("s_nationkey", "sheet")
             .agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "card"))).alias("cards"))
             .selectExpr("s_nationkey", "sheet", "array_join(cards.card, '') AS cards"))
    head = ("CASE WHEN s_nationkey % 5 = 0 THEN '<script type=\"application/ld+json\">{\"@type\":[\"WebPage\",\"CollectionPage\"]}</script>' ELSE '' END")
    body = "concat('<main><h1>Nation ', s_nationkey, '</h1>', cards, '<div class=\"pagination\">1</div></main>')"
    return _page(pages, "concat(s_nationkey, '-', sheet)",
                 "concat('https://list.example.com/n/', s_nationkey, '/', sheet)", head, body)


def order_heads(orders: DataFrame) -> DataFrame:
    """Head metadata with repeated keys, canonical links of three kinds, dates from three sources."""
    day = "date_format(o_orderdate, 'yyyy-MM-dd')"
    head = (
        "concat('<title>  Order ', o_orderkey, '\\n ', o_orderpriority, '</title>',"
        "'<meta property=\"OG:Title\" content=\"old\"><meta property=\"og:title\" content=\"Order ', o_orderkey, '\"><meta property=\"og:empty\" content=\"\">',"
        "'<meta name=\"twitter:site\" content=\"@', o_orderstatus, '\">',"
        "'<meta name=\"Description\" content=\" priority  ', o_orderpriority, ' \"><meta name=\"googlebot-robots\" content=\"noindex\">',"
        "CASE o_orderkey % 3 WHEN 0 THEN concat('<link rel=\"alternate\" href=\"/x\"><link rel=\"Canonical\" href=\" ../c/', o_orderkey, ' \">')"
        " WHEN 1 THEN concat('<link rel=\"canonical\" href=\"https://other.example.com/', o_custkey, '\">') ELSE '' END,"
        f"CASE o_custkey % 3 WHEN 0 THEN concat('<script type=\"application/ld+json\">[{{\"dateCreated\":\"', {day}, '\",\"datePublished\":7}},{{\"dateModified\":\"m', {day}, '\"}}]</script>')"
        f" WHEN 1 THEN concat('<meta property=\"article:published_time\" content=\"', {day}, '\"><meta property=\"article:modified_time\" content=\"\"><meta property=\"og:updated_time\" content=\"u', {day}, '\">')"
        " ELSE '' END)")
    return _page(orders, "o_orderkey", "concat('https://orders.example.com/o/p/', o_orderkey)", head, "'<p>x</p>'")


def trails(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Breadcrumbs region, nation, customer: as JSON-LD, or as a navigation element."""
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    named = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    ld = ("concat('<script type=\"application/ld+json\">{\"@type\":\"BreadcrumbList\",\"itemListElement\":[{\"item\":{\"name\":\"', r_name, "
          "'\",\"@id\":\"/r/', r_regionkey, '\"}},{\"name\":\"ignored\"},{\"item\":{\"name\":\"', n_name, '\"}},{\"item\":{\"name\":\"', c_name, '\",\"@id\":\"?c=', c_custkey, '\"}}]}</script>')")
    nav = ("concat('<nav aria-label=\"Breadcrumbs\"><a href=\"/r/', r_regionkey, '\">', r_name, '</a><a href=\"\"> </a><a>', n_name, "
           "'</a><a href=\"?c=', c_custkey, '\"><i>', c_name, '</i></a></nav>')")
    in_head = "c_mktsegment IN ('BUILDING', 'MACHINERY')"
    return _page(named, "c_custkey", "concat('https://trail.example.com/c/', c_custkey)",
                 f"CASE WHEN {in_head} THEN {ld} ELSE '' END", f"CASE WHEN {in_head} THEN '' ELSE {nav} END")


def order_tables(orders: DataFrame) -> DataFrame:
    """A ragged table with a blank row, and a second table nested in a cell."""
    body = ("concat('<table><tr><th>Status<th>Priority</tr><tr><td>', o_orderstatus, '<td> ', o_orderpriority, ' </tr>"
            "<tr><td> <td>&nbsp;</tr><tr><td>Customer <b>', o_custkey, '</b><table><tr><td>in', o_orderkey, '</table></table>')")
    return _page(orders, "o_orderkey", "concat('https://orders.example.com/t/', o_orderkey)", "''", body)


def part_media(part: DataFrame) -> DataFrame:
    """Images with three source attributes, and links of every kind."""
    img = ("CASE p_size % 3 WHEN 0 THEN concat('<img src=\"/img/', p_partkey, '.png\" alt=\" a  ', p_name, '\">') "
           "WHEN 1 THEN concat('<img src=\"\" data-src=\"img/', p_partkey, '.png\" data-lazy-src=\"x\">') "
           "ELSE concat('<img data-lazy-src=\"//cdn.example.org/', p_partkey, '.png\"><img alt=\"none\">') END")
    href = ("CASE p_size % 10 WHEN 0 THEN concat('/files/', p_partkey, '.PDF') WHEN 1 THEN concat('../up/', p_partkey) "
            "WHEN 2 THEN concat('?id=', p_partkey) WHEN 3 THEN concat('#s', p_partkey) WHEN 4 THEN concat('mailto:a', p_partkey, '@example.com') "
            "WHEN 5 THEN concat('https://other.example.com/', p_partkey, '.zip?x=1') WHEN 6 THEN '' "
            "WHEN 7 THEN concat(' ./a/./b/../', p_partkey, '/.. ') WHEN 8 THEN concat('//MEDIA.example.com:80/', p_partkey) "
            "ELSE concat('/a//b/', p_partkey) END")
    body = f"concat('<main>', {img}, '<a href=\"', {href}, '\">go <i>', p_name, '</i></a><a name=\"x\">anchor</a></main>')"
    return _page(part, "p_partkey", "concat('https://media.example.com:80/p/', p_brand, '/q/', p_partkey)", "''", body).withColumn(
        "url", F.regexp_replace("url", "#", ""))


def sitemaps(pages: DataFrame, per_sitemap: int = 50) -> DataFrame:
    """Child sitemaps of at most ``per_sitemap`` URLs per host and key range, and one index per host.

    Hosts on ``https`` get malformed XML. Every child also lists a page of another host,
    an image location and one URL twice; every index also lists a foreign and a missing child.
    """
    host = "lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1))"
    chunks = pages.selectExpr(f"{host} AS host", f"floor(page_id / {per_sitemap}) AS chunk", "page_id", "url")
    entry = (f"concat('<url><loc> ', {escape('url')}, ' </loc><image:image><image:loc>http://', host, '/i.png</image:loc></image:image></url>')")
    children = (
        chunks.withColumn("entry", F.expr(entry)).groupBy("host", "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("page_id", "entry"))).alias("es"))
        .selectExpr(
            "concat('https://', host, '/map-', chunk, '.xml') AS sitemap_url", "200 AS status",
            "concat('<urlset xmlns=\"http://www.sitemaps.org/schemas/sitemap/0.9\" xmlns:image=\"http://www.google.com/schemas/sitemap-image/1.1\">', "
            "array_join(es.entry, ''), es[0].entry, '<url><loc>https://elsewhere.example/x</loc></url>', "
            "CASE WHEN chunk % 2 = 1 THEN '<url>' ELSE '</urlset>' END) AS xml", "false AS is_index"))
    index = (
        chunks.select("host", "chunk").distinct()
        .withColumn("book", F.expr(f"floor(chunk / {per_sitemap})"))
        .groupBy("host", "book").agg(F.array_sort(F.collect_list(
            F.expr("concat('<sitemap><loc>https://', host, '/map-', chunk, '.xml</loc></sitemap>')"))).alias("es"))
        .selectExpr(
            "concat('https://', host, '/index-', book, '.xml') AS sitemap_url", "200 AS status",
            "concat('<sm:sitemapindex xmlns:sm=\"http://www.sitemaps.org/schemas/sitemap/0.9\">', "
            "replace(replace(array_join(es, ''), '<', '<sm:'), '<sm:/', '</sm:'), "
            "'<sm:sitemap><sm:loc>https://elsewhere.example/map.xml</sm:loc></sm:sitemap>', "
            "'<sm:sitemap><sm:loc>https://', host, '/missing.xml</sm:loc></sm:sitemap></sm:sitemapindex>') AS xml",
            "true AS is_index"))
    foreign = index.selectExpr("concat(sitemap_url, '?orphan') AS sitemap_url", "200 AS status",
                               "concat('<urlset><url><loc>', replace(sitemap_url, '.xml', '.html'), '</loc></url></urlset>') AS xml",
                               "false AS is_index")
    return children.unionByName(index).unionByName(foreign)
