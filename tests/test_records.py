"""Hand-written pages, one per behaviour that is easy to get wrong."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import content, entities
from corpusloom.operators.profiles import attach_profile
from corpusloom.operators.records import build_records, harvest_results, with_record_hash
from corpusloom.rules import Rules
from corpusloom.sources.fetched import from_pages
from corpusloom.sources.shred import shred_pages

URL = "https://site.example/a/b/page?q=1"
LONG = "This sentence is long enough to be counted as a block of text."


def ld(value) -> str:
    text = value if isinstance(value, str) else json.dumps(value)
    return f'<script type="Application/LD+JSON">{text}</script>'


def article(body: str, **extra) -> str:
    return ld({"@type": "Article", **extra}) + body


def product(body: str, **extra) -> str:
    return ld({"@type": "Product", **extra}) + body


CARDS = "".join(f'<div class="card"><a href="/{i}">card {i}</a></div>' for i in range(3))
PAGES = {
    # containers and boilerplate
    "h1_in_header": "<title> The  Title </title><main><header><h1>Lost</h1></header><h1>Kept</h1></main>",
    "h1_only_in_header": "<title></title><article><header><h1>Lost</h1></header><p>x</p></article>",
    "main_role": "<main><h1>first</h1></main><main role=main><h1>second</h1></main>",
    "container_is_boilerplate": '<body class="pagination"><h1>body stays</h1><form><h1>f</h1></form></body>',
    "nested_boilerplate": '<main><nav><aside><h1>x</h1></aside></nav><div id="comments"><h2>c</h2></div><h2>ok</h2></main>',
    "article_container": article('<main><h1>main</h1></main><article class="post x"><div class="entry-content"><h1>post</h1></div></article>'),
    "theme_container": article('<div class="entry-content"><h1>e</h1></div><div class="elementor-widget-theme-post-content"><h1>t</h1></div>'),
    "no_body": "<!-- nothing -->",
    "bare_text": LONG,
    # text
    "nbsp_text": "<main><h1>a&nbsp;  b<b>c</b></h1><h2>x<i>y</i></h2><h3> </h3></main>",
    "blocks": (f"<main><p>{LONG}</p><p>short</p><li>twenty characters ok</li><li>nineteen characters</li>"
               f"<blockquote>{LONG}</blockquote><li>x <p>{LONG}!</p></li></main>"),
    "unclosed": f"<main><p><b>{LONG}<p>{LONG} Two<br>three</main>",
    "article_fallback": article("<article><div>Only  a <b>few</b> words</div><nav>menu</nav></article>"),
    "script_text": f"<main><p>{LONG}<script>var x</script><style>p</style><template>t</template></p></main>",
    # tables
    "nested_tables": "<main><table><tr><td>a<table><tr><td>b</td></tr></table></td></tr><tr><td> </td></tr></table><table></table></main>",
    # links and images
    "links": ('<main><a href="mailto:x@y.z">m</a><a href="#frag">f</a><a href="">e</a><a>none</a><a href=" /f.PDF ">d</a>'
              '<a href="https://o.example/f.zip">z</a><a href="/g.pdf?x=1">q</a><a href="//SITE.example/up">h</a>'
              '<a href="../c">r</a><a href="../c">again</a></main>'),
    "images": ('<main><img src="" data-src="i.png" alt=" a  b "><img><img data-lazy-src="/l.png">'
               '<img src="data:x" alt="d"></main>'),
    # head
    "head": ('<link rel="nofollow CANONICAL" href=" ../c "><link rel=canonical href=/other><meta name=description>'
             '<meta name="x-Robots-tag" content=" no  index "><meta property="OG:a" content="1"><meta property="og:A" content="2">'
             '<meta property="og:b" content=""><meta name="Twitter:card" content=" raw  kept ">'),
    "dates_order": (ld([{"dateCreated": "c1", "datePublished": ""}, {"datePublished": "p2", "dateModified": 5}])
                    + '<meta property="article:modified_time" content="m"><meta property="og:updated_time" content="u">'),
    "date_updated_time": '<meta property="article:modified_time" content=""><meta property="og:updated_time" content="u">',
    # JSON-LD
    "duplicate_keys": ld('{"@type":"WebSite","@type":"Product","name":"last"}'),
    "byte_order_mark": ld('﻿{"@type":"NewsArticle"}'),
    "bad_json": ld("{not json") + ld("[]") + ld("3") + ld('{"@type":["a"," ProDuct "]}'),
    "graph": ld({"@graph": [{"@type": "WebSite"}, 7, {"@graph": [{"@type": "Product"}]}]}),
    "graph_not_list": ld({"@graph": {"@type": "Product"}, "@type": "Thing"}),
    # breadcrumbs
    "crumbs_jsonld": ld({"@type": "BreadcrumbList", "itemListElement": [
        {"position": 2, "item": {"name": "B", "@id": "/b"}}, {"position": 1, "item": {"name": "A"}},
        {"name": "no item"}, {"item": "https://x"}, 5, {"item": {"name": ""}}]}) + '<div class="breadcrumb"><a>dom</a></div>',
    "crumbs_dom": ld({"@type": "BreadcrumbList", "itemListElement": []}) + (
        '<nav aria-label="Main BreadCrumb x"><a href="/h"> Home </a><a href="/e"> </a><a>Here</a></nav>'),
    # classification
    "paged_cards": f'<main>{CARDS}<a class="x next">n</a></main>',
    "paged_two_cards": '<main><article>1</article><div class="entry">2</div></main><div class="pagination"></div>',
    "next_on_div": f'<main>{CARDS}<div class="next">n</div></main>',
    "item_list": ld({"@type": "ItemList"}) + "<main><h1>L</h1></main>",
    "product_wins": ld([{"@type": "Article"}, {"@type": "product"}]),
    # products
    "type_list_product": ld({"@type": ["Product"], "name": "ignored"}) + "<main><h1>H</h1></main>",
    "sections": product(
        "<main><h2>Description of packing:</h2><div><p>wrapped</p></div><h2>Overview</h2><p>one</p><ul><li>two</li></ul>"
        "<h5>h5</h5><ol><li>three</li></ol><p> </p><h3>Description</h3><p>late</p><h2>Packing</h2><p>box</p></main>", name="N"),
    "spec_tables": product(
        "<main><h2>Grades</h2><table><tr><td>1</td></tr></table><h3>Specifications</h3><p>text</p><table><tr><td>2</td></tr></table>"
        "<h4>Technical data</h4><table><tr><td>3</td></tr></table></main>", name=""),
    "heading_in_wrapper": product("<main><div><h2>Uses</h2></div><p>outside</p><div><h2>Uses</h2><p>inside</p></div></main>"),
    # articles
    "author_string": article("<main></main>", author="Plain"),
    "author_list": article("<main></main>", author=["x", {"name": 5}, {"name": "Ann"}, {"name": "Bob"}]),
    "tags": article('<meta property="article:tag" content=" b "><meta property="article:section" content="  ">'
                    '<meta property="article:section" content="second"><main></main>', keywords="a, ,b", articleSection=["s ", 4, ""]),
    "meta_in_boilerplate": article('<main><nav><meta property="article:tag" content="gone"></nav></main>', keywords=["k "]),
    "image_string": article('<main><img src="/x.png"></main>', image="rel.png"),
    "image_list": article("<main></main>", image=[{"url": 3}, {"url": "u.png"}, "s.png"]),
    "image_og": article('<meta property="og:image:url" content="o2"><meta property="og:image" content="o1"><main></main>'),
    "image_content": article('<main><img src="data:1"><img src="/l.png" alt="Site LOGO"><img src="/p.png" alt=""></main>'),
    # collections
    "nested_cards": ld({"@type": "CollectionPage"}) + (
        '<main><article><div class="card"><a href="/x"></a> text <img data-src="/lazy.png"></div><p class="Post-Excerpt">ex</p></article>'
        '<div class="card">no link</div></main>'),
}


@pytest.fixture(scope="module")
def records(spark):
    rows = [(name, URL, html) for name, html in PAGES.items()]
    rows.append(("listing", "https://SITE.example/Products//", product("<main></main>")))
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    built = build_records(shred_pages(from_pages(pages)), keep=("page_id",))
    as_json = built.select("page_id", F.to_json(F.struct(*built.columns), {"ignoreNullFields": "false"}).alias("j"))
    return {row.page_id: json.loads(row.j) for row in as_json.collect()}


def h1(record):
    return record["content"]["h1"]


def kind(record):
    return record["document_identifier"]["page_type"]


def test_boilerplate_and_title(records):
    assert h1(records["h1_in_header"]) == "Kept"
    assert records["h1_in_header"]["document_identifier"]["title"] == "The Title"
    assert h1(records["h1_only_in_header"]) is None
    assert records["h1_only_in_header"]["document_identifier"]["title"] is None
    assert h1(records["container_is_boilerplate"]) == "body stays"
    assert [h["text"] for h in records["nested_boilerplate"]["content"]["headings"]] == ["ok"]


def test_container_choice(records):
    assert h1(records["main_role"]) == "second"
    assert h1(records["article_container"]) == "post"
    assert h1(records["theme_container"]) == "t"
    assert records["no_body"]["content"]["text_blocks"] == []
    assert records["bare_text"]["content"]["text_blocks"] == [LONG]


def test_text_rules(records):
    content = records["nbsp_text"]["content"]
    assert content["h1"] == "a bc"
    assert content["headings"] == [{"tag": "h2", "text": "xy"}, {"tag": "h3", "text": ""}]
    assert records["blocks"]["content"]["text_blocks"] == [LONG, "twenty characters ok", f"x {LONG}!", f"{LONG}!"]
    assert records["unclosed"]["content"]["text_blocks"] == [LONG, f"{LONG} Two three"]
    assert records["article_fallback"]["content"]["text_blocks"] == ["Only a few words"]
    assert records["script_text"]["content"]["text_blocks"] == [LONG]


def test_nested_tables(records):
    assert records["nested_tables"]["content"]["tables"] == [[["a b", "b"], ["b"]], [["b"]]]


def test_links(records):
    content = records["links"]["content"]
    assert content["links_internal"] == sorted({
        f"{URL}#frag", URL, "https://site.example/g.pdf?x=1", "https://SITE.example/up", "https://site.example/a/c"})
    assert [x["text"] for x in content["links_internal_rich"]] == ["f", "e", "q", "h", "r", "again"]
    assert content["links_external"] == ["mailto:x@y.z"]
    assert content["downloads"] == [{"href": "https://site.example/f.PDF", "text": "d"},
                                    {"href": "https://o.example/f.zip", "text": "z"}]


def test_images(records):
    assert records["images"]["content"]["images"] == [
        {"src": "https://site.example/a/b/i.png", "alt": "a b"}, {"src": "https://site.example/l.png", "alt": ""},
        {"src": "data:x", "alt": "d"}]


def test_head(records):
    record = records["head"]
    meta = record["page_meta"]
    assert record["document_identifier"]["canonical"] == "https://site.example/a/c"
    assert meta["meta_description"] == "" and meta["robots"] == "no index"
    assert meta["og"] == {"og:a": "2"} and meta["twitter"] == {"twitter:card": " raw  kept "}
    assert records["blocks"]["page_meta"]["og"] is None
    assert records["blocks"]["document_identifier"]["canonical"] == URL


def test_dates(records):
    assert records["dates_order"]["page_meta"]["dates"] == {"published": "c1", "modified": "m"}
    assert records["date_updated_time"]["page_meta"]["dates"] == {"published": None, "modified": "u"}


def test_jsonld(records):
    assert records["duplicate_keys"]["product"]["name"] == "last"
    assert kind(records["byte_order_mark"]) == "Article"
    assert len(records["bad_json"]["jsonld"]) == 1 and kind(records["bad_json"]) == "Product"
    assert [o.get("@type") for o in records["graph"]["jsonld"]] == ["WebSite", None] and kind(records["graph"]) == "WebPage"
    assert kind(records["graph_not_list"]) == "WebPage"


def test_breadcrumbs(records):
    assert records["crumbs_jsonld"]["page_meta"]["breadcrumbs"] == [
        {"name": "B", "url": "https://site.example/b"}, {"name": "A", "url": None}]
    assert records["crumbs_dom"]["page_meta"]["breadcrumbs"] == [
        {"name": "Home", "url": "https://site.example/h"}, {"name": "Here", "url": None}]


def test_classification(records):
    assert kind(records["paged_cards"]) == "CollectionPage"
    assert kind(records["paged_two_cards"]) == "WebPage"
    assert kind(records["next_on_div"]) == "WebPage"
    assert kind(records["item_list"]) == "CollectionPage"
    assert kind(records["product_wins"]) == "Product"
    assert kind(records["listing"]) == "WebPage"


def test_product(records):
    assert records["type_list_product"]["product"]["name"] == "H"
    sections = records["sections"]["product"]["sections"]
    assert sections["description_of_product"] == "one\n\ntwo\n\nthree" and sections["packing"] == "box"
    assert sections["faqs"] == [] and sections["what_is_product"] is None
    specs = records["spec_tables"]["product"]["sections"]
    assert specs["grades_specs"] == [[["1"]], [["2"]]] == specs["specifications"]["tables"]
    assert specs["specifications"]["text"] == "text"
    uses = records["heading_in_wrapper"]["product"]["sections"]
    assert uses["uses_applications"] == uses["applications_and_uses"] == "inside" and uses["grades_specs"] is None


def test_article(records):
    assert records["author_string"]["article"]["author"] is None
    assert records["author_list"]["article"]["author"] == "Ann"
    assert records["tags"]["article"]["tags"] == ["a", "b"]
    assert records["tags"]["article"]["categories"] == ["", "s"]
    assert records["meta_in_boilerplate"]["article"]["tags"] == ["k"]
    images = {k: records[k]["article"]["featured_image"] for k in PAGES if k.startswith("image_")}
    assert images == {"image_string": {"src": "rel.png", "alt": None}, "image_list": {"src": "u.png", "alt": None},
                      "image_og": {"src": "o1", "alt": None},
                      "image_content": {"src": "https://site.example/p.png", "alt": None}}


def test_collection(records):
    collection = records["nested_cards"]["collection"]
    assert collection["pagination"] == {"page": 1, "total_pages": None}
    assert collection["items"] == [
        {"title": "text ex", "url": "https://site.example/x", "excerpt": "ex", "thumb": None, "date": None},
        {"title": "text", "url": "https://site.example/x", "excerpt": None, "thumb": None, "date": None}]
    assert records["blocks"]["collection"] is None and records["blocks"]["product"] is None


def test_fetch_outcomes(spark):
    rows = [("u1", "f1", 404, "<p>x"), ("u2", "f2", 200, ""), ("u3", "u3", 0, None), ("u4", "https://f.example/4", 200, "<title>t")]
    fetched = spark.createDataFrame(rows, "requested_url string, final_url string, status int, html string")
    got = {r.url: r for r in harvest_results(fetched).collect()}
    assert [(got[u].ok, got[u].status, got[u].error) for u in ("u1", "u2", "u3", "u4")] == [
        (False, 404, "HTTP 404"), (False, 200, "HTTP 200"), (False, 0, "HTTP 0"), (True, 200, None)]
    assert got["u1"].record is None and got["u4"].record.document_identifier.title == "t"


def test_parse_failure_keeps_the_row(spark, monkeypatch):
    from corpusloom.sources import shred

    nodes = shred._Nodes()
    monkeypatch.setattr(shred._Nodes, "_end", lambda self, tag: 1 / 0)
    for html in ("<p class='a b'>x</p>", "plain"):
        nodes.page(html)
    dom, errors = nodes.columns()
    assert errors.to_pylist() == ["ZeroDivisionError: division by zero", None]
    assert [len(d) for d in dom.to_pylist()] == [0, 5]


def test_profile(spark, records):
    pages = spark.createDataFrame([("https://A.example:80/x",), ("https://b.example/",)], "url string")
    profiles = spark.createDataFrame([("a.EXAMPLE:80", '{"n":1}'), ("a.example:80", '{"n":1}')], "host string, profile string")
    clash = profiles.union(spark.createDataFrame([("a.example:80", '{"n":2}')], "host string, profile string"))
    with pytest.raises(Exception, match="different profiles"):
        attach_profile(pages, clash).collect()
    got = attach_profile(pages, profiles).select("url", F.to_json("company_fixed").alias("p")).collect()
    assert sorted((r.url, r.p) for r in got) == [("https://A.example:80/x", '{"n":1}'), ("https://b.example/", None)]


def test_own_rules(spark):
    rules = Rules(min_block=3, boilerplate_tags=("section",), download_extensions=(".txt",), card_classes=("tile",),
                  section_patterns=(("packing", (r"\bboxes\b",)),))
    html = (product("<main><nav><p>kept</p></nav><section><p>gone</p></section><a href='/a.txt'>t</a><a href='/a.pdf'>p</a>"
                    "<h2>Boxes</h2><p>two</p><h2>Uses</h2><p>none</p></main>"))
    pages = from_pages(spark.createDataFrame([("1", URL, html)], "page_id string, url string, html string"))
    got = build_records(shred_pages(pages), rules=rules).first()
    assert got.content.text_blocks == ["kept", "two", "none"]
    assert [d.href[-5:] for d in got.content.downloads] == ["a.txt"]
    assert got.product.sections.packing == "two" and got.product.sections.uses_applications is None


def test_records_need_no_shuffle(spark):
    pages = from_pages(spark.createDataFrame([("1", URL, "<p>x")], "page_id string, url string, html string"))
    plan = with_record_hash(build_records(shred_pages(pages)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_facts_follow_the_site_that_is_named(spark):
    """A page below the listing path of its own host, but of another site, is a product; so is its content found."""
    html = '<script type="application/ld+json">{"@type":"Product"}</script><main><h2>a</h2></main><div class="entry-content"><h2>Grades</h2><table><tr><td>1</td></tr></table><p>x</p></div>'
    page = spark.createDataFrame([(1, "https://m.example/products", html)], "page_id long, url string, html string")
    pages = shred_pages(from_pages(page))
    assert entities.product_facts(pages).count() == 0
    assert entities.product_facts(pages, site_origin="https://www.example").count() == 1
    assert [r.text for r in content.headings(pages).collect()] == ["a"]
    assert [r.text for r in content.headings(pages, site_origin="https://www.example").collect()] == ["Grades"]
    assert content.table_cells(pages).count() == 0 and content.table_cells(pages, site_origin="https://www.example").count() == 1
