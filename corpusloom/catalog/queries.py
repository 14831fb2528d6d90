"""One runnable query per operator; each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import render
from corpusloom.functions import dom as D
from corpusloom.functions import text as X
from corpusloom.functions import urls as U
from corpusloom.operators import changes, classify, containers, content, entities, head, jsonld, quality
from corpusloom.operators.carry import carry_forward
from corpusloom.operators.profiles import attach_profile
from corpusloom.operators.records import (
    build_records, doc_id, duplicate_docs, harvest_records, harvest_results, with_record_hash)
from corpusloom.plans import harvest as plans
from corpusloom.session import configure, new_work_path, stage
from corpusloom.sinks import corpora, tables
from corpusloom.sources import corpus, sitemap
from corpusloom.sources.fetched import FetchStore, from_pages
from corpusloom.sources.shred import Needs, nodes, shred_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of one split from which a table is dealt out anew, and the rows that a task then gets.
SPLIT_ROWS, TASK_ROWS = 100_000, 25_000


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table that feeds the page parser, dealt out so that no task gets more than a bounded number of rows.

    The small given tables are one split each, and are dealt to the cores. Splits grow with the file and never part a row group, so
    their rows are counted, which reads no column; a table with a large split is dealt into as many tasks as its rows need.
    """
    rows, cores = table(spark, sf_dir, name), spark.sparkContext.defaultParallelism
    splits = rows.rdd.getNumPartitions()
    held = rows.groupBy(F.spark_partition_id().alias("split")).count()
    total, most = held.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    if splits >= cores and most <= SPLIT_ROWS:
        return rows
    return rows.repartition(max(2 * cores, splits, -(-total // TASK_ROWS)))


def crawled(spark: SparkSession, sf_dir: str, needs: Needs | None = None) -> DataFrame:
    return shred_pages(from_pages(scan(spark, sf_dir, "pages")), needs)


def fetched(rendered: DataFrame) -> DataFrame:
    return rendered.select("page_key", F.col("url").alias("requested_url"), F.col("url").alias("final_url"),
                           F.lit(200).alias("status"), "html")


def shredded(rendered: DataFrame, needs: Needs | None = None) -> DataFrame:
    return shred_pages(fetched(rendered), needs)


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.products(scan(spark, sf_dir, "part"))


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.articles(scan(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def collection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.collections(table(spark, sf_dir, "supplier"))


def trail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.trails(scan(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


def mixed_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds of rendered pages together with the crawl; some fetches of the crawl fail."""
    crawl = scan(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("page_key"), "url", "html")
    failing = crawl.select(
        "page_key", F.col("url").alias("requested_url"), F.col("url").alias("final_url"),
        F.expr(STATUS).alias("status"), F.expr(BODY).alias("html"))
    rendered = [fetched(p.withColumn("page_key", F.col("page_key").cast("string"))) for p in (
        product_pages(spark, sf_dir), article_pages(spark, sf_dir), collection_pages(spark, sf_dir))]
    return reduce(DataFrame.unionByName, [*rendered, failing])


# How the crawl table stands for fetches that failed: by URL form.
STATUS = ("CASE WHEN url LIKE '%page=%' THEN 404 WHEN url LIKE 'https://m.%' THEN 0 ELSE 200 END")
BODY = "CASE WHEN url LIKE 'https://m.%' OR url LIKE '%.html' THEN '' ELSE html END"


# ---- node selection, containers, text ------------------------------------------------

@query
def node_counts(spark, sf_dir):
    """Elements per page and tag, all tags."""
    elements = nodes(crawled(spark, sf_dir)).where(F.col("tag").isNotNull())
    return elements.groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query
def page_titles(spark, sf_dir):
    return head.with_head(crawled(spark, sf_dir, head.TITLE_NEEDS)).select("page_id", "head.title")


@query
def page_h1(spark, sf_dir):
    return content.with_headings(crawled(spark, sf_dir, content.heading_needs())).select("page_id", "h1")


@query
def container_text(spark, sf_dir):
    """Chosen main container and its whole text."""
    pages = containers.with_container(crawled(spark, sf_dir), "main")
    return pages.select("page_id", F.col("container.tag").alias("container_tag"), F.expr(D.text("container", " ")).alias("text"))


@query
def stripped_body_text(spark, sf_dir):
    """Text of the body after boilerplate removal."""
    pages = D.add(crawled(spark, sf_dir), container=D.first("dom", D.tag_in("body")))
    return containers.strip_boilerplate(pages).select("page_id", F.expr(D.text("container", " ")).alias("text"))


@query
def stripped_content_links(spark, sf_dir):
    """Links left in the content; the crawl has all of its own in navigation, and gets some within articles and asides."""
    link = F.concat(F.lit('<a href="/x/'), "page_id", F.lit('">x</a>'))
    inside = F.concat(F.lit("<article>"), F.when(F.col("page_id") % 3 == 0, link).otherwise(""), F.lit("<aside>"), link, F.lit("</aside>"))
    pages = scan(spark, sf_dir, "pages").withColumn("html", F.replace("html", F.lit("<article>"), inside))
    return content.with_links(shred_pages(from_pages(pages), content.link_needs())).select("page_id", F.size("links").alias("n_links"))


@query
def text_blocks(spark, sf_dir):
    return content.text_blocks(crawled(spark, sf_dir))


@query
def page_links(spark, sf_dir):
    return content.links(crawled(spark, sf_dir, content.link_needs(whole_page=True)), whole_page=True)


@query
def link_counts_by_host(spark, sf_dir):
    """Links and distinct targets per site; targets are made distinct first, so a large site is no hot task."""
    found = content.links(crawled(spark, sf_dir, content.link_needs(whole_page=True)), whole_page=True)
    per_target = (found.select(F.expr(U.authority("href")).alias("host"), "href")
                  .groupBy("host", "href").agg(F.count(F.lit(1)).alias("n")))
    return per_target.groupBy("host").agg(F.sum("n").alias("n_links"), F.count(F.lit(1)).alias("n_targets"))


@query
def rendered_links(spark, sf_dir):
    """Relative, absolute, download, mail and empty references resolved and sorted into kinds."""
    return content.links(shredded(render.part_media(scan(spark, sf_dir, "part"))), key="page_key")


@query
def images(spark, sf_dir):
    return content.images(shredded(render.part_media(scan(spark, sf_dir, "part"))), key="page_key")


@query
def headings(spark, sf_dir):
    return content.headings(shredded(product_pages(spark, sf_dir)), key="page_key")


@query
def table_cells(spark, sf_dir):
    return content.table_cells(shredded(render.order_tables(scan(spark, sf_dir, "orders"))), key="page_key")


@query
def article_text_blocks(spark, sf_dir):
    """Blocks of rendered articles: article container, comment form removed, repeated lines kept once."""
    pages = classify.with_page_type(shredded(article_pages(spark, sf_dir)))
    return content.text_blocks(pages, key="page_key")


@query
def article_fallback_blocks(spark, sf_dir):
    """Articles without block elements: the whole container text is the one block."""
    pages = shredded(render.blockless_articles(scan(spark, sf_dir, "documents")))
    return content.text_blocks(classify.with_page_type(pages), key="page_key")


# ---- head, JSON-LD ----------------------------------------------------------------------

@query
def head_meta(spark, sf_dir):
    pages = head.with_head(shredded(render.order_heads(scan(spark, sf_dir, "orders")), head.HEAD_NEEDS))
    return pages.select(
        "page_key", "head.title", "head.canonical", "head.meta_description", "head.robots",
        F.col("head.og")["og:title"].alias("og_title"), F.size("head.og").alias("n_og"),
        F.col("head.twitter")["twitter:site"].alias("twitter_site"))


@query
def page_dates(spark, sf_dir):
    return head.page_dates(shredded(render.order_heads(scan(spark, sf_dir, "orders"))), key="page_key")


@query
def breadcrumbs(spark, sf_dir):
    trails = trail_pages(spark, sf_dir)
    return head.breadcrumbs(shredded(trails), key="page_key")


@query
def breadcrumb_trails(spark, sf_dir):
    """Trails as one string, the form of the site CSV."""
    trails = trail_pages(spark, sf_dir)
    return head.with_breadcrumbs(shredded(trails)).select(
        "page_key", F.array_join(F.col("breadcrumbs")["name"], " > ").alias("trail"))


@query
def jsonld_objects(spark, sf_dir):
    rows = jsonld.extract_jsonld(shredded(article_pages(spark, sf_dir)), key="page_key")
    return rows.select("page_key", "script_pos", "obj_pos",
                       F.try_variant_get("obj", '$["@type"]', "string").alias("type"),
                       F.try_variant_get("obj", "$.author.name", "string").alias("author"),
                       F.try_variant_get("obj", "$.keywords", "string").alias("keywords"))


@query
def jsonld_types(spark, sf_dir):
    stories = article_pages(spark, sf_dir).withColumn("page_key", F.col("page_key").cast("string"))
    pages = jsonld.with_jsonld(shredded(stories.unionByName(collection_pages(spark, sf_dir))))
    return D.item_rows(pages, "page_key", jsonld.flatten_types("jsonld"), "pos", "type")


# ---- classification and entities --------------------------------------------------------

@query
def classify_pages(spark, sf_dir):
    """Page type of every page of the mixed site."""
    pages = shred_pages(mixed_site(spark, sf_dir).where((F.col("status") == 200) & (F.col("html") != "")))
    return classify.with_page_type(pages).select("final_url", "page_type")


def _part_pages(spark, sf_dir, url: str, body: str) -> DataFrame:
    pages = scan(spark, sf_dir, "part").selectExpr("p_partkey AS page_key", f"{url} AS url", f"{body} AS html")
    return shredded(pages)


@query
def listing_pages(spark, sf_dir):
    """Product pages below the listing path, and the listing itself in any case and with closing slashes."""
    url = ("CASE p_size % 4 WHEN 0 THEN 'https://shop.example.com/products' WHEN 1 THEN 'https://SHOP.example.com/Products//' "
           "WHEN 2 THEN concat('https://shop.example.com/products/', p_partkey) ELSE concat('https://shop.example.com/productsx', p_partkey) END")
    pages = _part_pages(spark, sf_dir, url, """'<script type="application/ld+json">{"@type":"Product"}</script><p>x</p>'""")
    return classify.classify_pages(pages, "page_key", "https://shop.example.com")


@query
def odd_scripts(spark, sf_dir):
    """Scripts that are not one JSON value, and such with values that JSON lacks."""
    script = ("CASE p_size % 5 WHEN 0 THEN concat('{\"@type\":\"Product\",\"n\":', p_partkey, '}') WHEN 1 THEN '{\"@type\":\"Product\"};' "
              "WHEN 2 THEN '{\"@type\":\"Product\",\"weight\":NaN,\"far\":[-Infinity]}' WHEN 3 THEN '{\"@type\":\"Product\"}{\"a\":1}' "
              "ELSE concat('{\"@type\":\"Article\"} ', p_name) END")
    pages = _part_pages(spark, sf_dir, "concat('https://shop.example.com/p/', p_partkey)", f"concat('<script type=\"application/ld+json\">', {script}, '</script>')")
    return classify.classify_pages(pages, "page_key")


@query
def skipped_images(spark, sf_dir):
    """Image of articles after inline images, logos and avatars, which are none."""
    last = "CASE WHEN p_size % 3 > 0 THEN concat('<img src=\"/i/', p_partkey, '.png\" alt=\"', p_name, '\">') ELSE '' END"
    body = ("concat('<script type=\"application/ld+json\">{\"@type\":\"BlogPosting\"}</script><main><img src=\"data:image/png;base64,x\"><img src=\"/l.png\" alt=\"Our LOGO\">"
            f"<img src=\"/a.png\" alt=\"Avatar of ', p_brand, '\">', {last}, '</main>')")
    facts = entities.article_facts(_part_pages(spark, sf_dir, "concat('https://shop.example.com/p/', p_partkey)", body), key="page_key")
    return facts.select("page_key", F.col("featured_image.src").alias("src"), F.col("featured_image.alt").alias("alt"))


@query
def heading_sections(spark, sf_dir):
    """Product section of headings made from part names."""
    wording = ("CASE p_size % 13 WHEN 0 THEN 'Description of ' WHEN 1 THEN 'WHAT IS ' WHEN 2 THEN 'Also known as: ' "
               "WHEN 3 THEN 'Technical  specs ' WHEN 4 THEN 'Industries for ' WHEN 5 THEN 'Packing and storage - ' "
               "WHEN 6 THEN 'Reused ' WHEN 7 THEN 'Description of packing ' WHEN 8 THEN 'upgrades ' WHEN 9 THEN 'Grade ' "
               "WHEN 10 THEN 'Usage of ' WHEN 11 THEN ' : ' ELSE '' END")
    named = table(spark, sf_dir, "part").selectExpr("p_partkey", f"concat({wording}, p_name, ' ?:') AS heading")
    return named.select("p_partkey", F.expr(X.normalize_heading("heading")).alias("norm"),
                        F.expr(classify.classify_heading("heading")).alias("section"))


@query
def table_rules(spark, sf_dir):
    """Section of headings made from part names by rules from a table: the library's, then one per part material, some without a literal word."""
    part = table(spark, sf_dir, "part")
    wording = "CASE p_size % 7 WHEN 0 THEN 'Description of ' WHEN 1 THEN 'Industries for ' WHEN 2 THEN 'Made of ' WHEN 3 THEN 'packing, ' ELSE '' END"
    headings = part.selectExpr("p_partkey", f"concat({wording}, p_type, CASE WHEN p_size % 5 = 0 THEN ' 2nd' ELSE '' END) AS heading")
    kinds = part.selectExpr("lower(substring_index(p_type, ' ', -1)) AS kind").distinct()
    own = kinds.selectExpr("100 AS section_prio", "ascii(kind) AS pattern_prio", "concat('material ', kind) AS section", "concat('\\\\b', kind, '\\\\b') AS pattern")
    loose = kinds.selectExpr("50 AS section_prio", "ascii(kind) AS pattern_prio", "concat('second ', kind) AS section", "concat(kind, '.*\\\\d') AS pattern")
    rules = classify.section_rules(spark).unionByName(own).unionByName(loose)
    return classify.classify_headings(headings, rules).select("p_partkey", "norm", "section")


@query
def section_assign(spark, sf_dir):
    """As-of assignment: every turn belongs to the latest user turn of its conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    opens = F.when(F.col("role") == "user", F.col("turn"))
    return carry_forward(turns, "conv_id", "turn", opens, "opened_by")


@query
def product_facts(spark, sf_dir):
    facts = entities.product_facts(shredded(product_pages(spark, sf_dir)), key="page_key")
    return facts.select(
        "page_key", "name", "description_of_product", "what_is_product", "other_names",
        F.col("specifications.text").alias("specifications_text"), "applications_and_uses", "packing",
        F.coalesce(F.size("grades_specs"), F.lit(0)).alias("n_spec_tables"))


@query
def product_spec_cells(spark, sf_dir):
    """Cells of the specification tables of products."""
    facts = entities.product_facts(shredded(product_pages(spark, sf_dir)), key="page_key")
    rows = D.item_rows(facts, "page_key", "grades_specs", "t", "rows")
    rows = D.item_rows(rows, ("page_key", "t"), "rows", "r", "cells")
    return D.item_rows(rows, ("page_key", "t", "r"), "cells", "c", "text")


@query
def article_facts(spark, sf_dir):
    facts = entities.article_facts(shredded(article_pages(spark, sf_dir)), key="page_key")
    return facts.select("page_key", "headline", "author", F.array_join("categories", "|").alias("categories"),
                        F.array_join("tags", "|").alias("tags"))


@query
def featured_images(spark, sf_dir):
    """Image of articles that only have content images."""
    ld = "<script type=\"application/ld+json\">{\"@type\":\"BlogPosting\"}</script>"
    media = render.part_media(scan(spark, sf_dir, "part")).withColumn("html", F.concat(F.lit(ld), "html"))
    facts = entities.article_facts(shredded(media), key="page_key")
    return facts.select("page_key", F.col("featured_image.src").alias("src"), F.col("featured_image.alt").alias("alt"))


@query
def collection_items(spark, sf_dir):
    return entities.collection_items(shredded(collection_pages(spark, sf_dir)), key="page_key")


# ---- records, results, exports ------------------------------------------------------------

@query
def doc_ids(spark, sf_dir):
    return build_records(crawled(spark, sf_dir), keep=("page_id",)).select("page_id", "doc_id")


@query
def duplicate_bodies(spark, sf_dir):
    """Pages with equal title and text: the identifier without the URL, where it repeats."""
    pages = content.with_text_blocks(head.with_head(crawled(spark, sf_dir)))
    return duplicate_docs(pages.select(F.expr(doc_id("''", "head.title", "text_blocks")).alias("doc_id")))


@query
def harvest_outcomes(spark, sf_dir):
    """Result row of every fetch of the crawl, failures included."""
    rows = scan(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("requested_url"), F.col("url").alias("final_url"),
        F.expr(STATUS).alias("status"), F.expr(BODY).alias("html"))
    results = harvest_results(rows, keep=("page_id",))
    return results.select("page_id", "url", "final_url", "status", "ok", "error",
                          F.col("record.document_identifier.title").alias("title"))


@query
def harvest_errors(spark, sf_dir):
    return corpora.harvest_errors(harvest_results(mixed_site(spark, sf_dir)))


@query
def frontier_fetches(spark, sf_dir):
    """The frontier with its fetch results; URLs never fetched have status 0."""
    pages = table(spark, sf_dir, "pages")
    frontier = pages.select("url").distinct()
    done = from_pages(pages.where("url LIKE 'https://%'")).drop("page_id")
    store = FetchStore.create(done, new_work_path(spark, "fetched"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return store.pages(frontier).select("requested_url", "final_url", "status", F.length("html").alias("n_chars"))


@query
def site_pages_csv(spark, sf_dir):
    return tables.csv_site_pages(build_records(crawled(spark, sf_dir)))


def _flat(records: DataFrame, columns: list, page_type: str) -> DataFrame:
    """The columns of a flat file, staged before its filter, which would else run the extractor once more."""
    kind = F.col("document_identifier.page_type").alias("_kind")
    return stage(records.select(*columns, kind), "flat").where(F.col("_kind") == page_type).drop("_kind")


@query
def products_csv(spark, sf_dir):
    return _flat(build_records(shredded(product_pages(spark, sf_dir))), tables.product_columns(), "Product")


@query
def articles_csv(spark, sf_dir):
    return _flat(build_records(shredded(article_pages(spark, sf_dir))), tables.article_columns(), "Article")


@query
def list_sizes(spark, sf_dir):
    records = build_records(shredded(article_pages(spark, sf_dir)), keep=("page_key",))
    return quality.list_sizes(records, "page_key")


@query
def type_counts(spark, sf_dir):
    return quality.type_counts(harvest_results(mixed_site(spark, sf_dir)))


@query
def quality_metrics(spark, sf_dir):
    return quality.quality_metrics(harvest_records(mixed_site(spark, sf_dir)))


@query
def harvest_summary(spark, sf_dir):
    """Counts of the summary of a whole harvest of the mixed site."""
    results, records = plans.harvest(mixed_site(spark, sf_dir))
    summary = plans.harvest_summary(results, records, source="https://shop.example.com", generated_at=datetime(2025, 1, 2, 3, 4, 5, 678))
    return summary.select(
        "source", "generated_at", "counts.total_records", "counts.products", "counts.articles", "counts.pages", "counts.collections",
        "counts.errors", F.col("quality.site.total_records").alias("quality_total"),
        F.size("content_hashes").alias("n_corpora"))


@query
def jsonl_round_trip(spark, sf_dir):
    """Collections written as compressed JSON lines and read back, with the line that each would be written as again."""
    path = new_work_path(spark, "jsonl")
    corpora.write_jsonl(build_records(shredded(collection_pages(spark, sf_dir))), path, file_bytes=1 << 20)
    back = corpus.read_corpus(spark, path)
    return back.select("url", F.col("document_identifier.page_type").alias("page_type"), F.col("content.h1").alias("h1"),
                       F.size("collection.items").alias("n_items"))


@query
def jsonl_lines(spark, sf_dir):
    """The crawl written as compressed JSON lines: the hash of every line that a record read back would be written as."""
    path = new_work_path(spark, "jsonl")
    corpora.write_jsonl(build_records(crawled(spark, sf_dir)), path, file_bytes=256 << 10)
    return with_record_hash(corpus.read_corpus(spark, path)).select("url", "record_hash")


@query
def export_positions(spark, sf_dir):
    """Position of every record of the crawl in the written corpus, read back from its files."""
    path = new_work_path(spark, "jsonl")
    corpora.write_jsonl(build_records(crawled(spark, sf_dir)), path, file_bytes=256 << 10)
    return corpus.read_positions(spark, path).select(
        "position", F.col("document_identifier.canonical").alias("canonical"), F.col("document_identifier.page_type").alias("page_type"), "doc_id")


@query
def csv_round_trip(spark, sf_dir):
    """Product CSV with quotes, commas and line breaks, written and read back."""
    name = "concat('P \\\\\"', p_name, '\\\\\",\\\\n', p_brand, ' \u00e9')"
    body = f"concat('<script type=\"application/ld+json\">{{\"@type\":\"Product\",\"name\":\"', {name}, '\"}}</script><title>', p_name, ', &quot;x&quot;</title>')"
    path = new_work_path(spark, "csv")
    flat = tables.csv_products(build_records(_part_pages(spark, sf_dir, "concat('https://shop.example.com/p/', p_partkey)", body)))
    tables.write_csv(flat, path)
    return spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(path).select("url", "title", "product_name", "has_specs_tables")


@query
def typed_corpora(spark, sf_dir):
    """All typed corpora written in one pass and counted by folder."""
    path = new_work_path(spark, "corpora")
    corpora.write_corpora(stage(harvest_records(mixed_site(spark, sf_dir)), "records"), path)
    back = spark.read.schema("doc_id STRING, corpus STRING").json(path)
    return back.groupBy("corpus").agg(F.count("doc_id").alias("n"))


@query
def published_versions(spark, sf_dir):
    """Publish the crawl, publish it again unchanged, then without its ``.html`` pages: what each version holds, and whether it was written anew."""
    root = new_work_path(spark, "versions")
    crawl = from_pages(scan(spark, sf_dir, "pages")).drop("page_id")
    whole = plans.harvest(crawl)
    smaller = plans.harvest(crawl.where("requested_url NOT LIKE '%.html'"))
    for results, records in (whole, whole, smaller):
        plans.publish_version(results, records, root)
    manifest = corpus.read_manifest(spark, f"{root}/manifest")
    before = manifest.select((F.col("version") + 1).alias("version"), "rel_path", F.col("path").alias("old_path"))
    return manifest.join(before, ["version", "rel_path"], "left").select(
        "version", "rel_path", "n_records", "content_hash", "corpus_signature", F.coalesce(F.col("path") == F.col("old_path"), F.lit(False)).alias("same_folder"))


@query
def published_delta(spark, sf_dir):
    """Records added, removed and changed between two published versions: some pages under other names, some with other titles."""
    root = new_work_path(spark, "versions")
    pages = scan(spark, sf_dir, "pages").select(F.col("url").alias("requested_url"), F.lit(200).alias("status"), "html")
    name = F.when(F.col("requested_url").like("%?%"), F.concat("requested_url", F.lit("&new=1"))).otherwise(F.col("requested_url"))
    title = F.when(F.col("requested_url").like("%/en/%"), F.replace("html", F.lit("<title>"), F.lit("<title>New "))).otherwise(F.col("html"))
    later = pages.select(name.alias("requested_url"), "status", title.alias("html"))
    for state in (pages, later):
        plans.publish_version(*plans.harvest(state.withColumn("final_url", F.col("requested_url"))), root)
    return plans.version_delta(spark, root, 2, 1)


@query
def previous_signature(spark, sf_dir):
    """Signature of the crawl, read back from a written summary."""
    root = new_work_path(spark, "versions")
    results, records = plans.harvest(from_pages(scan(spark, sf_dir, "pages")).drop("page_id"))
    published = plans.publish_version(results, records, root)
    return corpus.previous_signature(spark, f"{published.path}/summary")


# ---- signature, differences, versions, profile ------------------------------------------

def _hashed_titles(spark, sf_dir) -> DataFrame:
    titles = head.with_head(crawled(spark, sf_dir))
    return titles.select(F.col("final_url").alias("canonical"),
                         F.sha2(F.concat_ws("|", "final_url", "head.title"), 256).alias("record_hash"))


@query
def corpus_signature(spark, sf_dir):
    return changes.corpus_signature(_hashed_titles(spark, sf_dir))


@query
def signature_per_site(spark, sf_dir):
    hashed = D.add(_hashed_titles(spark, sf_dir), host=U.authority("canonical"))
    return changes.corpus_signature(hashed, "host")


def _snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The crawl, and an older state: fragment URLs not there yet, query URLs still there under another name, some bodies different."""
    pages = table(spark, sf_dir, "pages").select("url", "html")
    now = pages.select(F.col("url").alias("canonical"), F.sha2("html", 256).alias("record_hash"))
    body = F.when(F.col("url").like("%/en/%"), F.concat("html", F.lit(" "))).otherwise(F.col("html"))
    name = F.when(F.col("url").like("%?%"), F.concat("url", F.lit("&old=1"))).otherwise(F.col("url"))
    before = pages.where(~F.col("url").like("%#%")).select(name.alias("canonical"), F.sha2(body, 256).alias("record_hash"))
    return now, before


@query
def snapshot_diff(spark, sf_dir):
    return changes.snapshot_diff(*_snapshots(spark, sf_dir))


@query
def snapshot_counts(spark, sf_dir):
    return changes.diff_counts(changes.snapshot_diff(*_snapshots(spark, sf_dir)))


@query
def latest_version(spark, sf_dir):
    """Highest version among folder names, most of which are not versions."""
    name = "CASE WHEN c_mktsegment = 'BUILDING' THEN concat('corpus_ver', c_custkey + 3000000000) ELSE concat('corpus_ver', c_custkey, '_tmp') END"
    return changes.latest_version(table(spark, sf_dir, "customer").selectExpr(f"{name} AS name"))


@query
def profile_join(spark, sf_dir):
    """Publisher profiles attached to the pages of their hosts."""
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select(F.expr(U.authority("url")).alias("host")).where("host LIKE 'm.%'").distinct()
    profiles = hosts.select(F.upper("host").alias("host"), F.expr("concat('{\"name\":\"', host, '\"}')").alias("profile"))
    attached = attach_profile(pages.select("page_id", "url"), profiles)
    return attached.select("page_id", F.try_variant_get("company_fixed", "$.name", "string").alias("publisher"))


# ---- sitemaps -----------------------------------------------------------------------------

@query
def sitemap_locs(spark, sf_dir):
    return sitemap.sitemap_locs(render.sitemaps(table(spark, sf_dir, "pages")))


@query
def odd_sitemaps(spark, sf_dir):
    """Repeated and nested locations, foreign namespaces, and documents with more after the root element."""
    xml = ("concat('<urlset xmlns:i=\"urn:i\"><url><loc>https://a.example/', c_custkey, '</loc><loc> https://b.example/', c_custkey, ' </loc></url>"
           "<group><url><loc>https://c.example/', c_custkey, '</loc><i:loc>https://no.example/</i:loc></url></group></urlset>', "
           "CASE WHEN c_custkey % 3 = 0 THEN '<loc>https://d.example/</loc>' ELSE '' END)")
    return sitemap.sitemap_locs(table(spark, sf_dir, "customer").selectExpr("c_custkey AS sitemap_url", "200 AS status", f"{xml} AS xml"))


@query
def sitemap_frontier(spark, sf_dir):
    return sitemap.discover_frontier(render.sitemaps(table(spark, sf_dir, "pages")), F.col("is_index"))


@query
def record_hashes(spark, sf_dir):
    """Hash of the exported line of every page of the crawl."""
    return with_record_hash(build_records(crawled(spark, sf_dir), keep=("page_id",))).select("page_id", "record_hash")
