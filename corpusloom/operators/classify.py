"""Page type and product-section classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import dom as D
from corpusloom.functions.text import let, lit, normalize_heading, rx
from corpusloom.functions.urls import url_key
from corpusloom.operators.head import with_base
from corpusloom.operators.jsonld import JSONLD_NEEDS, flatten_types
from corpusloom.rules import DEFAULTS, SECTION_PATTERNS, Rules
from corpusloom.sources.shred import Needs

def section_rules(spark: SparkSession, patterns=SECTION_PATTERNS) -> DataFrame:
    """The rule set as rows: ``(section_prio, pattern_prio, section, pattern)``."""
    rows = [(i, j, section, pattern) for i, (section, regexes) in enumerate(patterns)
            for j, pattern in enumerate(regexes)]
    return spark.createDataFrame(rows, "section_prio int, pattern_prio int, section string, pattern string")


def classify_heading(heading: str, patterns=SECTION_PATTERNS) -> str:
    """Section a heading opens, null when no pattern matches; rules are tried in order."""
    rules = " ".join(f"WHEN norm RLIKE {rx('|'.join(f'(?:{r})' for r in regexes))} THEN {lit(section)}"
                     for section, regexes in patterns)
    return let("norm", normalize_heading(heading), f"CASE {rules} END")


# In the text of a pattern, before any group or class: a word between word borders, or before white space.
NEEDED_WORD = r"^[^(\[]*?\\b([a-z0-9]+)(?:\\b(?![?*{])|\\s\+)"
#: Rules without such a word are tested on every distinct heading; more of them than this are refused.
MOST_UNINDEXED = 1000


def classify_headings(headings: DataFrame, rules: DataFrame, heading: str = "heading") -> DataFrame:
    """Add ``norm`` and ``section``: the section of the first rule, by (section_prio, pattern_prio), that a heading matches; null without one.

    ``rules`` is ``(section_prio, pattern_prio, section, pattern)``, patterns in lower case. A rule is looked up by a word it needs: the words of the
    distinct headings are joined with those of the rules, and only the pairs so found are matched. Rules that need no whole word are
    matched one after the other with every distinct heading. Headings are made distinct first, so a frequent one is matched once.
    """
    normed = headings.withColumn("norm", F.expr(normalize_heading(heading)))
    distinct = normed.select("norm").distinct()
    choice = F.struct("section_prio", "pattern_prio", "section")
    # a pattern without alternatives has the word in every match
    known = rules.select(choice.alias("rule"), "pattern",
                         F.when(~F.col("pattern").contains("|"), F.nullif(F.regexp_extract("pattern", NEEDED_WORD, 1), F.lit(""))).alias("word"))
    words = distinct.select("norm", F.explode(F.array_distinct(F.split("norm", r"[^a-z0-9_]+"))).alias("word"))
    indexed = (words.join(known.where("word IS NOT NULL"), "word").where(F.expr("regexp_like(norm, pattern)"))
               .groupBy("norm").agg(F.min("rule").alias("found")))
    rest = known.where("word IS NULL").select("rule", "pattern")
    few = rest.agg(F.when(F.count(F.lit(1)) > MOST_UNINDEXED, F.raise_error(F.lit("too many rules without a literal word")).cast(ARRAY_OF_RULES))
                   .otherwise(F.array_sort(F.collect_list(F.struct("rule", "pattern"))))).scalar()
    tested = distinct.withColumn("_rules", few).select("norm", F.expr("get(filter(_rules, r -> regexp_like(norm, r.pattern)), 0).rule").alias("other"))
    first = (tested.join(indexed, "norm", "left")
             .select("norm", F.least("found", "other").getField("section").alias("section")).where("section IS NOT NULL"))
    return normed.join(first, "norm", "left").select(*headings.columns, "norm", "section")


ARRAY_OF_RULES = "array<struct<rule:struct<section_prio:int,pattern_prio:int,section:string>,pattern:string>>"


def is_card(rules: Rules = DEFAULTS) -> str:
    return D.any_of(D.tag_in("article"), D.has_class(*rules.card_classes))


def page_type_needs(rules: Rules = DEFAULTS) -> Needs:
    """What the page type is read from: JSON-LD types, paging, cards."""
    return JSONLD_NEEDS | Needs(tags=frozenset(["a", "article"]), classes=frozenset(["pagination", *rules.card_classes]), attrs=frozenset(["class"]))


def page_type_sql(site_origin: str | None = None, rules: Rules = DEFAULTS) -> str:
    site = lit(site_origin) if site_origin else "concat(base.scheme, '://', base.authority)"
    listing = f"{url_key('final_url')} = {url_key(f'concat({site}, {lit(rules.listing_path)})')}"

    def holds(*names: str) -> str:
        return "arrays_overlap(ts, array(" + ", ".join(map(lit, names)) + "))"

    paged = "exists(dom, n -> " + D.any_of(
        D.has_class("pagination"), D.tag_in("a") + " AND " + D.has_class("next", "prev")) + ")"
    by_type = let("ts", f"transform({flatten_types('jsonld')}, t -> lower(t))", (
        f"CASE WHEN {holds('product')} THEN 'Product' WHEN {holds(*rules.article_types)} THEN 'Article' "
        f"WHEN {holds(*rules.collection_types)} THEN 'CollectionPage' "
        f"WHEN {paged} AND size({D.select('dom', is_card(rules))}) >= {rules.cards_needed} THEN 'CollectionPage' "
        "ELSE 'WebPage' END"))
    return f"CASE WHEN {listing} THEN 'WebPage' ELSE {by_type} END"


def with_page_type(pages: DataFrame, site_origin: str | None = None, rules: Rules = DEFAULTS) -> DataFrame:
    """Add ``page_type``: Product, Article, CollectionPage or WebPage.

    ``site_origin`` (``https://host``) names the one site of a harvest; without it
    every page belongs to the site of its own URL.
    """
    if "page_type" in pages.columns:
        return pages
    return D.add(with_base(pages), page_type=page_type_sql(site_origin, rules))


def of_site(pages: DataFrame, site_origin: str | None, rules: Rules = DEFAULTS) -> DataFrame:
    """Pages typed as those of the one site of a harvest, if it is named; what is extracted then follows that type."""
    return with_page_type(pages, site_origin, rules) if site_origin else pages


def classify_pages(pages: DataFrame, key: str = "page_id", site_origin: str | None = None, rules: Rules = DEFAULTS) -> DataFrame:
    return with_page_type(pages, site_origin, rules).select(key, "page_type")
