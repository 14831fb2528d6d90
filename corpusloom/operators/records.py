"""Page records: the nested document of one page, and harvest results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import dom as D
from corpusloom.functions.canonical import canonical_json
from corpusloom.functions.text import sha256_hex
from corpusloom.operators.classify import page_type_sql
from corpusloom.operators.containers import with_content
from corpusloom.operators.content import content_sql
from corpusloom.operators.entities import (
    TITLE, article_inputs_sql, article_sql, collection_sql, items_sql, product_sql, sections_sql)
from corpusloom.operators.head import breadcrumbs_sql, dates_sql, head_sql, with_base
from corpusloom.rules import DEFAULTS, Rules
from corpusloom.sources.fetched import is_harvestable
from corpusloom.sources.shred import shred_pages

RECORD = ("doc_id", "url", "requested_url", "http", "document_identifier", "page_meta", "jsonld",
          "content", "company_fixed", "article", "product", "collection")
PAGE_TYPES = ("Product", "Article", "CollectionPage", "WebPage")


def doc_id(url: str, title: str, blocks: str) -> str:
    """Identifier made of the canonical URL, the title and all text blocks."""
    base = f"concat_ws('|', coalesce({url}, ''), coalesce({title}, ''), coalesce(array_join({blocks}, '\\n'), ''))"
    return f"concat('sha256:', {sha256_hex(base)})"


def build_records(pages: DataFrame, site_host: str | None = None, site_origin: str | None = None,
                  keep: tuple[str, ...] = (), rules: Rules = DEFAULTS) -> DataFrame:
    """Records of shredded pages, plus the ``keep`` columns. One narrow stage, no shuffle.

    A ``profile`` column (JSON text) becomes ``company_fixed``.

    JSON-LD, head data and the page type read the whole page; content is read after
    boilerplate removal. Columns are added in few projections, because each one
    copies the node array of the page.
    """
    df = D.add(with_base(pages), head=head_sql(), dates=dates_sql(), breadcrumbs=breadcrumbs_sql(),
               page_type=page_type_sql(site_origin, rules))
    df = D.add(with_content(df, rules), **content_sql(site_host, rules), **article_inputs_sql(rules),
               sections=sections_sql(rules), _items=items_sql(rules))

    def rich(kind: str) -> str:
        return (f"transform(filter(links, l -> l.kind = '{kind}'), l -> struct(l.href AS href, l.text AS text)) "
                f"AS {'downloads' if kind == 'download' else f'links_{kind}_rich'}")

    def urls(kind: str) -> str:
        return f"array_sort(array_distinct(filter(links, l -> l.kind = '{kind}').href)) AS links_{kind}"

    return df.selectExpr(
        *keep,
        f"{doc_id('head.canonical', TITLE, 'text_blocks')} AS doc_id",
        "final_url AS url", "requested_url", "struct(status AS status) AS http",
        f"struct({TITLE} AS title, head.canonical AS canonical, cast(null AS string) AS document_code, "
        "page_type AS page_type) AS document_identifier",
        "struct(head.meta_description AS meta_description, head.robots AS robots, head.og AS og, "
        "head.twitter AS twitter, breadcrumbs AS breadcrumbs, dates AS dates) AS page_meta",
        "jsonld",
        f"struct(h1, headings, text_blocks, tables, images, {rich('download')}, {urls('internal')}, {urls('external')}, "
        f"{rich('internal')}, {rich('external')}) AS content",
        f"{'try_parse_json(profile)' if 'profile' in df.columns else 'cast(null AS variant)'} AS company_fixed", f"{article_sql()} AS article", f"{product_sql()} AS product",
        f"{collection_sql()} AS collection")


def harvest_results(fetched: DataFrame, site_host: str | None = None, site_origin: str | None = None,
                    keep: tuple[str, ...] = (), rules: Rules = DEFAULTS) -> DataFrame:
    """``(ok, url, final_url, status, error, page_type, record, record_hash)`` of every fetch, failed ones included.

    The page type stands beside the record, so counting types does not build records.
    """
    checked = fetched.withColumn("html", F.when(is_harvestable(), F.col("html")))
    checked = checked.withColumn("_fetched", F.col("html").isNotNull())
    pages = shred_pages(checked)
    records = build_records(pages, site_host, site_origin, keep=(*keep, "_fetched", "parse_error", "page_type"), rules=rules)
    ok = F.col("_fetched") & F.col("parse_error").isNull()
    crashed = F.col("parse_error").isNotNull()
    results = records.select(
        *keep, ok.alias("ok"), F.col("requested_url").alias("url"),
        F.when(crashed, F.col("requested_url")).otherwise(F.col("url")).alias("final_url"),
        F.when(crashed, 0).otherwise(F.col("http.status")).alias("status"),
        F.when(~F.col("_fetched"), F.concat(F.lit("HTTP "), F.col("http.status").cast("string")))
        .otherwise(F.col("parse_error")).alias("error"),
        F.when(ok, F.col("page_type")).alias("page_type"),
        F.when(ok, F.struct(*RECORD)).alias("record"))
    return results.withColumn("record_hash", _content_hash(F.col("record"), results.schema["record"].dataType))


def harvest_records(fetched: DataFrame, site_host: str | None = None, site_origin: str | None = None,
                    rules: Rules = DEFAULTS) -> DataFrame:
    """Records of the fetches that succeed, straight from the parser; unused parts are pruned."""
    pages = shred_pages(fetched.where(is_harvestable()))
    return build_records(pages.where("parse_error IS NULL"), site_host, site_origin, rules=rules)


def ok_records(results: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return results.where("ok").select(*keep, "record.*")


def sort_key() -> list[Column]:
    """Export order: canonical (or URL), page type, identifier."""
    ident = F.col("document_identifier")
    empty = F.lit("")
    return [F.coalesce(F.nullif(ident["canonical"], empty), F.col("url"), empty),
            F.coalesce(ident["page_type"], empty), F.coalesce(F.col("doc_id"), empty)]


def duplicate_docs(records: DataFrame) -> DataFrame:
    """Identifiers carried by more than one record."""
    return records.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def _content_hash(record: Column, kind: T.DataType) -> Column:
    """Hash of the line that the record is exported as."""
    return F.sha2(canonical_json(record, kind), 256)


def with_record_hash(records: DataFrame) -> DataFrame:
    """Add ``record_hash`` over the canonical JSON of the whole record."""
    kind = T.StructType([records.schema[name] for name in RECORD])
    return records.withColumn("record_hash", _content_hash(F.struct(*RECORD), kind))
