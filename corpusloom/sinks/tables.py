"""Flat CSV mirrors of the corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENT, CONTENT, META = "document_identifier", "content", "page_meta"


def _n(path: str) -> Column:
    return F.coalesce(F.size(path), F.lit(0))


def _ident() -> list[Column]:
    return [F.col("doc_id"), F.col("url"), F.col(f"{IDENT}.canonical").alias("canonical")]


def _titles() -> list[Column]:
    return [F.col(f"{IDENT}.title").alias("title"), F.col(f"{CONTENT}.h1").alias("h1")]


def _dates() -> list[Column]:
    return [F.col(f"{META}.dates.published").alias("published"), F.col(f"{META}.dates.modified").alias("modified")]


def csv_site_pages(records: DataFrame) -> DataFrame:
    trail = F.filter(f"{META}.breadcrumbs", lambda b: b["name"] != "")
    return records.select(
        *_ident(), F.col(f"{IDENT}.page_type").alias("page_type"), *_titles(),
        F.col(f"{META}.meta_description").alias("meta_description"), *_dates(),
        F.coalesce(F.array_join(trail["name"], " > "), F.lit("")).alias("breadcrumbs"),
        _n(f"{CONTENT}.text_blocks").alias("num_text_blocks"),
        _n(f"{CONTENT}.links_internal").alias("num_internal_links"),
        _n(f"{CONTENT}.links_external").alias("num_external_links"))


def product_columns() -> list[Column]:
    return [*_ident(), *_titles(), F.col("product.name").alias("product_name"),
            F.col("product.sections.uses_applications").alias("uses_applications"),
            (_n("product.sections.grades_specs") > 0).alias("has_specs_tables"),
            _n(f"{CONTENT}.text_blocks").alias("num_text_blocks")]


def of_type(records: DataFrame, page_type: str) -> DataFrame:
    """Records of one page type; where they are stored by type, only its folder is read."""
    kind = F.col("page_type") if "page_type" in records.columns else F.col(f"{IDENT}.page_type")
    return records.where(kind == page_type)


def csv_products(records: DataFrame) -> DataFrame:
    return of_type(records, "Product").select(*product_columns())


def article_columns() -> list[Column]:
    return [*_ident(), *_titles(), F.col("article.headline").alias("headline"),
            F.col("article.author").alias("author"), *_dates(),
            _n(f"{CONTENT}.text_blocks").alias("num_text_blocks"),
            _n("article.tags").alias("num_tags"), _n("article.categories").alias("num_categories")]


def csv_articles(records: DataFrame) -> DataFrame:
    return of_type(records, "Article").select(*article_columns())


def write_csv(flat: DataFrame, path: str) -> None:
    """CSV with a header; quotes are doubled and line breaks kept inside quotes."""
    flat.write.mode("errorifexists").option("header", "true").option("escape", '"').csv(path)
