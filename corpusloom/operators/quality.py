"""Corpus counts and quality metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _page_type() -> Column:
    return F.col("document_identifier.page_type")


def _empty(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0)) == 0


def quality_columns() -> list[Column]:
    """Aggregates over records, all in one pass."""
    is_article, is_product = _page_type() == "Article", _page_type() == "Product"
    is_collection = _page_type() == "CollectionPage"
    blocks = F.coalesce(F.size("content.text_blocks"), F.lit(0))

    def n(test: Column, name: str) -> Column:
        return F.count_if(test).alias(name)

    return [
        n(is_article, "articles_total"),
        n(is_article & (blocks == 0), "articles_empty_text_blocks"),
        n(is_article & (blocks < 5), "articles_less_than_5_blocks"),
        n(is_article & _empty(F.col("article.tags")), "articles_empty_tags"),
        n(is_article & _empty(F.col("article.categories")), "articles_empty_categories"),
        n(is_product, "products_total"),
        n(is_product & _empty(F.col("product.sections.grades_specs")), "products_without_specs_tables"),
        n(is_collection, "collections_total"),
        n(is_collection & _empty(F.col("collection.items")), "collections_empty_items"),
        F.count(F.lit(1)).alias("site_total_records"),
    ]


def quality_metrics(records: DataFrame) -> DataFrame:
    return records.agg(*quality_columns())


def quality_struct() -> Column:
    """The flat metrics as the nested document of the harvest summary."""
    def part(prefix: str, **names: str) -> Column:
        return F.struct(*[F.col(f"{prefix}_{short}").alias(name) for name, short in names.items()])

    return F.struct(
        part("articles", total="total", num_empty_text_blocks="empty_text_blocks",
             num_less_than_5_blocks="less_than_5_blocks", num_empty_tags="empty_tags",
             num_empty_categories="empty_categories").alias("articles"),
        part("products", total="total", num_without_specs_tables="without_specs_tables").alias("products"),
        part("collections", total="total", num_empty_items="empty_items").alias("collections"),
        part("site", total_records="total_records").alias("site"))


def type_counts(results: DataFrame) -> DataFrame:
    """Records per page type, failed fetches under ``error`` and all records under ``total``."""
    kind = F.when(F.col("ok"), F.col("page_type")).otherwise("error")
    counts = results.groupBy(kind.alias("page_type"), "ok").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0))
    rolled = counts.rollup("page_type").agg(F.sum("n").alias("n"), total.alias("n_ok"),
                                            F.grouping("page_type").alias("all_types"))
    return rolled.select(
        F.when(F.col("all_types") == 1, "total").otherwise(F.col("page_type")).alias("page_type"),
        F.when(F.col("all_types") == 1, F.col("n_ok")).otherwise(F.col("n")).alias("n"))


def list_sizes(records: DataFrame, *keys: str) -> DataFrame:
    """Sizes of the lists of each record."""
    def size(path: str, name: str) -> Column:
        return F.coalesce(F.size(path), F.lit(0)).alias(name)

    return records.select(
        *keys, size("content.text_blocks", "num_text_blocks"), size("content.links_internal", "num_internal_links"),
        size("content.links_external", "num_external_links"), size("article.tags", "num_tags"),
        size("article.categories", "num_categories"))
