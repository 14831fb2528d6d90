"""Schemas of records as stored in JSON lines (open JSON parts stay ``VARIANT``)."""

from __future__ import annotations

_LINK = "ARRAY<STRUCT<href:STRING,text:STRING>>"
_TABLES = "ARRAY<ARRAY<ARRAY<STRING>>>"

RECORD_DDL = f"""
doc_id STRING, url STRING, requested_url STRING, http STRUCT<status:INT>,
document_identifier STRUCT<title:STRING,canonical:STRING,document_code:STRING,page_type:STRING>,
page_meta STRUCT<meta_description:STRING,robots:STRING,og:MAP<STRING,STRING>,twitter:MAP<STRING,STRING>,
  breadcrumbs:ARRAY<STRUCT<name:STRING,url:STRING>>,dates:STRUCT<published:STRING,modified:STRING>>,
jsonld ARRAY<VARIANT>,
content STRUCT<h1:STRING,headings:ARRAY<STRUCT<tag:STRING,text:STRING>>,text_blocks:ARRAY<STRING>,tables:{_TABLES},
  images:ARRAY<STRUCT<src:STRING,alt:STRING>>,downloads:{_LINK},links_internal:ARRAY<STRING>,
  links_external:ARRAY<STRING>,links_internal_rich:{_LINK},links_external_rich:{_LINK}>,
company_fixed VARIANT,
article STRUCT<headline:STRING,author:STRING,categories:ARRAY<STRING>,tags:ARRAY<STRING>,
  featured_image:STRUCT<src:STRING,alt:STRING>>,
product STRUCT<name:STRING,sections:STRUCT<description_of_product:STRING,what_is_product:STRING,other_names:STRING,
  specifications:STRUCT<text:STRING,tables:{_TABLES}>,applications_and_uses:STRING,packing:STRING,
  uses_applications:STRING,grades_specs:{_TABLES},faqs:ARRAY<STRING>>>,
collection STRUCT<name:STRING,description:STRING,pagination:STRUCT<page:INT,total_pages:INT>,
  items:ARRAY<STRUCT<title:STRING,url:STRING,excerpt:STRING,thumb:STRING,date:STRING>>>
""".replace("\n", " ")

SUMMARY_DDL = "change_detection STRUCT<previous_version:STRING,previous_corpus_signature:STRING,corpus_signature:STRING>"

# ``path`` is the folder, below the corpus root, of the version that wrote this content.
MANIFEST_DDL = ("version BIGINT, rel_path STRING, content_hash STRING, n_records BIGINT, "
                "corpus_signature STRING, path STRING, written_at TIMESTAMP")

# Lines per file, files and lines of a written corpus.
LAYOUT_DDL = "per_file BIGINT, files BIGINT, n_records BIGINT"
