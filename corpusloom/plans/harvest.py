"""Whole runs: harvest fetched pages, publish a version when the corpus changed."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.changes import corpus_signature, latest_version, snapshot_diff
from corpusloom.operators.hashtree import TREE_DDL, keys_of, tree_of
from corpusloom.operators.profiles import with_profile
from corpusloom.operators.quality import quality_columns, quality_struct
from corpusloom.operators.records import RECORD, harvest_results, ok_records
from corpusloom.rules import DEFAULTS, Rules
from corpusloom.session import configure, stage
from corpusloom.sinks.commits import create_once
from corpusloom.sinks.corpora import (
    CORPUS_OF_TYPE, corpus_name, corpus_stats, harvest_errors, line_stats, write_corpora, write_errors)
from corpusloom.sinks.tables import csv_articles, csv_products, csv_site_pages, write_csv
from corpusloom.sources.corpus import read_manifest
from corpusloom.sources.fetched import FetchStore, fetched_pages
from corpusloom.sources.sitemap import discover_frontier, require_frontier


def harvest(fetched: DataFrame, site_host: str | None = None, site_origin: str | None = None,
            profiles: DataFrame | None = None, rules: Rules = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """``(results, records)``, parsed and hashed once and staged in the shared folder, in one folder per page type.

    ``session.clear_staged`` removes what runs have staged.
    """
    configure(fetched.sparkSession)
    if profiles is not None:
        fetched = with_profile(fetched, profiles, "final_url")
    results = stage(harvest_results(fetched, site_host, site_origin, rules=rules), "results", by=("page_type",))
    records = ok_records(results, keep=("record_hash", "page_type"))
    return results, records.withColumn("canonical", F.col("document_identifier.canonical"))


def harvest_site(sitemaps: DataFrame, fetched: DataFrame | FetchStore, index_url: str, profiles: DataFrame | None = None,
                 rules: Rules = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """A whole site from its sitemap index: frontier, its fetch results, records; from a ``FetchStore`` no page is exchanged.

    Fails on an index URL without scheme or host, and when nothing is discovered.
    """
    parts = urlsplit(index_url)
    if not parts.scheme or not parts.netloc:
        raise ValueError(f"invalid sitemap index URL: {index_url}")
    is_index = F.col("sitemap_url") == index_url
    frontier = require_frontier(stage(discover_frontier(sitemaps, is_index, parts.netloc), "frontier"))  # read three times
    pages = fetched.pages(frontier) if isinstance(fetched, FetchStore) else fetched_pages(fetched, frontier)
    return harvest(pages, parts.netloc, f"{parts.scheme}://{parts.netloc}", profiles, rules)


def harvest_summary(results: DataFrame, records: DataFrame, source: str | None = None,
                    sitemap_index: str | None = None, generated_at: datetime | None = None,
                    previous_version: str | None = None, previous_signature: str | None = None,
                    output_root: str | None = None, changed: tuple[str, ...] = (),
                    unchanged: tuple[str, ...] = (), signature: str | None = None, hashes: dict[str, str] | None = None) -> DataFrame:
    """One row: counts, content hashes, quality and change detection of a run.

    ``signature`` and ``hashes`` (by corpus) are computed if not given.
    """
    stamp = F.lit(generated_at) if generated_at else F.current_timestamp()
    errors = results.where(~F.col("ok")).agg(F.count(F.lit(1)))
    kind = F.col("document_identifier.page_type")
    totals = records.agg(*quality_columns(), F.count_if(kind == "WebPage").alias("pages_total"))
    if hashes is None:
        per_corpus = corpus_stats(records.withColumn("corpus", corpus_name()), "corpus")
        by_corpus = per_corpus.agg(F.map_from_entries(F.array_sort(F.collect_list(
            F.struct("corpus", "corpus_signature"))))).scalar()
    else:
        by_corpus = F.create_map(*[F.lit(v) for pair in sorted(hashes.items()) for v in pair]).cast("map<string,string>")
    none = F.lit(None).cast("string")
    return totals.select(
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("generated_at"),
        F.lit(source).cast("string").alias("source"), F.lit(sitemap_index).cast("string").alias("sitemap_index"),
        F.struct(
            F.col("site_total_records").alias("total_records"), F.col("products_total").alias("products"),
            F.col("articles_total").alias("articles"), F.col("pages_total").alias("pages"),
            F.col("collections_total").alias("collections"), errors.scalar().alias("errors"),
            F.struct(F.col("site_total_records").alias("site_pages.csv"),
                     F.col("products_total").alias("products.csv"),
                     F.col("articles_total").alias("articles.csv")).alias("csv")).alias("counts"),
        by_corpus.alias("content_hashes"),
        quality_struct().alias("quality"),
        F.struct(
            (F.lit(previous_version) if previous_version else none).alias("previous_version"),
            (F.lit(previous_signature) if previous_signature else none).alias("previous_corpus_signature"),
            (F.lit(signature) if signature else corpus_signature(records).scalar()).alias("corpus_signature"),
            _strings(changed).alias("changed_files"), _strings(unchanged).alias("unchanged_files"),
        ).alias("change_detection"),
        F.lit(output_root).cast("string").alias("output_root"))


def _strings(values: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


@dataclass(frozen=True)
class Published:
    """Outcome of a publish: the version now current, and whether this run made it."""

    version: int
    created: bool
    signature: str
    path: str


def publish_version(results: DataFrame, records: DataFrame, root: str, **summary: str) -> Published:
    """Write a new version below ``root`` if the corpus signature differs from the last one.

    Each attempt has a folder of its own. A version exists from the moment its manifest file, named by the version's number, is put in place, which
    succeeds for one writer only: one that comes second takes the next number, or none if the first has published the same records. A run
    that dies before leaves no version behind. Only corpora, flat files and keys whose content changed are written; for the others the
    manifest points at the folder that holds them. A harvest without records is a version as well.
    """
    spark = records.sparkSession
    signature = corpus_signature(records).first()["corpus_signature"]
    latest = _latest(spark, root)
    if latest and latest["records"]["corpus_signature"] == signature:
        return _published(root, latest, False)
    attempt = _Attempt(results, records, root, signature, latest or {})
    while True:
        attempt.write_summary(latest or {}, **summary)
        made = attempt.manifest(latest or {})
        if create_once(spark, f"{root}/manifest/{made['records']['version']:020d}.json", "\n".join(map(json.dumps, made.values())) + "\n"):
            return _published(root, made, True)
        latest = _latest(spark, root)
        if latest["records"]["corpus_signature"] == signature:
            return _published(root, latest, False)


def _published(root: str, manifest: dict[str, dict], created: bool) -> Published:
    whole = manifest["records"]
    return Published(whole["version"], created, whole["corpus_signature"], f"{root}/{whole['path']}")


def _latest(spark: SparkSession, root: str) -> dict[str, dict] | None:
    """Manifest rows of the last version by name: one per corpus, flat file and log."""
    manifest = read_manifest(spark, f"{root}/manifest")
    names = manifest.where(F.col("rel_path") == "records").select(F.concat(F.lit("corpus_ver"), F.col("version").cast("string")).alias("name"))
    number = latest_version(names).first()["version"]
    return {r["rel_path"]: r.asDict() for r in manifest.where(F.col("version") == number).collect()} if number else None


class _Attempt:
    """What one run writes; all of it lies in a folder of its own and can be named by any version number."""

    def __init__(self, results: DataFrame, records: DataFrame, root: str, signature: str, before: dict[str, dict]) -> None:
        self.results, self.records, self.root, self.signature, self.before = results, records, root, signature, before
        self.folder = f"run-{uuid.uuid4().hex[:16]}"
        path, spark = f"{root}/{self.folder}", records.sparkSession
        flat = {f"csv/{name}": of(records) for name, of in (("site_pages", csv_site_pages), ("products", csv_products), ("articles", csv_articles))}
        found = corpus_stats(records.withColumn("rel_path", F.concat(F.lit("corpora/corpus="), corpus_name())), "rel_path")
        for name, lines in (flat | {"errors": harvest_errors(results)}).items():
            found = found.unionByName(line_stats(lines).withColumn("rel_path", F.lit(name)))
        self.stats = {r["rel_path"]: (r["corpus_signature"], r["n_records"]) for r in found.collect()}
        self.changed = {name for name, (content, _) in self.stats.items() if name not in before or before[name]["content_hash"] != content}
        kinds = [kind for kind, name in CORPUS_OF_TYPE.items() if f"corpora/corpus={name}" in self.changed]
        kind = F.col("page_type") if "page_type" in records.columns else F.col("document_identifier.page_type")
        new = records.where(kind.isin(kinds))
        new.select(*RECORD, "record_hash", "canonical", kind.alias("page_type")).write.partitionBy("page_type").parquet(f"{path}/records")
        write_corpora(new, f"{path}/corpora")
        for name in sorted(self.changed & flat.keys()):
            write_csv(flat[name], f"{path}/{name}")
        if "errors" in self.changed:
            write_errors(results, f"{path}/errors")
        self._write_tree(spark, path)
        self.stats["records"] = (signature, sum(n for name, (_, n) in self.stats.items() if name.startswith("corpora/")))

    def _write_tree(self, spark: SparkSession, path: str) -> None:
        """Keys below the prefixes that changed, and the tree that names the folder of every prefix."""
        keys = keys_of(self.records)
        known = {r["prefix"]: r for r in _tree(spark, self.root, self.before)}
        rows = []
        for r in tree_of(keys).collect():  # one row per prefix
            old = known.get(r["prefix"])
            rows.append((r["prefix"], r["digest"], r["n_keys"], old["path"] if old and old["digest"] == r["digest"] else self.folder))
        mine = [prefix for prefix, _, _, where in rows if where == self.folder]
        (keys.where(F.col("prefix").isin(mine)).repartitionByRange("prefix", "canonical", "record_hash").sortWithinPartitions("prefix", "canonical")
         .write.partitionBy("prefix").parquet(f"{path}/keys"))
        spark.createDataFrame(rows, TREE_DDL).coalesce(1).write.json(f"{path}/tree")

    def manifest(self, before: dict[str, dict]) -> dict[str, dict]:
        """Rows of the version after ``before``."""
        version = before["records"]["version"] + 1 if before else 1
        stamp = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
        old = {name: self.before[name]["path"] for name in self.before.keys() - self.changed - {"records"}}
        return {name: {"version": version, "rel_path": name, "content_hash": content, "n_records": n, "corpus_signature": self.signature,
                       "path": old.get(name, self.folder), "written_at": stamp} for name, (content, n) in sorted(self.stats.items())}

    def write_summary(self, before: dict[str, dict], **summary: str) -> None:
        changed = {name for name, (content, _) in self.stats.items() if name not in before or before[name]["content_hash"] != content}
        whole = before.get("records")
        (harvest_summary(self.results, self.records, previous_version=f"v{whole['version']}" if whole else None,
                         previous_signature=whole["corpus_signature"] if whole else None, output_root=self.root, signature=self.signature,
                         hashes={name.removeprefix("corpora/corpus="): content for name, (content, _) in self.stats.items() if name.startswith("corpora/")},
                         changed=tuple(sorted(changed | {"records"})), unchanged=tuple(sorted(self.stats.keys() - changed - {"records"})), **summary)
         .write.mode("overwrite").option("ignoreNullFields", "false").json(f"{self.root}/{self.folder}/summary"))


def _tree(spark: SparkSession, root: str, manifest: dict[str, dict]) -> list[Row]:
    """Rows of a version's tree, at most one per prefix."""
    return spark.read.schema(TREE_DDL).json(f"{root}/{manifest['records']['path']}/tree").collect() if manifest else []


def _version(spark: SparkSession, root: str, version: int) -> dict[str, dict]:
    rows = read_manifest(spark, f"{root}/manifest").where(F.col("version") == version).collect()
    if not rows:
        raise ValueError(f"no version {version} below {root}")
    return {r["rel_path"]: r.asDict() for r in rows}


def _keys(spark: SparkSession, root: str, tree: list[Row]) -> DataFrame:
    """``(canonical, record_hash)`` below the given prefixes, from the folders that hold them."""
    paths = [f"{root}/{r['path']}/keys/prefix={r['prefix']}" for r in tree]
    schema = "canonical STRING, record_hash STRING"
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def version_delta(spark: SparkSession, root: str, current: int, previous: int) -> DataFrame:
    """``(canonical, status)`` of the records added, removed or changed; prefixes with equal digests are not read."""
    now, before = (_tree(spark, root, _version(spark, root, n)) for n in (current, previous))
    same = {(r["prefix"], r["digest"]) for r in now} & {(r["prefix"], r["digest"]) for r in before}
    sides = [_keys(spark, root, [r for r in tree if (r["prefix"], r["digest"]) not in same]) for tree in (now, before)]
    return snapshot_diff(*sides).where("status <> 'same'")


def version_changes(manifest: DataFrame, version: int) -> DataFrame:
    """``(rel_path, status)`` of a version against the one before it: corpora, flat files, error log and all records."""
    def of(number: int) -> DataFrame:
        return manifest.where(F.col("version") == number)

    return snapshot_diff(of(version), of(version - 1), key="rel_path", record_hash="content_hash")


def version_records(spark: SparkSession, root: str, version: int) -> DataFrame:
    """``(canonical, record_hash, page_type)`` of a version, each corpus from the folder of the version that wrote it."""
    rows = read_manifest(spark, f"{root}/manifest").where(
        (F.col("version") == version) & F.col("rel_path").startswith("corpora/")).collect()  # at most one per page type
    kind_of = {f"corpora/corpus={name}": kind for kind, name in CORPUS_OF_TYPE.items()}
    parts = [spark.read.schema("canonical STRING, record_hash STRING").parquet(f"{root}/{r['path']}/records/page_type={kind_of[r['rel_path']]}")
             .withColumn("page_type", F.lit(kind_of[r["rel_path"]])) for r in rows]
    none = spark.createDataFrame([], "canonical STRING, record_hash STRING, page_type STRING")
    return reduce(DataFrame.unionByName, parts, none)


def version_diff(spark: SparkSession, root: str, current: int, previous: int) -> DataFrame:
    """``(canonical, status)`` of the records of two versions; reads two columns of each."""
    return snapshot_diff(version_records(spark, root, current), version_records(spark, root, previous))
