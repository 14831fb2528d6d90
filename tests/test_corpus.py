"""Signatures, differences, versions, sinks, sitemaps, streaming."""

import csv
import glob
import gzip
import hashlib
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.carry import carry_forward
from corpusloom.operators.changes import corpus_signature, diff_counts, latest_version, snapshot_diff
from corpusloom.operators.quality import quality_metrics
from corpusloom.operators.ranking import numbered
from corpusloom.operators.records import build_records, duplicate_docs, ok_records, with_record_hash
from corpusloom.plans import harvest as plans
from corpusloom.sinks import corpora, tables
from corpusloom.sinks.commits import create_once
from corpusloom.sources.corpus import previous_signature, read_corpus, read_manifest, read_positions
from corpusloom.sources.fetched import FetchStore, from_pages, read_fetched
from corpusloom.sources.shred import shred_pages
from corpusloom.sources.sitemap import discover_frontier, require_frontier, sitemap_locs
from corpusloom.streaming.ingest import fetched_once, fetched_stream, harvest_stream, latest_metrics, metrics_stream

LONG = "This sentence is long enough to be counted as a block of text."


def site(spark, *names):
    """A small site: two articles, a product, a collection, a plain page, each under its own URL."""
    html = {
        "art1": f'<title>A, "one"</title><script type="application/ld+json">{{"@type":"Article","keywords":"z,y"}}</script><p>{LONG}</p>',
        "art2": '<title>A two</title><script type="application/ld+json">{"@type":"Article"}</script><main>short</main>',
        "prod": '<title>P\nx</title><script type="application/ld+json">{"@type":"Product","name":"Né"}</script><main><h2>Grades</h2><table><tr><td>1</td></tr></table></main>',
        "coll": '<title>C</title><script type="application/ld+json">{"@type":"ItemList"}</script><main></main>',
        "page": '<title>W</title><nav class="breadcrumb"><a href="/">Home</a><a>Here</a></nav>',
    }
    rows = [(f"https://s.example/{n}", html[n]) for n in (names or html)]
    return spark.createDataFrame(rows, "url string, html string").selectExpr(
        "url AS requested_url", "url AS final_url", "200 AS status", "html")


def hashed(spark, values):
    return spark.createDataFrame([(k, v) for k, v in values], "canonical string, content string").select(
        "canonical", F.sha2("content", 256).alias("record_hash"))


def test_signature_ignores_layout_and_sees_every_edit(spark):
    rows = [(f"u{i}", f"c{i % 50}") for i in range(400)] + [("hot", "same")] * 200
    shuffled = random.Random(1).sample(rows, len(rows))

    def sign(values):
        return corpus_signature(hashed(spark, values)).first()["corpus_signature"]

    base = sign(rows)
    assert corpus_signature(hashed(spark, shuffled).repartition(7)).first()["corpus_signature"] == base
    assert sign(rows[:-1]) != base and sign([*rows, rows[0]]) != base and sign([("u0", "edited"), *rows[1:]]) != base


def test_signature_is_not_one_task(spark):
    plan = corpus_signature(hashed(spark, [("a", "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SinglePartition" in plan.split("listagg")[1]


def test_diff_against_brute_force(spark):
    rng = random.Random(2)
    old = [(f"k{rng.randrange(60)}", f"v{rng.randrange(3)}") for _ in range(150)] + [("hot", "x")] * 100
    new = [(f"k{rng.randrange(80)}", f"v{rng.randrange(3)}") for _ in range(150)] + [("hot", "x")] * 99
    o, n = {}, {}
    for target, rows in ((o, old), (n, new)):
        for k, v in rows:
            target.setdefault(k, Counter())[v] += 1
    want = {k: "added" if k not in o else "removed" if k not in n else "same" if o[k] == n[k] else "changed" for k in {*o, *n}}
    diff = snapshot_diff(hashed(spark, new), hashed(spark, old))
    assert {r.canonical: r.status for r in diff.collect()} == want
    assert {r.status: r.n for r in diff_counts(diff).collect()} == Counter(want.values())
    assert "Join" not in diff._jdf.queryExecution().executedPlan().toString()


def test_latest_version(spark):
    names = ["corpus_ver2", "corpus_ver10", "corpus_ver9x", "xcorpus_ver11", "corpus_ver", "corpus_ver99999999999"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert tuple(latest_version(df).first()) == (99999999999, "corpus_ver99999999999")
    assert tuple(latest_version(df.where("name LIKE 'x%'")).first()) == (None, None)


def test_version_beyond_64_bits_is_an_error(spark):
    df = spark.createDataFrame([("corpus_ver2",), ("corpus_ver" + "9" * 25,)], "name string")
    with pytest.raises(Exception, match="version number too large"):
        latest_version(df).collect()


def test_carry_forward_with_null_keys_and_sparse_time_stamps(spark):
    rows = [(k, 1_700_000_000_000 + i * 86_400_000, f"m{i}" if i % 7 == 3 else None) for k in (None, "a") for i in range(500)]
    df = spark.createDataFrame(rows, "key string, ms bigint, mark string")
    got = {(r.key, r.ms): r.seen for r in carry_forward(df, "key", "ms", F.col("mark"), "seen").collect()}
    seen = {}
    for key, ms, mark in rows:
        seen[key] = mark or seen.get(key)
        assert got[key, ms] == seen[key]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_carry_forward_with_a_hot_key(spark, parts):
    rng = random.Random(3)
    rows = [("hot", i, i if rng.random() < 0.1 else None) for i in range(300)] + [
        (f"k{i % 20}", i // 20, i if rng.random() < 0.3 else None) for i in range(200)]
    df = spark.createDataFrame(random.Random(4).sample(rows, len(rows)), "key string, pos int, mark int")
    df = df.repartition(parts)
    got = {(r.key, r.pos): r.seen for r in carry_forward(df, "key", "pos", F.col("mark"), "seen").collect()}
    want, last = {}, {}
    for key, pos, mark in sorted(rows, key=lambda r: r[:2]):
        last[key] = mark if mark is not None else last.get(key)
        want[key, pos] = last[key]
    assert got == want


def test_duplicates(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "doc_id string")
    assert [tuple(r) for r in duplicate_docs(df).collect()] == [("a", 2)]


def test_json_lines(spark, tmp_path):
    records = build_records(shred_pages(site(spark)))
    stats = corpora.write_jsonl(records, str(tmp_path / "all")).first()
    lines = [line for f in sorted(glob.glob(f"{tmp_path}/all/*.gz")) for line in gzip.open(f, "rt", encoding="utf-8")]
    rows = [json.loads(line) for line in lines]
    assert stats.n_records == len(rows) == 5
    assert [r["url"] for r in rows] == sorted(r["url"] for r in rows)
    assert all(list(r) == sorted(r) and list(r["content"]) == sorted(r["content"]) for r in rows)
    assert "company_fixed" in rows[0] and "Né" in "".join(lines)
    (tmp_path / "all" / "blank.json").write_text("\n  \n")
    back = read_corpus(spark, f"{tmp_path}/all").where("doc_id IS NOT NULL")
    assert corpus_signature(with_record_hash(back)).first()["corpus_signature"] == stats.corpus_signature


def test_typed_corpora_are_a_partition(spark, tmp_path):
    records = build_records(shred_pages(site(spark)))
    corpora.write_corpora(records, str(tmp_path / "c"))
    counts = {g.split("=")[1]: sum(1 for f in glob.glob(f"{g}/*.gz") for _ in gzip.open(f)) for g in glob.glob(f"{tmp_path}/c/corpus=*")}
    assert counts == {"articles": 2, "products": 1, "collections": 1, "pages": 1}


def test_csv(spark, tmp_path):
    records = build_records(shred_pages(site(spark)))
    for name, flat in (("site", tables.csv_site_pages), ("prod", tables.csv_products), ("art", tables.csv_articles)):
        tables.write_csv(flat(records).coalesce(1), f"{tmp_path}/{name}")

    def read(name):
        with open(glob.glob(f"{tmp_path}/{name}/*.csv")[0], newline="", encoding="utf-8") as f:
            return list(csv.DictReader(f))

    pages = {r["url"].rsplit("/", 1)[1]: r for r in read("site")}
    assert list(pages["page"]) == ["doc_id", "url", "canonical", "page_type", "title", "h1", "meta_description", "published", "modified",
                                   "breadcrumbs", "num_text_blocks", "num_internal_links", "num_external_links"]
    assert pages["art1"]["title"] == 'A, "one"' and pages["page"]["breadcrumbs"] == "Home > Here"
    assert [r["has_specs_tables"] for r in read("prod")] == ["true"] and read("prod")[0]["product_name"] == "Né"
    assert {r["url"][-4:]: (r["num_tags"], r["num_text_blocks"]) for r in read("art")} == {"art1": ("2", "1"), "art2": ("0", "1")}


def test_quality(spark):
    got = quality_metrics(build_records(shred_pages(site(spark)))).first().asDict()
    assert got == {"articles_total": 2, "articles_empty_text_blocks": 0, "articles_less_than_5_blocks": 2, "articles_empty_tags": 1,
                   "articles_empty_categories": 2, "products_total": 1, "products_without_specs_tables": 0,
                   "collections_total": 1, "collections_empty_items": 1, "site_total_records": 5}


def test_publish(spark, tmp_path):
    root = str(tmp_path / "out")
    first = plans.harvest(site(spark))
    one = plans.publish_version(*first, root)
    again = plans.publish_version(*first, root)
    assert (one.version, one.created, again.version, again.created) == (1, True, 1, False)
    failed = spark.createDataFrame([("https://s.example/x", "https://s.example/x", 500, "")], "requested_url string, final_url string, status int, html string")
    two = plans.publish_version(*plans.harvest(site(spark, "art1", "prod", "page").unionByName(failed)), root)
    assert two.version == 2 and two.created
    manifest = read_manifest(spark, f"{root}/manifest")
    status = {r.rel_path: r.status for r in plans.version_changes(manifest, 2).collect()}
    assert status == {"corpora/corpus=articles": "changed", "corpora/corpus=collections": "removed", "corpora/corpus=pages": "same",
                      "corpora/corpus=products": "same", "records": "changed", "csv/site_pages": "changed", "csv/articles": "changed",
                      "csv/products": "same", "errors": "changed"}
    assert {os.path.basename(p) for p in glob.glob(f"{two.path}/records/*=*")} == {"page_type=Article"}  # unchanged corpora are not written again
    assert not glob.glob(f"{two.path}/csv/products")
    where = {r.rel_path: f"{root}/{r.path}" for r in manifest.where("version = 2").collect()}
    assert where["corpora/corpus=pages"] == one.path and where["corpora/corpus=articles"] == two.path
    diff = plans.version_diff(spark, root, 2, 1)
    assert {r.canonical[-4:]: r.status for r in diff.collect()} == {"art1": "same", "art2": "removed", "prod": "same", "coll": "removed", "page": "same"}
    summary = spark.read.json(f"{two.path}/summary").first()
    assert summary.counts.errors == 1 and summary.counts.total_records == 3
    assert summary.change_detection.previous_version == "v1" and summary.output_root == root
    assert summary.change_detection.changed_files == ["corpora/corpus=articles", "csv/articles", "csv/site_pages", "errors", "records"]
    assert summary.change_detection.unchanged_files == ["corpora/corpus=pages", "corpora/corpus=products", "csv/products"]
    assert summary.change_detection.previous_corpus_signature == one.signature
    assert previous_signature(spark, f"{two.path}/summary").first()["corpus_signature"] == two.signature
    assert previous_signature(spark, f"{root}/nowhere").count() == 0
    log = [line for f in glob.glob(f"{two.path}/errors/*.txt") for line in open(f)]
    assert log == ["https://s.example/x\tstatus=500\tfinal=https://s.example/x\tHTTP 500\n"]


@pytest.mark.parametrize("step", ["write_corpora", "write_csv", "write_errors", "harvest_summary"])
def test_publish_after_a_run_that_died(spark, tmp_path, monkeypatch, step):
    run = plans.harvest(site(spark, "art1", "page"))

    def die(*args, **kwargs):
        raise RuntimeError("died")

    with monkeypatch.context() as broken:
        broken.setattr(plans, step, die)
        with pytest.raises(RuntimeError, match="died"):
            plans.publish_version(*run, str(tmp_path))
    assert read_manifest(spark, f"{tmp_path}/manifest").count() == 0
    done = plans.publish_version(*run, str(tmp_path))
    assert (done.version, done.created) == (1, True)
    assert plans.version_records(spark, str(tmp_path), 1).count() == 2


def test_two_publishers_at_once(spark, tmp_path, monkeypatch):
    """Both have read the manifest before either commits: different records make two versions, equal ones make one."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    create = plans.create_once
    for n, names in enumerate(((("art1",), ("page",)), (("page",), ("page",)))):
        runs, root, meet, met = [plans.harvest(site(spark, *some)) for some in names], f"{tmp_path}/{n}", Barrier(2), set()

        def together(spark, path, content):
            if path not in met and path.endswith("1.json"):
                meet.wait(300)
                met.add(path)
            return create(spark, path, content)
        monkeypatch.setattr(plans, "create_once", together)
        with ThreadPoolExecutor(2) as pool:
            done = [f.result() for f in [pool.submit(plans.publish_version, *run, root) for run in runs]]
        manifest = read_manifest(spark, f"{root}/manifest")
        per_version = {r.version: (r.n, r.sets) for r in manifest.groupBy("version").agg(
            F.count("*").alias("n"), F.countDistinct("corpus_signature").alias("sets")).collect()}
        assert all(sets == 1 and rows == manifest.where(F.col("version") == v).select("rel_path").distinct().count() for v, (rows, sets) in per_version.items())
        if n == 0:
            assert sorted((p.version, p.created) for p in done) == [(1, True), (2, True)] and len(per_version) == 2
            second = max(done, key=lambda p: p.version)
            assert spark.read.json(f"{second.path}/summary").first().change_detection.previous_version == "v1"
            assert {r.status for r in plans.version_delta(spark, root, 2, 1).collect()} == {"added", "removed"}
        else:
            assert sorted(p.created for p in done) == [False, True] and {p.version for p in done} == {1} and len(per_version) == 1
        assert not [f for f in os.listdir(f"{root}/manifest") if not f.strip(".").startswith("0")]


def test_a_difference_reads_only_prefixes_that_differ(spark, tmp_path):
    names = [f"p{i}" for i in range(60)]

    def pages(edited):
        rows = [(f"https://s.example/{n}", f"<title>{n}{'!' if n in edited else ''}</title>") for n in names if n not in edited[1:2]]
        return spark.createDataFrame(rows, "url string, html string").selectExpr("url AS requested_url", "url AS final_url", "200 AS status", "html")
    root = str(tmp_path)
    plans.publish_version(*plans.harvest(pages([])), root)
    two = plans.publish_version(*plans.harvest(pages(["p3", "p7"])), root)
    delta = plans.version_delta(spark, root, 2, 1)
    assert {r.canonical[-2:]: r.status for r in delta.collect()} == {"p3": "changed", "p7": "removed"}
    read = {f.split("prefix=")[1][:2] for f in delta.inputFiles()}
    touched = {hashlib.sha256(f"https://s.example/{n}".encode()).hexdigest()[:2] for n in ("p3", "p7")}
    assert read == touched
    assert {os.path.basename(p)[7:] for p in glob.glob(f"{two.path}/keys/prefix=*")} <= touched  # and only those are written again
    assert plans.version_delta(spark, root, 2, 2).count() == 0
    with pytest.raises(ValueError):
        plans.version_delta(spark, root, 3, 1)


def test_a_file_is_made_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    (tmp_path / "d").mkdir()
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: create_once(spark, f"{tmp_path}/d/x.json", f"{i}" * 1000), range(8)))
    assert sum(made) == 1
    assert (tmp_path / "d/x.json").read_text() == f"{made.index(True)}" * 1000
    assert [f for f in os.listdir(tmp_path / "d") if not f.startswith(".")] == ["x.json"]


def test_publish_without_records(spark, tmp_path):
    failed = spark.createDataFrame([("https://s.example/x", "https://s.example/x", 500, "")], "requested_url string, final_url string, status int, html string")
    run = plans.harvest(failed)
    one, again = (plans.publish_version(*run, str(tmp_path)) for _ in range(2))
    assert (one.version, one.created, again.created) == (1, True, False) and one.signature
    two = plans.publish_version(*plans.harvest(site(spark, "page")), str(tmp_path))
    assert two.version == 2
    assert {r.status for r in plans.version_diff(spark, str(tmp_path), 2, 1).collect()} == {"added"}


def test_unreadable_summary(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{oops")
    (tmp_path / "other.json").write_text('{"change_detection": {"corpus_signature": null}}')
    assert previous_signature(spark, f"{tmp_path}/bad.json").count() == 0
    assert previous_signature(spark, f"{tmp_path}/other.json").count() == 0


def test_profile_goes_into_the_records(spark):
    profiles = spark.createDataFrame([("s.example", '{"name":"S"}')], "host string, profile string")
    _, records = plans.harvest(site(spark, "page"), profiles=profiles)
    assert records.select(F.to_json("company_fixed").alias("p")).first().p == '{"name":"S"}'
    plain = plans.harvest(site(spark, "page"))[1]
    assert plain.first().record_hash != records.first().record_hash


def test_sitemaps(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    docs = [
        ("https://s.example/index.xml", 200, f"<sitemapindex {ns}>" + "".join(f"<sitemap><loc> {u} </loc></sitemap>" for u in (
            "https://S.example/a.xml", "https://s.example/b.xml", "https://s.example/dead.xml", "https://x.example/c.xml",
            "https://s.example/missing.xml")) + "</sitemapindex>"),
        ("https://S.example/a.xml", 200, f'<urlset {ns} xmlns:i="urn:i"><url><loc>https://s.example/2?a=1&amp;b</loc><i:image><i:loc>https://s.example/i</i:loc></i:image></url>'
                                         "<url><loc>https://s.example/1</loc></url><url><loc>https://s.example/1</loc></url><url><loc/></url></urlset>"),
        ("https://s.example/b.xml", 200, "<urlset><url><LOC>\nhttps://s.example/3\n</LOC><loc>https://x.example/no</loc> broken"),
        ("https://s.example/dead.xml", 500, "<urlset><url><loc>https://s.example/dead</loc></url></urlset>"),
        ("https://x.example/c.xml", 200, "<urlset><url><loc>https://s.example/foreign</loc></url></urlset>"),
        ("https://s.example/unlisted.xml", 200, "<urlset><url><loc>https://s.example/unlisted</loc></url></urlset>"),
    ]
    df = spark.createDataFrame(docs, "sitemap_url string, status int, xml string")
    locs = sitemap_locs(df.where("sitemap_url LIKE '%/a.xml'")).orderBy("pos").collect()
    assert [r.loc for r in locs] == ["https://s.example/2?a=1&b", "https://s.example/1", "https://s.example/1"]
    odd = [("deep", f"<urlset {ns}><url><loc>u1</loc><loc>u2</loc><group><url><loc> u3 </loc></url></group></url></urlset>"), ("junk", "<urlset><url><loc>a</loc></url></urlset> <loc>b</loc>"),
           ("prefix", '<s:urlset xmlns:s="urn:s"><s:url><s:loc>p</s:loc><loc>no</loc></s:url></s:urlset>'), ("none", None)]
    got = sitemap_locs(spark.createDataFrame([(u, 200, x) for u, x in odd], "sitemap_url string, status int, xml string"))
    assert sorted((r.sitemap_url, r.pos, r.loc) for r in got.collect()) == [("deep", 0, "u1"), ("deep", 1, "u2"), ("deep", 2, "u3"), ("junk", 0, "a"), ("junk", 1, "b"), ("prefix", 0, "p")]
    is_index = F.col("sitemap_url").endswith("index.xml")
    frontier = discover_frontier(df, is_index, "S.example")
    assert [r.url for r in frontier.collect()] == ["https://s.example/1", "https://s.example/2?a=1&b", "https://s.example/3"]
    with pytest.raises(ValueError):
        require_frontier(discover_frontier(df, is_index, "other.example"))


def test_harvest_site(spark, tmp_path):
    index = "https://s.example/index.xml"
    maps = spark.createDataFrame([
        (index, 200, "<sitemapindex><sitemap><loc>https://s.example/m.xml</loc></sitemap></sitemapindex>"),
        ("https://s.example/m.xml", 200, "<urlset>" + "".join(f"<url><loc>https://s.example/{n}</loc></url>" for n in ("art1", "page", "never")) + "</urlset>"),
    ], "sitemap_url string, status int, xml string")
    results, records = plans.harvest_site(maps, site(spark), index)
    assert {r.url[18:]: (r.ok, r.status, r.error) for r in results.collect()} == {
        "art1": (True, 200, None), "page": (True, 200, None), "never": (False, 0, "HTTP 0")}
    assert records.count() == 2
    store = FetchStore.create(site(spark), str(tmp_path / "store"), buckets=3)
    stored = plans.harvest_site(maps, store, index)[0]
    assert sorted(r.record_hash or "" for r in stored.collect()) == sorted(r.record_hash or "" for r in results.collect())
    with pytest.raises(ValueError):
        plans.harvest_site(maps, site(spark), "index.xml")


def test_read_fetched_and_stream_agree(spark, tmp_path):
    site(spark).write.parquet(f"{tmp_path}/in")
    batch = plans.harvest_results(read_fetched(spark, f"{tmp_path}/in"))
    query = harvest_stream(fetched_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/ck")
    query.awaitTermination(120)
    streamed = spark.read.parquet(f"{tmp_path}/out")
    assert streamed.count() == 5
    assert corpus_signature(ok_records(streamed, ("record_hash",))).first() == corpus_signature(ok_records(batch, ("record_hash",))).first()


def test_stream_restarted_between_arrivals(spark, tmp_path):
    """URLs that come again, also in a later run, are harvested once; running counts equal those of a batch over the URLs once."""
    def arrive(names, hour):
        rows = site(spark, *names).withColumn("fetched_at", F.expr(f"timestamp'2025-01-01 00:00:00' + interval {hour} hours"))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        query = harvest_stream(fetched_once(fetched_stream(spark, f"{tmp_path}/in", timed=True)).drop("fetched_at"), f"{tmp_path}/out", f"{tmp_path}/ck1")
        counts = metrics_stream(fetched_once(fetched_stream(spark, f"{tmp_path}/in", timed=True)).drop("fetched_at"), f"{tmp_path}/counts", f"{tmp_path}/ck2")
        query.awaitTermination(300)
        counts.awaitTermination(300)

    arrive(["art1", "page"], 0)
    arrive(["art1"], 1)
    run()
    arrive(["page", "prod", "art1"], 2)
    run()  # as a new process would, from the checkpoints
    run()
    urls = [r.url for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(urls) == sorted(f"https://s.example/{n}" for n in ("art1", "page", "prod"))
    batch = plans.harvest_results(site(spark, "art1", "page", "prod")).groupBy("ok", "status", "page_type").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, latest_metrics(spark, f"{tmp_path}/counts").collect())) == sorted(map(tuple, batch.collect()))


def test_corpus_is_read_by_as_many_tasks_as_files(spark, tmp_path):
    rows = [(f"https://s.example/{i % 40}", f"<title>t{i}</title><p>{LONG * 20}</p>") for i in range(200)]
    records = build_records(shred_pages(from_pages(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string"))))
    stats = corpora.write_jsonl(records, f"{tmp_path}/all", file_bytes=20_000).first()
    files = sorted(glob.glob(f"{tmp_path}/all/part-*.gz"))
    lines = [gzip.open(f, "rt", encoding="utf-8").read().splitlines() for f in files]
    assert len(files) > 8 and len({len(some) for some in lines[:-1]}) == 1
    assert max(sum(map(len, some)) for some in lines) < 25_000
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        assert read_corpus(spark, f"{tmp_path}/all").rdd.getNumPartitions() >= len(files)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    written = [json.loads(line) for some in lines for line in some]
    keys = [(r["document_identifier"]["canonical"], r["document_identifier"]["page_type"], r["doc_id"]) for r in written]
    assert keys == sorted(keys) and stats.n_records == 200
    back = read_positions(spark, f"{tmp_path}/all").select("position", "doc_id").orderBy("position").collect()
    assert [(r.position, r.doc_id) for r in back] == [(i, k[2]) for i, k in enumerate(keys)]


def test_positions_of_an_empty_corpus(spark, tmp_path):
    corpora.write_jsonl(build_records(shred_pages(site(spark).limit(0))), f"{tmp_path}/none")
    assert read_positions(spark, f"{tmp_path}/none").count() == 0


def test_flat_files_read_only_their_types_folder(spark):
    results, records = plans.harvest(site(spark))
    for flat, kind in ((tables.csv_products, "Product"), (tables.csv_articles, "Article")):
        plan = flat(records)._jdf.queryExecution().executedPlan().toString()
        filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
        assert filters and all(f"(page_type" in line and kind in line for line in filters)
        assert flat(records).count() == (1 if kind == "Product" else 2)


def test_staged_tables_are_removed(spark, tmp_path):
    from corpusloom import session
    before = session._STAGED[:]
    session._STAGED.clear()
    try:
        staged = session.stage(spark.range(3), "x")
        path = session._STAGED[0]
        assert staged.count() == 3 and os.path.isdir(path)
        assert session.clear_staged(spark) == 1 and not os.path.exists(path)
    finally:
        session._STAGED[:] = before


@pytest.mark.parametrize("by", [(), ("g",)])
def test_numbers_in_order(spark, by):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 10 + ["a", None]), rng.choice([None, *range(30)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(7)
    got = [(r.g if by else "", r.v, r.position, r.size) for r in numbered(df, F.col("v").asc_nulls_last(), by=by, total="size").collect()]
    groups = {}
    for g, v in rows:
        groups.setdefault(g if by else "", []).append(v)
    want = [(g, v, i, len(vs)) for g, vs in groups.items() for i, v in enumerate(sorted(vs, key=lambda v: (v is None, v or 0)))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert numbered(df.limit(0), F.col("v"), by=by).count() == 0


def test_from_pages_keeps_keys(spark):
    pages = spark.createDataFrame([(7, "u", "<p>x")], "page_id long, url string, html string")
    assert from_pages(pages).first().asDict() == {"page_id": 7, "requested_url": "u", "final_url": "u", "status": 200, "html": "<p>x"}
