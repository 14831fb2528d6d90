import math

from pyspark.sql import functions as F

from corpusloom.llm import urlfilter as U

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[:min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]


def rule(host, path):
    fits = [r for r in RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def check(rows, got):
    assert len(rows) == len(got)
    by = {r.page_id: r for r in got}
    for i, url in rows:
        host, path = parts(url)
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule(host, path))
        assert by[i].verdict == RULES.get(by[i].rule, "block" if by[i].score >= 0.5 else "allow")


def test_rules_on_awkward_urls(spark):
    urls = [None, "", "no scheme.net/", "http://a.NET/x", "http://a.net", "http://net/", "http://anet/", "x://y://z.net/", "http://WWW.Example.com/de/a?b#c", "http://example.com/de",
            "http://q.org/fr/é?x=/", "http://u@h.org:80/fr/", "http:///path", "http://Ä.org/fr/#", "http://a.net?x", "http://a.net#x/", "h" * 20_000, "http://b.example.net/en/1"]
    rows = [*enumerate(urls), (3, urls[3]), (17, urls[17])]  # repeated rows
    df = spark.createDataFrame([(i, u, "x", 1.0) for i, u in rows], "page_id bigint, url string, host string, label double")
    check(rows, U.judge_urls(df, RULES).collect())
    assert U.judge_urls(df.limit(0), RULES).count() == 0
    check(rows[:3], U.judge_urls(df.filter("page_id < 3"), RULES).collect())  # no labelled URL at all


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    check([(r.page_id, r.url) for r in pages.collect()], U.judge_urls(pages, RULES).collect())


def test_trees_learn_lexical_labels(spark):
    """Held-out accuracy on labels that length, digits and parameters decide."""
    urls = [(i, f"http://s{i % 7}.example/" + ("a-b/" * (i % 4)) + ("9" * 12 + f"?p={i}&q=1" if i % 3 == 0 else f"page{i % 10}")) for i in range(600)]
    df = spark.createDataFrame([(i, u) for i, u in urls], "page_id bigint, _url string").withColumns({"_host": U.host_of(F.col("_url")), "_path": U.path_of(F.col("_url"))})
    df = df.withColumn("label", F.when(F.col("page_id") % 3 == 0, 1.0).otherwise(0.0))
    model, suffixes, rate = U.fit(df.filter("page_id % 5 <> 0").drop("page_id"))
    held = model.transform(U.featured(df.filter("page_id % 5 = 0"), suffixes, rate))
    assert held.filter("prediction = label").count() / held.count() > 0.97


def test_entropy(spark):
    df = spark.createDataFrame([("",), ("aaaa",), ("ab.$",), ("aab",)], "t string")
    want = [0.0, 0.0, 2.0, -(2 / 3 * math.log2(2 / 3) + math.log2(1 / 3) / 3)]
    assert all(abs(r[0] - w) < 1e-9 for r, w in zip(df.select(U.entropy(F.col("t"))).collect(), want, strict=True))
