"""Suffix statistics cover all rows, whatever the trees' sample holds."""

import math
from collections import Counter

from test_urls import RULES, check, parts, rule

from corpusloom.llm import urlfilter as U


def test_suffix_statistics_of_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(U, "TRAIN_ROWS", 20)
    urls = [f"http://s{i}.{('net', 'org', 'io', 'shop')[i % 4]}/{('fr', 'en')[i % 3 == 0]}/{i % 90}" for i in range(400)]
    urls += ["http://a.example.net/en/x"] * 70 + [None, "no scheme"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    seen, featured = [], U.featured
    monkeypatch.setattr(U, "featured", lambda rows, suffixes, rate: seen.append((suffixes, rate)) or featured(rows, suffixes, rate))
    got = U.judge_urls(df, RULES)
    check(list(enumerate(urls)), got.collect())

    n, labels = Counter(), {}
    for url in urls:
        host, path = parts(url)
        suffix = host.rsplit(".", 1)[-1]
        n[suffix] += 1
        if fits := rule(host, path):
            labels.setdefault(suffix, []).append(RULES[fits] == "block")
    rate = sum(map(sum, labels.values())) / sum(map(len, labels.values()))
    suffixes, found_rate = seen[-1]
    assert math.isclose(found_rate, rate)
    rows = {r["_suffix"]: (r.suffix_rate, r.suffix_weight) for r in suffixes.collect()}
    assert rows.keys() == n.keys() >= {"io", "shop", ""}  # no rule fits these
    for suffix, (suffix_rate, weight) in rows.items():
        own = labels.get(suffix, [])
        assert math.isclose(weight, math.log2(n[suffix] + 1))
        assert math.isclose(suffix_rate, (sum(own) + 2 * rate) / (len(own) + 2))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a large suffix table
    try:
        assert sorted(U.judge_urls(df, RULES).collect()) == sorted(got.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
