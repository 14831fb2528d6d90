"""Column helpers against plain Python."""

import re
from urllib.parse import urljoin, urlsplit

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import urls as U
from corpusloom.functions import variants as V
from corpusloom.operators.classify import classify_heading, classify_headings, section_rules
from corpusloom.rules import SECTION_PATTERNS

BASES = ["http://h.example", "http://h.example/", "https://h.example:81/a/b/c?q=1", "http://h.example/a//b/",
         "http://h.example/a/./x/../y", "HTTP://u@H.example/a/b#frag"]
REFS = ["", "x", "x/y", "/x", "//o.example/x", "?q", "#f", "?q#f", ".", "..", "./", "../", "../x", "../../x", "../../../x", "./x",
        "x/.", "x/..", "x/../y", "/a/../b/./c", "/..", "/.", "a//b", "/a//b", "//o.example", "http://o.example/p/../q",
        "https://o.example/p", "mailto:a@b", "javascript:void(0)", "tel:+1", "x y", "/p?x=/../y", "/p#/../y", "g;x=1/../y",
        "http:rel", "HTTP://o.example/A", " x", "\tx\n", "é/ü", "/a.b/c.d/", "a:b", "1:b", "/%2e%2e/x", "http://o.example?x", "?", "#",
        "/x?", "ftp://f.example/x"]


def test_url_join(spark):
    pairs = [(b, r) for b in BASES for r in REFS]
    df = spark.createDataFrame(pairs, "base string, ref string")
    got = df.select("base", "ref", F.expr(U.make_abs(U.split_url("base"), "ref")).alias("url")).collect()
    wrong = [(r.base, r.ref, r.url, urljoin(r.base, r.ref)) for r in got if r.url != urljoin(r.base, r.ref)]
    assert wrong == []


def test_authority(spark):
    urls = [*BASES, "mailto:x@y", "/x", "", "http://U:P@Host:1/x?y#z"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select("u", F.expr(U.authority("u")).alias("a")).collect()
    assert all(r.a == urlsplit(r.u).netloc.lower() for r in got)


def test_whitespace(spark):
    odd = [chr(c) for c in range(1, 0x3100) if re.match(r"\s", chr(c))]
    texts = ["", " ", *[f"{c}a{c}{c} b{c}" for c in odd], "a​b", "no change"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", F.expr(X.normalize_ws("t")).alias("n"), F.expr(X.strip("t")).alias("s")).collect()
    assert [r.n for r in got] == [re.sub(r"\s+", " ", r.t).strip() for r in got]
    assert [r.s for r in got] == [r.t.strip() for r in got]


def test_headings(spark):
    def brute(text):
        norm = re.sub(r"[:?؛،\.\-]+$", "", re.sub(r"\s+", " ", text).strip().lower()).strip()
        return next((s for s, ps in SECTION_PATTERNS for p in ps if re.search(p, norm)), None)

    words = ["Description", "descriptions", "what is", "Aka", "specification", "Specifications:", "grade", "upgrade", "uses", "reused",
             "industry", "Industries ", "Packing", "packaging and delivery", "physical  properties", "étage grade", "gradeé", "About؟", "about،", ""]
    texts = [f"{a} {b}" for a in words for b in words]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", F.expr(classify_heading("t")).alias("s")).collect()
    assert [(r.t, r.s) for r in got if r.s != brute(r.t)] == []


def test_rule_table(spark):
    rows = section_rules(spark).orderBy("section_prio", "pattern_prio").collect()
    assert len(rows) == 37 and rows[0].section == "description" and rows[-1].section == "packing"


def test_json_is_one_whole_value(spark):
    good = ['{"a":1}', ' {"a": [1, 2]} ', "\ufeff[1]", '"x"', '{"a": NaN, "b": "NaN, \\" Infinity", "c": [-Infinity, 1]}', "null"]
    bad = ['{"a":1};', '{"a":1}{"b":2}', '{"a":1} text', "", "{", "oops", '1,2', '1],[2', '1,"#end"],["#end"']
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    got = [r[0] for r in df.selectExpr(f"to_json({V.tolerant_json('t')})").collect()]
    assert got[:5] == ['{"a":1}', '{"a":[1,2]}', "[1]", '"x"', '{"a":null,"b":"NaN, \\" Infinity","c":[null,1]}']
    assert got[6:] == [None] * len(bad)


def test_rules_from_a_table(spark):
    """The first rule by priority wins, whether it is found by a word or tested one by one; a third of all headings are alike."""
    texts = ["Description", "What is this?", "Industries", "Re-usage of", "packing  and storage:", "Synonym", "other name", "unrelated", "", None, "grades",
             "x foo y", "foo_bar", "foo", "bar foo 7", "foo?", "éfoo", "a foodie"] + ["Description"] * 9
    headings = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key int, heading string")
    more = [(2, 0, "late", r"\bfoo\b"), (2, 1, "later", "foo"), (0, 90, "digit", r"foo \d"), (7, 0, "optional", r"(\bfoo\b)?_bar"), (7, 1, "starred", r"fo*d")]
    rules = section_rules(spark).union(spark.createDataFrame(more, "section_prio int, pattern_prio int, section string, pattern string"))
    listed = sorted([(i, j, s, p) for i, (s, ps) in enumerate(SECTION_PATTERNS) for j, p in enumerate(ps)] + more)
    got = {r.key: (r.norm, r.section) for r in classify_headings(headings, rules).collect()}
    for key, (norm, section) in got.items():
        assert section == next((s for _, _, s, p in listed if re.search(p, norm)), None), norm
    assert len(got) == len(texts) and got[0][1] == "description" and got[14][1] == "digit"
    plan = classify_headings(headings, rules)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = classify_headings(headings, rules.limit(0)).collect()
    assert len(none) == len(texts) and all(r.section is None for r in none)
    with pytest.raises(Exception, match="too many rules"):
        classify_headings(headings, spark.range(1001).selectExpr("0 section_prio", "int(id) pattern_prio", "'s' section", "concat('a|', id) pattern")).collect()
