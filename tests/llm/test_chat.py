import hashlib
import itertools
import time

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm.chat import END, HEADER, escape, format_chats, masked_text, parse, unescape

PIECES = ["### ", "###", "</turn>", "\n", "\\", ":", "user", "", "é", "\n</turn>\n", "### assistant:\n", " "]


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string, nth int")
    return format_chats(df).withColumn("turns", parse(F.col("formatted"))).withColumn("loss", masked_text(F.col("formatted"), F.col("loss_mask"))).collect()


def test_all_short_texts_come_back(spark):
    texts = ["".join(p) for n in (1, 2, 3) for p in itertools.product(PIECES, repeat=n)]
    rows = [(i // 9, i % 9, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    got = {r.conv_id: r for r in formatted(spark, rows)}
    for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
        own = list(own)
        assert [tuple(t) for t in got[conv].turns] == [(r[2], r[3]) for r in own]
        assert got[conv].loss == "".join(r[3] for r in own if r[2] == "assistant")
        assert got[conv].agrees


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([*PIECES, "a", "\\\\###"]), max_size=9).map("".join), min_size=30, max_size=30))
def test_escaping_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escape(F.col("t"))).withColumn("u", unescape(F.col("e")))
    for r in df.collect():
        assert r.u == r.t
        assert "\n</turn>\n" not in r.e and ("###" not in r.t or "\\###" in r.e)


def test_awkward_rows(spark):
    rows = [(1, 1, None, None), (1, 0, "a:\n\\b ### x", "q"), (1, 0, "a:\n\\b ### x", "q"), (1, None, "user", "first"), (None, 0, "assistant", "m" * 300_000), (2, 0, "", "</turn>")]
    got = {r.conv_id: r for r in formatted(spark, rows)}
    assert [tuple(t) for t in got[1].turns] == [("user", "first"), ("a:\n\\b ### x", "q"), ("a:\n\\b ### x", "q"), ("", "")]
    assert got[None].loss == "m" * 300_000
    assert got[2].formatted == f"{HEADER}:\n\\</turn>{END}" and got[2].escapes == 1
    assert formatted(spark, []) == []
    assert hashlib.sha256(got[2].turns[0].text.encode()).hexdigest() == hashlib.sha256(b"</turn>").hexdigest()


def test_broken_text_has_null_turns(spark):
    df = spark.createDataFrame([(f"no header{END}",), (f"{HEADER}user:\nplain ### inside{END}",), (f"{HEADER}user:\nx{END}tail",)], "s string")
    got = [r[0] for r in df.select(parse(F.col("s"))).collect()]
    assert got[0] == [None] and got[1] == [None] and got[2][1] is None


def test_long_runs_of_backslashes(spark):
    """A million backslashes are gone through once a pass, before a control string or not."""
    run = "\\" * 1_000_000
    rows = [(1, 0, "assistant", run), (2, 0, "assistant", run + "###" + run), (3, 0, "user", (run[:200_000] + "x") * 5)]
    began = time.time()
    got = {r.conv_id: r for r in formatted(spark, rows)}
    assert time.time() - began < 60
    assert {c: r.turns[0].text for c, r in got.items()} == {c: t for c, _, _, t in rows}
    assert got[1].loss == run and got[2].loss == run + "###" + run and got[3].loss == ""
    assert (got[1].escapes, got[2].escapes) == (0, 1)
