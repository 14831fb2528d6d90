import re
import zlib

import numpy as np
import pytest
from brute import DOCUMENTS, documents

from corpusloom.llm import toxicity as X


def outputs(machine, symbols):
    state, out = 0, []
    for s in symbols:
        state, put = machine.step(state, s)
        out.append(put)
    return out


def test_composition_equals_running_in_turn():
    parts = [X.negation(2), X.reported_speech(), X.target()]
    whole = X.compose(X.compose(parts[0], parts[1]), parts[2])
    symbols = "other insult negation other insult insult end report threat target insult end negation end insult end".split()
    in_turn = symbols
    for part in parts:
        in_turn = outputs(part, in_turn)
    assert outputs(whole, symbols) == in_turn
    assert in_turn[4] == "negated insult" and in_turn[5] == "insult" and in_turn[8] == "reported threat" and in_turn[11] == "addressed end" and in_turn[15] == "end"


def test_clauses_not_isolated_words():
    score = X.Scorer(X.Lexicon({"fool": 2.0, "dumm*": 3.0})).features
    assert score("You are a fool.") == [0, 2, 0, 0, 1]
    assert score("A FOOL! He left.") == [2, 0, 0, 0, 1]
    assert score("not a fool, no harm") == [0, 0, 2, 0, 1]
    assert score("They said fool") == [0, 0, 0, 2, 1]
    assert score("Er ist ein Dummkopf; nicht dumm") == [3, 0, 3, 0, 2]
    assert score("I will kill you") == [0, 3, 0, 0, 1]
    assert score("foolish skill undumm") == [0, 0, 0, 0, 0] and score("") == [0, 0, 0, 0, 0]


def test_cues_are_stems_or_whole_words():
    cues = {"lou": (30, 3.0), "lout": (29, 3.5), "lout$": (29, 3.5), "verm": (40, 4.0), "vermA": (9, 4.0), "vermA$": (9, 4.0), "vermB$": (9, 4.0)}
    assert X.choose_cues(cues) == {"lout": 3.5, "verm*": 4.0}


def test_held_out_rows_and_accuracy(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = X.score_documents(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


@pytest.mark.parametrize("known", [[], [(2, 1, 1)], [(1, 1, 0), (2, 1, 0), (3, 0, None), (2, 1, 0)]])
def test_awkward_rows(spark, known):
    labels = spark.createDataFrame(known, "doc_id bigint, quality int, toxic int")
    got = X.score_documents(documents(spark), labels).collect()
    assert len(got) == len(DOCUMENTS) and all(r.score is not None for r in got)
    assert X.score_documents(documents(spark, []), labels).count() == 0


def test_insults_and_threats_are_matched_in_their_clause():
    score = X.Scorer(X.Lexicon({"fool": 2.0})).features
    assert score("kill the process, then shoot a photo") == [0, 0, 0, 0, 0]
    assert score("They will hurt you") == [0, 3, 0, 0, 1] and score("He kills you") == [0, 3, 0, 0, 1] and score("he killed them all") == [0, 3, 0, 0, 1]
    assert score("I'll gladly strangle") == [3, 0, 0, 0, 1] and score("Je te tuerai") == [3, 0, 0, 0, 1]
    assert score("I will not kill you") == [0, 0, 3, 0, 1] and score("He said they will kill you") == [0, 0, 0, 3, 1]
    assert score("I will kill you and will stab him") == [0, 6, 0, 0, 1]
    assert score("the word fool") == [0, 0, 0, 0, 0] and score("the word is short, you fool") == [0, 2, 0, 0, 1]
    assert score("will you be there when shots kill noise") == [0, 0, 0, 0, 0]


def plain_features(lexicon, text):
    """The transducers one after the other over the words of each clause, without composing them or looking for cues first."""
    out = [0.0] * 5
    for clause in re.split(r"[.!?;:\n]+", text.lower()):
        read = [lexicon.read(w) for w in re.findall(r"[^\W\d_]+", clause)]
        symbols = [symbol for symbol, _ in read] + ["end"]
        for machine in X.machines():
            symbols = outputs(machine, symbols)
        found = [0.0, 0.0, 0.0]
        for symbol, (_, weight) in zip(symbols, read):
            if symbol.endswith(("insult", "threat")):
                found[("negated" in symbol) + 2 * ("reported" in symbol)] += weight if "insult" in symbol else X.THREAT_WEIGHT
        out[symbols[-1] == "addressed end"] += found[0]
        out[2] += found[1]
        out[3] += found[2]
        out[4] += any(found)
    return out


def test_scores_equal_plain_ones(spark, sf_dir):
    """Every document's features by running the machines in turn, and its score by the calibrated sum of them."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    sample = X.training_sample(docs, labels)
    lexicon = X.learn_lexicon(sample)
    known = [(plain_features(lexicon, r.text), r.toxic) for r in sample.collect()]
    weights = X.calibrate(np.array([f for f, _ in known]), np.array([t for _, t in known], np.float64))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = X.score_documents(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        features = plain_features(lexicon, texts[r.doc_id])
        assert [r[f] for f in X.FEATURES] == pytest.approx(features)
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(weights[0] + np.dot(weights[1:], features), -30, 30))), abs=1e-6)


def test_sample_is_bounded_whatever_ids_repeat(spark):
    docs = spark.range(60_000).selectExpr("if(id < 50000, 1, id) as doc_id", "concat('text ', id % 3) as text")
    labels = spark.range(60_000).selectExpr("if(id < 1000, 1, id) as doc_id", "cast(id % 2 as int) as toxic")
    assert X.training_sample(docs, labels, rows=100).count() <= 100
    one = X.training_sample(docs.where("doc_id = 1"), labels.where("doc_id = 1"), rows=100).collect()
    assert [tuple(r) for r in one] in ([], [("text 0", 1)])
