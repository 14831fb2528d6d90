"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import stage

from .common import tidy

#: Bound of the training sample, in labelled documents.
TRAIN_ROWS = 20_000
#: A learned cue begins at least this many (document, word) pairs of label 1, and is this much likelier there.
LEAST_SEEN, LEAST_LOG_ODDS, LEAST_EVIDENCE = 5, 2.5, 12.0
SHORTEST, LONGEST = 3, 12
RIDGE = 0.01

# Fixed word lists of the grammar, in English, German, French and Spanish. Words that one of these languages uses for
# something common in another are left out, for the language of a text is no input.
TARGETS = ("you your yours yourself he she they them these those people everyone anyone dich dir euch ihr ihnen leute "
           "toi vous tu vos votre gens eux tú ustedes vosotros ellos gente").split()
NEGATIONS = "not never neither nor cannot hardly nicht kein keine keinen nie niemals pas jamais aucun aucune nunca jamás tampoco ningún".split()
REPORTS = ("said says saying called calls wrote writes quoted claimed claims reported alleged sagte sagt nannte schrieb behauptet "
           "dit disait écrit appelé affirme dijo dice escribió llamó afirma").split()
HARMS = ("kill kills killed killing murder murders murdered murdering stab stabs stabbed stabbing strangle strangles strangled strangling shoot shoots shot shooting "
         "hurt hurts hurting umbringen umbringe umbringt umgebracht töten töte tötet getötet erschießen erschieße erschießt erschossen ermorden ermorde ermordet "
         "tuer tue tues tuez assassiner assassine égorger égorge étrangler étrangle matar mato mata matamos asesinar asesina apuñalar apuñala").split()
VOWS = "tuerai tuerons assassinerai égorgerai étranglerai mataré mataremos asesinaré apuñalaré".split()  # harm in a future form
INTENTS = "will ll gonna going shall must werde werden muss vais allons voy vamos".split()
MENTIONS = "word words term terms wort wörter begriff mot mots terme palabra palabras término".split()
INSULTS = ("idiot moron stupid loser pathetic worthless disgusting scum trash imbecile jerk bastard bitch asshole dumbass trottel arschloch dummkopf "
           "schwachkopf connard imbécile abruti salaud crétin idiota imbécil estúpido cabrón pendejo").split()
INSULT_WEIGHT, THREAT_WEIGHT = 3.0, 3.0

WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n]+")

# --- transducers -------------------------------------------------------------------------------------------------------

#: Symbols of words, and what transducers make of them: matched insults and threats, and their marked forms.
SYMBOLS = ("other", "insult word", "mention", "harm", "vow", "intent", "target", "negation", "report", "end", "insult", "threat", "aimed threat",
           "negated insult", "negated threat", "reported insult", "reported threat", "addressed end")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) -> (state, symbol put out); what has no arc passes unchanged and keeps the state."""

    arcs: dict[tuple[int, str], tuple[int, str]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (state, symbol))

    def states(self) -> list[int]:
        return sorted({0} | {s for s, _ in self.arcs} | {s for s, _ in self.arcs.values()})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Reads what ``first`` reads and puts out what ``second`` makes of its output."""
    number, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        for symbol in SYMBOLS:
            a2, middle = first.step(a, symbol)
            b2, out = second.step(b, middle)
            if (a2, b2) not in number:
                number[a2, b2] = len(number)
                todo.append((a2, b2))
            arcs[number[a, b], symbol] = (number[a2, b2], out)
    return Transducer(arcs)


def insult(reach: int = 2) -> Transducer:
    """Matches insult words, but not within ``reach`` words after a word for words: 'the word idiot' insults nobody."""
    arcs: dict[tuple[int, str], tuple[int, str]] = {}
    for state in range(reach + 1):
        arcs[state, "mention"] = (reach, "mention")
        arcs[state, "end"] = (0, "end")
        arcs[state, "insult word"] = (max(0, state - 1), "other" if state else "insult")
        for symbol in ("other", "harm", "vow", "intent", "target", "report", "negation"):
            arcs[state, symbol] = (max(0, state - 1), symbol)
    return Transducer(arcs)


def threat(reach: int = 3) -> Transducer:
    """Matches a verb of harm within ``reach`` words after an intent, or before somebody it is aimed at, and vows: 'kill the process' threatens nobody.

    A state is what is left of the reach of an intent and of a verb of harm.
    """
    arcs: dict[tuple[int, str], tuple[int, str]] = {}
    number = {(i, h): i * (reach + 1) + h for i in range(reach + 1) for h in range(reach + 1)}
    for (i, h), state in number.items():
        less = number[max(0, i - 1), max(0, h - 1)]
        for symbol in ("other", "mention", "insult", "report"):
            arcs[state, symbol] = (less, symbol)
        arcs[state, "intent"] = (number[reach, max(0, h - 1)], "intent")
        arcs[state, "vow"] = (0, "threat")
        arcs[state, "harm"] = (0, "threat") if i else (number[0, reach], "other")
        arcs[state, "target"] = (number[i, 0], "aimed threat") if h else (less, "target")
        arcs[state, "end"] = (0, "end")
    return Transducer(arcs)


MATCHED = {"insult": "insult", "threat": "threat", "aimed threat": "threat"}


def negation(reach: int = 3) -> Transducer:
    """Marks an insult or threat within ``reach`` words after a negation."""
    arcs: dict[tuple[int, str], tuple[int, str]] = {}
    for state in range(reach + 1):
        arcs[state, "negation"] = (reach, "negation")
        arcs[state, "end"] = (0, "end")
        if state:
            for symbol in ("other", "mention", "intent", "target", "report"):
                arcs[state, symbol] = (state - 1, symbol)
            for symbol, kind in MATCHED.items():
                arcs[state, symbol] = (state - 1, f"negated {kind}")
    return Transducer(arcs)


def reported_speech() -> Transducer:
    """Marks what follows a verb of saying in its clause."""
    arcs = {(0, "report"): (1, "report"), (1, "end"): (0, "end")}
    arcs |= {(1, s): (1, f"reported {kind}") for s, kind in MATCHED.items()}
    return Transducer(arcs)


def target() -> Transducer:
    """Marks the end of a clause that names somebody."""
    return Transducer({(0, "target"): (1, "target"), (0, "aimed threat"): (1, "aimed threat"), (1, "end"): (0, "addressed end")})


def machines() -> list[Transducer]:
    """The five transducers in the order in which each reads what the one before puts out."""
    return [insult(), threat(), negation(), reported_speech(), target()]


def grammar() -> np.ndarray:
    """The composed machine as a table: [state, symbol] -> (state, symbol)."""
    machine = reduce(compose, machines())
    table = np.zeros((len(machine.states()), len(SYMBOLS), 2), np.int64)
    for state in machine.states():
        for i, symbol in enumerate(SYMBOLS):
            to, out = machine.step(state, symbol)
            table[state, i] = to, SYMBOLS.index(out)
    return table


#: What a document is scored by: weights of matched insults and threats, by the form the grammar gave them.
FEATURES = ("plain", "addressed", "negated", "reported", "clauses")


@dataclass(frozen=True)
class Lexicon:
    """Symbols of words: words and word beginnings (``stem*``) with their insult weights, the fixed lists with theirs."""

    weights: dict[str, float]

    def __post_init__(self) -> None:
        lists = {"target": TARGETS, "negation": NEGATIONS, "report": REPORTS, "harm": HARMS, "vow": VOWS, "intent": INTENTS, "mention": MENTIONS}
        fixed = {w: symbol for symbol, some in lists.items() for w in some}
        object.__setattr__(self, "fixed", fixed)
        object.__setattr__(self, "lengths", sorted({len(w) - 1 for w in self.weights if w.endswith("*")}))

    def read(self, word: str) -> tuple[str, float]:
        weight = self.weights.get(word)
        if weight is None:
            weight = next((self.weights[k] for n in self.lengths if n <= len(word) and (k := word[:n] + "*") in self.weights), None)
        if weight is not None:
            return "insult word", weight
        return self.fixed.get(word, "other"), 0.0


class Scorer:
    def __init__(self, lexicon: Lexicon) -> None:
        import ahocorasick

        self.lexicon, self.table = lexicon, grammar().tolist()
        self.symbol = {s: i for i, s in enumerate(SYMBOLS)}
        self.automaton = ahocorasick.Automaton()
        for cue in {w.rstrip("*") for w in lexicon.weights} | set(HARMS) | set(VOWS):
            self.automaton.add_word(cue, len(cue))
        if len(self.automaton):
            self.automaton.make_automaton()

    def features(self, text: str) -> list[float]:
        """Sums over the clauses that hold a cue; texts without any cue are left after one pass of the automaton."""
        out = [0.0] * len(FEATURES)
        low = text.lower()
        if not len(self.automaton) or next(iter(self.automaton.iter(low)), None) is None:
            return out
        for clause in CLAUSE_END.split(low):
            if next(iter(self.automaton.iter(clause)), None) is None:
                continue
            state, found = 0, [0.0, 0.0, 0.0]  # plain, negated, reported
            for word in WORD.findall(clause):
                symbol, weight = self.lexicon.read(word)
                state, put = self.table[state][self.symbol[symbol]]
                name = SYMBOLS[put]
                weight = weight if name.endswith("insult") else THREAT_WEIGHT if name.endswith("threat") else 0.0
                if weight:
                    found[1 if name.startswith("negated") else 2 if name.startswith("reported") else 0] += weight
            state, put = self.table[state][self.symbol["end"]]
            out[1 if SYMBOLS[put] == "addressed end" else 0] += found[0]
            out[2] += found[1]
            out[3] += found[2]
            out[4] += any(found)
        return out


# --- learning ----------------------------------------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from; those without an id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Staged ``(text, toxic)`` of the ``rows`` labelled documents with the smallest hash of their id, none of them held out.

    Of repeated labels the greatest counts, of repeated ids the least text, so the sample has ``rows`` rows at most. The chosen ids are
    bounded by ``rows``, hence the broadcast.
    """
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    return stage(one.join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "toxic-sample")


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """The fixed insults, and the words and word beginnings that mark label 1, weighted by log odds.

    Counts are (document, word) pairs. A beginning is kept if it is clearly likelier under label 1; of nested ones the longest
    that keeps nearly all of its pairs, so that a stem with many endings is one cue and a single word is a whole word.
    """
    label = F.col("toxic").cast("bigint")
    sizes = sample.agg(F.coalesce(F.sum(label), F.lit(0)), F.count("*")).first()
    toxic, clean = sizes[0], sizes[1] - sizes[0]
    words = (sample.select(label.alias("toxic"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))).alias("word"))
             .groupBy("word").agg(F.sum("toxic").alias("ones"), F.count("*").alias("all")))
    cut = F.sequence(F.lit(SHORTEST), F.greatest(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST))))
    begins = F.concat(F.array(F.concat("word", F.lit("$"))), F.transform(cut, lambda n: F.substring("word", F.lit(1), n)))
    counted = (words.filter(F.length("word") >= SHORTEST).select(F.explode(begins).alias("cue"), "ones", "all")
               .groupBy("cue").agg(F.sum("ones").alias("ones"), F.sum("all").alias("all")))
    rate = F.log(((F.col("ones") + 0.5) / (toxic + 1)) / ((F.col("all") - F.col("ones") + 0.5) / (clean + 1)))
    # Evidence: how far the count lies above what label 1's share of documents would give.
    likely = F.col("ones") * F.log(F.greatest(F.col("ones") / F.col("all") / (toxic / max(1, toxic + clean) or 1.0), F.lit(1.0)))
    kept = counted.filter(F.col("ones") >= LEAST_SEEN).withColumn("odds", rate).filter((F.col("odds") >= LEAST_LOG_ODDS) & (likely >= LEAST_EVIDENCE))
    cues = {r["cue"]: (r["ones"], r["odds"]) for r in kept.orderBy(F.desc("ones"), "cue").collect()}  # of a bounded sample
    return Lexicon(dict.fromkeys(INSULTS, INSULT_WEIGHT) | choose_cues(cues))


def choose_cues(cues: dict[str, tuple[int, float]], share: float = 0.9) -> dict[str, float]:
    """Weights by ``word`` or ``stem*`` from counts of ``word$`` and beginnings."""
    chosen: dict[str, float] = {}
    for cue in sorted(cues, key=lambda c: (len(c.rstrip("$")), c.endswith("$"), c)):
        if cue.endswith("$"):
            if not any(cue[:n] + "*" in chosen for n in range(SHORTEST, len(cue))):
                chosen[cue[:-1]] = cues[cue][1]
        else:
            longer = [c for c in cues if c.startswith(cue) and len(c) == len(cue) + 1 and cues[c][0] >= share * cues[cue][0]]
            if not longer and not any(cue[:n] + "*" in chosen for n in range(SHORTEST, len(cue))):
                chosen[cue + "*"] = cues[cue][1]
    return chosen


def _features(lexicon: Lexicon, keep: list[str]) -> Callable:
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for batch in batches:
            texts = batch["text"] if "text" in batch.schema.names else pc.struct_field(batch["row"], "text")
            rows = np.array([scorer.features(t.as_py() or "") for t in texts], np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *(pa.array(rows[:, i]) for i in range(len(FEATURES)))], [*keep, *FEATURES])
    return score


def calibrate(features: np.ndarray, labels: np.ndarray, steps: int = 25) -> np.ndarray:
    """Intercept and weights of a ridge logistic regression; with one label only its rate decides."""
    weights = np.zeros(features.shape[1] + 1)
    if not len(labels) or labels.min() == labels.max():
        weights[0] = 4.0 if len(labels) and labels.max() > 0 else -4.0
        return weights
    x = np.c_[np.ones(len(features)), features]
    ridge = np.diag([1e-6] + [RIDGE] * features.shape[1]) * len(labels) / 100
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge + np.eye(len(weights)) * 1e-9
        weights = weights - np.linalg.solve(curve, x.T @ (p - labels) + ridge @ weights)
    return weights


def score_documents(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keep, held_out, score, predicted, *FEATURES)`` of every row of ``(doc_id, text)``.

    Only the text is scored: learned cues and fixed lists give symbols, the composed grammar rewrites them clause by clause, and a
    calibrated sum of the clause weights gives the score. Null and empty texts have no clause and get the score of the
    intercept. Without labelled documents nothing is learned and scores are low. Repeated rows are scored each; very long texts are read whole, clause by
    clause; an empty table gives no rows; columns named like those added are only read if kept. Rows are never exchanged.
    """
    sample = training_sample(docs, labels)
    lexicon = learn_lexicon(sample)
    fields = ", ".join(f"{f} double" for f in FEATURES)
    known = sample.mapInArrow(tidy(_features(lexicon, ["toxic"])), f"toxic {sample.schema['toxic'].dataType.simpleString()}, {fields}").toArrow()
    matrix = np.column_stack([known[f].to_numpy() for f in FEATURES]).reshape(-1, len(FEATURES))
    weights = calibrate(matrix, known["toxic"].to_numpy().astype(np.float64))
    # A text that is kept anyway travels once.
    text = [] if "text" in keep and docs.schema["text"].dataType == T.StringType() else [F.col("text").cast("string").alias("text")]
    rows = docs.select(F.struct(*keep).alias("row"), *text, held_out(F.col("doc_id")).alias("held_out"))
    scored = rows.mapInArrow(tidy(_features(lexicon, ["row", "held_out"])), f"row {rows.schema['row'].dataType.simpleString()}, held_out boolean, {fields}")
    total = sum((F.col(f) * float(w) for f, w in zip(FEATURES, weights[1:], strict=True)), F.lit(float(weights[0])))
    score = 1 / (1 + F.exp(-F.greatest(F.least(total, F.lit(30.0)), F.lit(-30.0))))
    return (scored.withColumn("score", score).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
            .select(*[F.col("row")[c].alias(c) for c in keep], "held_out", "score", "predicted", *FEATURES))
