"""Toxicity by a weighted finite-state pattern grammar (operator 2).

A text becomes clauses of word classes: insults, threats, targets, negations, reporting verbs. Three small
transducers read the classes, each tracking one thing (is the clause negated, reported, aimed at somebody);
they are composed into one product machine. Insults and threats are not in it: they are read beside it, and
its state at them, with the one at the clause's end, says what was matched: a plain, targeted, negated or
reported insult, a threat, or an untargeted one. A document's score is a logistic function of the weights of
its matched clauses, and of the number of matched words, of distinct ones, and their weight in a hundred words.

What counts as an insult is learned from labelled rows: beginnings of words and whole words that occur
nearly only in rows labelled toxic get the logit of a lower confidence bound as weight, besides a short
fixed list. The weights of the clause kinds are fitted on other labelled rows. Both use rows of a sample
of at most about ``TRAIN_ROWS`` labelled documents, none with crc32(doc_id) mod 4 = 2; every document is
scored over its whole text.

Defined results: null and empty texts get the score of a text without matches; a null doc_id is not held
out; repeated rows get the same score; without labels the fixed list and the prior weights hold.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Bound of the labelled sample, of the learned lexicon, least support of an entry, and lengths of beginnings.
TRAIN_ROWS, LEXICON, SUPPORT, LENGTHS = 20_000, 20_000, 4, range(3, 9)
LIMIT = 0.3

# The grammar's word lists (English, German, French, Spanish).
INSULTS = """idiot moron stupid clown scum trash loser pathetic worthless disgusting imbecile fool dumb
    dummkopf trottel abschaum verlierer connard imbécile crétin ordure idiota imbécil estúpido basura""".split()
THREATS = """kill hurt destroy punch stab shoot strangle beat töten umbringen schlagen erschießen tuer
    frapper détruire matar golpear destruir""".split()
TARGETS = """you your yours he she they him them his her their du dich dir ihr euch sie er tu toi vous te
    il elle ils tú usted ustedes él ella ellos""".split()
NEGATIONS = """not no never isn aren wasn don doesn didn nicht kein keine nie pas jamais aucun nunca jamás
    ningún""".split()
REPORTS = """said says say told wrote quoted claimed alleged reported called sagte sagt schrieb behauptete dit
    disait écrit prétend dijo dice escribió""".split()

#: Class codes of words; FULL ends a clause. Insults have a code for each level of weight.
PLAIN, FULL, TARGET, NEGATION, REPORT, THREAT, INSULT = b" .tnrT1"
LEVELS = 4
TOKEN = re.compile(r"\w+|[.!?;:\n|]")

#: The kinds of matched clauses, in the order of the features.
KINDS = ("insult", "targeted", "negated", "reported", "threat", "wish")
#: Prior coefficients: intercept, then the sum of weights of each kind, insult words, distinct ones, and in a hundred words.
PRIOR = np.array([-3.0, 1.5, 1.8, 0.3, 0.4, 1.5, 0.2, 0.6, 0.6, 0.3])


def transducers() -> list[dict]:
    """Each: states from 0, and moves (state, class) -> state; other classes keep the state."""
    near = {(0, NEGATION): 3, (3, PLAIN): 2, (2, PLAIN): 1, (1, PLAIN): 0}  # a negation reaches three words on
    near |= {(s, c): max(0, s - 1) for s in (1, 2, 3) for c in (TARGET, REPORT)} | {(s, NEGATION): 3 for s in (1, 2, 3)}
    return [
        {"name": "negation", "moves": near},
        {"name": "report", "moves": {(0, REPORT): 1}},
        {"name": "target", "moves": {(0, TARGET): 1}},
    ]


def compose() -> tuple[dict[tuple[int, int], int], list[tuple[int, ...]]]:
    """The product machine: moves over the states that can be reached, and what each state stands for."""
    parts, classes = transducers(), (PLAIN, TARGET, NEGATION, REPORT, THREAT, INSULT)
    states, moves, at = [(0,) * len(parts)], {}, 0
    while at < len(states):
        for c in classes:
            to = tuple(p["moves"].get((s, c), s) for p, s in zip(parts, states[at], strict=True))
            if to not in states:
                states.append(to)
            moves[at, c] = states.index(to)
        at += 1
    return moves, states


MOVES, STATES = compose()
SHOUT = re.compile(rb"[T1-9]")


def clause_match(clause: bytes, weights: list[float]) -> list[tuple[int, float]]:
    """The matches of one clause: (kind, weight) for each insult and threat in it."""
    state, found = 0, []
    for c in clause:
        if c == THREAT or c >= INSULT and c < INSULT + LEVELS:
            negated, reported, _ = STATES[state]
            if c == THREAT:
                found.append((None, 1.0))
            else:
                found.append((2 if negated else 3 if reported else 0, weights[c - INSULT]))
            c = THREAT if c == THREAT else INSULT
        state = MOVES[state, c]
    aimed = STATES[state][2]
    return [((4 if aimed else 5) if k is None else 1 if k == 0 and aimed else k, w) for k, w in found]


class Classes(dict):
    """Word to class code, looked up once a word."""

    def __init__(self, lexicon: dict[str, float], weights: list[float]):
        self.lexicon, self.weights = lexicon, weights
        self.fixed = ({w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS}
                      | {w: THREAT for w in THREATS})

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[token] = code = self.code(token)
        return code

    def code(self, token: str) -> int:
        if not (token[0].isalnum() or token[0] == "_"):
            return FULL
        got = [self.lexicon[f] for f in features(token) if f in self.lexicon]
        if got:
            return INSULT + int(np.searchsorted(self.weights[1:], max(got), "right"))
        return self.fixed.get(token, PLAIN)


def features(word: str) -> list[str]:
    """A word's beginnings and the word itself (marked at its end)."""
    return [word[:n] for n in LENGTHS if n <= len(word)] + [word + "$"]


def document_features(text: str | None, classes: Classes) -> list[float]:
    """Logs of: weights of the matched clauses by kind, matched words, distinct ones, and weight in a hundred words."""
    sums, words = [0.0] * len(KINDS), Counter()
    tokens = TOKEN.findall((text or "").lower())
    codes = bytes(map(classes.__getitem__, tokens))
    if SHOUT.search(codes):
        for clause in codes.split(bytes([FULL])):
            if SHOUT.search(clause):
                for kind, weight in clause_match(clause, classes.weights):
                    sums[kind] += weight
        for m in SHOUT.finditer(codes):
            words[tokens[m.start()]] += 1
    part = 100 * sum(sums) / max(20, len(codes))
    return [math.log1p(x) for x in (*sums, words.total(), len(words), part)]


def _counts(batches):
    """Of each batch of texts (label, text): in how many texts with either label each beginning or word occurs."""
    for batch in batches:
        toxic, all_ = Counter(), Counter()
        for label, text in zip(batch.column("_label").to_pylist(), batch.column("_text").to_pylist(), strict=True):
            got = set(itertools.chain.from_iterable(map(features, set(re.findall(r"\w+", (text or "").lower())))))
            all_.update(got)
            if label:
                toxic.update(got)
        keys = list(toxic)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
                                          pa.array([all_[k] for k in keys], pa.int64())], names=["f", "toxic", "n"])
        keys = [k for k in all_ if k not in toxic]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([0] * len(keys), pa.int64()),
                                          pa.array([all_[k] for k in keys], pa.int64())], names=["f", "toxic", "n"])


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(_fold, _label, _text): distinct labelled texts, held-out rows excluded, thinned by a hash to the bound."""
    crc = F.crc32(F.col("_id").cast("string"))
    known = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_label"))
             .filter("_id IS NOT NULL AND _label IN (0, 1)").groupBy("_id").agg(F.max("_label").alias("_label"))
             .withColumn("_fold", (crc % 4).cast("int")).filter("_fold <> 2"))
    n = known.count()
    if n > TRAIN_ROWS:
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * TRAIN_ROWS / n))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    # at most about TRAIN_ROWS rows of three numbers
    return stored(rows.join(F.broadcast(known), "_id").dropDuplicates(["_text"]).select("_fold", "_label", "_text").repartition(64), "labelled")


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of beginnings and words: the logit of the lower bound of the share of toxic texts with them."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("toxic")).first()
    lexicon = {w + "$": 2.0 for w in INSULTS}
    if not total["n"] or not total["toxic"]:
        return lexicon
    base, z = total["toxic"] / total["n"], 1.64
    share, n = F.col("toxic") / F.col("n"), F.col("n")
    lower = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    found = (rows.select("_label", "_text").mapInArrow(_counts, "f string, toxic long, n long")
             .groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).filter(F.col("toxic") >= SUPPORT)
             .withColumn("lower", lower).filter(F.col("lower") >= max(0.5, min(0.9, 3 * base)))
             .orderBy(F.desc("lower"), F.desc("n"), "f").limit(LEXICON).collect())
    for r in found:
        lexicon[r["f"]] = max(lexicon.get(r["f"], 0.0), min(4.0, math.log(r["lower"] / (1 - min(r["lower"], 0.99)))) + 0.1)
    return lexicon


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, held towards the prior coefficients."""
    x, hold = np.hstack([np.ones((len(x), 1)), x]), np.full(len(PRIOR), 1.0)
    hold[0] = 0.01
    beta = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - hold * (beta - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), gradient)
        beta = beta + step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def score(values: list[float], beta: np.ndarray) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(beta[0]) + sum(b * v for b, v in zip(beta[1:].tolist(), values, strict=True))))))


class Model:
    def __init__(self, lexicon: dict[str, float], beta: np.ndarray | None = None):
        self.weights = [0.1, 0.8, 1.6, 2.4]  # the levels to which weights are rounded down
        self.lexicon, self.beta = lexicon, PRIOR if beta is None else beta

    def classes(self) -> Classes:
        return Classes(self.lexicon, self.weights)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    rows = training_rows(docs, labels)
    model = Model(learn_lexicon(rows.filter("_fold IN (0, 1)")))
    shared = spark.sparkContext.broadcast(model.lexicon)  # at most LEXICON entries and the fixed list

    def measured(batches):
        classes = Model(shared.value).classes()
        for batch in batches:
            got = [document_features(t, classes) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.float64())), batch.column("_label")], names=["x", "y"])

    found = rows.filter("_fold = 3").select("_text", "_label").mapInArrow(measured, "x array<double>, y int").collect()
    if found:
        model.beta = fit(np.array([r["x"] for r in found]), np.array([r["y"] for r in found], float))
    model.lexicon = learn_lexicon(rows)  # now that the weights are known, from all labelled rows
    return model


def scored(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The documents' own columns, then _score."""
    shared = spark.sparkContext.broadcast((model.lexicon, model.beta))
    names = docs.columns
    work = docs.select(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(names)],
                       docs["text"].cast("string").alias("_text"))
    kept = [f"c{i}" for i in range(len(names))]

    def run(batches):
        lexicon, beta = shared.value
        classes = Model(lexicon).classes()
        for batch in batches:
            got = [score(document_features(t.as_py(), classes), beta) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(got, pa.float64())], names=[*kept, "_score"])

    schema = work.drop("_text").schema.add("_score", "double")
    return work.mapInArrow(run, schema).toDF(*names, "_score")


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(spark, docs, labels)
    got = scored(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), F.col("_score").alias("score"),
                      (F.col("_score") >= LIMIT).cast("int").alias("predicted"))


def without_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is under the limit, with their own columns."""
    return scored(spark, docs, train(spark, docs, labels)).filter(F.col("_score") < LIMIT).drop("_score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
