"""Toxicity by a weighted finite-state grammar of clauses.

Insults and threats are looked up in lists. Three small transducers, for
targets, negation and reported speech, are composed to one table of
transitions that marks each of them with what surrounds it in its clause. A
document scores the sums of its words by mark. Words that are aimed at nobody
have a mark and a weight of their own and do score: toxic documents of the
given labels hold insults without a target. The weights of the marks, and which
words are insults beside a fixed list, are learned from labelled documents.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import labelled_sample, reach_workers, slices

#: Labelled documents that weights are learned from at most, the first ones by hash of their id.
TRAIN_DOCS = 20_000
#: Insults learned from labels at most, and the labelled documents that must hold one.
LEARNED, SUPPORT = 300, 5

#: Word lists of the grammar.
INSULTS = frozenset("idiot idiots moron morons loser losers scum trash clown clowns pathetic worthless stupid disgusting dumb fool jerk vermin".split())
THREATS = frozenset("kill hurt destroy punch shoot stab burn beat smash hunt".split())
TARGETS = frozenset("you your yours yourself he she him her his they them their these those people everyone".split())
NEGATIONS = frozenset("not no never neither nor hardly isn't aren't wasn't don't doesn't didn't won't".split())
REPORTS = frozenset("said says say told tells called calls claimed claims wrote quoted according reported".split())

# Symbols that the transducers read.
WORD, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = range(8)
_TOKENS = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;:\n]|[\"“”«»]")
_ENDS, _QUOTES = frozenset(".!?;:\n"), frozenset("\"“”«»")


@dataclass(frozen=True)
class Transducer:
    """Reads symbols in states 0, 1, ...; ``marks`` says which states mark what is read next."""

    step: dict[tuple[int, int], int]  # (state, symbol) -> state; all other pairs count down to 0
    marks: frozenset[int]

    def next(self, state: int, symbol: int) -> int:
        if (state, symbol) in self.step:
            return self.step[state, symbol]
        return 0 if symbol == END else self.rest(state)

    def rest(self, state: int) -> int:
        return max(0, state - 1)


class Held(Transducer):
    """Keeps its state until the clause ends or a symbol changes it."""

    def rest(self, state: int) -> int:
        return state


def _near(symbol: int, reach: int) -> Transducer:
    """Marks the ``reach`` words after a symbol."""
    return Transducer({(s, symbol): reach for s in range(reach + 1)}, frozenset(range(1, reach + 1)))


def grammar() -> list[Transducer]:
    """Target nearby before, negation in scope, reported or quoted speech."""
    reported = {(s, REPORT): 1 for s in (0, 1)} | {(0, QUOTE): 1, (1, QUOTE): 0}
    return [_near(TARGET, 4), _near(NEGATION, 3), Held(reported, frozenset({1}))]


#: Marks of an insult or a threat: its kind, and whether it is aimed, negated or reported.
MARKS = list(itertools.product(("insult", "threat"), (0, 1), (0, 1), (0, 1)))
FEATURES = [*MARKS, "aimed after", "clauses", "strongest", "share"]


@dataclass
class Composed:
    """The product of the transducers as tables over (state, symbol)."""

    step: list[list[int]]
    mark: list[int]

    @staticmethod
    def of(parts: list[Transducer]) -> Composed:
        start = tuple(0 for _ in parts)
        number, queue, step, mark = {start: 0}, [start], [], []
        for state in queue:
            row = []
            for symbol in range(END + 1):
                to = tuple(p.next(s, symbol) for p, s in zip(parts, state, strict=True))
                if to not in number:
                    number[to] = len(queue)
                    queue.append(to)
                row.append(number[to])
            step.append(row)
            aimed, negated, reported = (int(s in p.marks) for p, s in zip(parts, state, strict=True))
            mark.append(aimed << 2 | negated << 1 | reported)
        return Composed(step, mark)


@dataclass
class Grammar:
    """The composed transducer with the words it knows and, once fitted, its weights."""

    insults: dict[str, float]
    weights: np.ndarray | None = None
    machine: Composed = field(default_factory=lambda: Composed.of(grammar()))

    def __post_init__(self) -> None:
        self.symbols = dict.fromkeys(REPORTS, REPORT) | dict.fromkeys(NEGATIONS, NEGATION) | dict.fromkeys(TARGETS, TARGET)
        self.symbols |= dict.fromkeys(THREATS, THREAT) | dict.fromkeys(self.insults, INSULT)
        self.strong = {w for w, s in self.symbols.items() if s in (INSULT, THREAT)}

    def features(self, text: str) -> list[float]:
        """What the grammar finds in a whole text, by FEATURES; zeros where it matches nothing."""
        found = [0.0] * len(FEATURES)
        tokens = _TOKENS.findall(text.lower())
        if self.strong.isdisjoint(tokens):
            return found
        step, mark, symbols, insults = self.machine.step, self.machine.mark, self.symbols, self.insults
        n_marks = len(MARKS)
        state, clause, since, clauses, matched, top, open_clause = 0, 0.0, 9, 1, 0, 0.0, False
        for token in tokens:
            symbol = symbols.get(token, WORD)
            if symbol == WORD and len(token) == 1:
                symbol = END if token in _ENDS else QUOTE if token in _QUOTES else WORD
            if symbol in (INSULT, THREAT):
                weight = insults[token] if symbol == INSULT else 1.0
                found[(symbol == THREAT) << 3 | mark[state]] += weight
                clause, since, open_clause = clause + weight, 0, True
            elif symbol == TARGET and since <= 3:
                found[n_marks] += 1
            state, since = step[state][symbol], since + 1
            if symbol == END:
                clauses += 1
                matched, top = matched + open_clause, max(top, clause)
                clause, since, open_clause = 0.0, 9, False
        matched, top = matched + open_clause, max(top, clause)
        found[n_marks + 1 :] = [math.log1p(matched), top, matched / clauses]
        return [math.log1p(x) for x in found[: n_marks + 1]] + found[n_marks + 1 :]

    def score(self, text: str) -> float:
        if self.weights is None:
            raise ValueError("the grammar has no weights yet")
        x = float(self.weights[0] + np.dot(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


def logistic(rows: np.ndarray, labels: np.ndarray, l2: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Intercept and weights of a ridge logistic regression by Newton steps."""
    n = len(labels)
    weights = np.zeros(rows.shape[1] + 1)
    chance = (labels.sum() + 0.5) / (n + 1)
    weights[0] = math.log(chance / (1 - chance))
    if not n or labels.min() == labels.max():
        return weights
    x = np.hstack([np.ones((n, 1)), rows])
    ridge = np.full(x.shape[1], l2)
    ridge[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (labels - p) - ridge * weights)
        weights += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return weights


def learned_insults(sample: DataFrame, most: int = LEARNED, support: int = SUPPORT) -> dict[str, float]:
    """Words far more frequent in toxic documents of ``sample (text, label)``, with weights from 0 to 1.

    Document counts are added up in the tasks, then by word; at most ``most``
    words come back, those with the greatest log-odds for their support.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    seen[label].update({w for w in _TOKENS.findall(text.lower()) if len(w) > 2})
            for label in (0, 1):
                names = list(seen[label])
                ones = pa.array([seen[label][w] for w in names], pa.int64())
                none = pa.array([0] * len(names), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), ones if label else none, none if label else ones], ["word", "toxic", "clean"])

    counts = sample.select("label", "text").mapInArrow(count, "word string, toxic bigint, clean bigint")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = sample.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in totals}
    odds = F.log((F.col("toxic") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1))
    rated = counts.filter(F.col("toxic") >= support).withColumn("odds", odds).filter(F.col("odds") > 2.5)
    top = rated.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "word").limit(most).collect()
    return {r["word"]: min(1.0, r["odds"] / 8) for r in top}


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", train_docs: int = TRAIN_DOCS) -> Grammar:
    """A grammar with weights from labelled documents, ``train_docs`` at most, where ``train`` holds over ``doc_id``."""
    reach_workers(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, train, train_docs)
    known = Grammar(dict.fromkeys(INSULTS, 1.0) | learned_insults(sample))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "label", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = sample.select("doc_id", "label", "text").mapInArrow(measure, f"doc_id {kind}, label int, found array<double>")
    seen = seen.orderBy(F.xxhash64("doc_id"), "found").limit(train_docs).collect()
    rows = np.array([r["found"] for r in seen], dtype=float).reshape(len(seen), len(FEATURES))
    known.weights = logistic(rows, np.array([r["label"] for r in seen], dtype=float))
    return known


def score(docs: DataFrame, known: Grammar) -> DataFrame:
    """Every whole text scored: ``(doc_id, score)``, higher if toxic.

    A text in which no clause matches, an empty one and a null one have the
    score of no match; repeated rows are scored alike; an empty table gives no
    rows; other columns are not looked at. Texts are scored where they lie.
    """
    reach_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text"), 4 << 20):
                part = batch.slice(start, stop - start)
                scores = [known.score(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, score double")


def reject(docs: DataFrame, known: Grammar, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``limit``.

    Only the texts go to Python, and only scores come back.
    """
    reach_workers(docs.sparkSession)

    @F.arrow_udf("double")
    def judge(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([known.score(t.as_py() or "") for t in texts], pa.float64())

    return docs.filter(judge("text") < limit)
