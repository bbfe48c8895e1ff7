"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown level by level on binned statistics of a bounded sample of
labelled documents and flattened into arrays, which numpy walks for whole
batches of documents at once.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import labelled_sample, reach_workers, slices, words

#: Labelled documents that the trees are fitted on at most, the first ones by hash of their id.
TRAIN_DOCS = 20_000

#: Frequent function words of four languages.
FUNCTION_WORDS = frozenset(
    "the of and to in a is that it for on was be with as by this from are or an at not he but"
    " der die das und ist von zu den mit sich des auf für im dem nicht ein eine als auch"
    " le la les de des et en un une du que qui dans pour par sur au pas avec ce"
    " el los las y es una por con para del se lo como su al más".split()
)

NUMBERS = (
    "bytes", "letters", "digits", "uppers", "spaces", "lines", "symbols", "wide", "words", "word_length", "long_words",
    "distinct", "top_word", "function_words", "capital_words", "bare_symbols", "marked_words", "again", "repeated_lines", "line_words",
    "packed", "entropy",
)

_KIND = np.zeros(256, dtype=np.int64)  # 0 symbol, 1 lower, 2 digit, 3 upper, 4 blank, 5 line end, 6 beyond ASCII
_KIND[ord("a") : ord("z") + 1], _KIND[ord("0") : ord("9") + 1], _KIND[ord("A") : ord("Z") + 1] = 1, 2, 3
_KIND[[9, 11, 12, 13, 32]], _KIND[10], _KIND[128:] = 4, 5, 6


def statistics(text: str) -> list[float]:
    """The numbers of NUMBERS for a whole text; zeros for an empty one."""
    if not text:
        return [0.0] * len(NUMBERS)
    raw = text.encode()
    shares = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) / len(raw)
    symbol, lower, digit, upper, blank, line_end, wide = np.bincount(_KIND, weights=shares, minlength=7).tolist()
    used = shares[shares > 0]
    found = words(text)
    n = max(1, len(found))
    counts = Counter(found)
    lines = [x for x in text.split("\n") if x.strip()]
    sizes = [len(w) for w in counts]
    return [
        math.log1p(len(raw)), lower + upper, digit, upper, blank, line_end, symbol, wide, math.log1p(len(found)),
        sum(s * c for s, c in zip(sizes, counts.values(), strict=True)) / n,
        sum(c for w, c in counts.items() if len(w) > 20) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(counts[w] for w in FUNCTION_WORDS if w in counts) / n,
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n,
        sum(c for w, c in counts.items() if not any(map(str.isalnum, w))) / n,
        sum(c for w, c in counts.items() if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum()) / n,
        sum(map(str.__eq__, found, found[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        math.log1p(len(found) / max(1, len(lines))),
        len(zlib.compress(raw, 1)) / len(raw),
        float(-(used * np.log2(used)).sum()),
    ]


@dataclass
class Trees:
    """Boosted trees of one depth, flattened: node ``i`` of a tree has the children ``2i + 1`` and ``2i + 2``."""

    base: float
    depth: int
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # (trees, inner nodes); up to the cut a row goes left
    value: np.ndarray  # (trees, leaves)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The chance of label 1 for each row of numbers."""
        total = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (rows[at, feature[node]] > cut[node])
            total += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def boost(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 5.0) -> Trees:
    """Trees fitted to labels 0 and 1 by Newton steps on histograms of binned numbers.

    Without rows the chance is one half; with labels of one kind it is near
    that label for all.
    """
    n, p = rows.shape
    mean = (labels.sum() + 1) / (n + 2)
    inner, leaves = 2**depth - 1, 2**depth
    model = Trees(float(np.log(mean / (1 - mean))), depth, *(np.zeros((0, k), dtype=t) for k, t in ((inner, np.int64), (inner, float), (leaves, float))))
    if not n or labels.min() == labels.max():
        return model
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(p)]
    binned = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    total = np.full(n, model.base)
    made: tuple[list, list, list] = ([], [], [])
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, bend = labels - chance, chance * (1 - chance)
        node, feature, cut = np.zeros(n, dtype=np.int64), np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            key = (node - first) * bins
            best = np.zeros(width)
            for j in range(p):
                place = key + binned[:, j]
                g = np.bincount(place, slope, width * bins).reshape(width, bins).cumsum(axis=1)
                h = np.bincount(place, bend, width * bins).reshape(width, bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + l2) + (g_all - g) ** 2 / (h_all - h + l2) - g_all**2 / (h_all + l2)
                gain[:, len(edges[j]) :] = 0
                top = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(width), top] > best + 1e-9):
                    best[k], feature[first + k], cut[first + k] = gain[k, top[k]], j, edges[j][top[k]]
            node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + l2)
        total += value[leaf]
        for kept, x in zip(made, (feature, cut, value), strict=True):
            kept.append(x)
    return Trees(model.base, depth, *map(np.array, made))


def _with_statistics(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for start, stop in slices(batch.column("text"), 4 << 20):
        part = batch.slice(start, stop - start)
        yield part, np.array([statistics(t or "") for t in part.column("text").to_pylist()])


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", train_docs: int = TRAIN_DOCS, **options) -> Trees:
    """Trees from labelled documents, ``train_docs`` at most, where ``train`` holds over ``doc_id``."""
    reach_workers(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, numbers in _with_statistics(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(numbers.tolist(), pa.list_(pa.float64()))], ["doc_id", "label", "numbers"])

    sample = labelled_sample(docs, labels, label, train, train_docs).select("doc_id", "label", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = sample.mapInArrow(measure, f"doc_id {kind}, label int, numbers array<double>").orderBy(F.xxhash64("doc_id"), "numbers").limit(train_docs).collect()
    rows = np.array([r["numbers"] for r in seen], dtype=float).reshape(len(seen), len(NUMBERS))
    return boost(rows, np.array([r["label"] for r in seen], dtype=float), **options)


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """Every whole text scored: ``(doc_id, score)``.

    A null text is scored as an empty one; repeated rows are scored alike; an
    empty table gives no rows; other columns are not looked at. Each batch is
    scored where it lies, nothing is shuffled.
    """
    reach_workers(docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, numbers in _with_statistics(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(numbers), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, score double")
