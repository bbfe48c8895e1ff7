"""The rules once more in plain Python, as brute force for small fixtures."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

BLANKS = re.compile(r"[ \t\n\r\f]+")


def pieces(text: str, separator: str) -> list[str]:
    """Split on a regex without empty pieces at the end."""
    found = re.split(separator, text, flags=re.ASCII)
    if len(found) == 1:
        return found
    while found and found[-1] == "":
        found.pop()
    return found


def normal(token: str, compat: bool = False) -> str:
    return re.sub(r"[^a-zA-Z0-9]\]" if compat else r"[^a-zA-Z0-9]", "", token).lower()


def tokens(text: str, compat: bool = False) -> list[str]:
    return [u for u in (normal(t, compat) for t in BLANKS.split(text) if t) if u]


def tf_idf(articles: list[tuple[str, str]], compat: bool = False) -> dict[tuple[str, str], float]:
    counts: dict[str, Counter] = defaultdict(Counter)
    docs_of: dict[str, set] = defaultdict(set)
    for doc, text in articles:
        counts[doc].update(tokens(text, compat))
        for unigram in tokens(text):
            docs_of[unigram].add(doc)
    product: dict[tuple[str, str], float] = {}
    for doc, terms in counts.items():
        for unigram, n in terms.items():
            product[doc, unigram] = 0.5 + 0.5 * (n / max(terms.values()))
    for unigram, docs in docs_of.items():
        for doc in docs:
            product[doc, unigram] = product.get((doc, unigram), 1.0) * math.log10(len(articles) / len(docs))
    return product


def sentence_score(sentence: str, weights: dict[str, float], n: int = 5) -> float:
    by_value: dict[float, set] = defaultdict(set)
    for unigram in tokens(sentence):
        if unigram in weights:
            by_value[weights[unigram]].add(unigram)
    left, total = n, 0.0
    for value in sorted(by_value, reverse=True):
        if left <= 0:
            break
        for _ in by_value[value]:
            total += value
            left -= 1
    return total


def summary(text: str, weights: dict[str, float], k: int = 3) -> str:
    sentences = pieces(text, r"\.\s")
    scores = [sentence_score(sentence, weights) for sentence in sentences]
    best = sorted(range(len(sentences)), key=lambda i: (-scores[i], i))[:k]
    return "".join(sentences[i] + ". " for i in sorted(best))


def pagerank(
    edges: list[tuple[int, int]], rounds: int, tax: float | None = None, keep_all: bool = False
) -> dict[int, float]:
    targets: dict[int, list[int]] = defaultdict(list)
    for src, dst in edges:
        targets[src].append(dst)
    everyone = set(targets) | {dst for _, dst in edges}
    rank = dict.fromkeys(everyone if keep_all else targets, 1.0)
    for _ in range(rounds):
        got: dict[int, float] = defaultdict(float)
        if keep_all:
            got.update(dict.fromkeys(everyone, 0.0))
        for page, value in rank.items():
            for dst in targets.get(page, ()):
                got[dst] += value / len(targets[page])
        rank = {page: s if tax is None else tax + (1 - tax) * s for page, s in got.items()}
    return rank
