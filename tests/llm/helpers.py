"""Small corpora with every awkward row, and brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id bigint, text string, source string, score double, n_tokens bigint, size bigint, key string"


def corpus(seed: int = 5) -> list[tuple]:
    """Copies, near copies, shared passages, nulls in all columns, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["the", "an", "io", "ré", "ß", "x", "7"]) for _ in range(rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rng.randint(1, 90))) for _ in range(60)]
    passage = " ".join(word() for _ in range(70))
    for k in range(25):
        words = texts[k].split(" ")
        words[rng.randrange(len(words))] = "new"
        texts += [" ".join(words), texts[k]] if k % 2 else [" ".join(words)]
    texts += [texts[0][:50] + passage + word() for _ in range(5)] + [passage.upper()]
    texts += ["", "   ", "\n\t", "  a  b", "日本語 テキスト 🎉 x\x1cy", "<|endoftext|>a <s></s>", "a" * 900, "ab " * 4000, "don't we'll 's ''s"]
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, 0.5, 1, 2, "k") for i, t in enumerate(texts)]
    return [*rows, (900, None, "s0", None, None, None, None), (None, texts[3], None, None, None, None, None), rows[4], rows[4]]


def rows(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def without_repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        covered = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                covered[p : p + length] = b"\1" * length
        kept = bytes(x for x, c in zip(r, covered, strict=True) if not c)
        out.append((len(r), len(r) - len(kept), len(re.findall(b"\1+", bytes(covered))), sha(kept)))
    return out


def similar_groups(docs: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, tuple[int, int]]:
    """Set size and component of each id; ids are distinct."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in docs:
        words = re.findall("[^\\x20\\x09-\\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
    links = defaultdict(set)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    out = {}
    for a in sorted(sets):
        if a not in out:
            group, queue = {a}, [a]
            while queue:
                new = links[queue.pop()] - group
                group |= new
                queue += new
            out |= {b: (len(sets[b]), a) for b in group}
    return out
