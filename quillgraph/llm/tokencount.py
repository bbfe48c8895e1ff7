"""Token counts of a piece model by heap-and-linked-list pair merging.

The symbols of a text form a linked list. All adjacent pairs that make a piece
wait in a heap; the best one is merged again and again, the leftmost first of
equals. The count is the number of initial symbols minus the merges. Pieces
are never looked up as ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import reach_workers, slices

#: Fixed value: what a space is written as inside pieces.
SPACE = "▁"
#: Kinds of pieces in a model file that text can be merged into.
NORMAL, USER_DEFINED, UNUSED = 1, 4, 5
#: Chunks whose counts a worker remembers; the memory is emptied when full.
REMEMBERED = 1_500_000

_CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")


def piece_ranks(model_file: str) -> dict[str, int]:
    """Pieces of a model by rank, 0 the best score; equal scores share a rank.

    Only models that the counter follows exactly are taken: pair merging with
    byte fallback, text unchanged but for one space put before it, and pieces
    that hold a space at their start only, so that no merge joins two words.
    """
    from sentencepiece import sentencepiece_model_pb2 as files

    model = files.ModelProto()
    with open(model_file, "rb") as f:
        model.ParseFromString(f.read())
    form, kind = model.normalizer_spec, model.trainer_spec
    pieces = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
    followed = (
        kind.model_type == kind.BPE
        and kind.byte_fallback
        and not kind.treat_whitespace_as_suffix
        and form.add_dummy_prefix
        and form.escape_whitespaces
        and not form.remove_extra_whitespaces
        and not form.precompiled_charsmap
        and not any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces)
        and not any(SPACE in p.lstrip(SPACE) for p in pieces)
    )
    if not followed:
        raise ValueError(f"{model_file} is no model of the kind that is counted here")
    order = {score: rank for rank, score in enumerate(sorted(set(pieces.values()), reverse=True))}
    return {piece: order[score] for piece, score in pieces.items()}


def count_chunk(chunk: str, ranks: dict[str, int]) -> int:
    """Tokens of one chunk: a run of spaces with the word after it."""
    get = ranks.get
    total = n = len(chunk)
    # A character without a piece falls apart into its bytes, which never merge.
    for c in chunk:
        if c not in ranks:
            total += len(c.encode()) - 1
    # An entry is rank, position and length of the pair in one number. The length tells
    # whether it is stale: what starts at a position only ever grows.
    heap = []
    for i in range(n - 1):
        rank = get(chunk[i : i + 2])
        if rank is not None:
            heap.append(rank << 64 | i << 32 | 2)
    if not heap:
        return total
    heapify(heap)
    symbols: list[str | None] = list(chunk)
    symbols.append(None)
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    while heap:
        entry = heappop(heap)
        i = entry >> 32 & 0xFFFFFFFF
        left = symbols[i]
        if left is None:
            continue
        j = after[i]
        right = symbols[j]
        if right is None or len(left) + len(right) != entry & 0xFFFFFFFF:
            continue
        merged = symbols[i] = left + right
        symbols[j] = None
        total -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            pair = merged + symbols[k]
            rank = get(pair)
            if rank is not None:
                heappush(heap, rank << 64 | i << 32 | len(pair))
        h = before[i]
        if h >= 0:
            pair = symbols[h] + merged
            rank = get(pair)
            if rank is not None:
                heappush(heap, rank << 64 | h << 32 | len(pair))
    return total


def count_text(text: str, ranks: dict[str, int], known: dict[str, int]) -> int:
    """Tokens of a text. ``known`` remembers the counts of chunks."""
    if not text:
        return 0
    if "  " in text or text[0] == " " or SPACE in text:
        chunks = _CHUNK.findall(SPACE + text.replace(" ", SPACE))
    else:
        chunks = text.split(" ")  # each stands for itself with one space before it
        try:
            return sum(map(known.__getitem__, chunks))
        except KeyError:
            total = 0
            for word in chunks:
                count = known.get(word)
                if count is None:
                    count = count_chunk(SPACE + word, ranks)
                    if len(word) <= 64:
                        known[word] = count
                total += count
            return total
    # chunks with their spaces are kept under their own name, which no bare word can have
    total = 0
    for chunk in chunks:
        count = known.get(chunk)
        if count is None:
            count = count_chunk(chunk, ranks)
            if len(chunk) <= 64:
                known[chunk] = count
        total += count
    return total


_REMEMBERED: dict[str, dict[str, int]] = {}
_RANKS: dict[str, dict[str, int]] = {}


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """Tokens of every whole text: ``(doc_id, n_bytes, n_tokens, over_limit)``.

    No begin, end or added tokens are counted. ``over_limit`` is true above
    ``limit`` tokens. A null text counts as empty and has none; repeated rows
    are counted each; an empty table gives no rows; other columns are not
    looked at. One task reads one part of the input, in slices of some
    megabytes; nothing is shuffled. ``model_file`` must be there on every
    worker; it is read once by each.
    """
    reach_workers(docs.sparkSession)
    piece_ranks(model_file)  # a model of another kind fails here, not in a task

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_file not in _RANKS:
            _RANKS[model_file] = piece_ranks(model_file)
        ranks, known = _RANKS[model_file], _REMEMBERED.setdefault(model_file, {})
        for batch in batches:
            texts = batch.column("text")
            for start, stop in slices(texts, 4 << 20):
                part = texts.slice(start, stop - start)
                if len(known) > REMEMBERED:
                    known.clear()
                counts = [count_text(t, ranks, known) if t else 0 for t in part.to_pylist()]
                n_bytes = pc.fill_null(pc.binary_length(part), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, stop - start), n_bytes, pa.array(counts, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
