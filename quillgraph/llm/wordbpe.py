"""Byte-level BPE by a table of distinct words.

1. Tasks split texts into words and number the distinct words of each chunk
   of some megabytes.
2. The distinct words of all chunks meet by hash, and each is encoded once.
3. Their ids go back to the chunks, where each text, as word numbers, gets its
   ids by position.

The text is read twice, once for the words and once for the numbers, which
takes less disk than to keep the numbers; a chunk whose second reading finds
other words than the first fails the query.

Only distinct words and word numbers are shuffled, packed, so a frequent word
costs no more than a rare one and no group grows with the corpus. Decoding
joins ids with the vocabulary's pieces by position.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import reach_workers, shuffle_width, slices

KIND_WORDS, KIND_DOC = 0, 1
#: Bytes of text whose distinct words are numbered together.
CHUNK = 8 << 20

#: Texts of these characters only are split by a pattern, any others by the tokenizer itself.
PLAIN = r"\t\n\r -~¡-ɏ–-…"
LETTERS, DIGITS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t\n\r "
#: The words of a byte-level pre-tokenizer among these characters.
PATTERN = (
    rf" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+"
    rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)

_WORDS, _STRANGE = re.compile(PATTERN), re.compile(f"[^{PLAIN}]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, by rule: printable ones for themselves, the rest in order from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """A tokenizer file, with its pieces as bytes."""

    file: str

    def __post_init__(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(self.file, encoding="utf-8") as f:
            told = json.load(f)
        before = told["pre_tokenizer"] or {}
        added = told["added_tokens"]
        followed = (
            told["normalizer"] is None
            and told["model"]["type"] == "BPE"
            and not told["model"]["dropout"]
            and (before.get("type"), before.get("add_prefix_space"), before.get("use_regex")) == ("ByteLevel", False, True)
            and (told["decoder"] or {}).get("type") == "ByteLevel"
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
        )
        if not followed:
            raise ValueError(f"{self.file} is no plain byte-level BPE")
        self.specials = {t["content"]: t["id"] for t in added}
        marks = sorted(map(re.escape, self.specials), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(marks) + ")") if marks else None
        letters = byte_letters()
        self.shown = {b: c for c, b in letters.items()}
        names = {i: bytes(letters[c] for c in piece) for piece, i in told["model"]["vocab"].items()}
        names |= {i: content.encode() for content, i in self.specials.items()}
        pieces = [names.get(i, b"") for i in range(max(names) + 1)]
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def _plain_words(self, text: str) -> list[str]:
        if not _STRANGE.search(text):
            return _WORDS.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        """The words of a text, special tokens being words of their own."""
        if self.special is None or not any(s in text for s in self.specials):
            return self._plain_words(text)
        found: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            found += [part] if k % 2 else self._plain_words(part)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one word, merged by the library's own model."""
        special = self.specials.get(word.decode())
        if special is not None:
            return [special]
        return [t.id for t in self.tokenizer.model.tokenize(word.decode("latin-1").translate(self.shown))]

    def decode(self, ids: np.ndarray) -> str:
        """The bytes of all pieces in order, read as UTF-8."""
        return self.letters[_spans(self.starts[ids], self.lengths[ids])].tobytes().decode("utf-8", errors="replace")


@functools.cache
def vocabulary(file: str) -> Vocabulary:
    return Vocabulary(file)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all runs ``start ... start + length - 1``, one after the other."""
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


def _pack(*parts: bytes) -> bytes:
    head = np.array([len(parts), *map(len, parts)], dtype="<u4").tobytes()
    raw = head + b"".join(parts)
    return np.array([len(raw)], dtype="<u8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(body: bytes) -> list[bytes]:
    size = int(np.frombuffer(body, dtype="<u8", count=1)[0])
    raw = pa.decompress(body[8:], decompressed_size=size, codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, dtype="<u4", count=1)[0])
    at, parts = 4 * (n + 1), []
    for length in np.frombuffer(raw, dtype="<u4", count=n, offset=4).tolist():
        parts.append(raw[at : at + length])
        at += length
    return parts


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 byte plane by byte plane, which packs small ones well."""
    return _pack(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack_numbers(body: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack(body)[0], dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(numbers: np.ndarray, words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), dtype="<u4", count=len(words))
    return _pack(np.diff(numbers, prepend=0).astype("<u4").tobytes(), lengths.tobytes(), b"".join(words))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task in chunks of about CHUNK bytes."""
    for batch in batches:
        for start, stop in slices(batch.column("text"), CHUNK):
            yield batch.slice(start, stop - start)


def _named(words: dict[str, int]) -> str:
    """A chunk's name, made of its words in their order. Chunks that share it share their table of ids."""
    return hashlib.blake2b(chr(0).join(words).encode(), digest_size=16).hexdigest()


def _distinct(docs: DataFrame, file: str, buckets: int) -> DataFrame:
    """The distinct words of each chunk in blocks: ``(chunk, bucket, body)``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(file)
        for piece in _chunks(batches):
            words: dict[str, int] = {}
            for text in piece.column("text").to_pylist():
                if text:
                    words.update(dict.fromkeys(vocab.words(text), 0))
            raw = [w.encode() for w in words]
            place = np.fromiter((zlib.crc32(w) % buckets for w in raw), dtype=np.int64, count=len(raw))
            order = np.argsort(place, kind="stable")
            groups = np.split(order, np.flatnonzero(np.diff(place[order])) + 1) if len(order) else []
            bodies = [_pack_words(g, [raw[i] for i in g.tolist()]) for g in groups]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_named(words)] * len(groups), pa.string()),
                    pa.array([int(place[g[0]]) for g in groups], pa.int32()),
                    pa.array(bodies, pa.binary()),
                ],
                ["chunk", "bucket", "body"],
            )

    return docs.select("text").mapInArrow(split, "chunk string, bucket int, body binary")


def _numbers(docs: DataFrame, file: str) -> DataFrame:
    """Each text as numbers of its words, in the order in which a chunk meets them first: ``(chunk, doc_id, body)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(file)
        for piece in _chunks(batches):
            numbers: defaultdict[str, int] = defaultdict()
            numbers.default_factory = numbers.__len__
            bodies = []
            for text in piece.column("text").to_pylist():
                found = vocab.words(text) if text else []
                bodies.append(_pack_numbers(np.fromiter(map(numbers.__getitem__, found), dtype="<u4", count=len(found))))
            name = pa.array([_named(numbers)] * len(piece), pa.string())
            yield pa.RecordBatch.from_arrays([name, piece.column("doc_id"), pa.array(bodies, pa.binary())], ["chunk", "doc_id", "body"])

    return docs.select("doc_id", "text").mapInArrow(number, f"chunk string, doc_id {kind}, body binary")


def _encode_distinct(blocks: DataFrame, file: str, width: int) -> DataFrame:
    """The words of each block as ids, every distinct word of a bucket encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, at, known = vocabulary(file), None, {}
        for batch in batches:
            out = []
            for bucket, body in zip(batch.column("bucket").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if bucket != at:
                    at, known = bucket, {}
                numbers, lengths, raw = _unpack(body)
                ends = np.cumsum(np.frombuffer(lengths, dtype="<u4")).tolist()
                words = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                for word in words:
                    if word not in known:
                        known[word] = np.array(vocab.encode_word(word), dtype="<u4").tobytes()
                found = [known[w] for w in words]
                counts = np.fromiter(map(len, found), dtype="<u4", count=len(found)) // 4
                out.append(_pack(numbers, counts.tobytes(), b"".join(found)))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(out, pa.binary())], ["chunk", "body"])

    blocks = blocks.repartition(width, "bucket").sortWithinPartitions("bucket")
    return blocks.mapInArrow(encode, "chunk string, body binary")


class _Table:
    """The ids of a chunk's words by number, filled block by block."""

    def __init__(self) -> None:
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.made: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def add(self, body: bytes) -> None:
        steps, counts, ids = (np.frombuffer(x, dtype="<u4") for x in _unpack(body))
        self.blocks.append((np.cumsum(steps.astype(np.int64)), counts.astype(np.int64), ids))

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        if self.made is None:
            n = sum(len(b[0]) for b in self.blocks)
            starts, lengths, base = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), 0
            for at, counts, ids in self.blocks:
                lengths[at], starts[at] = counts, base + np.cumsum(counts) - counts
                base += len(ids)
            self.made = starts, lengths, np.concatenate([b[2] for b in self.blocks]) if n else np.zeros(0, dtype="<u4")
        starts, lengths, flat = self.made
        if int(numbers.max()) >= len(starts):
            raise RuntimeError("a chunk was read again with other words; encode a table that keeps its order, such as files")
        return flat[_spans(starts[numbers], lengths[numbers])]


def encode(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Every whole text as ids: ``(doc_id, n_tokens, ids)``, ids as little-endian unsigned 32-bit numbers.

    No special tokens are added; their strings inside a text become their ids,
    as the tokenizer's default does. A null or empty text has no ids; repeated
    rows come out as often as they came in; an empty table gives no rows;
    other columns are not looked at. ``tokenizer_file`` must be there on every
    worker.
    """
    Vocabulary(tokenizer_file)  # Other tokenizers are refused here; the driver keeps none.
    reach_workers(docs.sparkSession)
    width, kind = shuffle_width(docs.sparkSession), docs.schema["doc_id"].dataType.simpleString()
    words = _encode_distinct(_distinct(docs, tokenizer_file, 4 * width), tokenizer_file, width)
    texts = _numbers(docs, tokenizer_file).select(F.lit(KIND_DOC).alias("kind"), "chunk", "doc_id", "body")
    back = words.select(F.lit(KIND_WORDS).alias("kind"), "chunk", F.lit(None).cast(kind).alias("doc_id"), "body")

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known = None, _Table()
        for batch in batches:
            kinds, chunks = batch.column("kind").to_pylist(), batch.column("chunk").to_pylist()
            places, out, size = [], [], 0
            for i, body in enumerate(batch.column("body")):
                if chunks[i] != at:
                    at, known = chunks[i], _Table()
                if kinds[i] == KIND_WORDS:
                    known.add(body.as_py())
                    continue
                numbers = _unpack_numbers(body.as_py())
                out.append(known.ids(numbers).tobytes() if len(numbers) else b"")
                places.append(i)
                size += len(out[-1])
                if size > CHUNK:
                    yield _encoded(batch, places, out)
                    places, out, size = [], [], 0
            if out:
                yield _encoded(batch, places, out)

    met = back.unionByName(texts).repartition(width, "chunk").sortWithinPartitions("chunk", "kind")
    return met.mapInArrow(put_together, f"doc_id {kind}, n_tokens bigint, ids binary")


def _encoded(batch: pa.RecordBatch, places: list[int], out: list[bytes]) -> pa.RecordBatch:
    counts = pa.array([len(x) // 4 for x in out], pa.int64())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(pa.array(places, pa.int64())), counts, pa.array(out, pa.binary())], ["doc_id", "n_tokens", "ids"]
    )


def decode(encoded: DataFrame, tokenizer_file: str) -> DataFrame:
    """The texts of ``(doc_id, ids)`` as ``(doc_id, n_tokens, ids, text)``, special tokens kept.

    Ids without a piece give nothing; null ids give an empty text.
    """
    reach_workers(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer_file)
        for batch in batches:
            for start, stop in slices(batch.column("ids"), CHUNK):
                part = batch.slice(start, stop - start)
                found = []
                for body in part.column("ids"):
                    ids = np.frombuffer(body.as_py() or b"", dtype="<u4")
                    found.append(vocab.decode(ids[ids < len(vocab.lengths)]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], ["doc_id", "n_tokens", "ids", "text"])

    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(texts, f"doc_id {kind}, n_tokens bigint, ids binary, text string")
