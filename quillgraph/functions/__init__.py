from quillgraph.functions.text import (
    normalize,
    raw_tokens,
    sentences,
    split_char,
    text_lines,
    trim_control,
    unigrams,
)

__all__ = [
    "normalize",
    "raw_tokens",
    "sentences",
    "split_char",
    "text_lines",
    "trim_control",
    "unigrams",
]
