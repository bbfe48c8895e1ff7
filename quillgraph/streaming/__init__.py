from quillgraph.streaming.running import (
    emit_word_count,
    read_emitted,
    read_word_count,
    run_word_count,
    running_word_count,
    stream_table,
)

__all__ = [
    "emit_word_count",
    "read_emitted",
    "read_word_count",
    "run_word_count",
    "running_word_count",
    "stream_table",
]
