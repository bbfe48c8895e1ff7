from quillgraph.sources.shared import WorkFolder, let_go, session_settings, shared_dir, shuffle_partitions, work_folder, work_path
from quillgraph.sources.sinks import format_ranked, write_summaries, write_tsv
from quillgraph.sources.text import locate_lines, number_lines, parse_articles, parse_links, read_lines, read_weights

__all__ = [
    "WorkFolder",
    "format_ranked",
    "let_go",
    "locate_lines",
    "number_lines",
    "parse_articles",
    "parse_links",
    "read_lines",
    "read_weights",
    "session_settings",
    "shared_dir",
    "shuffle_partitions",
    "work_folder",
    "work_path",
    "write_summaries",
    "write_tsv",
]
