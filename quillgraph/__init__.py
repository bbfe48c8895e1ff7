"""Text profiles, TF·IDF summaries and link-graph ranking as Spark DataFrame functions."""

from quillgraph.operators import *  # noqa: F401,F403
from quillgraph.operators import __all__ as _operators
from quillgraph.sources import *  # noqa: F401,F403
from quillgraph.sources import __all__ as _sources
from quillgraph.streaming import *  # noqa: F401,F403
from quillgraph.streaming import __all__ as _streaming

__all__ = [*_operators, *_sources, *_streaming]
