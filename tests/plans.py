"""The plan that a DataFrame ran by, as text."""

from __future__ import annotations


def executed_plan(df) -> str:
    """The final plan, without the first plans that it, or a subquery in it, set out with."""
    df.collect()
    kept, left_out = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        # An initial plan is a child of its node: deeper lines belong to it, as do those at its own depth.
        depth = len(line) - len(line.lstrip(" :"))
        if left_out is not None and depth >= left_out:
            continue
        left_out = depth if "== Initial Plan ==" in line else None
        if left_out is None:
            kept.append(line)
    return "\n".join(kept)
