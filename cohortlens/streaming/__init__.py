"""Structured Streaming entry points.

The original workload has no streaming operators (no windows, watermarks or
state beyond batch aggregation). The one job that naturally runs on
arriving files is the thresholded token count, so it is offered over a
streaming text source with the same operators as the batch version; its
state lives in the query's checkpoint folder and survives restarts.
"""

from cohortlens.streaming.textcount import token_counts_stream

__all__ = ["token_counts_stream"]
