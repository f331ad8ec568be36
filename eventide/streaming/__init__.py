"""Structured Streaming forms of the operators.

Once the watermark has passed, each stream form gives the same rows and columns as the batch
operator over the same input.  At the end of a bounded input, ``streaming.bounded`` reads what is
left in the operators' state and finishes it by the batch rule, which the reference's engine does
by a last watermark.
"""

from eventide.streaming.windows import (
    stream_window_agg, stream_distinct_per_window, stream_approx_distinct, top_n_batch_writer,
    checkpoint_location, stream_sliding_agg,
)
from eventide.streaming.joins import stream_interval_join
from eventide.streaming.runners import branch_writer, resolve_latest, start_branches, versioned_writer
from eventide.streaming.processors import (
    stream_cap_per_key, stream_strict_pairs, stream_followed_by, stream_pair_one_to_one,
    stream_first_sightings, stream_capped_counts,
)
from eventide.streaming.stores import (
    bitmap_writer, compact_bitmaps, newest_rankings, ranking_writer, running_counts, store_counts,
)

__all__ = [
    "stream_window_agg", "stream_distinct_per_window", "stream_approx_distinct",
    "top_n_batch_writer", "checkpoint_location", "stream_interval_join", "stream_cap_per_key",
    "stream_strict_pairs", "stream_followed_by", "stream_pair_one_to_one", "branch_writer",
    "start_branches", "stream_first_sightings", "versioned_writer", "resolve_latest",
    "stream_sliding_agg", "stream_capped_counts", "running_counts", "bitmap_writer", "compact_bitmaps",
    "store_counts", "ranking_writer", "newest_rankings",
]
