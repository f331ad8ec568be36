"""DataFrame operators.  Each takes and returns DataFrames; nothing is collected."""

from eventide.operators.aggs import Agg, Count, Sum, Min, Max, IntAvg, Avg, ApproxDistinct
from eventide.operators.windows import tumbling_agg, sliding_agg

__all__ = ["Agg", "Count", "Sum", "Min", "Max", "IntAvg", "Avg", "ApproxDistinct",
           "tumbling_agg", "sliding_agg"]
