"""eventide: event-time behaviour analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers for the behaviour/ad/login/order/receipt/access-log inputs and
           adapters from the driver tables
functions  column-level helpers (event time, window arithmetic, hashing, report text)
operators  DataFrame operators: window aggregates, distinct counts, top-N, caps,
           sequence patterns, interval join, one-to-one pairing, late-row policy
plans      the user-level jobs and the registry of queries over the driver tables
streaming  Structured Streaming forms of the operators
"""

from eventide.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
