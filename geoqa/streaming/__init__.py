"""Incremental re-runs of checks with Structured Streaming.

The reference has no stream processing; its checks are re-run on a
schedule.  ``run_incremental`` expresses that schedule Spark-first: a
file-source stream over the folder where new input files land, processed
with ``trigger(availableNow=True)`` (everything new, then stop) and
``foreachBatch`` running an ordinary batch check against the static tables.
"""

from geoqa.streaming.incremental import run_incremental  # noqa: F401
