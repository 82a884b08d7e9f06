"""The outcome-rate aggregate over a growing folder of files.

The analysis itself is batch. This is the same ``rate_by_key`` operator
kept up to date with Structured Streaming as new result files land:
per-key running counts live in the state store (one entry per key), and
each micro-batch rewrites the small result table.
"""

from outcomelab.streaming.rates import latest_rates, start_rate_stream

__all__ = ["latest_rates", "start_rate_stream"]
