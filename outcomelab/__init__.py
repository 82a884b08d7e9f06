"""Outcome analytics on Spark.

Operators take and return DataFrames. Column expressions live in
``outcomelab.functions``, readers and writers in ``outcomelab.sources``,
DataFrame operators in ``outcomelab.operators``, query bindings to the
benchmark tables in ``outcomelab.plans`` and the streaming form of the
rate aggregate in ``outcomelab.streaming``.
"""

__version__ = "0.1.0"
