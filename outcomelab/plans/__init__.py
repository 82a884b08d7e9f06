"""Query bindings: each operator applied to the benchmark tables.

``registry.QUERIES`` maps a key to ``fn(spark, sf_dir) -> DataFrame``;
``oracle.ORACLE_SQL`` holds the DuckDB twin of every key that has a SQL
meaning.
"""
