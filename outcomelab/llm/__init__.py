"""Operators for preparing training text at scale.

Each module holds one operator; ``queries`` binds them to the benchmark
tables. Nothing else in the library imports this subpackage.
"""
