"""Column expressions: pure functions from Columns to a Column.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen and has a line-for-line DuckDB equivalent.
"""

from outcomelab.functions.draws import hash_draw, unit_draw, HASH_SPAN
from outcomelab.functions.buckets import (ordered_bucket, right_closed_bins,
                                          label_order, era_of_year)
from outcomelab.functions.labels import (encode_label, decode_label,
                                         differs_from, at_most, event_flag)
from outcomelab.functions.scores import softmax, argmax, dense_array
from outcomelab.functions.text import extract_number, extract_group

__all__ = [
    "hash_draw", "unit_draw", "HASH_SPAN",
    "ordered_bucket", "right_closed_bins", "label_order", "era_of_year",
    "encode_label", "decode_label", "differs_from", "at_most", "event_flag",
    "softmax", "argmax", "dense_array",
    "extract_number", "extract_group",
]
