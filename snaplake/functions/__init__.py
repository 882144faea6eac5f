"""Column-expression helpers (all built-in Spark expressions, no UDFs)."""

from snaplake.functions.bands import band_of
from snaplake.functions.casts import lenient_cast, lenient_int, parse_timestamp
from snaplake.functions.json import json_string_field, parse_object, schema_for_paths
from snaplake.functions.stats import safe_corr
from snaplake.functions.time import day_number, epoch_micros, trunc_like

__all__ = [
    "band_of", "lenient_cast", "lenient_int", "parse_timestamp",
    "parse_object", "json_string_field", "schema_for_paths", "safe_corr",
    "day_number", "epoch_micros", "trunc_like",
]
