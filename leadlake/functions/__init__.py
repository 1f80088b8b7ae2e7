"""Column-expression helpers. Every function returns a built-in Spark
``Column`` so it stays inside whole-stage code generation."""

from leadlake.functions.categories import bucket_categories, one_hot, weighted_category
from leadlake.functions.jsonfields import json_double, json_integer, json_timestamp
from leadlake.functions.numeric import accuracy, clamp, f1_score, ratio_or_zero, safe_ratio
from leadlake.functions.text import clean_text, safe_name, safe_name_col, trim_blanks
from leadlake.functions.timefmt import add_seconds, epoch_ms_to_timestamp, iso_utc, parse_date

__all__ = [
    "accuracy", "add_seconds", "bucket_categories", "clamp", "clean_text",
    "epoch_ms_to_timestamp", "f1_score", "iso_utc", "json_double", "json_integer",
    "json_timestamp", "one_hot", "parse_date", "ratio_or_zero", "safe_name",
    "safe_name_col", "safe_ratio", "trim_blanks", "weighted_category",
]
