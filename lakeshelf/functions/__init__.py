"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from lakeshelf.functions.predicates import (  # noqa: F401
    all_of, decode, eq_ci, flag_text, is_missing, matches_ci, nan_to_null_col,
)
from lakeshelf.functions.dates import date_attributes, date_key  # noqa: F401
from lakeshelf.functions.keywords import any_keyword, keyword_pattern  # noqa: F401
