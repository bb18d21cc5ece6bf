"""Predicate and conditional column builders."""

from __future__ import annotations

from functools import reduce
from typing import Any, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matches_ci(c: str | Column, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive containment; NULL text never matches.

    By default ``pattern`` is a regular expression (unanchored, like a search
    box that accepts regex); ``literal=True`` matches the plain substring."""
    col = _c(c)
    if literal:
        hit = F.lower(col).contains(pattern.lower())
    else:
        hit = col.rlike("(?iu)" + pattern)  # u: case folding beyond ASCII
    return F.coalesce(hit, F.lit(False))


def eq_ci(c: str | Column, value: str) -> Column:
    """Case-insensitive equality against a trimmed parameter."""
    return F.coalesce(F.lower(_c(c)) == value.strip().lower(), F.lit(False))


def all_of(preds: Iterable[Column]) -> Column:
    """Conjunction of predicates; an empty list is TRUE."""
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def decode(c: str | Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Map codes to labels. Keys may be tuples: every code in the tuple maps to
    the label. Unknown codes and NULL give ``default``."""
    col = _c(c)
    expr = None
    for codes, label in mapping.items():
        codes = list(codes) if isinstance(codes, (tuple, list, set, frozenset)) else [codes]
        cond = col.isin(*codes) if len(codes) > 1 else (col == codes[0])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def flag_text(c: str | Column, yes: str = "Yes", no: str = "No") -> Column:
    """1 -> Yes, 0 -> No, anything else (including NULL) -> NULL."""
    col = _c(c)
    return F.when(col == 1, F.lit(yes)).when(col == 0, F.lit(no))


def nan_to_null_col(c: str | Column) -> Column:
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def present(c: str | Column) -> Column:
    """Neither NULL nor NaN (for numbers)."""
    col = _c(c)
    return col.isNotNull() & ~F.isnan(col)


def is_missing(c: str | Column, numeric: bool = True) -> Column:
    col = _c(c)
    return (col.isNull() | F.isnan(col)) if numeric else col.isNull()
