"""Keyword matching as one JVM-side regex per list."""

from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyword_pattern(words: Iterable[str], regex: bool = False) -> str:
    """Alternation of the words. Plain words are quoted so that regex
    metacharacters in them match literally."""
    parts = [w if regex else re.escape(w) for w in words if w]
    return "(" + "|".join(parts) + ")" if parts else "(?!)"


def any_keyword(text: str | Column, words: Iterable[str], regex: bool = False) -> Column:
    """TRUE if the lower-cased text contains any of the words (unanchored
    substring match); NULL text gives FALSE."""
    col = F.col(text) if isinstance(text, str) else text
    pat = keyword_pattern([w.lower() for w in words] if not regex else words, regex)
    return F.coalesce(F.lower(col).rlike(pat), F.lit(False))
