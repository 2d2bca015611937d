"""Regular-expression helpers with the null semantics of the scripts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_META = re.compile(r"[\\^$.|?*+()\[\]{}]")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regexp_contains(s, pattern: str) -> Column:
    """Unanchored match. A pattern without metacharacters becomes a
    plain ``contains``, which skips the regex engine."""
    if not _META.search(pattern):
        return _col(s).contains(pattern)
    return _col(s).rlike(pattern)


def regexp_extract_or_null(s, pattern: str, group: int = 1) -> Column:
    """Group ``group`` of the first match, NULL when nothing matches.

    Spark's ``regexp_extract`` gives '' both for no match and for an
    empty match; the guard keeps the two apart.
    """
    return F.when(_col(s).rlike(pattern), F.regexp_extract(_col(s), pattern, group))


def split_keep_empty(s, delimiter: str) -> Column:
    """``SPLIT(s, delimiter)`` keeping trailing empty parts (literal delimiter)."""
    return F.split(_col(s), re.escape(delimiter), -1)
