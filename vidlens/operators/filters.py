"""Gold-stage read filters.

On a keyword-partitioned Parquet table both keyword forms prune partitions:
``isin`` and ``contains`` on the partition column are evaluated on partition
values, so unmatched keyword folders are never listed for reading. The view
filter is pushed to the Parquet reader (row-group min/max skipping).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens.functions.text import normalize_keyword_text, parse_keyword_list


def min_views_filter(df: DataFrame, min_views: int = 0, col: str = "view_count") -> DataFrame:
    """P3."""
    return df.filter(F.col(col) >= min_views)


def keyword_terms(keyword: str | list[str] | None) -> list[str]:
    """Cleaned terms of a comma list, or of a list whose members may hold commas.

    No filter gives []; a filter of blanks only is refused, as it would return everything.
    """
    if isinstance(keyword, (list, tuple)):
        terms = [t for t in map(normalize_keyword_text, keyword) if t]
    else:
        terms = parse_keyword_list(keyword)
    if keyword and not terms:
        raise ValueError(f"keyword filter {keyword!r} holds no keyword")
    return terms


def keyword_filter(df: DataFrame, keyword: str | list[str] | None = None, mode: str = "exact",
                   col: str = "keyword") -> DataFrame:
    """P4 (exact, ``isin``) or P5 (substring, OR over terms). ``keyword`` is a
    comma list or a list; terms are normalised like stored keywords."""
    terms = keyword_terms(keyword)
    if not terms:
        return df
    if mode == "contains":
        return df.filter(reduce(or_, [F.col(col).contains(t) for t in terms]))
    if mode != "exact":
        raise ValueError(f"keyword mode must be 'exact' or 'contains', not {mode!r}")
    return df.filter(F.col(col).isin(terms))


class NoKeywordMatch(RuntimeError):
    """No row matched ``terms``; ``present`` are keywords that do exist."""

    def __init__(self, message: str, terms: list[str], present: list[str | None]):
        super().__init__(message)
        self.terms, self.present = terms, present


def require_match(filtered: DataFrame, source: DataFrame, keyword, mode: str = "exact",
                  col: str = "keyword", sample: int = 20) -> DataFrame:
    """Raise when a keyword filter matched nothing, naming up to ``sample``
    keywords that do exist (a bounded pull, never the whole table)."""
    terms = keyword_terms(keyword)
    if terms and filtered.isEmpty():
        present = [r[0] for r in source.select(col).distinct().limit(sample).collect()]
        raise NoKeywordMatch(f"no rows matched keyword(s) {terms} in {mode} mode; "
                             f"keywords present include: {present}", terms, present)
    return filtered


def read_gold_input(silver: DataFrame, min_views: int = 0, keyword=None, mode: str = "exact",
                    check: bool = True) -> DataFrame:
    """The gold stage's input: keyword filter, then the view filter, then P6."""
    out = min_views_filter(keyword_filter(silver, keyword, mode), min_views)
    return require_match(out, silver, keyword, mode) if check else out
