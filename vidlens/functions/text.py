"""String normalisers shared by stored and searched keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Apostrophe look-alikes folded to a straight apostrophe
# (left single quote U+2018, right single quote U+2019, modifier letter
# apostrophe U+02BC, backtick).
APOSTROPHE_VARIANTS = "[‘’ʼ`]"


def normalize_keyword(c: Column | str) -> Column:
    """trim -> lower -> fold apostrophes; a blank keyword becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    folded = F.regexp_replace(F.lower(F.trim(c)), APOSTROPHE_VARIANTS, "'")
    return F.nullif(folded, F.lit(""))


def normalize_keyword_text(kw: str) -> str:
    """The same rule for a search term given by the caller (driver side, scalar)."""
    import re
    return re.sub(APOSTROPHE_VARIANTS, "'", kw.strip(" ").lower())


def parse_keyword_list(keyword: str | None) -> list[str]:
    """Comma list -> cleaned terms; blanks dropped; None/empty -> []."""
    if not keyword:
        return []
    out = []
    for part in keyword.split(","):
        term = normalize_keyword_text(part)
        if term:
            out.append(term)
    return out
