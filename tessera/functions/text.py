"""Text column expressions (X15-X18): native regex / string functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_IN_PARENS = r"\((\d{4})\)"


def split_title_year_cols(col: str = "title") -> tuple[Column, Column]:
    """Split at the *last* ``(YYYY)``: ("Toy Story (1995)") -> ("Toy Story", 1995);
    no year -> (trimmed title, null) (X16)."""
    t = F.trim(F.col(col))
    years = F.regexp_extract_all(t, F.lit(YEAR_IN_PARENS), 1)
    year = F.when(F.size(years) > 0, F.element_at(years, -1).cast("int"))
    # greedy prefix stops at the last "(YYYY)"
    clean = F.when(F.size(years) > 0, F.trim(F.regexp_extract(t, r"^(.*)\(\d{4}\)", 1))).otherwise(t)
    return clean, year


# Fixed values of the passenger title feature.
RARE_TITLES = ["Lady", "Countess", "Capt", "Col", "Don", "Dr", "Major", "Rev", "Sir", "Jonkheer", "Dona"]
TITLE_SYNONYMS = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}


def honorific(col: str = "Name") -> Column:
    """Text between ``,`` and the next ``.``, rare ones merged, synonyms mapped."""
    raw = F.trim(F.regexp_extract(F.col(col), r",\s*([^.]*)\.", 1))
    raw = F.when(raw == "", F.lit(None)).otherwise(raw)
    merged = F.when(raw.isin(*RARE_TITLES), F.lit("Rare")).otherwise(raw)
    out = merged
    for k, v in TITLE_SYNONYMS.items():
        out = F.when(merged == k, F.lit(v)).otherwise(out)
    return out

