"""Column-name and text normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake_case(name: str) -> str:
    name = re.sub(r"\([^)]*\)", "", name.strip()).replace("%", " percent ")
    return re.sub(r"[^A-Za-z0-9]+", "_", name).strip("_").lower()


def squeezed(text: Column) -> Column:
    """Trim, collapse whitespace runs, and turn blank / 'nan' / 'None' into NULL."""
    tidy = F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\s+", " ")
    untidy = text.rlike(r"[\t\n\x0B\f\r]|  |^ | $")  # one look instead of two copies for most cells
    kept = lambda t: F.when(~t.isin("", "nan", "None"), t)
    return F.when(untidy, kept(tidy)).otherwise(kept(text))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def title_case(text: Column) -> Column:
    """Capitalise every letter that does not follow a letter, lower-case the others. Words parted by blanks only need no splitting."""
    words = F.split(F.lower(text), r"(?<=[^\p{L}])(?=\p{L})")
    return F.when(text.rlike("^[A-Za-z ]*$"), F.initcap(text)).otherwise(F.array_join(F.transform(words, F.initcap), ""))
