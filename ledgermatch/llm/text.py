"""Text normalisation shared by the operators (SQL functions only)."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_text(col: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z alone lower-cased. For pure ASCII that is ``lower``,
    which has a fast path; other letters keep their case through ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
