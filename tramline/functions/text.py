"""Text rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tramline.constants import WHITESPACE


def strip_ws(text: Column) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def name_split_second(name: Column) -> Column:
    """The piece between the first and second dot, trimmed; null without a dot."""
    return strip_ws(F.try_element_at(F.split(name, "[.]"), F.lit(2)))


def name_strip_prefix(name: Column) -> Column:
    """Drop a leading ``<digits>.`` and trim. Keeps later dots, so it loses no text."""
    return strip_ws(F.regexp_replace(name, r"^\p{Nd}+\.", ""))


def zfill(text: Column, width: int = 5) -> Column:
    """Left-fill with zeros up to ``width``; longer text is kept whole, a sign stays in front."""
    sign = F.regexp_extract(text, "^[+-]?", 0)
    digits = F.substring(text, F.length(sign) + 1, F.length(text))
    filled = F.concat(sign, F.lpad(digits, F.lit(width) - F.length(sign), F.lit("0")))
    return F.when(F.length(text) < width, filled).otherwise(text)


def pad_number(number: Column, width: int = 2) -> Column:
    """Whole number as zero-padded text."""
    return F.format_string(f"%0{width}d", number)
