"""String expressions. Each takes and returns a Column."""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from placestats.constants import UNKNOWN


def norm_text(col: Column) -> Column:
    return F.upper(F.trim(col))


def clean_text(col: Column, default: str = UNKNOWN) -> Column:
    """Trimmed upper-case text; blank and null become `default`."""
    return F.coalesce(F.nullif(norm_text(col), F.lit("")), F.lit(default))


def squeeze_ws(col: Column) -> Column:
    return F.regexp_replace(col, r"\s+", " ")


def clean_squeezed(col: Column, default: str = UNKNOWN) -> Column:
    return F.coalesce(F.nullif(squeeze_ws(norm_text(col)), F.lit("")), F.lit(default))


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def valid_zip(col: Column, default: str = UNKNOWN) -> Column:
    """Five digits and not all zero, else `default`."""
    zip5 = F.trim(col)
    return F.when(zip5.rlike("^[0-9]{5}$") & (zip5 != "00000"), zip5).otherwise(F.lit(default))


def pad_left(col: Column, width: int, fill: str = "0") -> Column:
    """Left pad; longer text is cut to `width`, as SQL LPAD does."""
    return F.lpad(col, width, fill)


def padded_zip(col: Column) -> Column:
    """Digits padded to five. A missing ZIP becomes 00000, never a sentinel."""
    return pad_left(digits_only(F.coalesce(col.cast("string"), F.lit(""))), 5)


def clean_phone(col: Column, default: str = UNKNOWN) -> Column:
    return F.coalesce(F.nullif(digits_only(F.coalesce(col, F.lit(""))), F.lit("")), F.lit(default))


def valid_phone(col: Column, min_digits: int = 10) -> Column:
    return F.length(digits_only(F.coalesce(col, F.lit("")))) >= min_digits


def concat_strict(*cols: Column | str) -> Column:
    """Concatenation that is null when any part is null. Text arguments are literals."""
    return F.concat(*[F.lit(c) if isinstance(c, str) else c.cast("string") for c in cols])


def humanize(col: Column, case: str = "lower") -> Column:
    """`SOME_CODE` -> `some code`, `Some Code` or `Some code`."""
    words = F.lower(F.replace(col, F.lit("_"), F.lit(" ")))
    if case == "title":
        return F.initcap(words)
    if case == "sentence":
        return F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))
    return words


def any_like(col: Column, patterns: list[str], ci: bool = False) -> Column:
    """True when any LIKE (or ILIKE) pattern matches. Null text gives null."""
    tests = [col.ilike(p) if ci else col.like(p) for p in patterns]
    return reduce(operator.or_, tests)


def any_word(col: Column, words: list[str]) -> Column:
    """True when the text contains any of the words."""
    return any_like(col, [f"%{w}%" for w in words])


def split_trim(col: Column, sep: str) -> Column:
    return F.transform(F.split(col, re.escape(sep)), lambda part: F.trim(part))


def truncate_text(col: Column, n: int) -> Column:
    return F.substring(col, 1, n)


def normalize_blank_runs(col: Column) -> Column:
    """CRLF to LF, at most one blank line in a row, single spaces, ends stripped."""
    unix = F.regexp_replace(col, "\r\n", "\n")
    lines = F.regexp_replace(unix, "\n{3,}", "\n\n")
    spaces = F.regexp_replace(lines, "[ \t]{2,}", " ")
    return F.regexp_replace(spaces, r"^\s+|\s+$", "")


def rewrite_counts(col: Column, clusters: Column, share: Column) -> Column:
    """Replace cluster counts and crime shares quoted in stored text by current values."""
    plural = F.when(clusters == 1, F.lit("")).otherwise(F.lit("s"))
    counted = F.regexp_replace(
        col,
        F.lit(r"(?i)\d+\s+(?:[A-Za-z\-]+\s+){0,4}(?:clusters?|hotspots?)"),
        F.concat(clusters.cast("string"), F.lit(" hotspot cluster"), plural),
    )
    return F.regexp_replace(
        counted,
        F.lit(r"(?i)[\d.]+%\s+of\s+(?:[A-Za-z\-]+\s+){0,3}crimes\s+\w+"),
        F.concat(share.cast("string"), F.lit("% of crimes occur")),
    )


def fixed(col: Column, decimals: int = 0, thousands: bool = False) -> Column:
    """Fixed-point text, optionally with thousands separators."""
    if thousands:
        return F.format_number(col.cast("double"), decimals)
    return F.format_string(f"%.{decimals}f", F.bround(col.cast("double"), decimals))


def fill_template(template: str, **overrides: Column) -> Column:
    """Turn `text {column} text` into a null-propagating concatenation."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts: list[Column] = []
    for i, piece in enumerate(pieces):
        if i % 2:
            parts.append(overrides.get(piece, F.col(piece)).cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
