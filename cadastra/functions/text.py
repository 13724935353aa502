"""Text functions that are more than one built-in call.

Plain built-ins (``lower``, ``regexp_replace``, ``concat`` ...) are used directly by callers.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cadastra.functions.cols import ColumnLike, as_col

DIGITS = "0123456789"


def extract_first(text: ColumnLike, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern``; null (not the empty string) when nothing matches."""
    return F.nullif(F.regexp_extract(as_col(text), pattern, group), F.lit(""))


def extract_all_joined(text: ColumnLike, pattern: str, sep: str = "") -> Column:
    """All matches of group 1 of ``pattern``, glued together."""
    return F.array_join(F.regexp_extract_all(as_col(text), F.lit(pattern), F.lit(1)), sep)


def extract_groups(text: ColumnLike, pattern: str, names: list[str]) -> Column:
    """Capture groups of ``pattern`` as a struct with one string field per name."""
    fields = [extract_first(text, pattern, i).alias(name) for i, name in enumerate(names, start=1)]
    return F.struct(*fields)


def strip_digits(text: ColumnLike) -> Column:
    """Lower-case text without its digits."""
    return F.translate(F.lower(as_col(text)), DIGITS, "")


def resource_slug(name: ColumnLike) -> Column:
    """Place name as a file-name part: ``", "``, ``". "`` and ``" "`` become ``"-"``."""
    return F.regexp_replace(as_col(name), r", |\. | ", "-")


def resource_name(prefix: str, code: ColumnLike, name: ColumnLike, suffix: str = ".zip") -> Column:
    """``<prefix>-<code>-<slug><suffix>``; null when code or name is null."""
    return F.concat(
        F.lit(prefix), F.lit("-"), as_col(code), F.lit("-"), resource_slug(name), F.lit(suffix)
    )


def code_prefix(labelled: ColumnLike, length: int = 9) -> Column:
    """Code part of a labelled value such as ``"E01000001 : City"``."""
    return F.substring(as_col(labelled), 1, length)


def lat_lon(point: ColumnLike) -> Column:
    """``"lat,lon"`` text as a struct of two doubles."""
    text = as_col(point)
    return F.struct(
        F.trim(F.split_part(text, F.lit(","), F.lit(1))).try_cast("double").alias("latitude"),
        F.trim(F.split_part(text, F.lit(","), F.lit(2))).try_cast("double").alias("longitude"),
    )
