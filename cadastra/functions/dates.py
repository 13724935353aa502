"""Date and period functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cadastra.functions.cols import ColumnLike, as_col


def parse_timestamp(text: ColumnLike, fmt: str) -> Column:
    """Zone-free timestamp, null when the text does not follow ``fmt``."""
    return F.try_to_timestamp(as_col(text), F.lit(fmt)).cast("timestamp_ntz")


def date_parts(value: ColumnLike, prefix: str = "") -> list[Column]:
    """Day, month and year as int columns named ``<prefix>day`` and so on."""
    value = as_col(value)
    return [
        F.dayofmonth(value).alias(f"{prefix}day"),
        F.month(value).alias(f"{prefix}month"),
        F.year(value).alias(f"{prefix}year"),
    ]


def iso_text_parts(text: ColumnLike) -> list[Column]:
    """Date parts sliced out of ISO text (``2024-01-31T23:59:00``) without parsing it."""
    text = as_col(text)

    def number(start: int, length: int, name: str) -> Column:
        return F.substring(text, start, length).cast("int").alias(name)

    return [
        F.substring(text, 1, 10).alias("date"),
        number(1, 4, "year"),
        number(6, 2, "month"),
        number(9, 2, "day_of_month"),
        number(12, 2, "hour"),
    ]


def month_from_label(label: ColumnLike) -> Column:
    """First of the month for labels that start with a month abbreviation and hold a two-digit year.

    ``jul_23_total_devices`` becomes 2023-07-01.
    """
    label = as_col(label)
    month = F.initcap(F.substring(label, 1, 3))
    year = F.lit(2000) + F.regexp_extract(label, r"\d+", 0).try_cast("int")
    return F.try_to_date(F.concat(F.lit("01-"), month, F.lit("-"), year.cast("string")), "dd-MMM-yyyy")


def quarter_start(label: ColumnLike) -> Column:
    """First day of the quarter named ``2023 4`` or ``2023 Q4``."""
    label = as_col(label)
    year = F.regexp_extract(label, r"^(\d{4})", 1).try_cast("int")
    quarter = F.regexp_extract(label, r"([1-4])$", 1).try_cast("int")
    return F.make_date(year, (quarter - 1) * 3 + 1, F.lit(1))


def month_after(value: ColumnLike) -> Column:
    """First day of the month after ``value``."""
    return F.trunc(F.add_months(as_col(value), 1), "month")


def month_before(value: ColumnLike) -> Column:
    """First day of the month before ``value``; January rolls back to December."""
    return F.trunc(F.add_months(as_col(value), -1), "month")


def is_year_end(value: ColumnLike) -> Column:
    """True on 31 December: the year that ends with ``value`` is complete."""
    value = as_col(value)
    return (F.month(value) == 12) & (F.dayofmonth(value) == 31)


def last_complete_year(max_date: ColumnLike) -> Column:
    """Year of ``max_date`` if that is its last day, else the year before."""
    max_date = as_col(max_date)
    return F.year(max_date) - F.when(is_year_end(max_date), 0).otherwise(1)
