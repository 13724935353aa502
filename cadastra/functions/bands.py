"""Construction age bands: free text such as ``England and Wales: 1930-1949`` to years and labels.

Four rules exist side by side because published series use different ones. They differ on
"before 1900", on odd sums and on open ranges:

====================  ============  ============  ===================  ==========
band                  range rule    digit rule    group rule           mean rule
====================  ============  ============  ===================  ==========
before 1900           1899          1899          1900 / Before 1900   1900
1900-1929             1914          1914          1915 / Between ...   1914.5
1930-1949             1940          1939          1940 / Between ...   1939.5
2007 onwards          2007          2007          2007 / After 2007    2007
NO DATA!, null        null          null          null                 null
====================  ============  ============  ===================  ==========
"""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

from cadastra.functions.cols import ColumnLike, as_col
from cadastra.functions.numbers import floor_midpoint
from cadastra.functions.text import extract_all_joined, extract_first, extract_groups

# What the range rule strips from a band: letters, white space, ":" and "!".
_WORDING = string.ascii_letters + string.whitespace + ":!"


def year_by_range_exact(band: ColumnLike) -> Column:
    """Range rule without the final integer cast: 1900-1929 gives 1914.5."""
    band = as_col(band)
    span = F.translate(band, _WORDING, "")
    low = F.split_part(span, F.lit("-"), F.lit(1)).try_cast("int")
    high = F.split_part(span, F.lit("-"), F.lit(2)).try_cast("int")
    return (
        F.when(span == "", None)
        .when(F.lower(band).contains("before"), F.lit(1899.0))
        .when(span.contains("-"), (low + high) / 2)
        .otherwise(span.try_cast("int").cast("double"))
    )


def year_by_range(band: ColumnLike) -> Column:
    """Range rule: middle of the range (ties to even), 1899 for "before", else the number itself."""
    return F.rint(year_by_range_exact(band)).cast("int")


def year_by_digits(band: ColumnLike) -> Column:
    """Digit rule: join all digits; a second year gives the floored midpoint; a lone 1900 means 1899."""
    digits = extract_all_joined(band, "([0-9])")
    first = F.when(digits == "1900", F.lit(1899)).otherwise(F.substring(digits, 1, 4).try_cast("smallint"))
    second = F.substring(digits, 5, 8).try_cast("smallint")
    return F.coalesce(floor_midpoint(first.cast("int"), second.cast("int")), first.cast("int"))


def band_struct(band: ColumnLike) -> Column:
    """Group rule: struct of start, end, only_year, mean_year and a readable label.

    ``mean_year`` rounds half away from zero. ``only_year`` is null when it repeats ``start``.
    """
    # Patterns and label words are fixed values of the published series.
    span = extract_groups(band, r"(\b\d{4}\b)-(\b\d{4}\b)", ["start", "end"])
    start, end = span["start"].cast("int"), span["end"].cast("int")
    year = extract_first(band, r"(\d{4}\b)", 1).cast("int")
    only_year = F.when(start.isNull() | (year != start), year)
    label = (
        F.when(only_year == 1900, "Before 1900")
        .when(only_year > 1900, F.concat(F.lit("After "), only_year.cast("string")))
        .otherwise(
            F.concat(F.lit("Between "), start.cast("string"), F.lit(" and "), end.cast("string"))
        )
    )
    return F.struct(
        start.alias("start"),
        end.alias("end"),
        only_year.alias("only_year"),
        F.when(start.isNull(), year).otherwise(F.round((start + end) / 2).cast("int")).alias("mean_year"),
        label.alias("label"),
    )


def mean_of_years(band: ColumnLike) -> Column:
    """Mean rule: mean of every four-digit number in the text, null when there is none."""
    years = F.regexp_extract_all(as_col(band), F.lit(r"(\b\d{4}\b)"), F.lit(1))
    total = F.aggregate(years, F.lit(0.0), lambda acc, y: acc + y.cast("double"))
    return F.try_divide(total, F.nullif(F.size(years), F.lit(0)))


def epoch(year: ColumnLike) -> Column:
    """Construction epoch of a nominal year."""
    year = as_col(year)
    return (
        F.when(year < 1900, "Before 1900")
        .when(year <= 1930, "1900 - 1930")
        .when(year > 1930, "1930 to present")
        .otherwise("Unknown")
    )
