"""The test tables seen as register tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Scale for amounts whose means are compared after rounding. Means of whole cents often sit exactly
# between two rounded values, where engines differ by the last bit of a sum; scaled ones do not.
UNTIED = 0.70710678

# Age band texts in every form the register uses, chosen by an integer column.
BANDS = [
    "England and Wales: before 1900",
    "England and Wales: 1900-1929",
    "England and Wales: 1930-1949",
    "England and Wales: 2007 onwards",
    "2021",
    "NO DATA!",
]


def band_text(number: str) -> Column:
    """One of :data:`BANDS`, or null for one number in seven."""
    texts = F.array(*[F.lit(b) for b in BANDS], F.lit(None).cast("string"))
    return F.element_at(texts, (F.col(number) % 7 + 1).cast("int"))


def band_sql(number: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(BANDS))
    return f"CASE {number} % 7 {cases} END"


# Expected values, worked out by hand from the rules: year by the range rule, and its epoch.
_BAND_YEARS = dict(zip(BANDS, (1899, 1914, 1940, 2007, 2021, None)))
_YEAR_EPOCHS = {1899: "Before 1900", 1914: "1900 - 1930", 1940: "1930 to present", 2007: "1930 to present", 2021: "1930 to present"}


def range_year_sql(band: str) -> str:
    """Expected construction year of each band of :data:`BANDS`."""
    rows = ", ".join(f"('{b}', {'NULL' if y is None else y})" for b, y in _BAND_YEARS.items())
    return f"CAST((SELECT known_year FROM (VALUES {rows}) known(known_band, known_year) WHERE known_band = {band}) AS INTEGER)"


def epoch_sql(year: str) -> str:
    """Expected epoch of each year that :func:`range_year_sql` gives."""
    rows = ", ".join(f"({y}, '{e}')" for y, e in _YEAR_EPOCHS.items())
    return f"coalesce((SELECT known_epoch FROM (VALUES {rows}) known(known_year, known_epoch) WHERE known_year = {year}), 'Unknown')"


def words(values: dict[str, str | None], column: str) -> Column:
    """Replace each listed value of a column by another text."""
    out = F.lit(None).cast("string")
    for value, text in values.items():
        out = F.when(F.col(column) == value, F.lit(text)).otherwise(out)
    return out


def words_sql(values: dict[str, str | None], column: str) -> str:
    cases = " ".join(
        f"WHEN '{v}' THEN " + ("NULL" if t is None else "'" + t + "'") for v, t in values.items()
    )
    return f"CASE {column} {cases} END"
