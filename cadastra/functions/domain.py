"""Derived columns for certificates and cost tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cadastra.functions.cols import ColumnLike, as_col


def tenure(text: ColumnLike) -> Column:
    """Standard tenure name, tolerant of case at the start of the word. Null becomes ``Unknown``."""
    text = as_col(text)  # the words and names below are fixed values of the published series
    return (
        F.when(text.contains("wner"), "Owner occupied")
        .when(text.contains("rivate"), "Private rented")
        .when(text.contains("ocial"), "Social rented")
        .otherwise("Unknown")
    )


def tenure_strict(text: ColumnLike) -> Column:
    """Standard tenure name by exact lower-case words; social is tested before private."""
    text = as_col(text)  # fixed values, as above
    return (
        F.when(text.contains("wner-occupied"), "Owner occupied")
        .when(text.contains("social"), "Social rented")
        .when(text.contains("private"), "Private rented")
        .otherwise("Unknown")
    )


def text_flag(text: ColumnLike, needle: str) -> Column:
    """1 when the text holds ``needle``, 0 when not, null for null text."""
    return as_col(text).contains(needle).cast("int")


def equals_flag(text: ColumnLike, value: str) -> Column:
    """1 when the text is exactly ``value``, 0 when not, null for null text."""
    return (as_col(text) == value).cast("int")


def one_hot(text: ColumnLike, values: dict[str, str]) -> list[Column]:
    """One 0/1 column per (name -> value); null text gives null flags."""
    return [equals_flag(text, value).alias(name) for name, value in values.items()]


# Flags of the small-area housing profile (fixed values): name -> (source column, text searched).
PROFILE_TEXT_FLAGS = {
    "d_roof_good": ("roof_energy_eff", "Good"),
    "d_roof_poor": ("roof_energy_eff", "Poor"),
    "d_walls_good": ("walls_energy_eff", "Good"),
    "d_walls_poor": ("walls_energy_eff", "Poor"),
    "d_mf_electricity": ("main_fuel", "lectricity"),
    "d_mf_gas": ("main_fuel", "mains gas"),
    "d_mf_oil": ("main_fuel", "oil"),
    "d_epc_rent_social": ("tenure", "social"),
    "d_epc_owned": ("tenure", "wn"),
    "d_epc_rent_private": ("tenure", "private"),
    "d_terrace": ("built_form", "Terrace"),
}
PROFILE_EQUAL_FLAGS = {
    "d_detached": ("built_form", "Detached"),
    "d_semi_detached": ("built_form", "Semi-Detached"),
}


def profile_flags() -> list[Column]:
    """The flag columns of the housing profile over certificate columns in lower case."""
    flags = []
    for name, (column, needle) in PROFILE_TEXT_FLAGS.items():
        flags.append(text_flag(F.nullif(F.col(column), F.lit("NO DATA!")), needle).alias(name))
    for name, (column, value) in PROFILE_EQUAL_FLAGS.items():
        flags.append(equals_flag(F.nullif(F.col(column), F.lit("NO DATA!")), value).alias(name))
    return flags


def cost_bounds(text: ColumnLike) -> Column:
    """``£1,500 - £4,000`` as struct(low, high, mean) in whole pounds, pence cut off.

    The mean is null if either bound is null.
    """
    plain = F.regexp_replace(as_col(text), "£|,", "")
    low, high = (F.split_part(plain, F.lit(" - "), F.lit(i)).try_cast("double").try_cast("int") for i in (1, 2))
    return F.struct(low.alias("low"), high.alias("high"), ((low + high) / 2).alias("mean"))


def rating_category(band: ColumnLike) -> Column:
    """``A`` for every band that holds an A (A, A+), else ``B_G``; null stays null."""
    band = as_col(band)
    return F.when(band.contains("A"), "A").when(band.isNotNull(), "B_G")
