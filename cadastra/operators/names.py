"""Renaming and choosing columns by rule."""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, types as T

from cadastra.operators.aggs import column_values

_PUNCTUATION = str.maketrans({ch: "_" for ch in string.punctuation + " "})
_NO_DIGITS = str.maketrans("", "", string.digits)


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[rule(name) for name in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return rename_all(df, str.lower)


def upper_names(df: DataFrame) -> DataFrame:
    return rename_all(df, str.upper)


def swap_chars(df: DataFrame, swaps: dict[str, str]) -> DataFrame:
    """Replace characters in every name, e.g. ``{"-": "_", " ": "_", ":": ""}``."""
    table = str.maketrans(swaps)
    return rename_all(df, lambda name: name.translate(table))


def clean_name(name: str) -> str:
    """Lower case, punctuation and spaces to single underscores, none at the ends, no line breaks."""
    words = name.replace("\n", "").lower().translate(_PUNCTUATION).split("_")
    return "_".join(word for word in words if word)


def clean_names(df: DataFrame) -> DataFrame:
    return rename_all(df, clean_name)


def remove_digits(name: str) -> str:
    return name.lower().translate(_NO_DIGITS)


def numbered_names(names: list[str], drop_digits: bool = False) -> list[str]:
    """Lower-case names, repeats numbered from 1; the last of each repeated name stays plain.

    ``A1, A2, B`` without digits gives ``a_1, a, b``.
    """
    plain = [remove_digits(n) if drop_digits else n.lower() for n in names]
    remaining, seen, out = Counter(plain), Counter(), []
    for name in plain:
        remaining[name] -= 1
        if remaining[name]:
            seen[name] += 1
            out.append(f"{name}_{seen[name]}")
        else:
            out.append(name)
    return out


def strip_digit_names(df: DataFrame) -> DataFrame:
    return df.toDF(*numbered_names(df.columns, drop_digits=True))


def affix_names(df: DataFrame, prefix: str, new_prefix: str = "", suffix: str = "") -> DataFrame:
    """Columns that start with ``prefix`` lose it and get ``new_prefix`` and ``suffix``."""

    def rule(name: str) -> str:
        return f"{new_prefix}{name[len(prefix):]}{suffix}" if name.startswith(prefix) else name

    return rename_all(df, rule)


def value_names(df: DataFrame, column: str, prefix: str = "") -> dict[str, str]:
    """Clean names, with a prefix, of the values found in a low-cardinality column: name -> value.

    Values of one clean name are an error, since one of them would be lost.
    """
    found = column_values(df, column)
    named = {prefix + clean_name(str(value)): value for value in found}
    if len(named) < len(found):
        raise ValueError(f"values of {column} share a name: {found}")
    return named


def matching(df: DataFrame, pattern: str | None = None, numeric: bool = False) -> list[str]:
    """Column names that match a regular expression and/or hold numbers."""
    return [
        field.name
        for field in df.schema
        if (pattern is None or re.search(pattern, field.name))
        and (not numeric or isinstance(field.dataType, T.NumericType))
    ]
