"""String expressions, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space as Unicode has it, including the separators that Java's \s leaves out.
_SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"


def strip(value: Column) -> Column:
    """``value`` without white space at both ends; the look-behind keeps it linear."""
    return F.regexp_replace(value, rf"^{_SPACE}+|(?<!{_SPACE}){_SPACE}+$", "")


def has_space(value: Column) -> Column:
    """Whether ``value`` holds any white space."""
    return value.rlike(_SPACE)


def normal_name(value: Column) -> Column:
    """Lower case letters and digits of any script only; other signs are dropped."""
    return F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]", "")


def clean_name(value: Column) -> Column:
    """ASCII letters, digits and underscores of ``value``, case kept."""
    return F.regexp_replace(value, r"[^A-Za-z0-9_]", "")
