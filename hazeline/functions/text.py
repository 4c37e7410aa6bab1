"""Text expressions used by reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_prefixes(names, prefixes=("components.", "main.")):
    """Column names without the given literal substrings."""
    cleaned = []
    for name in names:
        for prefix in prefixes:
            name = name.replace(prefix, "")
        cleaned.append(name)
    return cleaned


def feature_label(name: Column) -> Column:
    """``aqi_lag_1h`` -> ``Aqi Lag 1H``: every run of letters is capitalised.

    ``initcap`` would leave the letter after a digit small, so a space is put
    between digit and letter first and taken out again.
    """
    spaced = F.regexp_replace(F.replace(name, F.lit("_"), F.lit(" ")), "([0-9])([A-Za-z])", "$1\u0001 $2")
    return F.replace(F.initcap(spaced), F.lit("\u0001 "), F.lit(""))


def hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", value)
