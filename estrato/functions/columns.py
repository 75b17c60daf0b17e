"""Scalar column functions. All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrato import config


def col(name: str) -> Column:
    """A column by its literal name, dots and parentheses included."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_to_null(text: Column, tokens=config.NA_TOKENS) -> Column:
    """Whole cells that read as missing become NULL (no trimming)."""
    return F.when(~text.isin(*tokens), text)


def sentinel_to_null(text: Column, sentinel: str = config.SENTINEL) -> Column:
    """NULL where the whole cell equals the sentinel."""
    return F.nullif(text, F.lit(sentinel))


def finite(number: Column) -> Column:
    """NaN and infinities become NULL, the only missing value here. (NaN
    compares as larger than any number.)"""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def text_to_double(text: Column, decimal_comma: bool = False) -> Column:
    """Text -> DOUBLE, NULL where it is not a plain number; may overflow.

    The engine's cast trims, and takes just ``config.NUMBER_PATTERN`` plus type
    suffixes, names such as ``NaN`` and hexadecimal forms. Spoiling their
    letters leaves the pattern; it costs less than matching it, and keeps the
    compiled code of wide tables small enough for the JVM to optimise.
    """
    letters = config.NUMBER_LETTERS
    if decimal_comma:
        return F.translate(text, letters + ",", "?" * len(letters) + ".").try_cast("double")
    return F.translate(text, letters, "?" * len(letters)).try_cast("double")


def parse_number(text: Column, decimal_comma: bool = False) -> Column:
    """Text -> finite DOUBLE or NULL."""
    return finite(text_to_double(text, decimal_comma))


def mid_depth(top: Column, bottom: Column) -> Column:
    return (top + bottom) / 2


def test_type(item: Column) -> Column:
    """Text before the first hyphen; the whole text if there is none."""
    return F.substring_index(item, "-", 1)


test_type.__test__ = False  # keeps pytest from collecting it by its name


def decode_file_name(name: Column) -> Column:
    """Undo the URL-encoding of Spark's file metadata ('+' is literal there)."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def site_name(file_name: Column) -> Column:
    """``Colegio_San_Juan.csv`` -> ``Colegio San Juan``."""
    stem = F.replace(file_name, F.lit(".csv"), F.lit(""))
    return F.replace(stem, F.lit("_"), F.lit(" "))


def depth_step(idx: Column, max_depth: Column, points: int = config.PROFILE_POINTS) -> Column:
    """The idx-th of ``points`` evenly spaced depths from 0 to ``max_depth``.

    The last point is ``max_depth`` itself, not a product that may miss it.
    """
    if points == 1:
        return max_depth * 0.0
    return F.when(idx == points - 1, max_depth).otherwise(idx * (max_depth / (points - 1)))


def location_label(north: Column, east: Column) -> Column:
    """``Norte 1.0 Este 2.0``: each number in its shortest text."""
    return F.concat(F.lit("Norte "), _plain(north), F.lit(" Este "), _plain(east))


def _plain(number: Column) -> Column:
    """A double in its shortest text without an exponent (``12.5``, ``7.0``).

    Outside the usual range the engine's own text, exponent included, stays.
    """
    digits = number.cast("string").try_cast("decimal(38,18)").cast("string")
    usual = (F.abs(number) < F.lit(1e16)) & ((F.abs(number) >= F.lit(1e-4)) | (number == 0))
    return (F.when(usual, F.regexp_replace(digits, r"(\.\d+?)0+$", "$1"))
            .otherwise(number.cast("string")))


def metric_label(rmse: Column, mae: Column, r2: Column) -> Column:
    """The three-line text that goes with an evaluation."""
    return F.format_string("RMSE: %.2f\nMAE: %.2f\nR²: %.4f", rmse, mae, r2)
