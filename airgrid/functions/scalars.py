"""Text, number and missing-value expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Fixed value: the two-sided 95 % quantile of the standard normal distribution.
Z95 = 1.959963984540054


def pad_left(text: Column, width: int, pad: str = "0") -> Column:
    """H2: left-pad to ``width``; text that is already longer is kept whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, pad)).otherwise(text)


def paste(sep: str, *parts: Column) -> Column:
    """H1: join with a separator; a missing part is written as ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def base_name(path: Column) -> Column:
    """H7: last component of a path."""
    return F.regexp_extract(path, r"[^/]+$", 0)


def strip_extension(name: Column) -> Column:
    """H7: file name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def lenient_number(text: Column) -> Column:
    """A3: the first number in the text, grouping commas dropped; text without one is NULL."""
    plain = F.regexp_replace(text, r"(?<=[0-9]),(?=[0-9]{3})", "")
    found = F.regexp_extract(plain, r"[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?", 0)
    return found.try_cast("double")


def without_comment(line: Column, mark: str = "#") -> Column:
    """A2: the line up to the first comment mark that is not inside double quotes, without trailing
    blanks. In a line whose quotes do not close, a mark after the last open quote is text."""
    m = "\\" + mark if not mark.isalnum() else mark
    return F.rtrim(F.regexp_replace(line, f'(?s)^((?:[^"{m}]++|"[^"]*+")*+){m}.*$', "$1"))


def name_year(path: Column, pattern: str | None = None) -> Column:
    """A5/H7: the year in a file name: group 1 of ``pattern``, by default the last group of exactly
    four digits."""
    return F.regexp_extract(
        base_name(path), pattern or r"^.*(?<![0-9])([0-9]{4})(?![0-9])", 1
    ).try_cast("int")


def not_in(value: Column, members: Iterable) -> Column:
    """B4: "not a member"; a missing value is not a member, so the answer is true."""
    return F.coalesce(~value.isin(list(members)), F.lit(True))


def set_missing(value: Column, condition: Column) -> Column:
    """NULL where the condition holds; an unknown condition changes nothing."""
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(None)).otherwise(value)


def nan_to_null(value: Column) -> Column:
    """The engine keeps one kind of missing number."""
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def significant(value: Column, digits: int) -> Column:
    """Round to ``digits`` significant digits, half to even; 0 and NULL pass through."""
    shift = F.lit(digits - 1).cast("double") - F.floor(F.log10(F.abs(value))).cast("double")
    scale = F.pow(F.lit(10.0), shift)
    return F.when(value == 0, value).otherwise(F.rint(value * scale) / scale)


def inverse_square_weight(distance: Column, center_weight: float = 100.0) -> Column:
    """1/d², with a fixed weight for the centre (never divides by zero)."""
    squared = (distance * distance).cast("double")
    return F.when(distance == 0, F.lit(float(center_weight))).otherwise(
        F.try_divide(F.lit(1.0), squared)
    )


def split_text(value: Column, sep: str = "-") -> Column:
    """H5: split on a literal separator."""
    return F.split(value, r"\Q" + sep + r"\E")


def region_size(region: Column) -> Column:
    """Number of cells that were merged into a region id."""
    return F.size(split_text(region))


def within_box(x: Column, y: Column, xmin: float, xmax: float, ymin: float, ymax: float) -> Column:
    """Inclusive bounding-box test."""
    return x.between(xmin, xmax) & y.between(ymin, ymax)
