"""Sizes and boxes of printed pages, in points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_INCH, MM_PER_INCH = 72.0, 25.4
# Paper sizes in points, upright, in the order in which they are tried.
PAPERS = (("Letter", 612.0, 792.0), ("Legal", 612.0, 1008.0), ("Tabloid", 792.0, 1224.0), ("A4", 595.28, 841.89), ("A3", 841.89, 1190.55), ("A5", 419.53, 595.28))


def inches(points: Column) -> Column:
    return points / PER_INCH


def millimetres(points: Column) -> Column:
    return points / PER_INCH * MM_PER_INCH


def in_units(**sides: Column) -> Column:
    """A struct with each side in points, inches and millimetres, rounded to 3, 4 and 3 digits."""
    units = (("pt", lambda x: x, 3), ("in", inches, 4), ("mm", millimetres, 3))
    return F.struct(*(F.round(f(c), digits).alias(f"{name}_{unit}") for unit, f, digits in units for name, c in sides.items()))


def paper_name(width: Column, height: Column, tolerance: float = 2.0) -> Column:
    """The paper a page is printed on, upright or turned; Custom for others."""
    near = lambda a, b: F.abs(a - b) <= tolerance
    out = F.lit("Custom")
    for name, w, h in reversed(PAPERS):
        out = F.when((near(width, w) & near(height, h)) | (near(width, h) & near(height, w)), name).otherwise(out)
    return out


def boxes_differ(a: list[Column], b: list[Column], tolerance: float = 0.5) -> Column:
    """Whether any side of two boxes (left, top, right, bottom) lies apart by more than the tolerance."""
    return F.greatest(*(F.abs(x - y) > tolerance for x, y in zip(a, b, strict=True)))


def design_page(page: Column, designs: int, contents: bool = False) -> Column:
    """The design (from 0) behind a page: the contents design on page 1 if asked for, else right for odd and left for even pages.

    Designs come as contents, right, left, or right, left, or one for all.
    """
    if contents and designs < 3:
        raise ValueError("a contents design needs three designs")
    if designs < 1:
        raise ValueError("no designs")
    right, left = (1, 2) if designs >= 3 else (0, 1) if designs == 2 else (0, 0)
    facing = F.when(page % 2 == 1, right).otherwise(left)
    return F.when(page == 1, 0).otherwise(facing) if contents else facing


def placed(border_width: Column, border_height: Column, left: Column | None, top: Column, width: float = 612.0, height: float = 792.0) -> Column:
    """The box of a border on its page: in the middle, or at ``left``, and kept within the page."""
    within = lambda at, side, whole: F.least(F.greatest(F.lit(0.0), at), F.greatest(F.lit(0.0), F.lit(whole) - side))
    x = within((F.lit(width) - border_width) / 2 if left is None else left, border_width, width)
    y = within(top, border_height, height)
    return F.struct(x.alias("x0"), y.alias("y0"), (x + border_width).alias("x1"), (y + border_height).alias("y1"))


def size_variants(pages: DataFrame) -> DataFrame:
    """(width, height, name, pages): how many of ``pages`` (width, height) have each size, to the hundredth of a point."""
    sized = pages.select(F.round("width", 2).alias("width"), F.round("height", 2).alias("height")).where("width is not null and height is not null")
    counted = sized.groupBy("width", "height").agg(F.count("*").alias("pages"))
    return counted.select("width", "height", paper_name(F.col("width"), F.col("height")).alias("name"), "pages")
