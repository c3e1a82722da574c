"""Box predicates as Column expressions. A box is a struct with x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def side(low: Column, high: Column, plus: float = 0.0) -> Column:
    return F.greatest(high - low + plus, F.lit(0.0))


def area(b: Column, plus: float = 0.0) -> Column:
    return side(b["x1"], b["x2"], plus) * side(b["y1"], b["y2"], plus)


def intersection(a: Column, b: Column, plus: float = 0.0) -> Column:
    return side(F.greatest(a["x1"], b["x1"]), F.least(a["x2"], b["x2"]), plus) * side(F.greatest(a["y1"], b["y1"]), F.least(a["y2"], b["y2"]), plus)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole isn't above zero."""
    return F.when(whole > 0, F.try_divide(part, whole)).otherwise(F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    inter = intersection(a, b)
    return ratio(inter, area(a) + area(b) - inter)


def share_of(b: Column, other: Column, plus: float = 0.0) -> Column:
    """How much of b lies in other."""
    return ratio(intersection(b, other, plus), area(b, plus))


def link_overlap(a: Column, b: Column) -> Column:
    """The largest of IoU and either box's share, with 1e-6 in the denominators."""
    inter, eps = intersection(a, b), F.lit(1e-6)
    return F.greatest(inter / (area(a) + area(b) - inter + eps), inter / (area(a) + eps), inter / (area(b) + eps))


def contains(b: Column, x: Column, y: Column) -> Column:
    """Borders included."""
    return (x >= b["x1"]) & (x <= b["x2"]) & (y >= b["y1"]) & (y <= b["y2"])
