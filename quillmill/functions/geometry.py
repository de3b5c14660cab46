"""Bounding boxes: struct(l, t, r, b, origin), origin TOPLEFT or BOTTOMLEFT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<l:double,t:double,r:double,b:double,origin:string>"


def to_top_left(box: Column, height: Column) -> Column:
    """With the origin at the top left; a box whose page has no height stays as it is."""
    flipped = F.struct(box["l"].alias("l"), (height - box["t"]).alias("t"), box["r"].alias("r"), (height - box["b"]).alias("b"), F.lit("TOPLEFT").alias("origin"))
    return F.when((box["origin"] == "TOPLEFT") | height.isNull(), box).otherwise(flipped)


def area(box: Column) -> Column:
    """0 for an empty or upside-down box."""
    return F.greatest(box["r"] - box["l"], F.lit(0.0)) * F.greatest(box["b"] - box["t"], F.lit(0.0))


def intersection_area(a: Column, b: Column) -> Column:
    width = F.least(a["r"], b["r"]) - F.greatest(a["l"], b["l"])
    height = F.least(a["b"], b["b"]) - F.greatest(a["t"], b["t"])
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def overlap_ratio(a: Column, b: Column) -> Column:
    """The share of a that lies in b; 0 for an empty a."""
    return F.when(area(a) > 0, intersection_area(a, b) / area(a)).otherwise(F.lit(0.0))


def clip(box: Column, page: Column, pad: float) -> Column:
    """The box grown by pad on all sides and cut to the page; null if nothing is left."""
    grown = F.struct(
        F.greatest(box["l"] - pad, page["l"]).alias("l"), F.greatest(box["t"] - pad, page["t"]).alias("t"), F.least(box["r"] + pad, page["r"]).alias("r"), F.least(box["b"] + pad, page["b"]).alias("b"), box["origin"].alias("origin")
    )
    return F.when((grown["l"] < grown["r"]) & (grown["t"] < grown["b"]), grown)


def union_of(boxes: Column) -> Column:
    """The least box around an array of boxes, with the first one's origin; null if there is none."""
    of = lambda f, k: f(F.transform(boxes, lambda b: b[k]))
    return F.when(F.size(boxes) > 0, F.struct(of(F.array_min, "l").alias("l"), of(F.array_min, "t").alias("t"), of(F.array_max, "r").alias("r"), of(F.array_max, "b").alias("b"), F.get(boxes, F.lit(0))["origin"].alias("origin")))
