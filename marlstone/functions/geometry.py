"""Box arithmetic as column expressions: nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Upper area bounds of the size buckets of dataset statistics, exports and reviews.
EDA_BUCKETS = (("small", 32**2), ("medium", 96**2), ("large", None))
EXPORT_BUCKETS = (("tiny", 16**2), ("small", 32**2), ("medium", 96**2), ("large", None))
REVIEW_BUCKETS = (("tiny", 32**2), ("small", 96**2), ("medium", 288**2), ("large", None))


def bucket(area: Column, bounds=EDA_BUCKETS) -> Column:
    """The first bucket whose bound exceeds the area."""
    out = F.lit(bounds[-1][0])
    for name, most in reversed(bounds[:-1]):
        out = F.when(area < most, F.lit(name)).otherwise(out)
    return out


def corners(cx: Column, cy: Column, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def centre(x1: Column, y1: Column, x2: Column, y2: Column) -> tuple[Column, Column, Column, Column]:
    return (x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1


def clip(x: Column, most: Column | float) -> Column:
    return F.greatest(F.lit(0.0), F.least(x, F.lit(most) if isinstance(most, (int, float)) else most))


def _box(p: str) -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{p}{c}") for c in ("x1", "y1", "x2", "y2"))


def area(p: str = "") -> Column:
    x1, y1, x2, y2 = _box(p)
    return F.greatest(F.lit(0.0), x2 - x1) * F.greatest(F.lit(0.0), y2 - y1)


def intersection(p: str, q: str) -> Column:
    (a1, b1, a2, b2), (c1, d1, c2, d2) = _box(p), _box(q)
    return F.greatest(F.lit(0.0), F.least(a2, c2) - F.greatest(a1, c1)) * F.greatest(F.lit(0.0), F.least(b2, d2) - F.greatest(b1, d1))


def iou(p: str, q: str) -> Column:
    """Intersection over union of the boxes in columns <p>x1.. and <q>x1..; 0 for an empty union."""
    both = intersection(p, q)
    union = area(p) + area(q) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def giou(p: str, q: str) -> Column:
    (a1, b1, a2, b2), (c1, d1, c2, d2) = _box(p), _box(q)
    hull = (F.greatest(a2, c2) - F.least(a1, c1)) * (F.greatest(b2, d2) - F.least(b1, d1))
    union = area(p) + area(q) - intersection(p, q)
    return iou(p, q) - F.when(hull > 0, (hull - union) / hull).otherwise(F.lit(0.0))


def polygon_area(coords: Column) -> Column:
    """Shoelace area of [x0, y0, x1, y1, ...]."""
    n = (F.size(coords) / 2).cast("int")
    at = lambda i: F.element_at(coords, i + 1)
    term = lambda i: at(2 * i) * at(2 * ((i + 1) % n) + 1) - at(2 * ((i + 1) % n)) * at(2 * i + 1)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda a, i: a + term(i))
    return F.when(n >= 3, F.abs(total) / 2).otherwise(F.lit(0.0))


def polygon_box(coords: Column) -> Column:
    xs = F.filter(coords, lambda _, i: i % 2 == 0)
    ys = F.filter(coords, lambda _, i: i % 2 == 1)
    return F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"))


def interpolate(x: Column, x0: float, x1: float, y0: float, y1: float) -> Column:
    """Linear between the ends, clamped outside."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - x0) / (x1 - x0)))
    return y0 + t * (y1 - y0)


def short_side(w: Column, h: Column, width: float, height: float, size: float) -> Column:
    """Shorter side of a box after the image is resized to a square of `size`."""
    return F.least(w * size / width, h * size / height)


def bucket_value(x: Column, buckets: tuple[tuple[float, float], ...]) -> Column:
    """The value of the first bucket whose threshold exceeds x; null beyond the last."""
    out = F.lit(None)
    for most, value in reversed(buckets):
        out = F.when(x < most, F.lit(value)).otherwise(out)
    return out


def inverse_sigmoid(x: Column, eps: float = 1e-5) -> Column:
    x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    return F.log(F.greatest(x, F.lit(eps)) / F.greatest(1 - x, F.lit(eps)))


def pack_colour(r: Column, g: Column, b: Column) -> Column:
    return F.shiftleft(r.cast("long"), 16).bitwiseOR(F.shiftleft(g.cast("long"), 8)).bitwiseOR(b.cast("long"))


def unpack_colour(c: Column) -> tuple[Column, Column, Column]:
    return F.shiftright(c, 16).bitwiseAND(255), F.shiftright(c, 8).bitwiseAND(255), c.bitwiseAND(255)


def tile_starts(size: Column, tile: int, overlap: float) -> Column:
    """Where tiles begin along a side: steps of the tile less its overlap, pulled back to end with the image (so the last ones may repeat)."""
    step = max(1, int((1 - overlap) * tile))
    return F.transform(F.sequence(F.lit(0).cast("long"), (size - 1).cast("long"), F.lit(step).cast("long")), lambda s: F.least(s + tile, size) - tile)
