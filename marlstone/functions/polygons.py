"""Polygons as arrays of struct<x, y>: predicates, canonical order, clipping and IoU in higher-order functions, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS, PARALLEL = 1e-12, 1e-15


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def orientation(a: Column, b: Column, c: Column) -> Column:
    """Twice the signed area of a, b, c."""
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def _at(points: Column, i: Column) -> Column:
    """The point at an index taken around the polygon."""
    return F.get(points, F.pmod(i, F.size(points)))


def signed_area(points: Column) -> Column:
    part = lambda ps: lambda p, i: p["x"] * _at(ps, i + 1)["y"] - _at(ps, i + 1)["x"] * p["y"]
    return _let(points, lambda ps: F.aggregate(F.transform(ps, part(ps)), F.lit(0.0), lambda a, x: a + x) / 2)


def _on(p: Column, a: Column, b: Column) -> Column:
    inside = lambda k: (F.least(a[k], b[k]) - EPS <= p[k]) & (p[k] <= F.greatest(a[k], b[k]) + EPS)
    return (F.abs(orientation(a, b, p)) <= EPS) & inside("x") & inside("y")


def segments_meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether ab and cd cross, or an end of one lies on the other."""
    crossing = (orientation(a, b, c) * orientation(a, b, d) < -EPS) & (orientation(c, d, a) * orientation(c, d, b) < -EPS)
    return crossing | _on(c, a, b) | _on(d, a, b) | _on(a, c, d) | _on(b, c, d)


def is_simple(points: Column) -> Column:
    """No two sides that are not neighbours meet; fewer than three points have no such sides."""
    n = F.size(points)
    apart = lambda i, j: (j > i + 1) & (F.pmod(j + 1, n) != i)
    meets = lambda i, j: segments_meet(_at(points, i), _at(points, i + 1), _at(points, j), _at(points, j + 1))
    sides = F.transform(points, lambda _, i: i)
    return ~F.exists(sides, lambda i: F.exists(sides, lambda j: apart(i, j) & meets(i, j)))


def is_convex(points: Column) -> Column:
    """All turns that are turns go one way, there is one, and no sides meet."""
    turns = F.filter(F.transform(points, lambda p, i: orientation(_at(points, i - 1), p, _at(points, i + 1))), lambda t: F.abs(t) > EPS)
    return (F.size(turns) > 0) & (F.forall(turns, lambda t: t > 0) | F.forall(turns, lambda t: t < 0)) & is_simple(points)


def canonical(points: Column) -> Column:
    """The least of all rotations of the points and of their reversal: equal for equal outlines."""
    turn = lambda p: F.transform(p, lambda _, i: F.concat(F.slice(p, i + 1, F.size(p)), F.slice(p, F.lit(1), i)))
    return _let(points, lambda p: F.array_min(F.concat(turn(p), _let(F.reverse(p), turn))))


def _crossing(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Where ab meets the line cd; b if they are parallel."""
    ux, uy, vx, vy = b["x"] - a["x"], b["y"] - a["y"], d["x"] - c["x"], d["y"] - c["y"]
    den = ux * vy - uy * vx
    t = ((c["x"] - a["x"]) * vy - (c["y"] - a["y"]) * vx) / F.when(F.abs(den) > PARALLEL, den)
    return F.when(F.abs(den) > PARALLEL, point(a["x"] + t * ux, a["y"] + t * uy)).otherwise(b)


def convex_clip(subject: Column, clip: Column) -> Column:
    """The part of a polygon within a convex one: cut by one side after the other."""
    def cut(points: Column, side: Column) -> Column:
        inside = lambda p: orientation(side["a"], side["b"], p) >= -EPS

        def step(p: Column, i: Column) -> Column:
            before = _at(points, i - 1)
            met = _crossing(before, p, side["a"], side["b"])
            return (
                F.when(inside(p) & inside(before), F.array(p)).when(inside(p), F.array(met, p)).when(inside(before), F.array(met)).otherwise(F.slice(F.array(p), 1, 0))
            )

        return F.flatten(F.transform(points, step))

    # sides with their inner half to the left; the area is taken once per polygon, not per side and point
    sides = F.transform(clip, lambda p, i: F.struct(p.alias("a"), _at(clip, i + 1).alias("b")))
    turned = F.transform(sides, lambda s: F.struct(s["b"].alias("a"), s["a"].alias("b")))
    return F.aggregate(F.when(signed_area(clip) > 0, sides).otherwise(turned), subject, cut)


def convex_iou(first: Column, second: Column) -> Column:
    """IoU of two convex polygons; 0 for an empty union."""
    area = lambda p: F.abs(signed_area(p))
    sizes = F.struct((area(first) + area(second)).alias("total"), area(convex_clip(first, second)).alias("both"))
    union = lambda s: s["total"] - s["both"]
    return _let(sizes, lambda s: F.when(union(s) > 0, s["both"] / F.when(union(s) > 0, union(s))).otherwise(0.0))


def rle_encode(flat: Column) -> Column:
    """Run lengths of an array of booleans, the first of false (0 if it starts with true); none for an empty array."""
    n = F.size(flat)
    starts = F.filter(F.transform(flat, lambda _, i: i), lambda i: (i == 0) | (F.get(flat, i) != F.get(flat, i - 1)))
    runs = F.transform(starts, lambda s, k: F.coalesce(F.get(starts, k + 1), n) - s)
    return F.when(F.coalesce(F.get(flat, F.lit(0)), F.lit(False)), F.concat(F.array(F.lit(0)), runs)).otherwise(runs)


def rle_decode(counts: Column) -> Column:
    return F.flatten(F.transform(counts, lambda c, i: F.array_repeat(i % 2 == 1, c)))
