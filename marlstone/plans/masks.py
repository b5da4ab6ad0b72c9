"""Label masks as pixel rows, and polygons: histograms, quality, runs, remaps, outlines, clips.

Masks of the generated tables are grids of 8 by 8 pixels an image, painted by its boxes in file order, the last one on top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import geometry, polygons
from marlstone.plans.catalog import T, _query
from marlstone.sources.tables import boxes

GRID, IGNORE, IGNORED_CLASS = 8, 255, 11
_CELLS = T + f""", cl AS (SELECT image_id, r, c, max((line_no, part, supp, k)) FILTER (hit) AS t, max((line_no, part, supp, k)) FILTER (part % 3 <> 0) AS p
  FROM (SELECT *, substr(class, 7, 2)::BIGINT AS k FROM boxes) JOIN range({GRID}) rr(r) ON r * 80 + 40 BETWEEN y1 AND y2 JOIN range({GRID}) cc(c) ON c * 80 + 40 BETWEEN x1 AND x2 GROUP BY ALL),
cells AS (SELECT image_id, r, c, t[4] AS target, p[4] AS pred FROM cl)
"""


def _cells(spark, d) -> DataFrame:
    """image_id, r, c, target, pred: a row for each painted pixel, null where that mask has no label."""
    b = boxes(spark, d).withColumn("k", F.substring("class", 7, 2).cast("long"))
    top = F.struct("line_no", "part", "supp", "k")

    def run(lo: Column, hi: Column) -> Column:
        first, last = F.greatest(F.ceil((lo - 40) / 80), F.lit(0)), F.least(F.floor((hi - 40) / 80), F.lit(GRID - 1))
        return F.when(first <= last, F.sequence(first, last))

    painted = b.withColumn("r", F.explode(run(F.col("y1"), F.col("y2")))).withColumn("c", F.explode(run(F.col("x1"), F.col("x2"))))
    tops = painted.groupBy("image_id", "r", "c").agg(F.max(F.when(F.col("hit"), top)).alias("t"), F.max(F.when(F.col("part") % 3 != 0, top)).alias("p"))
    return tops.select("image_id", "r", "c", F.col("t.k").alias("target"), F.col("p.k").alias("pred"))


@_query(_CELLS + "SELECT image_id, target AS label, count(*) AS pixels FROM cells WHERE target IS NOT NULL GROUP BY ALL")
def mask_label_counts(spark, d):
    return _cells(spark, d).where("target is not null").groupBy("image_id", F.col("target").alias("label")).agg(F.count(F.lit(1)).alias("pixels"))


_QUALITY = _CELLS + f""", v AS (SELECT image_id, target, coalesce(pred, 0) AS pred FROM cells WHERE target <> {IGNORED_CLASS}),
n AS (SELECT image_id, target, pred, count(*) AS n FROM v GROUP BY ALL), g AS (SELECT image_id, target AS k, sum(n) AS g, coalesce(sum(n) FILTER (target = pred), 0) AS tp FROM n GROUP BY ALL), p AS (SELECT image_id, pred AS k, sum(n) AS p FROM n GROUP BY ALL),
q AS (SELECT image_id, avg(coalesce(tp, 0) / (coalesce(g, 0) + coalesce(p, 0) - coalesce(tp, 0))) AS miou, max_by(k, (coalesce(g, 0), -k)) AS dominant FROM g FULL JOIN p USING (image_id, k) GROUP BY image_id)
SELECT i.image_id, coalesce(miou, 0) AS miou, coalesce(dominant, -1) AS dominant, dominant IS NOT NULL AS valid FROM (SELECT DISTINCT image_id FROM cells) i LEFT JOIN q USING (image_id)"""


@_query(_QUALITY)
def semantic_image_quality(spark, d):
    """Mean IoU over the classes of an image's two masks, its most frequent true class (ties: the lowest, -1 for none), whether it has a valid pixel.

    Pixels without a true class or of the ignored one are left out; a pixel without a prediction counts as class 0.
    """
    cells = _cells(spark, d)
    ok = F.coalesce(F.col("target") != IGNORED_CLASS, F.lit(False))
    n = cells.groupBy("image_id", "target", F.coalesce("pred", F.lit(0)).alias("pred"), ok.alias("ok")).agg(F.count(F.lit(1)).alias("n"))
    role = lambda k, g, p, t: F.struct(k.alias("k"), g.alias("g"), p.alias("p"), t.alias("t"))
    zero, same = F.lit(0).cast("long"), F.when(F.col("target") == F.col("pred"), F.col("n")).otherwise(0)
    # images without a valid pixel keep a row whose class is null
    e = n.select("image_id", F.explode(F.when(F.col("ok"), F.array(role(F.col("target"), F.col("n"), zero, same), role(F.col("pred").cast("long"), zero, F.col("n"), zero))).otherwise(F.array(role(F.lit(None).cast("long"), zero, zero, zero)))).alias("e")).select("image_id", "e.*")
    s = e.groupBy("image_id", "k").agg(F.sum("g").alias("g"), F.sum("p").alias("p"), F.sum("t").alias("t"))
    iou = F.when(F.col("k").isNotNull(), F.col("t") / F.when(F.col("k").isNotNull(), F.col("g") + F.col("p") - F.col("t")))
    best = F.max_by("k", F.when(F.col("k").isNotNull(), F.struct("g", -F.col("k"))))
    return s.groupBy("image_id").agg(F.coalesce(F.avg(iou), F.lit(0.0)).alias("miou"), F.coalesce(best, F.lit(-1)).alias("dominant"), (F.count("k") > 0).alias("valid"))


@_query(_CELLS + f""", m AS (SELECT image_id, target AS label, count(*) AS pixels, min(c) AS x1, min(r) AS y1, max(c) AS x2, max(r) AS y2, list(c * {GRID} + r ORDER BY c, r) AS ps FROM cells WHERE target <> {IGNORED_CLASS} GROUP BY ALL),
f AS (SELECT image_id, label, i, list_contains(ps, i) AS v FROM m CROSS JOIN range({GRID * GRID}) t(i)), s AS (SELECT *, i - row_number() OVER (PARTITION BY image_id, label, v ORDER BY i) AS run FROM f),
u AS (SELECT image_id, label, v, min(i) AS a, count(*) AS n FROM s GROUP BY image_id, label, v, run), w AS (SELECT image_id, label, string_agg(n::VARCHAR, ',' ORDER BY a) AS runs, arg_min(v, a) AS starts FROM u GROUP BY ALL)
SELECT image_id, label, pixels, x1, y1, x2, y2, CASE WHEN starts THEN '0,' ELSE '' END || runs AS counts, pixels AS decoded FROM m JOIN w USING (image_id, label)""")
def class_mask_runs(spark, d):
    """A binary mask for each class an image has, without the ignored one: its box, column-major run lengths, and the pixels they decode to."""
    ps = F.sort_array(F.collect_list(F.col("c") * GRID + F.col("r")))
    m = _cells(spark, d).where(F.col("target") != IGNORED_CLASS).groupBy("image_id", F.col("target").alias("label")).agg(
        F.count(F.lit(1)).alias("pixels"), F.min("c").alias("x1"), F.min("r").alias("y1"), F.max("c").alias("x2"), F.max("r").alias("y2"), ps.alias("ps"))
    flat = F.transform(F.sequence(F.lit(0), F.lit(GRID * GRID - 1)), lambda i: F.array_contains("ps", i.cast("long")))
    m = m.withColumn("flat", flat).withColumn("runs", polygons.rle_encode(F.col("flat")))
    decoded = F.size(F.filter(polygons.rle_decode(F.col("runs")), lambda v: v)).cast("long")
    return m.select("image_id", "label", "pixels", "x1", "y1", "x2", "y2", F.array_join(F.transform("runs", lambda n: n.cast("string")), ",").alias("counts"), decoded.alias("decoded"))


def remap(label: Column, lut: dict[int, int], ignore: int = IGNORE, source_ignore: int | None = None, unknown: str = "error") -> Column:
    """Labels through a table; the source's ignore label becomes `ignore`, unknown ones too or raise an error."""
    table = F.create_map(*[F.lit(x).cast("long") for kv in lut.items() for x in kv])
    found = F.try_element_at(table, label.cast("long"))
    miss = F.lit(ignore) if unknown == "ignore" else F.raise_error(F.concat(F.lit("unknown label "), label.cast("string"))).cast("long")
    own = F.lit(False) if source_ignore is None else label == source_ignore
    return F.when(label.isNull(), F.lit(None)).when(own, F.lit(ignore)).when(found.isNotNull(), found).otherwise(miss)


@_query(_CELLS + f"""SELECT image_id, CASE WHEN target = {IGNORED_CLASS} OR target > 20 THEN {IGNORE} ELSE target // 10 END AS label, count(*) AS pixels, count(*) FILTER (target > 20) AS unknown FROM cells WHERE target IS NOT NULL GROUP BY ALL""")
def mask_remap(spark, d):
    """Classes to 20 go to their tens, class 11 is the source's ignore label, others are unknown."""
    lut = {k: k // 10 for k in range(1, 21)}
    c = _cells(spark, d).where("target is not null")
    new = remap(F.col("target"), lut, source_ignore=IGNORED_CLASS, unknown="ignore").cast("long")
    return c.groupBy("image_id", new.alias("label")).agg(F.count(F.lit(1)).alias("pixels"), F.count_if(F.col("target") > 20).alias("unknown"))


_POLY = T + """, q AS (SELECT image_id, x1 AS x, y1 AS y, row_number() OVER (PARTITION BY image_id ORDER BY line_no, part, supp) - 1 AS i, count(*) OVER (PARTITION BY image_id) AS n FROM boxes),
e AS (SELECT a.image_id, a.i, a.n, a.x AS ax, a.y AS ay, b.x AS xb, b.y AS yb, c.x AS cx, c.y AS cy FROM q a JOIN q b ON b.image_id = a.image_id AND b.i = (a.i + 1) % a.n JOIN q c ON c.image_id = a.image_id AND c.i = (a.i + 2) % a.n WHERE a.n >= 3),
t AS (SELECT image_id, abs(sum(ax * yb - xb * ay)) / 2 AS area, sum(((xb - ax) * (cy - ay) - (yb - ay) * (cx - ax) > 0)::INT) AS lefts, sum(((xb - ax) * (cy - ay) - (yb - ay) * (cx - ax) < 0)::INT) AS rights FROM e GROUP BY image_id),
o AS (SELECT f.*, s.ax AS px, s.ay AS py, s.xb AS qx, s.yb AS qy, (f.xb - f.ax) * (s.ay - f.ay) - (f.yb - f.ay) * (s.ax - f.ax) AS o1, (f.xb - f.ax) * (s.yb - f.ay) - (f.yb - f.ay) * (s.xb - f.ax) AS o2,
  (s.xb - s.ax) * (f.ay - s.ay) - (s.yb - s.ay) * (f.ax - s.ax) AS o3, (s.xb - s.ax) * (f.yb - s.ay) - (s.yb - s.ay) * (f.xb - s.ax) AS o4 FROM e f JOIN e s ON s.image_id = f.image_id AND s.i > f.i + 1 AND (s.i + 1) % s.n <> f.i),
m AS (SELECT DISTINCT image_id FROM o WHERE (o1 * o2 < 0 AND o3 * o4 < 0) OR (o1 = 0 AND px BETWEEN least(ax, xb) AND greatest(ax, xb) AND py BETWEEN least(ay, yb) AND greatest(ay, yb)) OR (o2 = 0 AND qx BETWEEN least(ax, xb) AND greatest(ax, xb) AND qy BETWEEN least(ay, yb) AND greatest(ay, yb))
  OR (o3 = 0 AND ax BETWEEN least(px, qx) AND greatest(px, qx) AND ay BETWEEN least(py, qy) AND greatest(py, qy)) OR (o4 = 0 AND xb BETWEEN least(px, qx) AND greatest(px, qx) AND yb BETWEEN least(py, qy) AND greatest(py, qy)))
SELECT t.image_id, area, m.image_id IS NULL AS simple, m.image_id IS NULL AND (lefts > 0) <> (rights > 0) AS convex FROM t LEFT JOIN m USING (image_id)"""


def _outlines(spark, d) -> DataFrame:
    """An image's box corners in file order as one polygon."""
    corner = F.struct("line_no", "part", "supp", polygons.point(F.col("x1"), F.col("y1")).alias("p"))
    g = boxes(spark, d).groupBy("image_id").agg(F.sort_array(F.collect_list(corner)).alias("cs")).where(F.size("cs") >= 3)
    return g.select("image_id", F.transform("cs", lambda c: c["p"]).alias("ps"))


@_query(_POLY)
def polygon_predicates(spark, d):
    ps = F.col("ps")
    return _outlines(spark, d).select("image_id", F.abs(polygons.signed_area(ps)).alias("area"), polygons.is_simple(ps).alias("simple"), polygons.is_convex(ps).alias("convex"))


def _ring(p: str, first: int = 0, back: bool = False) -> Column:
    """The corners of a box as a polygon that starts anywhere and runs either way."""
    c = [polygons.point(F.col(f"{p}{x}"), F.col(f"{p}{y}")) for x, y in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"))]
    c = c[first:] + c[:first]
    return F.array(*(c[::-1] if back else c))


@_query(T + "SELECT image_id, part, supp, line_no, x1 || ',' || y1 || ' ' || x1 || ',' || y2 || ' ' || x2 || ',' || y2 || ' ' || x2 || ',' || y1 AS outline FROM (SELECT image_id, part, supp, line_no, x1::BIGINT AS x1, y1::BIGINT AS y1, (x1 + 5)::BIGINT AS x2, (y1 + 3)::BIGINT AS y2 FROM boxes)")
def canonical_outlines(spark, d):
    """Equal outlines by their least rotation, whatever corner they start at and whichever way they run."""
    b = boxes(spark, d).select("image_id", "part", "supp", "line_no", "x1", "y1", (F.col("x1") + 5).alias("x2"), (F.col("y1") + 3).alias("y2"))
    any_ring = F.when(F.col("part") % 2 == 0, _ring("", 2)).otherwise(_ring("", 3, True))
    text = lambda p: F.concat_ws(",", p["x"].cast("long").cast("string"), p["y"].cast("long").cast("string"))
    return b.withColumn("ring", any_ring).select("image_id", "part", "supp", "line_no", F.array_join(F.transform(polygons.canonical(F.col("ring")), text), " ").alias("outline"))


_INTER = "greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"


@_query(T + f"""SELECT a.image_id, a.part AS a_part, a.supp AS a_supp, b.part AS b_part, b.supp AS b_supp, round({_INTER} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_INTER}), 6) AS iou
FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND (a.line_no, a.part, a.supp) < (b.line_no, b.part, b.supp) WHERE {_INTER} > 0""")
def polygon_overlaps(spark, d):
    """IoU of convex polygons of one image by clipping, for pairs whose boxes meet; the polygons here are boxes, one of them run backwards."""
    cols = ["line_no", "part", "supp", "x1", "y1", "x2", "y2"]
    b = boxes(spark, d)
    side = lambda p: b.select("image_id", *[F.col(c).alias(p + c) for c in cols])
    before = F.struct("a_line_no", "a_part", "a_supp") < F.struct("b_line_no", "b_part", "b_supp")
    p = side("a_").join(side("b_"), "image_id").where(before & (geometry.intersection("a_", "b_") > 0)).withColumns({"p": _ring("a_", 1), "q": _ring("b_", 2, True)})
    return p.select("image_id", "a_part", "a_supp", "b_part", "b_supp", F.round(polygons.convex_iou(F.col("p"), F.col("q")), 6).alias("iou"))


_MERGED = T + """, g AS (SELECT *, row_number() OVER (PARTITION BY image_id, fam ORDER BY (x2 - x1) * (y2 - y1) DESC, line_no, part, supp) AS k FROM (SELECT *, substr(class, 7, 1) AS fam, max((substr(class, 8, 1) > '3')::INT) OVER (PARTITION BY image_id, substr(class, 7, 1)) AS merged FROM boxes) WHERE merged = 1),
w AS (WITH RECURSIVE r AS (SELECT image_id, fam, k, part, supp, line_no, [{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}] AS kept, true AS stays FROM g WHERE k = 1 UNION ALL
  SELECT g.image_id, g.fam, g.k, g.part, g.supp, g.line_no, CASE WHEN h THEN kept ELSE list_append(kept, {'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}) END, NOT h FROM (SELECT g.*, r.kept, len(list_filter(r.kept, lambda b: greatest(0, least(b.x2, g.x2) - greatest(b.x1, g.x1)) * greatest(0, least(b.y2, g.y2) - greatest(b.y1, g.y1)) >=
  0.25 * ((b.x2 - b.x1) * (b.y2 - b.y1) + (g.x2 - g.x1) * (g.y2 - g.y1) - greatest(0, least(b.x2, g.x2) - greatest(b.x1, g.x1)) * greatest(0, least(b.y2, g.y2) - greatest(b.y1, g.y1))))) > 0 AS h FROM r JOIN g ON g.image_id = r.image_id AND g.fam = r.fam AND g.k = r.k + 1) g) SELECT * FROM r)
SELECT image_id, fam AS target, line_no, part, supp FROM w WHERE NOT stays"""


@_query(_MERGED)
def merge_overlaps(spark, d):
    """Boxes that go when classes merge: within an image and a target class that a merged class feeds, the larger box stays of two that overlap.

    Greedy by falling area (ties: file order), as one fold over the sorted boxes of a group, JVM-side. The group is one image's boxes of one class.
    """
    b = boxes(spark, d).withColumn("target", F.substring("class", 7, 1))
    one = F.struct((-geometry.area()).alias("a"), "line_no", "part", "supp", "x1", "y1", "x2", "y2")
    g = b.groupBy("image_id", "target").agg(F.sort_array(F.collect_list(one)).alias("es"), F.max(F.substring("class", 8, 1) > "3").alias("merged")).where(F.col("merged") & (F.size("es") > 1))

    def hit(x: Column, y: Column) -> Column:
        both = F.greatest(F.lit(0.0), F.least(x["x2"], y["x2"]) - F.greatest(x["x1"], y["x1"])) * F.greatest(F.lit(0.0), F.least(x["y2"], y["y2"]) - F.greatest(x["y1"], y["y1"]))
        return (both > 0) & (both >= 0.25 * (-x["a"] - y["a"] - both))

    kept = F.aggregate("es", F.slice(F.col("es"), 1, 0), lambda acc, e: F.when(F.exists(acc, lambda k: hit(k, e)), acc).otherwise(F.concat(acc, F.array(e))))
    order = lambda e: F.struct(e["a"], e["line_no"], e["part"], e["supp"])
    gone = g.withColumn("kept", kept).select("image_id", "target", F.explode(F.filter("es", lambda e: ~F.exists("kept", lambda k: order(k) == order(e)))).alias("e"))
    return gone.select("image_id", "target", "e.line_no", "e.part", "e.supp")
