"""All queries of the annotation side, with their SQL. Each is declared over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import geometry, stats
from marlstone.operators import match
from marlstone.sources.tables import SQL as T
from marlstone.sources.tables import boxes, images, read

SPLITS = ("train", "val", "test")
QUERIES: dict = {}
ORACLES: dict = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _labelled(spark, d) -> DataFrame:
    return boxes(spark, d).join(images(spark, d), "image_id")


def _file_order() -> list[str]:
    return ["line_no", "part", "supp"]


@_query(T + """SELECT coalesce(split, 'all') AS split, class, count(DISTINCT image_id) AS n_images, count(*) AS n_boxes
FROM boxes JOIN images USING (image_id) GROUP BY GROUPING SETS ((split, class), (class))""")
def eda_class_split_stats(spark, d):
    b = _labelled(spark, d)
    # images first, then counts: one shuffle of (image, class) partials serves both groupings
    per = b.groupBy("split", "class", "image_id").agg(F.count(F.lit(1)).alias("c"))
    own = per.groupBy("split", "class").agg(F.count(F.lit(1)).alias("n_images"), F.sum("c").alias("n_boxes"))
    total = own.groupBy("class").agg(F.sum("n_images").alias("n_images"), F.sum("n_boxes").alias("n_boxes"))
    return own.unionByName(total.withColumn("split", F.lit("all")))


_JS = T + """, c AS (SELECT class, split, count(*) AS n, count(DISTINCT image_id) AS m FROM boxes JOIN images USING (image_id) GROUP BY class, split),
g AS (SELECT class, s AS split, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM (SELECT DISTINCT class FROM c) CROSS JOIN (VALUES ('train'), ('val'), ('test')) v(s) LEFT JOIN c USING (class, split)),
"""


@_query(_JS.replace("v(s) LEFT JOIN c USING (class, split)", "v(s) LEFT JOIN c ON c.class = c0.class AND c.split = s").replace("SELECT class, s AS split", "SELECT c0.class, s AS split").replace("(SELECT DISTINCT class FROM c) CROSS", "(SELECT DISTINCT class FROM c) c0 CROSS") + """
p AS (SELECT class, split, n / sum(n) OVER (PARTITION BY class) AS p, sum(n) OVER (PARTITION BY split) / sum(n) OVER () AS q,
  m / sum(m) OVER (PARTITION BY class) AS pm, sum(m) OVER (PARTITION BY split) / sum(m) OVER () AS qm FROM g)
SELECT class, sum(coalesce(p * log2(p / ((p + q) / 2)), 0) + coalesce(q * log2(q / ((p + q) / 2)), 0)) / 2 AS js_boxes,
  sum(coalesce(pm * log2(pm / ((pm + qm) / 2)), 0) + coalesce(qm * log2(qm / ((pm + qm) / 2)), 0)) / 2 AS js_images
FROM p GROUP BY class ORDER BY round(js_boxes, 9) DESC, class LIMIT 10""")
def eda_drift_ranking(spark, d):
    b = _labelled(spark, d)
    per = b.groupBy("class", "split", "image_id").agg(F.count(F.lit(1)).alias("c")).groupBy("class", "split").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("m"))
    w = per.groupBy("class").pivot("split", list(SPLITS)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("m"), F.lit(0)).alias("m"))
    totals = w.agg(*[F.sum(f"{s}_{k}").alias(f"all_{s}_{k}") for s in SPLITS for k in "nm"])
    w = w.crossJoin(F.broadcast(totals))  # one row

    def js(k: str) -> Column:
        own, every = sum(F.col(f"{s}_{k}") for s in SPLITS), sum(F.col(f"all_{s}_{k}") for s in SPLITS)
        return sum(stats.js_term(F.col(f"{s}_{k}") / own, F.col(f"all_{s}_{k}") / every) for s in SPLITS)

    return w.select("class", js("n").alias("js_boxes"), js("m").alias("js_images")).orderBy(F.round("js_boxes", 9).desc(), "class").limit(10)


_COUNTS = T + ", c AS (SELECT split, class, count(*)::DOUBLE AS x FROM boxes JOIN images USING (image_id) GROUP BY split, class), "


@_query(_COUNTS + """r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY x) AS i, count(*) OVER (PARTITION BY split) AS n, sum(x) OVER (PARTITION BY split) AS total,
  row_number() OVER (PARTITION BY split ORDER BY x DESC) AS j FROM c)
SELECT split, count(*) AS class_count, count(*) AS active_class_count, max(total)::BIGINT AS total, min(x)::BIGINT AS min_count,
  (max(x) FILTER (i = ceil((n - 1) * 0.5) + 1))::BIGINT AS median, (max(x) FILTER (i = ceil((n - 1) * 0.75) + 1))::BIGINT AS p75, (max(x) FILTER (i = ceil((n - 1) * 0.9) + 1))::BIGINT AS p90,
  max(x)::BIGINT AS max_count, max(x) / max(total) AS top1_share, sum(x) FILTER (j <= 3) / max(total) AS top3_share, stddev_pop(x) / avg(x) AS variation,
  2 * sum(i * x) / (max(n) * max(total)) - (max(n) + 1) / max(n) AS gini, -sum(x / total * ln(x / total)) / ln(max(n)) AS evenness
FROM r GROUP BY split""")
def eda_distribution_metrics(spark, d):
    return stats.distribution_metrics(_labelled(spark, d).groupBy("split", "class").agg(F.count(F.lit(1)).alias("x")), ["split"], "x")


_AREA = "((x2 - x1) * (y2 - y1))"


@_query(T + f"""SELECT split, CASE WHEN {_AREA} < 1024 THEN 'small' WHEN {_AREA} < 9216 THEN 'medium' ELSE 'large' END AS bucket, count(*) AS n,
  count(*) / sum(count(*)) OVER (PARTITION BY split) AS share FROM boxes JOIN images USING (image_id) GROUP BY 1, 2""")
def eda_size_buckets(spark, d):
    n = _labelled(spark, d).groupBy("split", geometry.bucket(geometry.area()).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("split")))


@_query(T + f"""SELECT image_id, count(*) FILTER ({_AREA} < 256) AS tiny, count(*) FILTER ({_AREA} >= 256 AND {_AREA} < 1024) AS small,
  count(*) FILTER ({_AREA} >= 1024 AND {_AREA} < 9216) AS medium, count(*) FILTER ({_AREA} >= 9216) AS large FROM boxes GROUP BY image_id""")
def candidate_size_buckets(spark, d):
    b = boxes(spark, d).select("image_id", geometry.bucket(geometry.area(), geometry.EXPORT_BUCKETS).alias("k"))
    return b.groupBy("image_id").agg(*[F.count_if(F.col("k") == k).alias(k) for k in ("tiny", "small", "medium", "large")])


@_query(T + """, i AS (SELECT split, image_id, count(*) AS n_boxes, count(DISTINCT class) AS n_classes FROM boxes JOIN images USING (image_id) GROUP BY ALL)
SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY split ORDER BY n_boxes DESC, n_classes DESC, image_id) <= 10""")
def eda_dense_images(spark, d):
    b = _labelled(spark, d).groupBy("split", "image_id").agg(F.count(F.lit(1)).alias("n_boxes"), F.size(F.collect_set("class")).cast("long").alias("n_classes"))
    w = Window.partitionBy("split").orderBy(F.desc("n_boxes"), F.desc("n_classes"), "image_id")
    return b.withColumn("r", F.row_number().over(w)).where("r <= 10").drop("r")


_IOU = """(greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)))"""


@_query(T + f"""SELECT a.image_id, a.part AS a_part, b.part AS b_part, {_IOU} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_IOU}) AS iou
FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND (a.line_no, a.part, a.supp) < (b.line_no, b.part, b.supp)
WHERE {_IOU} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_IOU}) >= 0.5""")
def iou_overlaps(spark, d):
    """Pairs of boxes of one image that overlap by half: an equi join on the image with the IoU as residual."""
    b = boxes(spark, d)
    a, c = b.select("image_id", *[F.col(x).alias(f"a_{x}") for x in b.columns if x != "image_id"]), b.select("image_id", *[F.col(x).alias(f"b_{x}") for x in b.columns if x != "image_id"])
    before = F.struct("a_line_no", "a_part", "a_supp") < F.struct("b_line_no", "b_part", "b_supp")
    return a.join(c, "image_id").where(before).withColumn("iou", geometry.iou("a_", "b_")).where("iou >= 0.5").select("image_id", "a_part", "b_part", "iou")


_CONF = T + """, m AS (SELECT class AS gt, 'Brand#' || (CASE WHEN part % 3 = 0 THEN 11 + (part + supp) % 5 ELSE substr(class, 7, 2)::INT END) AS pred FROM boxes),
c AS (SELECT gt, pred, count(*) AS n FROM m GROUP BY ALL) """


def _confusion(spark, d) -> DataFrame:
    pred = F.concat(F.lit("Brand#"), F.when(F.col("part") % 3 == 0, 11 + (F.col("part") + F.col("supp")) % 5).otherwise(F.substring("class", 7, 2).cast("long")))
    return boxes(spark, d).groupBy(F.col("class").alias("gt"), pred.alias("pred")).agg(F.count(F.lit(1)).alias("n"))


@_query(_CONF + "SELECT * FROM c")
def confusion_counts(spark, d):
    return _confusion(spark, d)


@_query(_CONF + """, t AS (SELECT gt, sum(n)::BIGINT AS total FROM c GROUP BY gt),
p AS (SELECT a.gt AS a, b.gt AS b, a.total AS ga, b.total AS gb, coalesce(x.n, 0) AS ab, coalesce(y.n, 0) AS ba FROM t a JOIN t b ON a.gt < b.gt LEFT JOIN c x ON x.gt = a.gt AND x.pred = b.gt LEFT JOIN c y ON y.gt = b.gt AND y.pred = a.gt),
r AS (SELECT *, ab / ga AS ra, ba / gb AS rb FROM p WHERE ab >= greatest(3, floor(ga * 0.02)) OR ba >= greatest(3, floor(gb * 0.02)))
SELECT CASE WHEN least(ra, rb) < 0.06 AND rb > ra THEN b ELSE a END AS source_class, CASE WHEN least(ra, rb) < 0.06 AND rb > ra THEN a ELSE b END AS target_class,
  CASE WHEN least(ra, rb) >= 0.06 THEN 'two-way' ELSE 'one-way' END AS confusion_type, greatest(ra, rb) AS score FROM r WHERE greatest(ra, rb) >= 0.06""")
def merge_candidates(spark, d):
    """Class pairs confused in either direction; the matrix is joined to its transpose, so only pairs that occur are formed."""
    t = 0.06
    c = _confusion(spark, d)
    total = c.groupBy("gt").agg(F.sum("n").alias("total"))
    low, high = F.least("gt", "pred"), F.greatest("gt", "pred")
    p = c.where("gt <> pred").groupBy(low.alias("a"), high.alias("b")).agg(F.sum(F.when(F.col("gt") < F.col("pred"), F.col("n")).otherwise(0)).alias("ab"), F.sum(F.when(F.col("gt") > F.col("pred"), F.col("n")).otherwise(0)).alias("ba"))
    p = p.join(total.select(F.col("gt").alias("a"), F.col("total").alias("ga")), "a").join(total.select(F.col("gt").alias("b"), F.col("total").alias("gb")), "b")
    gate = lambda n, g: n >= F.greatest(F.lit(3), F.floor(g * F.lit(0.02)))
    p = p.where(gate(F.col("ab"), F.col("ga")) | gate(F.col("ba"), F.col("gb"))).withColumn("ra", F.col("ab") / F.col("ga")).withColumn("rb", F.col("ba") / F.col("gb")).where(F.greatest("ra", "rb") >= t)
    both = F.least("ra", "rb") >= t
    turn = ~both & (F.col("rb") > F.col("ra"))
    return p.select(F.when(turn, F.col("b")).otherwise(F.col("a")).alias("source_class"), F.when(turn, F.col("a")).otherwise(F.col("b")).alias("target_class"), F.when(both, "two-way").otherwise("one-way").alias("confusion_type"), F.greatest("ra", "rb").alias("score"))


@_query(_CONF + """, g AS (SELECT gt AS class, sum(n) AS g, sum(n) FILTER (gt = pred) AS tp FROM c GROUP BY gt), p AS (SELECT pred AS class, sum(n) AS p FROM c GROUP BY pred)
SELECT class, coalesce(tp, 0)::BIGINT AS tp, (coalesce(p, 0) - coalesce(tp, 0))::BIGINT AS fp, (coalesce(g, 0) - coalesce(tp, 0))::BIGINT AS fn, coalesce(tp, 0) / (coalesce(p, 0) + coalesce(g, 0) - coalesce(tp, 0)) AS iou FROM g FULL JOIN p USING (class)""")
def pixel_iou(spark, d):
    """tp, fp, fn and IoU per class from sparse confusion counts, one pass: each count is dealt to its row and its column."""
    e = _confusion(spark, d).select("n", F.explode(F.array(F.struct(F.col("gt").alias("class"), F.lit(1).alias("g"), F.lit(0).alias("p"), (F.col("gt") == F.col("pred")).cast("int").alias("t")), F.struct(F.col("pred").alias("class"), F.lit(0).alias("g"), F.lit(1).alias("p"), F.lit(0).alias("t")))).alias("e")).select("n", "e.*")
    s = e.groupBy("class").agg(*[F.sum(F.col("n") * F.col(k)).alias(k) for k in "gpt"])
    return s.select("class", F.col("t").alias("tp"), (F.col("p") - F.col("t")).alias("fp"), (F.col("g") - F.col("t")).alias("fn"), (F.col("t") / (F.col("p") + F.col("g") - F.col("t"))).alias("iou"))


@_query(T + """, c AS (SELECT image_id, class, count(*) AS n, min((line_no, part, supp)) AS f FROM boxes GROUP BY ALL)
SELECT image_id, class AS dominant, n FROM c QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY n DESC, f) = 1""")
def dominant_class(spark, d):
    """Most frequent class per image, ties to the one met first: one aggregate instead of a window."""
    c = boxes(spark, d).groupBy("image_id", "class").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("line_no", "part", "supp")).alias("f"))
    m = c.groupBy("image_id").agg(F.min(F.struct((-F.col("n")).alias("k"), "f", "class")).alias("m"))
    return m.select("image_id", F.col("m.class").alias("dominant"), (-F.col("m.k")).alias("n"))


@_query(T + """, k AS (SELECT class, row_number() OVER (ORDER BY class) - 1 AS new_id FROM (SELECT DISTINCT class FROM boxes WHERE class NOT LIKE '%5'))
SELECT image_id, new_id, count(*) AS n FROM boxes JOIN k USING (class) GROUP BY ALL""")
def remap_contiguous(spark, d):
    """Classes kept get ids 0..K-1 in order of name; lines of others are dropped."""
    b = boxes(spark, d).where(~F.col("class").like("%5"))
    ids = b.select("class").distinct().withColumn("new_id", F.row_number().over(Window.orderBy("class")).cast("long") - 1)  # a row per class
    return b.groupBy("image_id", "class").agg(F.count(F.lit(1)).alias("n")).join(ids, "class").select("image_id", "new_id", "n")


_QUOTA = "CASE WHEN n < 5 THEN n ELSE greatest(5, least(20, 5 + round_even(3 * log10(n), 0))) END::BIGINT"


@_query(T + f", c AS (SELECT class, count(DISTINCT image_id) AS n FROM boxes GROUP BY class) SELECT class, n, {_QUOTA} AS quota FROM c")
def class_quotas(spark, d):
    c = boxes(spark, d).groupBy("class").agg(F.countDistinct("image_id").alias("n"))
    q = F.when(F.col("n") < 5, F.col("n")).otherwise(F.greatest(F.lit(5.0), F.least(F.lit(20.0), 5 + F.bround(3 * F.log10("n"), 0))))
    return c.withColumn("quota", q.cast("long"))


@_query("""SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_doc, count(*) OVER (PARTITION BY text) AS copies FROM documents""")
def content_dedupe(spark, d):
    docs = read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return docs.join(docs.groupBy("h").agg(F.min("doc_id").alias("keep_doc"), F.count(F.lit(1)).alias("copies")), "h").drop("h")


@_query("""SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text) AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)""")
def exclusion(spark, d):
    docs = read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    bench = read(spark, d, "benchmark").select(F.sha2("text", 256).alias("h"))
    toxic = read(spark, d, "labels").where("toxic = 1").select("doc_id")
    return docs.join(bench, "h", "left_anti").join(toxic, "doc_id", "left_anti").select("doc_id")


@_query("""WITH p AS (SELECT quality AS truth, (length(text) > 1500)::INT AS pred FROM labels JOIN documents USING (doc_id)), c AS (SELECT v AS class, count(*) FILTER (truth = v AND pred = v) AS tp, count(*) FILTER (truth <> v AND pred = v) AS fp, count(*) FILTER (truth = v AND pred <> v) AS fn FROM p CROSS JOIN (VALUES (0), (1)) x(v) GROUP BY v)
SELECT class, tp, fp, fn, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM c""")
def classification_report(spark, d):
    p = read(spark, d, "labels").join(read(spark, d, "documents"), "doc_id").select(F.col("quality").alias("truth"), (F.length("text") > 1500).cast("int").alias("pred"))
    n = p.groupBy("truth", "pred").agg(F.count(F.lit(1)).alias("n"))
    e = n.withColumn("class", F.explode(F.array(F.lit(0), F.lit(1))))
    t, q = F.col("truth") == F.col("class"), F.col("pred") == F.col("class")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    s = e.groupBy("class").agg(total(t & q).alias("tp"), total(~t & q).alias("fp"), total(t & ~q).alias("fn"))
    return s.select("*", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / (F.col("tp") + F.col("fn"))).alias("recall"), (2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).alias("f1"))


@_query("""WITH s AS (SELECT quality AS y, length(text) AS x FROM labels JOIN documents USING (doc_id)), g AS (SELECT x, sum(y) AS p, count(*) - sum(y) AS n FROM s GROUP BY x),
c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT sum(p * (below + n / 2)) / (sum(p) * sum(n)) AS auroc FROM c""")
def auroc(spark, d):
    """Ties count half. Scores are counted first; only distinct scores are put in order."""
    s = read(spark, d, "labels").join(read(spark, d, "documents"), "doc_id").groupBy(F.length("text").alias("x")).agg(F.sum("quality").alias("p"), (F.count(F.lit(1)) - F.sum("quality")).alias("n"))
    w = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumn("below", F.coalesce(F.sum("n").over(w), F.lit(0))).agg((F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)) / (F.sum("p") * F.sum("n"))).alias("auroc"))


@_query("""SELECT event_id, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS running_mean FROM events""")
def running_mean(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-19, 0)
    return read(spark, d, "events").select("event_id", F.avg("value").over(w).alias("running_mean"))


@_query("""SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""")
def last_write_wins(spark, d):
    """Latest value per series, the first on ties: one aggregate."""
    e = read(spark, d, "events").groupBy("user_id", "event_type").agg(F.min(F.struct((-F.unix_micros(F.col("ts").cast("timestamp"))).alias("t"), "event_id", "value")).alias("m"))
    return e.select("user_id", "event_type", "m.event_id", "m.value")


@_query("""SELECT event_type, count(*) AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS total_k FROM events GROUP BY event_type""")
def json_props(spark, d):
    e = read(spark, d, "events").select("event_type", F.from_json("props", "k long")["k"].alias("k"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total_k"))


@_query(T + """, i AS (SELECT image_id, md5('split:' || image_id) AS h FROM images) SELECT image_id, CASE WHEN h < 'cccc' THEN 'train' WHEN h < 'e666' THEN 'val' ELSE 'test' END AS split FROM i""")
def hash_split(spark, d):
    """80/10/10 by the image's own hash: no sort, no shuffle, and images never change split when others come."""
    h = F.md5(F.concat(F.lit("split:"), F.col("image_id").cast("string")))
    return images(spark, d).select("image_id", F.when(h < "cccc", "train").when(h < "e666", "val").otherwise("test").alias("split"))


@_query(T + """, i AS (SELECT split, image_id, count(*) AS c FROM boxes JOIN images USING (image_id) GROUP BY ALL), h AS (SELECT split, c, count(*) AS k FROM i GROUP BY ALL),
e AS (SELECT *, sum(k) OVER (PARTITION BY split ORDER BY c) AS upto, sum(k) OVER (PARTITION BY split) AS n FROM h)
SELECT split, min(c) FILTER (upto >= ceil((n - 1) * 0.5) + 1) AS p50, min(c) FILTER (upto >= ceil((n - 1) * 0.9) + 1) AS p90, min(c) FILTER (upto >= ceil((n - 1) * 0.98) + 1) AS p98 FROM e GROUP BY split""")
def density_quantiles(spark, d):
    """Nearest ranks of boxes per image from a histogram of counts, so no group's values are collected."""
    h = _labelled(spark, d).groupBy("split", "image_id").agg(F.count(F.lit(1)).alias("c")).groupBy("split", "c").agg(F.count(F.lit(1)).alias("k"))
    e = h.withColumn("upto", F.sum("k").over(Window.partitionBy("split").orderBy("c"))).withColumn("n", F.sum("k").over(Window.partitionBy("split")))
    q = lambda x: F.min(F.when(F.col("upto") >= F.ceil((F.col("n") - 1) * F.lit(x)) + 1, F.col("c")))
    return e.groupBy("split").agg(q(0.5).alias("p50"), q(0.9).alias("p90"), q(0.98).alias("p98"))


@_query(T + f"""SELECT a.class, count(*) AS tp, avg({_IOU} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_IOU})) AS segment_quality
FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND a.class = b.class AND a.hit AND NOT b.hit
WHERE {_IOU} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_IOU}) > 0.1 GROUP BY a.class""")
def segment_quality(spark, d):
    b = boxes(spark, d)
    side = lambda p, c: b.where(c).select("image_id", "class", *[F.col(x).alias(p + x) for x in ("x1", "y1", "x2", "y2")])
    j = side("a_", F.col("hit")).join(side("b_", ~F.col("hit")), ["image_id", "class"]).withColumn("iou", geometry.iou("a_", "b_")).where("iou > 0.1")
    return j.groupBy("class").agg(F.count(F.lit(1)).alias("tp"), F.avg("iou").alias("segment_quality"))


@_query()
def hungarian_match(spark, d):
    from marlstone.plans import detection

    return match.hungarian_match(*detection.sides(spark, d), threshold=0.1)


@_query()
def nms(spark, d):
    from marlstone.plans import detection

    p, _ = detection.sides(spark, d)
    return match.suppress(p.select("image_id", "class", "score", "pred_no", "x1", "y1", "x2", "y2"), 0.3, by_class=False)
