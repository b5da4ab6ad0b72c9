"""Detection quality from real matches: truth are the boxes not returned, predictions the returned ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import geometry
from marlstone.operators import match
from marlstone.operators.running import envelope, ranked_hits, ratio
from marlstone.plans.catalog import _IOU, T, _labelled, _query
from marlstone.sources.tables import boxes, images

NO = "(line_no * 1000003 + part) * 10007 + supp"
MATCH_IOU = 0.1


def sides(spark, d) -> tuple[DataFrame, DataFrame]:
    b = lambda name: boxes(spark, d).withColumn(name, F.expr(NO).cast("long"))
    return b("pred_no").where(~F.col("hit")), b("gt_no").where("hit")


_PAIR = "(greatest(0, least(p.x2, g.x2) - greatest(p.x1, g.x1)) * greatest(0, least(p.y2, g.y2) - greatest(p.y1, g.y1)))"
_PAIR_IOU = f"{_PAIR} / ((p.x2 - p.x1) * (p.y2 - p.y1) + (g.x2 - g.x1) * (g.y2 - g.y1) - {_PAIR})"
#: Greedy matching as recursion over the ranks of an image's predictions of one class.
_MATCH = T.replace("WITH images", "WITH RECURSIVE images") + f""",
nb AS (SELECT *, ({NO})::BIGINT AS no FROM boxes),
p AS (SELECT *, row_number() OVER (PARTITION BY image_id, class ORDER BY score DESC, no) AS k FROM nb WHERE NOT hit),
g AS (SELECT * FROM nb WHERE hit),
c AS (SELECT p.image_id, p.class, p.k, g.no AS gt, {_PAIR_IOU} AS iou FROM p JOIN g ON p.image_id = g.image_id AND p.class = g.class WHERE {_PAIR_IOU} >= {MATCH_IOU}),
cl AS (SELECT image_id, class, k, list(gt ORDER BY iou DESC, gt) AS options FROM c GROUP BY ALL),
po AS (SELECT p.image_id, p.class, p.k, p.no, p.score, coalesce(cl.options, []::BIGINT[]) AS options FROM p LEFT JOIN cl USING (image_id, class, k)),
m AS (SELECT image_id, class, k, no, score, options[1] AS gt, CASE WHEN len(options) > 0 THEN [options[1]] ELSE []::BIGINT[] END AS used FROM po WHERE k = 1
  UNION ALL
  SELECT po.image_id, po.class, po.k, po.no, po.score, list_filter(po.options, lambda x: NOT list_contains(m.used, x))[1],
    list_concat(m.used, list_filter(po.options, lambda x: NOT list_contains(m.used, x))[1:1])
  FROM m JOIN po ON po.image_id = m.image_id AND po.class = m.class AND po.k = m.k + 1),
matched AS (SELECT image_id, class, no AS pred_no, score, gt IS NOT NULL AS is_tp FROM m)
"""


def matched(spark, d) -> DataFrame:
    return match.greedy_match(*sides(spark, d), threshold=MATCH_IOU)


@_query(_MATCH + "SELECT * FROM matched")
def greedy_match(spark, d):
    return matched(spark, d)


_REPORT = _MATCH + """, tg AS (SELECT {g}, count(*) AS gt FROM g JOIN images USING (image_id) GROUP BY {g}),
r AS (SELECT {g}, is_tp, row_number() OVER w AS k, sum(is_tp::INT) OVER w AS tp FROM matched JOIN images USING (image_id) WINDOW w AS (PARTITION BY {g} ORDER BY score DESC, image_id, pred_no)),
e AS (SELECT {g}, is_tp, k, tp, max(tp / k) OVER (PARTITION BY {g} ORDER BY k DESC ROWS UNBOUNDED PRECEDING) AS env FROM r),
a AS (SELECT {g}, count(*) AS pred, sum(is_tp::INT)::BIGINT AS tp, sum(CASE WHEN is_tp THEN env ELSE 0 END) AS area FROM e GROUP BY {g}),
report AS (SELECT {g}, coalesce(gt, 0) AS gt, coalesce(pred, 0) AS pred, coalesce(tp, 0) AS tp, CASE WHEN gt > 0 THEN coalesce(area, 0) / gt ELSE 0 END AS ap,
  CASE WHEN pred > 0 THEN tp / pred ELSE 0 END AS precision, CASE WHEN gt > 0 THEN coalesce(tp, 0) / gt ELSE 0 END AS recall FROM tg FULL JOIN a USING ({g}))
"""


def report(spark, d, group: list[str], of=None) -> DataFrame:
    """Per group gt, pred, tp, ap, precision, recall; every group seen in truth or predictions, and 0 where nothing can be divided.

    Recall rises only at hits, by 1 / gt, so the area under the envelope is the sum of the envelope at the hits over gt.
    """
    of = of or (lambda x: x)
    split = images(spark, d)
    truth = of(sides(spark, d)[1].join(split, "image_id")).groupBy(*group).agg(F.count(F.lit(1)).alias("gt"))
    r = ranked_hits(of(matched(spark, d).join(split, "image_id")), group, "score", ["image_id", "pred_no"], "is_tp")
    e = envelope(r, group, F.col("tp") / F.col("k"))
    a = e.groupBy(*group).agg(F.count(F.lit(1)).alias("pred"), F.count_if("is_tp").alias("tp"), F.sum(F.when(F.col("is_tp"), F.col("envelope")).otherwise(0.0)).alias("area"))
    out = truth.join(a, group, "full").fillna(0, ["gt", "pred", "tp"]).fillna(0.0, ["area"])
    return out.select(*group, "gt", "pred", "tp", ratio(F.col("area"), F.col("gt")).alias("ap"), ratio(F.col("tp"), F.col("pred")).alias("precision"), ratio(F.col("tp"), F.col("gt")).alias("recall"))


@_query(_REPORT.replace("{g}", "class") + "SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM report")
def average_precision(spark, d):
    r = report(spark, d, ["class"])
    return r.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


@_query(_REPORT.replace("{g}", "class") + "SELECT sum(gt)::BIGINT AS gt, sum(pred)::BIGINT AS pred, sum(tp)::BIGINT AS tp, avg(ap) AS map_05, sum(tp) / sum(pred) AS precision, sum(tp) / sum(gt) AS recall FROM report")
def eval_summary(spark, d):
    """Totals of an evaluation; the mean is over all classes seen in truth or predictions."""
    s = report(spark, d, ["class"]).agg(*[F.sum(c).alias(c) for c in ("gt", "pred", "tp")], F.avg("ap").alias("map_05"))
    return s.select("*", ratio(F.col("tp"), F.col("pred")).alias("precision"), ratio(F.col("tp"), F.col("gt")).alias("recall"))


@_query(_REPORT.replace("{g}", "class, split").replace("USING (class, split)", "USING (class, split)") + """, s AS (SELECT class, sum(gt)::BIGINT AS gt, sum(pred)::BIGINT AS pred, sum(tp)::BIGINT AS tp, avg(ap) AS ap FROM report GROUP BY class)
SELECT *, CASE WHEN pred > 0 THEN tp / pred ELSE 0 END AS precision, CASE WHEN gt > 0 THEN tp / gt ELSE 0 END AS recall FROM s""")
def merged_reports(spark, d):
    """One report per split, merged: counts add up, AP is averaged, precision and recall are computed again."""
    m = report(spark, d, ["class", "split"]).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("gt", "pred", "tp")], F.avg("ap").alias("ap"))
    return m.select("*", ratio(F.col("tp"), F.col("pred")).alias("precision"), ratio(F.col("tp"), F.col("gt")).alias("recall"))


_SHARD = "(image_id % 97)"
_SMALL = _REPORT.replace("{g}", "class, shard").replace("FROM g JOIN images USING (image_id)", f"FROM (SELECT *, {_SHARD} AS shard FROM g) g").replace("FROM matched JOIN images USING (image_id)", f"FROM (SELECT *, {_SHARD} AS shard FROM matched) x")
#: Fixed values of the risk score: weights, and the limits of its regimes.
_RISK = _SMALL + """, f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1, CASE WHEN pred > 0 THEN (pred - tp) / pred ELSE 0 END AS fp_rate FROM report),
k AS (SELECT *, CASE WHEN gt = 0 THEN 1.0::DOUBLE WHEN gt < 5 THEN least(0.6::DOUBLE + 0.4::DOUBLE * (1 - gt / 5) + CASE WHEN pred = 0 THEN 0.2::DOUBLE ELSE 0 END, 1.0::DOUBLE)
  ELSE CASE WHEN gt < 10 THEN 0.4::DOUBLE * (1 - gt / 10) ELSE 0 END + CASE WHEN ap < 0.3 THEN 0.3::DOUBLE * (1 - ap / 0.3::DOUBLE) ELSE 0 END
    + CASE WHEN f1 < 0.4 THEN 0.2::DOUBLE * (1 - f1 / 0.4::DOUBLE) ELSE 0 END + CASE WHEN fp_rate > 0.5 THEN 0.1::DOUBLE * fp_rate ELSE 0 END END AS risk FROM f)
SELECT class, shard, gt, risk, CASE WHEN gt = 0 THEN 'very high' WHEN risk >= 0.6 THEN 'high' WHEN risk >= 0.3 THEN 'medium' ELSE 'low' END AS risk_level,
  CASE WHEN gt = 0 THEN 'none' WHEN gt < 5 THEN 'low' ELSE 'normal' END AS confidence FROM k"""


def _shards(df: DataFrame) -> DataFrame:
    return df.withColumn("shard", F.col("image_id") % 97)


@_query(_RISK)
def class_quality_risk(spark, d):
    """Piecewise risk per class, in 97 reports by image, so that classes with no truth, few and many boxes all occur."""
    a = report(spark, d, ["class", "shard"], _shards)
    a = a.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).withColumn("fp_rate", ratio(F.col("pred") - F.col("tp"), F.col("pred")))
    term = lambda c, x: F.when(c, x).otherwise(F.lit(0.0))
    few = F.least(0.6 + 0.4 * (1 - F.col("gt") / 5) + term(F.col("pred") == 0, F.lit(0.2)), F.lit(1.0))
    many = term(F.col("gt") < 10, 0.4 * (1 - F.col("gt") / 10)) + term(F.col("ap") < 0.3, 0.3 * (1 - F.col("ap") / 0.3)) + term(F.col("f1") < 0.4, 0.2 * (1 - F.col("f1") / 0.4)) + term(F.col("fp_rate") > 0.5, 0.1 * F.col("fp_rate"))
    a = a.withColumn("risk", F.when(F.col("gt") == 0, 1.0).when(F.col("gt") < 5, few).otherwise(many))
    level = F.when(F.col("gt") == 0, "very high").when(F.col("risk") >= 0.6, "high").when(F.col("risk") >= 0.3, "medium").otherwise("low")
    sure = F.when(F.col("gt") == 0, "none").when(F.col("gt") < 5, "low").otherwise("normal")
    return a.select("class", "shard", "gt", "risk", level.alias("risk_level"), sure.alias("confidence"))


@_query(_SMALL + "SELECT class, shard, gt, pred, tp, ap FROM report WHERE gt > 0 AND ap < 0.3")
def bad_classes(spark, d):
    return report(spark, d, ["class", "shard"], _shards).where("gt > 0 and ap < 0.3").select("class", "shard", "gt", "pred", "tp", "ap")


@_query(_SMALL + "SELECT class, shard, gt < 5 AS few, ap < 0.1 AS weak FROM report WHERE ap < 0.1 OR gt < 5")
def outlier_classes(spark, d):
    """Classes whose AP or truth is too small to trust the rest of the report."""
    return report(spark, d, ["class", "shard"], _shards).where("ap < 0.1 or gt < 5").select("class", "shard", (F.col("gt") < 5).alias("few"), (F.col("ap") < 0.1).alias("weak"))


#: A box pair is a duplicate at this IoU, centre distance in pixels and ratio of sizes; siblings conflict at that IoU.
DUP_IOU, DUP_CENTRE, DUP_SIZE, CONFLICT_IOU = 0.9, 5.0, 0.95, 0.5


def box_pairs(b: DataFrame) -> DataFrame:
    """Pairs of boxes of one image that overlap by half, in order of the file: columns a_*, b_*, image_id, iou."""
    side = lambda p: b.select("image_id", *[F.col(x).alias(p + x) for x in b.columns if x != "image_id"])
    before = F.struct("a_line_no", "a_part", "a_supp") < F.struct("b_line_no", "b_part", "b_supp")
    return side("a_").join(side("b_"), "image_id").where(before).withColumn("iou", geometry.iou("a_", "b_")).where(f"iou >= {CONFLICT_IOU}")


_SIDE = "(least({0}.x2 - {0}.x1, {1}.x2 - {1}.x1) / greatest({0}.x2 - {0}.x1, {1}.x2 - {1}.x1))"
_FLAGS = T + f""", bp AS (SELECT a.image_id, a.part AS a_part, a.supp AS a_supp, b.part AS b_part, b.supp AS b_supp, substr(a.class, 7, 1) = substr(b.class, 7, 1) AND a.class <> b.class AS sibling, substr(a.class, 7, 1) AS fam,
  {_IOU} / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_IOU}) AS iou, sqrt(power((a.x1 + a.x2) / 2 - (b.x1 + b.x2) / 2, 2) + power((a.y1 + a.y2) / 2 - (b.y1 + b.y2) / 2, 2)) AS centre,
  least(least(a.x2 - a.x1, b.x2 - b.x1) / greatest(a.x2 - a.x1, b.x2 - b.x1), least(a.y2 - a.y1, b.y2 - b.y1) / greatest(a.y2 - a.y1, b.y2 - b.y1)) AS size_ratio
  FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND (a.line_no, a.part, a.supp) < (b.line_no, b.part, b.supp)),
fl AS (SELECT *, iou >= {DUP_IOU} AND centre <= {DUP_CENTRE} AND size_ratio >= {DUP_SIZE} AS dup, CASE WHEN sibling THEN 'conflict:' || fam END AS conflict FROM bp WHERE iou >= {CONFLICT_IOU})
"""


def _flagged(spark, d) -> DataFrame:
    p = box_pairs(boxes(spark, d))
    c = {k: (F.col(f"{k}_x1") + F.col(f"{k}_x2")) / 2 for k in "ab"}, {k: (F.col(f"{k}_y1") + F.col(f"{k}_y2")) / 2 for k in "ab"}
    centre = F.sqrt(F.pow(c[0]["a"] - c[0]["b"], 2) + F.pow(c[1]["a"] - c[1]["b"], 2))
    w = {k: F.col(f"{k}_x2") - F.col(f"{k}_x1") for k in "ab"}
    h = {k: F.col(f"{k}_y2") - F.col(f"{k}_y1") for k in "ab"}
    size = F.least(*[F.least(x["a"], x["b"]) / F.greatest(x["a"], x["b"]) for x in (w, h)])
    fam = F.substring("a_class", 7, 1)
    sibling = (fam == F.substring("b_class", 7, 1)) & (F.col("a_class") != F.col("b_class"))
    return p.withColumns({"dup": (F.col("iou") >= DUP_IOU) & (centre <= DUP_CENTRE) & (size >= DUP_SIZE), "conflict": F.when(sibling, F.concat(F.lit("conflict:"), fam))})


@_query(_FLAGS + "SELECT image_id, a_part, a_supp, b_part, b_supp, iou, dup, conflict FROM fl WHERE dup OR conflict IS NOT NULL")
def geometry_flags(spark, d):
    """Near-duplicate boxes, and overlapping boxes of sibling classes (brands of one family)."""
    return _flagged(spark, d).where("dup or conflict is not null").select("image_id", "a_part", "a_supp", "b_part", "b_supp", "iou", "dup", "conflict")


@_query(T + """, c AS (SELECT DISTINCT class, substr(class, 7, 1) AS fam FROM boxes) SELECT a.class AS class_a, b.class AS class_b, 'family ' || a.fam AS group_name FROM c a JOIN c b ON a.fam = b.fam AND a.class < b.class""")
def sibling_pairs(spark, d):
    """Members of a group as unordered pairs; groups are small (families of classes)."""
    c = boxes(spark, d).select("class").distinct().groupBy(F.substring("class", 7, 1).alias("fam")).agg(F.sort_array(F.collect_set("class")).alias("m"))
    pairs = F.flatten(F.transform("m", lambda a: F.transform(F.filter("m", lambda b: b > a), lambda b: F.struct(a.alias("class_a"), b.alias("class_b")))))
    return c.select("fam", F.explode(pairs).alias("p")).select("p.class_a", "p.class_b", F.concat(F.lit("family "), F.col("fam")).alias("group_name"))


#: Pixels below which a box is tiny, and the share of the image above which it is the whole.
MIN_PX, MAX_SHARE = 20, 0.05
_BOXFLAGS = f"list_filter(['tiny' , 'full_image', 'out_of_bounds'], lambda f: (f = 'tiny' AND (x2 - x1 < {MIN_PX} OR y2 - y1 < {MIN_PX})) OR (f = 'full_image' AND (x2 - x1) * (y2 - y1) / 409600 > {MAX_SHARE}) OR (f = 'out_of_bounds' AND (x1 < -1 OR y1 < -1 OR x2 > 641 OR y2 > 641)))"


@_query(T + f", f AS (SELECT image_id, line_no, part, supp, array_to_string({_BOXFLAGS}, ',') AS flags FROM boxes) SELECT * FROM f WHERE flags <> ''")
def bad_boxes(spark, d):
    b = boxes(spark, d)
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    tests = (("tiny", (w < MIN_PX) | (h < MIN_PX)), ("full_image", w * h / 409600 > MAX_SHARE), ("out_of_bounds", (F.col("x1") < -1) | (F.col("y1") < -1) | (F.col("x2") > 641) | (F.col("y2") > 641)))
    flags = F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in tests])
    return b.select("image_id", "line_no", "part", "supp", flags.alias("flags")).where("flags <> ''")


#: What each kind of problem weighs; a geometry flag weighs one.
WEIGHTS = {"missing": 2.0, "swapped": 2.5, "false_pos": 1.5, "loc": 1.0, "low_conf": 0.5}
_PROBLEMS = _MATCH.replace("matched AS (SELECT image_id, class, no", "matched AS (SELECT image_id, class, gt, no") + f""", pr AS (
  SELECT image_id, 'missing' AS kind FROM g ANTI JOIN (SELECT image_id, gt FROM matched WHERE gt IS NOT NULL) t ON g.image_id = t.image_id AND g.no = t.gt
  UNION ALL SELECT image_id, 'false_pos' FROM matched WHERE gt IS NULL UNION ALL SELECT image_id, 'low_conf' FROM matched WHERE gt IS NOT NULL AND score < 0.03)
SELECT image_id, count(*) FILTER (kind = 'missing') AS missing, count(*) FILTER (kind = 'false_pos') AS false_pos, count(*) FILTER (kind = 'low_conf') AS low_conf,
  count(*) FILTER (kind = 'missing') * {WEIGHTS['missing']}::DOUBLE + count(*) FILTER (kind = 'false_pos') * {WEIGHTS['false_pos']}::DOUBLE + count(*) FILTER (kind = 'low_conf') * {WEIGHTS['low_conf']}::DOUBLE AS problem_score
FROM pr GROUP BY image_id"""


@_query(_PROBLEMS)
def problem_scores(spark, d):
    """Truth nobody found, predictions without truth, hits of low score, and their weighted sum per image."""
    truth = sides(spark, d)[1].groupBy("image_id").agg(F.count(F.lit(1)).alias("gt"))
    m = matched(spark, d).groupBy("image_id").agg(F.count_if("is_tp").alias("tp"), F.count_if(~F.col("is_tp")).alias("false_pos"), F.count_if(F.col("is_tp") & (F.col("score") < 0.03)).alias("low_conf"))
    j = truth.join(m, "image_id", "full").fillna(0).withColumn("missing", F.col("gt") - F.col("tp")).where("missing + false_pos + low_conf > 0")
    return j.select("image_id", "missing", "false_pos", "low_conf", sum(F.col(k) * WEIGHTS[k] for k in ("missing", "false_pos", "low_conf")).alias("problem_score"))


#: Short side below which a face cannot be found, sizes in pixels of the input, most boxes a detector returns.
DEVICE, QUERIES_MAX, DETECTIONS_MAX = 320.0, 4, 2


@_query(T + f""", b AS (SELECT image_id, least((x2 - x1) * {DEVICE} / 640, (y2 - y1) * {DEVICE} / 640) AS device, y2 - y1 AS h FROM boxes),
i AS (SELECT image_id, count(*) AS n, count(*) FILTER (device < 16) AS lt, count(*) FILTER (device >= 16) AS ge, count(*) FILTER (h <= 30) AS low, count(*) FILTER (h > 30 AND device >= 16) AS reach FROM b GROUP BY image_id)
SELECT count(*) AS images, sum(n)::BIGINT AS boxes, count(*) FILTER (n > {DETECTIONS_MAX}) AS dense_images, coalesce(sum(n) FILTER (n > {DETECTIONS_MAX}), 0)::BIGINT AS dense_boxes, sum(greatest(0, n - {DETECTIONS_MAX}))::BIGINT AS beyond_detections,
  sum(greatest(0, n - {QUERIES_MAX}))::BIGINT AS beyond_queries, sum(lt)::BIGINT AS lt, sum(ge)::BIGINT AS ge, sum(low)::BIGINT AS low, sum(reach)::BIGINT AS reachable, round(sum(reach) / sum(n) * 100, 2) AS reachable_pct FROM i""")
def size_audit(spark, d):
    """Boxes by short side at the model's input, boxes beyond what is evaluated, and boxes that can be found at all."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    b = boxes(spark, d).select("image_id", geometry.short_side(w, h, 640, 640, DEVICE).alias("device"), h.alias("h"))
    tests = {"lt": "device < 16", "ge": "device >= 16", "low": "h <= 30", "reachable": "h > 30 and device >= 16"}
    i = b.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(c)).alias(k) for k, c in tests.items()])
    over = lambda most: F.sum(F.greatest(F.lit(0), F.col("n") - most))
    s = i.agg(F.count(F.lit(1)).alias("images"), F.sum("n").alias("boxes"), F.count_if(F.col("n") > DETECTIONS_MAX).alias("dense_images"), F.coalesce(F.sum(F.when(F.col("n") > DETECTIONS_MAX, F.col("n"))), F.lit(0)).alias("dense_boxes"), over(DETECTIONS_MAX).alias("beyond_detections"), over(QUERIES_MAX).alias("beyond_queries"), *[F.sum(k).alias(k) for k in tests])
    return s.withColumn("reachable_pct", F.round(ratio(F.col("reachable"), F.col("boxes")) * 100, 2))


@_query(T + """, s AS (SELECT split, count(*) FILTER (a < 256) AS tiny, count(*) FILTER (a >= 256 AND a < 1024) AS small, count(*) FILTER (a >= 1024 AND a < 9216) AS medium, count(*) FILTER (a >= 9216) AS large
  FROM (SELECT split, (x2 - x1) * (y2 - y1) AS a FROM boxes JOIN images USING (image_id)) GROUP BY split)
SELECT split, tiny, small / (small + medium + large) AS small, medium / (small + medium + large) AS medium, large / (small + medium + large) AS large FROM s""")
def size_shares(spark, d):
    """Shares of small, medium and large boxes; tiny ones are counted but no part of the whole."""
    k = geometry.bucket(geometry.area(), geometry.EXPORT_BUCKETS)
    s = _labelled(spark, d).select("split", k.alias("k")).groupBy("split").agg(*[F.count_if(F.col("k") == n).alias(n) for n in ("tiny", "small", "medium", "large")])
    total = F.col("small") + F.col("medium") + F.col("large")
    return s.select("split", "tiny", *[ratio(F.col(n), total).alias(n) for n in ("small", "medium", "large")])


@_query(T + """, p AS (SELECT image_id, class, part, score, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, part, supp, line_no) AS r FROM boxes WHERE score > 0.02) SELECT image_id, class, part, score FROM p WHERE r <= 3""")
def score_top_k(spark, d):
    """What goes into suppression: predictions above a score (strictly), the best three of an image."""
    w = Window.partitionBy("image_id").orderBy(F.desc("score"), "part", "supp", "line_no")
    return boxes(spark, d).where("score > 0.02").withColumn("r", F.row_number().over(w)).where("r <= 3").select("image_id", "class", "part", "score")


@_query(T + "SELECT image_id, count(*) FILTER (score > 0.05) AS detection, count(*) FILTER (score >= 0.05) AS instance FROM boxes GROUP BY image_id")
def score_filters(spark, d):
    """Detections must exceed the threshold, instance masks may equal it."""
    return boxes(spark, d).groupBy("image_id").agg(F.count_if(F.col("score") > 0.05).alias("detection"), F.count_if(F.col("score") >= 0.05).alias("instance"))


@_query(T + f""", ov AS (SELECT a.image_id, a.part AS a_part, b.part AS b_part, {_IOU} / ((a.x2 - a.x1) * (a.y2 - a.y1)) AS cover FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND a.line_no < b.line_no)
SELECT * FROM ov WHERE cover >= 0.5""")
def own_overlap(spark, d):
    """How much of its own area a box shares with a later one of its image."""
    b = boxes(spark, d)
    side = lambda p: b.select("image_id", F.col("part").alias(f"{p}part"), F.col("line_no").alias(f"{p}line"), *[F.col(x).alias(p + x) for x in ("x1", "y1", "x2", "y2")])
    j = side("a_").join(side("b_"), "image_id").where("a_line < b_line")
    return j.select("image_id", "a_part", "b_part", ratio(geometry.intersection("a_", "b_"), geometry.area("a_")).alias("cover")).where("cover >= 0.5")


@_query(T + f""", gi AS (SELECT a.image_id, a.part AS a_part, b.part AS b_part, {_IOU} AS i, (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_IOU} AS u, (greatest(a.x2, b.x2) - least(a.x1, b.x1)) * (greatest(a.y2, b.y2) - least(a.y1, b.y1)) AS hull
  FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND a.hit AND NOT b.hit AND a.class = b.class) SELECT image_id, a_part, b_part, i / u AS iou, i / u - (hull - u) / hull AS giou FROM gi""")
def generalised_iou(spark, d):
    b = boxes(spark, d)
    side = lambda p, c: b.where(c).select("image_id", "class", F.col("part").alias(f"{p}part"), *[F.col(x).alias(p + x) for x in ("x1", "y1", "x2", "y2")])
    j = side("a_", F.col("hit")).join(side("b_", ~F.col("hit")), ["image_id", "class"])
    return j.select("image_id", "a_part", "b_part", geometry.iou("a_", "b_").alias("iou"), geometry.giou("a_", "b_").alias("giou"))
