"""Choosing classes and images: statistics over splits, filters with reasons, samples, splits, joins and unions of datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import geometry
from marlstone.operators.running import ratio
from marlstone.plans.catalog import SPLITS, T, _labelled, _query
from marlstone.sources.tables import boxes, images, read

#: Fine classes: brand and the last two digits of the image, so that rare and absent ones occur.
_FINE = T + """, fb AS (SELECT b.*, split, class || '/' || (image_id % 97) AS fine FROM boxes b JOIN images USING (image_id)),
cs AS (SELECT fine, count(DISTINCT image_id) FILTER (split = 'train') AS train_images, count(*) FILTER (split = 'train') AS train_boxes, count(*) AS all_boxes FROM fb GROUP BY fine),
dc AS (SELECT fine, train_images, train_boxes, all_boxes, concat_ws(',', CASE WHEN train_images < 4 THEN 'too_few_train_images' END, CASE WHEN train_boxes < 5 THEN 'too_few_train_boxes' END, CASE WHEN all_boxes <= 0 THEN 'no_boxes' END) AS drop_reasons,
  concat_ws(',', CASE WHEN train_images >= 4 AND train_images < 6 THEN 'low_image_volume_reference' END, CASE WHEN train_boxes >= 5 AND train_boxes < 8 THEN 'low_box_volume_reference' END) AS notes FROM cs)
"""


def _fine(spark, d) -> DataFrame:
    return _labelled(spark, d).withColumn("fine", F.concat("class", F.lit("/"), (F.col("image_id") % 97).cast("string")))


def soft_minimum(least: int, share: float, step: int) -> int:
    """The softer bound below which a class goes; between it and the stated one it is only noted."""
    import math

    return max(1, least - max(step, math.ceil(least * share))) if least > 0 else 0


def class_decisions_of(b: DataFrame, cls: str, min_images: int = 6, min_boxes: int = 8, reference: str = "train") -> DataFrame:
    """Per class counts on the reference split, reasons to drop it and notes; no reason means it is kept."""
    per = b.groupBy(cls, "image_id").agg(F.count_if(F.col("split") == reference).alias("r"), F.count(F.lit(1)).alias("c"))
    s = per.groupBy(cls).agg(F.count_if(F.col("r") > 0).alias(f"{reference}_images"), F.sum("r").alias(f"{reference}_boxes"), F.sum("c").alias("all_boxes"))
    soft_i, soft_b = soft_minimum(min_images, 0.15, 2), soft_minimum(min_boxes, 0.1, 3)
    i, n = F.col(f"{reference}_images"), F.col(f"{reference}_boxes")
    reasons = F.concat_ws(",", F.when(i < soft_i, F.lit(f"too_few_{reference}_images")), F.when(n < soft_b, F.lit(f"too_few_{reference}_boxes")), F.when(F.col("all_boxes") <= 0, F.lit("no_boxes")))
    notes = F.concat_ws(",", F.when((i >= soft_i) & (i < min_images), F.lit("low_image_volume_reference")), F.when((n >= soft_b) & (n < min_boxes), F.lit("low_box_volume_reference")))
    return s.withColumns({"drop_reasons": reasons, "notes": notes})


@_query(_FINE + "SELECT *, drop_reasons = '' AS kept FROM dc")
def class_decisions(spark, d):
    return class_decisions_of(_fine(spark, d), "fine").withColumn("kept", F.col("drop_reasons") == "")


@_query(_FINE + """SELECT fine, CASE WHEN contains(drop_reasons, 'no_boxes') THEN 'no_boxes' WHEN contains(drop_reasons, 'images') THEN 'too_few_train_images' ELSE 'too_few_train_boxes' END AS reason FROM dc WHERE drop_reasons <> ''""")
def dropped_classes(spark, d):
    """Classes that go, each with the weightiest of its reasons."""
    r = F.split("drop_reasons", ",")
    order = ("no_boxes", "low_ap", "too_few_train_images", "too_few_train_boxes")
    first = F.coalesce(*[F.when(F.array_contains(r, x), F.lit(x)) for x in order])
    return class_decisions_of(_fine(spark, d), "fine").where("drop_reasons <> ''").select("fine", first.alias("reason"))


_CANDIDATES = _FINE + """, k2 AS (SELECT image_id, split, sum(c)::BIGINT AS n, max(c) AS most FROM (SELECT image_id, split, fb.fine, count(*) AS c FROM fb JOIN dc ON dc.fine = fb.fine AND drop_reasons = '' GROUP BY ALL) GROUP BY ALL),
ca AS (SELECT i.image_id, i.split, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'no_kept_labels' WHEN n > 6 THEN 'too_many_boxes_in_image' WHEN most > 1 THEN 'too_many_boxes_for_single_class' END AS reason FROM images i LEFT JOIN k2 USING (image_id, split))
"""


def _candidates(spark, d, most: int = 6, most_of_class: int = 1) -> DataFrame:
    b = _fine(spark, d)
    kept = class_decisions_of(b, "fine").where("drop_reasons = ''").select("fine")
    c = b.join(kept, "fine", "left_semi").groupBy("image_id", "fine").agg(F.count(F.lit(1)).alias("c")).groupBy("image_id").agg(F.sum("c").alias("n"), F.max("c").alias("most"))
    i = images(spark, d).join(c, "image_id", "left")
    reason = F.when(F.col("n").isNull(), "no_kept_labels").when(F.col("n") > most, "too_many_boxes_in_image").when(F.col("most") > most_of_class, "too_many_boxes_for_single_class")
    return i.select("image_id", "split", F.coalesce("n", F.lit(0)).alias("n"), reason.alias("reason"))


@_query(_CANDIDATES + "SELECT image_id, split, n FROM ca WHERE reason IS NULL")
def export_candidates(spark, d):
    """Images whose kept labels fit the limits per image and per class."""
    return _candidates(spark, d).where("reason is null").drop("reason")


@_query(_CANDIDATES + "SELECT split, reason, count(*) AS n FROM ca WHERE reason IS NOT NULL GROUP BY ALL")
def skip_reasons(spark, d):
    return _candidates(spark, d).where("reason is not null").groupBy("split", "reason").agg(F.count(F.lit(1)).alias("n"))


@_query(T + """, w AS (SELECT DISTINCT class FROM boxes UNION ALL VALUES ('Brand#99')), c AS (SELECT class, split, count(DISTINCT image_id) AS n_images, count(*) AS n_boxes FROM boxes JOIN images USING (image_id) GROUP BY ALL)
SELECT w.class, s AS split, coalesce(n_images, 0) AS n_images, coalesce(n_boxes, 0) AS n_boxes FROM w CROSS JOIN (VALUES ('train'), ('val'), ('test')) v(s) LEFT JOIN c ON c.class = w.class AND c.split = s""")
def class_counts_filled(spark, d):
    """Counts of all wanted classes and splits, zero where there are none; Brand#99 is wanted and absent."""
    b = _labelled(spark, d)
    per = b.groupBy("class", "split", "image_id").agg(F.count(F.lit(1)).alias("c")).groupBy("class", "split").agg(F.count(F.lit(1)).alias("n_images"), F.sum("c").alias("n_boxes"))
    absent = spark.range(1).select(F.lit("Brand#99").alias("class"))
    wanted = per.select("class").unionByName(absent).distinct().withColumn("split", F.explode(F.array(*[F.lit(s) for s in SPLITS])))
    return wanted.join(per, ["class", "split"], "left").fillna(0, ["n_images", "n_boxes"])


@_query(T + """, m AS (SELECT image_id, line_no, part, supp, 'family ' || substr(class, 7, 1) AS target FROM boxes WHERE substr(class, 7, 1) <> '2'), k AS (SELECT image_id, target, count(*) AS n FROM m GROUP BY ALL) SELECT * FROM k""")
def class_mapping_filter(spark, d):
    """Labels through a class map; lines of unmapped classes go, and images with them if none is left."""
    b = boxes(spark, d)
    m = b.select("class").distinct().where(F.substring("class", 7, 1) != "2").withColumn("target", F.concat(F.lit("family "), F.substring("class", 7, 1)))  # a row per class
    return b.groupBy("image_id", "class").agg(F.count(F.lit(1)).alias("c")).join(m, "class").groupBy("image_id", "target").agg(F.sum("c").alias("n"))


@_query(T + """, m AS (SELECT image_id, count(*) AS all_lines, count(*) FILTER (substr(class, 7, 1) <> '2') AS mapped FROM boxes GROUP BY image_id) SELECT count(*) FILTER (mapped = 0) AS images_dropped, sum(all_lines - mapped)::BIGINT AS lines_dropped FROM m""")
def class_mapping_dropped(spark, d):
    m = boxes(spark, d).groupBy("image_id").agg(F.count(F.lit(1)).alias("a"), F.count_if(F.substring("class", 7, 1) != "2").alias("m"))
    return m.agg(F.count_if(F.col("m") == 0).alias("images_dropped"), F.sum(F.col("a") - F.col("m")).alias("lines_dropped"))


_TAILED = _FINE + """, n AS (SELECT fine, count(DISTINCT image_id) AS images FROM fb GROUP BY fine), wanted AS (SELECT b || '/' || r AS fine FROM (SELECT DISTINCT class AS b FROM boxes) CROSS JOIN (SELECT unnest(range(97)) AS r)),
f AS (SELECT w.fine, coalesce(images, 0) AS images FROM wanted w LEFT JOIN n USING (fine))
"""


@_query(_TAILED + "SELECT t AS threshold, count(*) FILTER (images < t) AS below, count(*) AS total, count(*) FILTER (images < t) / count(*) AS share FROM f CROSS JOIN (VALUES (1), (10), (20), (50)) v(t) GROUP BY t")
def long_tail_summary(spark, d):
    """Classes with fewer images than each threshold; wanted classes without any count too."""
    b = _fine(spark, d)
    n = b.groupBy("fine", "image_id").count().groupBy("fine").agg(F.count(F.lit(1)).alias("images"))
    wanted = b.select("class").distinct().withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(96)))).select(F.concat("class", F.lit("/"), F.col("r").cast("string")).alias("fine"))
    f = wanted.join(n, "fine", "left").fillna(0, ["images"]).withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in (1, 10, 20, 50)])))
    s = f.groupBy("threshold").agg(F.count_if(F.col("images") < F.col("threshold")).alias("below"), F.count(F.lit(1)).alias("total"))
    return s.withColumn("share", ratio(F.col("below"), F.col("total")))


@_query(_TAILED + """, x AS (SELECT image_id, max((images >= 20)::INT) AS eligible, max((images < 15)::INT) AS rare FROM fb JOIN f USING (fine) GROUP BY image_id)
SELECT image_id, eligible = 1 AS keep_incidental, eligible = 1 AND rare = 0 AS exclude_images FROM x""")
def long_tail_policies(spark, d):
    """Which images stay: one policy asks for an eligible class, the other also for no rare one."""
    b = _fine(spark, d).select("image_id", "fine")
    n = b.groupBy("fine", "image_id").count().groupBy("fine").agg(F.count(F.lit(1)).alias("images"))
    x = b.join(n, "fine").groupBy("image_id").agg(F.max(F.col("images") >= 20).alias("keep_incidental"), F.max(F.col("images") < 15).alias("rare"))
    return x.select("image_id", "keep_incidental", (F.col("keep_incidental") & ~F.col("rare")).alias("exclude_images"))


_TARGET = "WITH t AS (SELECT class, row_number() OVER (ORDER BY class) - 1 AS id FROM (SELECT DISTINCT p_brand AS class FROM part WHERE substr(p_brand, 7, 1) <> '1')), n AS (SELECT class, (SELECT count(*) FROM t) + row_number() OVER (ORDER BY class) - 1 AS id FROM (SELECT DISTINCT p_brand AS class FROM part WHERE p_brand NOT IN (SELECT class FROM t)))"


@_query(_TARGET + " SELECT p_partkey AS id, coalesce(t.id, n.id) AS target, t.id IS NULL AS added FROM part LEFT JOIN t ON t.class = p_brand LEFT JOIN n ON n.class = p_brand")
def remap_by_name(spark, d):
    """Ids of another dataset by class name; names it lacks get ids after its last, in order of name."""
    p = read(spark, d, "part")
    classes = p.select(F.col("p_brand").alias("class")).distinct().withColumn("added", F.substring("class", 7, 1) == "1")
    ids = classes.withColumn("target", F.row_number().over(Window.orderBy("added", "class")).cast("long") - 1)  # a row per class
    return p.join(ids, p["p_brand"] == ids["class"]).select(F.col("p_partkey").alias("id"), "target", "added")


@_query("""WITH o AS (SELECT class, row_number() OVER (ORDER BY class) - 1 AS old_id FROM (SELECT DISTINCT p_brand AS class FROM part)), m AS (SELECT *, CASE WHEN class LIKE '%5' THEN NULL WHEN old_id % 4 = 1 THEN old_id - 1 ELSE old_id END AS root FROM o),
r AS (SELECT m.*, CASE WHEN (SELECT class FROM o WHERE o.old_id = m.root) LIKE '%5' THEN NULL ELSE root END AS keep FROM m) SELECT class, old_id, CASE WHEN keep IS NOT NULL THEN dense_rank() OVER (ORDER BY keep NULLS LAST) - 1 END AS new_id FROM r""")
def optimised_classes(spark, d):
    """Old ids to new ones after merges (every fourth class into the one before) and drops; null where a class goes."""
    c = read(spark, d, "part").select(F.col("p_brand").alias("class")).distinct().withColumn("old_id", F.row_number().over(Window.orderBy("class")).cast("long") - 1)
    merged = F.when(F.col("old_id") % 4 == 1, F.col("old_id") - 1).otherwise(F.col("old_id"))
    m = c.withColumn("root", F.when(~F.col("class").like("%5"), merged))
    gone = c.where(F.col("class").like("%5")).select(F.col("old_id").alias("root"), F.lit(True).alias("gone"))
    m = m.join(gone, "root", "left").withColumn("keep", F.when(F.col("gone").isNull(), F.col("root")))
    return m.select("class", "old_id", F.when(F.col("keep").isNotNull(), F.dense_rank().over(Window.orderBy(F.col("keep").asc_nulls_last())).cast("long") - 1).alias("new_id"))


#: The issues of an image in order of their weight.
ISSUES = ("image_open_error", "missing_label_file", "invalid_label_lines", "empty_label_file", "coord_anomaly_lines")
_BAD = T + """, f AS (SELECT image_id, split, image_id % 997 = 0 AS open_error, count(b.image_id) > 0 OR image_id % 2 = 0 AS exists, count(b.image_id) AS lines, count(*) FILTER (score > 0.095) AS invalid, count(*) FILTER (x2 > 640 OR y2 > 640) AS anomaly FROM images LEFT JOIN boxes b USING (image_id) GROUP BY image_id, split),
s AS (SELECT *, lines - invalid AS valid, list_filter([CASE WHEN open_error THEN 'image_open_error' END, CASE WHEN NOT exists THEN 'missing_label_file' END, CASE WHEN invalid > 0 THEN 'invalid_label_lines' END, CASE WHEN exists AND lines = 0 THEN 'empty_label_file' END, CASE WHEN anomaly > 0 THEN 'coord_anomaly_lines' END], lambda x: x IS NOT NULL) AS tags,
  CASE WHEN open_error THEN 1000 ELSE 0 END + CASE WHEN NOT exists THEN 800 ELSE 0 END + CASE WHEN invalid > 0 THEN 200 + 100 * invalid ELSE 0 END + CASE WHEN exists AND lines = 0 THEN 180 ELSE 0 END + CASE WHEN anomaly > 0 THEN 80 + 20 * anomaly ELSE 0 END AS bad_score FROM f)
"""


def _bad(spark, d) -> DataFrame:
    b = boxes(spark, d).groupBy("image_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("score") > 0.095).alias("invalid"), F.count_if((F.col("x2") > 640) | (F.col("y2") > 640)).alias("anomaly"))
    f = images(spark, d).join(b, "image_id", "left").fillna(0, ["lines", "invalid", "anomaly"])
    exists = (F.col("lines") > 0) | (F.col("image_id") % 2 == 0)
    tests = (F.col("image_id") % 997 == 0, ~exists, F.col("invalid") > 0, exists & (F.col("lines") == 0), F.col("anomaly") > 0)
    points = (F.lit(1000), F.lit(800), 200 + 100 * F.col("invalid"), F.lit(180), 80 + 20 * F.col("anomaly"))
    tags = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in zip(ISSUES, tests)]))
    score = sum(F.when(c, p).otherwise(F.lit(0)) for c, p in zip(tests, points)).cast("long")
    return f.withColumns({"valid": F.col("lines") - F.col("invalid"), "tags": tags, "bad_score": score})


@_query(_BAD + "SELECT image_id, split, array_to_string(tags, ',') AS issues, tags[1] AS primary_issue, len(tags) AS issue_count, bad_score::BIGINT AS bad_score FROM s WHERE len(tags) > 0")
def eda_bad_images(spark, d):
    """Issues of an image, the first of which is its primary one, and an additive score."""
    return _bad(spark, d).where("size(tags) > 0").select("image_id", "split", F.array_join("tags", ",").alias("issues"), F.get("tags", F.lit(0)).alias("primary_issue"), F.size("tags").cast("long").alias("issue_count"), "bad_score")


_ORDER = "bad_score DESC, invalid DESC, anomaly DESC, valid DESC, image_id"


@_query(_BAD + f""", g AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {_ORDER}) AS place FROM s WHERE len(tags) > 0),
e AS (SELECT image_id, tag, list_position(['image_open_error', 'missing_label_file', 'invalid_label_lines', 'empty_label_file', 'coord_anomaly_lines'], tag) AS t, row_number() OVER (PARTITION BY split, tag ORDER BY place) AS r FROM (SELECT image_id, split, place, unnest(tags) AS tag FROM g)),
q AS (SELECT image_id, min((t, r)) AS turn FROM e WHERE r <= 8 GROUP BY image_id)
SELECT split, image_id, bad_score::BIGINT AS bad_score FROM g LEFT JOIN q USING (image_id) QUALIFY row_number() OVER (PARTITION BY split ORDER BY q.turn IS NULL, q.turn, place) <= 24""")
def eda_bad_sample(spark, d):
    """Per split the worst eight of each issue, an image for the first issue that takes it, filled up to 24 by score.

    Ranks are cut at 8 per issue and 24 per split before anything else is sorted.
    """
    order = [F.desc("bad_score"), F.desc("invalid"), F.desc("anomaly"), F.desc("valid"), "image_id"]
    b = _bad(spark, d).where("size(tags) > 0").select("split", "image_id", "bad_score", "invalid", "anomaly", "valid", "tags")
    tag = b.withColumn("tag", F.explode("tags")).withColumn("r", F.row_number().over(Window.partitionBy("split", "tag").orderBy(*order))).where("r <= 8")
    turn = F.struct(F.array_position(F.array(*[F.lit(i) for i in ISSUES]), F.col("tag")).alias("t"), "r")
    quota = tag.groupBy("split", "image_id", "bad_score", "invalid", "anomaly", "valid").agg(F.min(turn).alias("turn"))
    fill = b.drop("tags").withColumn("r", F.row_number().over(Window.partitionBy("split").orderBy(*order))).where("r <= 64").drop("r")  # 40 quota rows at most stand before the last one taken
    every = quota.unionByName(fill.join(quota.select("split", "image_id"), ["split", "image_id"], "left_anti"), allowMissingColumns=True)
    w = Window.partitionBy("split").orderBy(F.col("turn").isNull(), "turn", *order)
    return every.withColumn("r", F.row_number().over(w)).where("r <= 24").select("split", "image_id", "bad_score")


@_query(T + """, c AS (SELECT split, class, count(DISTINCT image_id) AS n_images, count(*) AS n_boxes FROM boxes JOIN images USING (image_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY n_boxes DESC, n_images DESC, class) AS by_boxes, row_number() OVER (PARTITION BY split ORDER BY n_images DESC, n_boxes DESC, class) AS by_images, row_number() OVER (PARTITION BY split ORDER BY n_boxes, n_images, class) AS tail FROM c)
SELECT split, class, n_images, n_boxes, by_boxes <= 10 AS top_boxes, by_images <= 10 AS top_images, tail <= 10 AS tail FROM r""")
def top_tail_classes(spark, d):
    """The ten largest classes by boxes and by images, and the ten smallest; windows are over one row per class."""
    per = _labelled(spark, d).groupBy("split", "class", "image_id").agg(F.count(F.lit(1)).alias("c")).groupBy("split", "class").agg(F.count(F.lit(1)).alias("n_images"), F.sum("c").alias("n_boxes"))
    top = lambda *o: F.row_number().over(Window.partitionBy("split").orderBy(*o)) <= 10
    return per.select("*", top(F.desc("n_boxes"), F.desc("n_images"), "class").alias("top_boxes"), top(F.desc("n_images"), F.desc("n_boxes"), "class").alias("top_images"), top("n_boxes", "n_images", "class").alias("tail"))


@_query(T + """, s AS (SELECT split, count(DISTINCT i.image_id) AS images, count(DISTINCT b.image_id) AS labeled, count(b.image_id) AS labels FROM images i LEFT JOIN boxes b USING (image_id) GROUP BY split)
SELECT split, images, labeled, labels, round_even(labels / images, 4) AS per_image, CASE WHEN labeled > 0 THEN round_even(labels / labeled, 4) ELSE 0 END AS per_labeled, round_even(labeled / images, 6) AS labeled_ratio FROM s""")
def export_summary(spark, d):
    """Averages and ratios of an exported split."""
    n = boxes(spark, d).groupBy("image_id").agg(F.count(F.lit(1)).alias("c"))
    s = images(spark, d).join(n, "image_id", "left").groupBy("split").agg(F.count(F.lit(1)).alias("images"), F.count("c").alias("labeled"), F.coalesce(F.sum("c"), F.lit(0)).alias("labels"))
    i, lab, n = (F.col(c) for c in ("images", "labeled", "labels"))
    return s.select("*", F.bround(ratio(n, i), 4).alias("per_image"), F.bround(ratio(n, lab), 4).alias("per_labeled"), F.bround(ratio(lab, i), 6).alias("labeled_ratio"))


@_query(T + ", s AS (SELECT class, count(*) FILTER (a < 1024) AS small, count(*) FILTER (a >= 1024 AND a < 9216) AS medium, count(*) FILTER (a >= 9216) AS large, sum(a) AS area FROM (SELECT class, (x2 - x1) * (y2 - y1) AS a FROM boxes) GROUP BY class) SELECT class, small, medium, large, round(area, 2) AS area FROM s")
def class_size_buckets(spark, d):
    b = boxes(spark, d).select("class", geometry.area().alias("a"), geometry.bucket(geometry.area()).alias("k"))
    return b.groupBy("class").agg(*[F.count_if(F.col("k") == k).alias(k) for k in ("small", "medium", "large")], F.round(F.sum("a"), 2).alias("area"))


@_query(T + """, r AS (SELECT image_id, class, part, supp, line_no, row_number() OVER (PARTITION BY class ORDER BY score DESC, image_id, line_no, part, supp) AS r FROM boxes)
SELECT image_id, class, part, line_no, row_number() OVER (ORDER BY r, class) AS place FROM r QUALIFY place <= 40""")
def diverse_pick(spark, d):
    """Best of each class in turn: ranks within a class, then class by class at each rank, 40 in all."""
    w = Window.partitionBy("class").orderBy(F.desc("score"), "image_id", "line_no", "part", "supp")
    top = boxes(spark, d).withColumn("r", F.row_number().over(w)).where("r <= 40")
    return top.orderBy("r", "class").limit(40).withColumn("place", F.row_number().over(Window.orderBy("r", "class")).cast("long")).select("image_id", "class", "part", "line_no", "place")


@_query("""WITH r AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS k FROM events)
SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END, event_id) AS place FROM r WHERE k = 1""")
def latest_runs(spark, d):
    """The latest run of each kind, preferred kinds first."""
    e = read(spark, d, "events").groupBy("user_id", "event_type").agg(F.min(F.struct((-F.unix_micros(F.col("ts").cast("timestamp"))).alias("t"), "event_id")).alias("m"))
    first = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "view", 1).otherwise(2)
    return e.select("user_id", "event_type", "m.event_id").withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy(first, "event_id")).cast("long"))


@_query(T + ", s AS (SELECT image_id, count(*) AS n, string_agg(class, ',' ORDER BY line_no, part, supp) AS classes FROM boxes GROUP BY image_id) SELECT image_id, split, coalesce(n, 0) AS n, coalesce(classes, '') AS classes FROM images LEFT JOIN s USING (image_id)")
def image_labels(spark, d):
    """Every image with its labels, none where there is no file."""
    b = boxes(spark, d).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "part", "supp", "class"))).alias("r"))
    return images(spark, d).join(b, "image_id", "left").select("image_id", "split", F.coalesce(F.size("r"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.array_join(F.transform("r", lambda x: x["class"]), ","), F.lit("")).alias("classes"))


@_query(T + """, p AS (SELECT image_id % 5000 AS stem, max(image_id) AS image_id FROM boxes WHERE NOT hit GROUP BY 1), g AS (SELECT image_id % 5000 AS stem, count(*) AS truth FROM boxes WHERE hit GROUP BY 1) SELECT stem, p.image_id, truth FROM p JOIN g USING (stem)""")
def predictions_by_stem(spark, d):
    """Predictions meet truth by stem: stems that clash keep the last prediction file, images without one go."""
    b = boxes(spark, d).withColumn("stem", F.col("image_id") % 5000)
    return b.where(~F.col("hit")).groupBy("stem").agg(F.max("image_id").alias("image_id")).join(b.where("hit").groupBy("stem").agg(F.count(F.lit(1)).alias("truth")), "stem")


@_query(T + ", k AS (SELECT DISTINCT class FROM boxes WHERE substr(class, 7, 1) <> '2') SELECT b.class, k.class IS NULL AS unknown, count(*) AS n FROM boxes b LEFT JOIN k ON k.class = b.class GROUP BY ALL")
def unknown_categories(spark, d):
    """Annotations by category, those whose category is not declared marked."""
    n = boxes(spark, d).groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    known = n.select("class").where(F.substring("class", 7, 1) != "2").withColumn("known", F.lit(True))
    return n.join(known, "class", "left").select("class", F.col("known").isNull().alias("unknown"), "n")


@_query(T + """, det AS (SELECT image_id FROM images WHERE image_id % 3 = 0), seg AS (SELECT DISTINCT image_id FROM boxes WHERE hit)
SELECT det.image_id, seg.image_id IS NOT NULL AS mirrored FROM det LEFT JOIN seg USING (image_id)""")
def mirrored_subset(spark, d):
    """Images of a detection subset that a segmentation dataset has too; the others are reported."""
    seg = boxes(spark, d).where("hit").select("image_id").distinct().withColumn("mirrored", F.lit(True))
    return images(spark, d).where("image_id % 3 = 0").select("image_id").join(seg, "image_id", "left").withColumn("mirrored", F.coalesce("mirrored", F.lit(False)))


@_query("""WITH s AS (SELECT DISTINCT p_brand AS name, lower(replace(p_brand, '#', '')) AS key FROM part), r AS (SELECT DISTINCT 'brand ' || substr(p_brand, 7) AS name FROM part WHERE substr(p_brand, 7, 1) = '1')
SELECT s.name AS source_name, r.name AS reference_name FROM s LEFT JOIN r ON regexp_replace(lower(r.name), '[\\W_]+', '', 'g') = s.key""")
def taxonomy_match(spark, d):
    """Classes of two datasets by normalised name; null where the reference has none."""
    from marlstone.functions import names

    key = lambda c: names.compact(names.fold(F.col(c)))
    s = read(spark, d, "part").select(F.col("p_brand").alias("source_name")).distinct()
    r = s.where(F.substring("source_name", 7, 1) == "1").select(F.concat(F.lit("brand "), F.expr("substr(source_name, 7)")).alias("reference_name"))
    return s.withColumn("k", key("source_name")).join(r.withColumn("k", key("reference_name")), "k", "left").drop("k")


_PR = "WITH p AS (SELECT lang AS truth, CASE WHEN n_chars % 7 = 0 THEN 'xx' WHEN n_chars % 5 = 0 THEN 'en' ELSE lang END AS pred FROM documents WHERE lang IS NOT NULL), k AS (SELECT DISTINCT truth AS class FROM p), c AS (SELECT class, count(*) FILTER (truth = class AND pred = class) AS tp, count(*) FILTER (truth <> class AND pred = class) AS fp, count(*) FILTER (truth = class AND pred <> class) AS fn FROM p CROSS JOIN k GROUP BY class), s AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1, CASE WHEN tp + fp + fn > 0 THEN tp / (tp + fp + fn) ELSE 0 END AS jaccard, tp + fn AS support FROM c)"


def _scores(spark, d) -> DataFrame:
    """Per class tp, fp, fn and what follows; each count of the confusion matrix is dealt to its row and column."""
    pred = F.when(F.col("n_chars") % 7 == 0, "xx").when(F.col("n_chars") % 5 == 0, "en").otherwise(F.col("lang"))
    n = read(spark, d, "documents").where("lang is not null").groupBy(F.col("lang").alias("truth"), pred.alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    same = F.col("truth") == F.col("pred")
    row = lambda c, t, p: F.struct(F.col(c).alias("class"), F.lit(t).alias("t"), F.lit(p).alias("p"))
    e = n.withColumn("same", same).select("n", "same", F.explode(F.array(row("truth", 1, 0), row("pred", 0, 1))).alias("e")).select("n", "same", "e.*")
    s = e.groupBy("class").agg(F.sum(F.when(F.col("same") & (F.col("t") == 1), F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(~F.col("same") & (F.col("p") == 1), F.col("n")).otherwise(0)).alias("fp"), F.sum(F.when(~F.col("same") & (F.col("t") == 1), F.col("n")).otherwise(0)).alias("fn"))
    s = s.join(n.select(F.col("truth").alias("class")).distinct(), "class", "left_semi")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return s.select("*", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(tp, tp + fp + fn).alias("jaccard"), (tp + fn).alias("support"))


@_query(_PR + " SELECT * FROM s")
def multiclass_scores(spark, d):
    return _scores(spark, d)


@_query(_PR + " SELECT sum(tp) / sum(support) AS accuracy, avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1, avg(jaccard) AS mean_iou, sum(f1 * support) / sum(support) AS weighted_f1, sum(precision * support) / sum(support) AS weighted_precision, 2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) AS micro_f1 FROM s")
def multiclass_averages(spark, d):
    """Accuracy, micro, macro and weighted means; predictions outside the known classes only cost recall."""
    s = _scores(spark, d)
    w = lambda c: ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    return s.agg(ratio(F.sum("tp"), F.sum("support")).alias("accuracy"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"), F.avg("jaccard").alias("mean_iou"), w("f1").alias("weighted_f1"), w("precision").alias("weighted_precision"), ratio(2 * F.sum("tp"), 2 * F.sum("tp") + F.sum("fp") + F.sum("fn")).alias("micro_f1"))


_ML = "WITH s AS (SELECT doc_id, quality, toxic, length(coalesce(text, '')) / 4000 AS sq, (length(coalesce(text, '')) % 100) / 100 AS st FROM labels JOIN documents USING (doc_id)), l AS (SELECT doc_id, 'quality' AS label, quality AS y, sq AS score FROM s UNION ALL SELECT doc_id, 'toxic', toxic, st FROM s)"


@_query(_ML + " SELECT label, count(*) FILTER (y = 1 AND score > 0.5) AS tp, count(*) FILTER (y = 0 AND score > 0.5) AS fp, count(*) FILTER (y = 1 AND score <= 0.5) AS fn, count(*) FILTER ((y = 1) = (score > 0.5)) / count(*) AS accuracy, count(*) FILTER ((y = 1) <> (score > 0.5)) / count(*) AS hamming FROM l GROUP BY label")
def multilabel_scores(spark, d):
    """Each label thresholded for itself; Hamming distance is the share of wrong decisions."""
    s = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n")), "doc_id")
    one = lambda name, score: F.struct(F.lit(name).alias("label"), F.col(name).alias("y"), score.alias("score"))
    x = s.select(F.explode(F.array(one("quality", F.col("n") / 4000), one("toxic", (F.col("n") % 100) / 100))).alias("l")).select("l.*")
    y, p = F.col("y") == 1, F.col("score") > 0.5
    return x.groupBy("label").agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), ratio(F.count_if(y == p), F.count(F.lit(1))).alias("accuracy"), ratio(F.count_if(y != p), F.count(F.lit(1))).alias("hamming"))


@_query("""WITH g AS (SELECT sha256(coalesce(text, '')) AS h, min(doc_id) AS keep_doc, count(*) AS copies, count(DISTINCT coalesce(lang, '')) AS labels, string_agg(DISTINCT coalesce(lang, ''), '|' ORDER BY coalesce(lang, '')) AS merged FROM documents GROUP BY 1)
SELECT keep_doc, copies, labels > 1 AS conflict, merged FROM g WHERE copies > 1""")
def duplicate_labels(spark, d):
    """Copies by content: those with one label collapse, others are a conflict or get the union of their labels."""
    lab = F.coalesce("lang", F.lit(""))
    g = read(spark, d, "documents").groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")).agg(F.min("doc_id").alias("keep_doc"), F.count(F.lit(1)).alias("copies"), F.collect_set(lab).alias("l"))
    return g.where("copies > 1").select("keep_doc", "copies", (F.size("l") > 1).alias("conflict"), F.array_join(F.array_sort("l"), "|").alias("merged"))


@_query("""WITH a AS (SELECT 'docs' AS source, doc_id AS id, sha256(coalesce(text, '')) AS h, CASE WHEN doc_id % 10 < 8 THEN 'train' ELSE 'val' END AS split FROM documents UNION ALL SELECT 'bench', item_id, sha256(coalesce(text, '')), 'test' FROM benchmark),
l AS (SELECT h FROM a GROUP BY h HAVING count(DISTINCT split) > 1) SELECT source, split, count(*) AS n, count(*) FILTER (h IN (SELECT h FROM l)) AS leaked FROM a GROUP BY ALL""")
def union_leakage(spark, d):
    """A union of sources with provenance, and the samples whose content stands in more than one split."""
    split = F.when(F.col("doc_id") % 10 < 8, "train").otherwise("val")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")
    a = read(spark, d, "documents").select(F.lit("docs").alias("source"), split.alias("split"), digest).unionByName(read(spark, d, "benchmark").select(F.lit("bench").alias("source"), F.lit("test").alias("split"), digest))
    c = a.groupBy("source", "split", "h").agg(F.count(F.lit(1)).alias("c"))  # contents once per source and split
    leak = c.groupBy("h").agg((F.min("split") != F.max("split")).alias("leak"))
    return c.join(leak, "h").groupBy("source", "split").agg(F.sum("c").alias("n"), F.sum(F.when(F.col("leak"), F.col("c")).otherwise(0)).alias("leaked"))


@_query(T + f", w AS (SELECT *, least((x2 - x1) * 320 / 640, (y2 - y1) * 320 / 640) AS side, (x2 - x1) / (y2 - y1) AS aspect FROM boxes) SELECT image_id, line_no, part, supp FROM w WHERE side BETWEEN 20 AND 60 AND aspect BETWEEN 0.65 AND 1.55 AND x1 >= 2 AND y1 >= 2 AND x2 <= 638 AND y2 <= 638")
def donors(spark, d):
    """Boxes fit to be copied elsewhere: size, shape and distance from the edge."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    side = geometry.short_side(w, h, 640, 640, 320)
    return boxes(spark, d).where(side.between(20, 60) & (w / h).between(0.65, 1.55) & F.expr("x1 >= 2 and y1 >= 2 and x2 <= 638 and y2 <= 638")).select("image_id", "line_no", "part", "supp")


@_query(T + """, h AS (SELECT image_id, md5('cut:' || image_id) AS h FROM images), r AS (SELECT image_id, row_number() OVER (ORDER BY h, image_id) - 1 AS r, count(*) OVER () AS n FROM h)
SELECT image_id, CASE WHEN r < round_even(n * 0.8, 0) THEN 'train' WHEN r < round_even(n * 0.8, 0) + round_even(n * 0.1, 0) THEN 'val' ELSE 'test' END AS split FROM r""")
def shuffled_split(spark, d):
    """Exact 80/10/10 of a shuffle: ranks come from counts per key range, so no task sorts all images."""
    h = images(spark, d).select("image_id", F.md5(F.concat(F.lit("cut:"), F.col("image_id").cast("string"))).alias("h")).withColumn("part", F.substring("h", 1, 3))
    n = h.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    offs = n.select("part", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"), F.sum("c").over(Window.partitionBy()).alias("n"))  # 4096 rows
    r = F.col("off") + F.row_number().over(Window.partitionBy("part").orderBy("h", "image_id")) - 1
    train, val = F.bround(F.col("n") * F.lit(0.8)), F.bround(F.col("n") * F.lit(0.1))
    j = h.join(offs, "part").withColumn("r", r)
    return j.select("image_id", F.when(F.col("r") < train, "train").when(F.col("r") < train + val, "val").otherwise("test").alias("split"))
