"""Exports and training reports: trims to quotas, targets per split, evenly spaced samples, top scores, best heads, losses, timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import geometry, names
from marlstone.operators.running import ordered_ranks, ratio
from marlstone.plans.catalog import SPLITS, T, _query
from marlstone.sources.tables import boxes, images, read

_TRIM = T + """, o AS (SELECT *, row_number() OVER (PARTITION BY image_id, class ORDER BY line_no, part, supp) AS i, count(*) OVER (PARTITION BY image_id, class) AS n FROM boxes),
r AS (SELECT class, count(*) AS realized FROM boxes GROUP BY class), q AS (SELECT class, realized, greatest(0, realized - (SELECT floor(min(realized) * 0.9) FROM r))::BIGINT AS need FROM r),
z AS (SELECT o.*, row_number() OVER (PARTITION BY class ORDER BY n - i + 1 DESC, image_id) AS k FROM o)
"""


def trim_to_quota(b: DataFrame, caps: DataFrame, cls: str = "class", image: str = "image_id", order: tuple = ("line_no", "part", "supp")) -> DataFrame:
    """The boxes that go so that each class has at most its cap (class, cap): always the first line of the image that has most of the class left
    (ties: the smaller image).

    A line's level is what its image has left of the class when it goes; classes lose their highest levels whole and, of the level at which
    the quota is met, the first images'. So levels are counted, and only that one level is ranked by image.
    """
    w = Window.partitionBy(image, cls)
    d = b.withColumn("level", F.count(F.lit(1)).over(w) - F.row_number().over(w.orderBy(*order)) + 1)
    levels = d.groupBy(cls, "level").agg(F.count(F.lit(1)).alias("c"))
    by = Window.partitionBy(cls)
    levels = levels.withColumn("above", F.coalesce(F.sum("c").over(by.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("all", F.sum("c").over(by))
    left = levels.join(caps, cls).withColumn("left", F.greatest(F.col("all") - F.col("cap"), F.lit(0)) - F.col("above")).where("left > 0").select(cls, "level", "left", (F.col("left") >= F.col("c")).alias("whole"))
    going = d.join(left, [cls, "level"])
    last = ordered_ranks(going.where("not whole"), [cls], image, list(order), "k").where("k < left").drop("k", "total")
    return going.where("whole").unionByName(last).select(b.columns)


def _caps(b: DataFrame) -> DataFrame:
    """Nine tenths of the rarest class as every class's cap."""
    n = b.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return n.select("class").crossJoin(F.broadcast(n.agg(F.floor(F.min("n") * F.lit(0.9)).alias("cap"))))  # one row


@_query(_TRIM + "SELECT image_id, class, count(*) AS removed FROM z JOIN q USING (class) WHERE k <= need GROUP BY ALL")
def quota_trim(spark, d):
    b = boxes(spark, d)
    return trim_to_quota(b, _caps(b)).groupBy("image_id", "class").agg(F.count(F.lit(1)).alias("removed"))


@_query(_TRIM + "SELECT class, any_value(realized) AS before, count(*) FILTER (k <= need) AS trimmed, count(*) FILTER (k > need) AS after FROM z JOIN q USING (class) GROUP BY class")
def quota_trim_summary(spark, d):
    b = boxes(spark, d)
    gone = trim_to_quota(b, _caps(b)).groupBy("class").agg(F.count(F.lit(1)).alias("trimmed"))
    n = b.groupBy("class").agg(F.count(F.lit(1)).alias("before")).join(gone, "class", "left").fillna(0, ["trimmed"])
    return n.withColumn("after", F.col("before") - F.col("trimmed"))


@_query(T + """, a AS (SELECT class, count(*) AS avail, count(*) FILTER (image_id % 4 = 0) AS sel FROM boxes GROUP BY class), m AS (SELECT max(sel) AS most FROM a),
c AS (SELECT image_id, class, count(*) AS n FROM boxes WHERE image_id % 4 <> 0 GROUP BY ALL)
SELECT image_id, sum(n * (1.0::DOUBLE / avail) * ((most + 1.0::DOUBLE) / (sel + 1.0::DOUBLE))) * (1.0::DOUBLE / (1.0::DOUBLE + greatest(sum(n) - 1, 0) * 0.1::DOUBLE)) AS score FROM c JOIN a USING (class) CROSS JOIN m GROUP BY image_id""")
def fallback_scores(spark, d):
    """What an image that is not selected (here: image not divisible by 4) adds: scarce classes and those with few selected boxes count more, crowds less."""
    c = boxes(spark, d).groupBy("image_id", "class").agg(F.count(F.lit(1)).alias("n"))
    chosen = F.when(F.col("image_id") % 4 == 0, F.col("n")).otherwise(0)
    a = c.groupBy("class").agg(F.sum("n").alias("avail"), F.sum(chosen).alias("sel"))
    a = a.crossJoin(F.broadcast(a.agg(F.max("sel").alias("most"))))  # one row
    one = F.col("n") * (1.0 / F.col("avail")) * ((F.col("most") + 1.0) / (F.col("sel") + 1.0))
    s = c.where("image_id % 4 <> 0").join(a, "class").groupBy("image_id").agg(F.sum(one).alias("s"), F.sum("n").alias("boxes"))
    return s.select("image_id", (F.col("s") * (1.0 / (1.0 + F.greatest(F.col("boxes") - 1, F.lit(0)) * 0.1))).alias("score"))


def spaced(ranked: DataFrame, quota: int) -> DataFrame:
    """Of ranked rows (k from 0, total) at most `quota`, evenly spaced from first to last; the middle one if it is 1."""
    steps = F.least(F.lit(quota).cast("long"), F.col("total"))
    # k is taken if some step i rounds (half to even) to it: only the two steps around k * (q - 1) / (n - 1) can
    near = F.floor(F.col("k") * (steps - 1) / F.greatest(F.col("total") - 1, F.lit(1)))
    at = lambda i: F.bround((i * (F.col("total") - 1)) / F.greatest(steps - 1, F.lit(1)), 0).cast("long") == F.col("k")
    hit = F.when(steps == 1, F.col("k") == F.floor(F.col("total") / 2)).otherwise(at(near) | (at(near + 1) & (near + 1 < steps)))
    return ranked.where(hit if quota > 0 else F.lit(False))


@_query(T + """, r AS (SELECT split, image_id, row_number() OVER (PARTITION BY split ORDER BY image_id) - 1 AS k, count(*) OVER (PARTITION BY split) AS n FROM images), q AS (SELECT split, n, least(50, n) AS q FROM r GROUP BY ALL),
w AS (SELECT DISTINCT split, CASE WHEN q = 1 THEN n // 2 ELSE round_even(i * (n - 1) / greatest(q - 1, 1)::DOUBLE, 0)::BIGINT END AS k FROM q JOIN range(50) t(i) ON i < q) SELECT split, k, image_id FROM r JOIN w USING (split, k)""")
def visualization_sample(spark, d):
    return spaced(ordered_ranks(images(spark, d), ["split"], "image_id", [], "k"), 50).select("split", "k", "image_id")


@_query(T + "SELECT image_id, split, n, row_number() OVER (ORDER BY image_id, split, n) - 1 AS place FROM (SELECT image_id, split, count(*) AS n FROM boxes JOIN images USING (image_id) GROUP BY ALL)")
def candidate_pool(spark, d):
    """Candidates of all splits as one list in order of path, split and boxes; places are ranks within ranges of ids."""
    n = boxes(spark, d).groupBy("image_id").agg(F.count(F.lit(1)).alias("n")).join(images(spark, d), "image_id")
    return ordered_ranks(n.withColumn("pool", F.lit(0)), ["pool"], "image_id", ["split", "n"], "place").select("image_id", "split", "n", "place")


def split_targets(df: DataFrame, amount: Column, shares: dict[str, Column], total: Column, out: str = "target") -> DataFrame:
    """Rows by split: amount * share / total in whole numbers; all that is left goes to the split with the largest remainder (ties: the last name)."""
    raw = {s: (amount * x) / total for s, x in shares.items()}
    d = df.withColumn("raw", F.array(*[F.struct(F.floor(r).alias("f"), (r - F.floor(r)).alias("rest"), F.lit(s).alias("split")) for s, r in raw.items()]))
    most = F.array_max(F.transform("raw", lambda s: F.struct(s["rest"], s["split"])))
    spare = amount - F.aggregate("raw", F.lit(0).cast("long"), lambda a, s: a + s["f"])
    d = d.withColumn("most", most).withColumn("spare", spare).withColumn("e", F.explode("raw"))
    return d.withColumn("split", F.col("e.split")).withColumn(out, F.col("e.f") + F.when(F.col("e.split") == F.col("most.split"), F.col("spare")).otherwise(0)).drop("raw", "most", "spare", "e")


@_query(T + """, n AS (SELECT count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM images),
x AS (SELECT class, split, boxes, boxes * w / total AS raw, floor(boxes * w / total)::BIGINT AS f FROM (SELECT class, count(*) AS boxes FROM boxes GROUP BY class) CROSS JOIN n CROSS JOIN LATERAL (VALUES ('train', train), ('val', val), ('test', test)) v(split, w)),
y AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY raw - f DESC, split DESC) AS o, boxes - sum(f) OVER (PARTITION BY class) AS spare FROM x) SELECT class, split, (f + CASE WHEN o = 1 THEN spare ELSE 0 END)::BIGINT AS target FROM y""")
def box_targets_per_split(spark, d):
    """Each class's boxes over the splits by how many images those take."""
    n = images(spark, d).agg(*[F.count_if(F.col("split") == s).alias(s) for s in SPLITS], F.count(F.lit(1)).alias("total"))
    c = boxes(spark, d).groupBy("class").agg(F.count(F.lit(1)).alias("boxes")).crossJoin(F.broadcast(n))  # one row
    return split_targets(c, F.col("boxes"), {s: F.col(s) for s in SPLITS}, F.col("total")).select("class", "split", "target")


_BUCKETS = ", ".join(f"count(*) FILTER (b = '{n}') AS {n}" for n, _ in geometry.EXPORT_BUCKETS)


@_query(T + f", s AS (SELECT image_id, class, CASE WHEN (x2 - x1) * (y2 - y1) < 256 THEN 'tiny' WHEN (x2 - x1) * (y2 - y1) < 1024 THEN 'small' WHEN (x2 - x1) * (y2 - y1) < 9216 THEN 'medium' ELSE 'large' END AS b FROM boxes) SELECT image_id, class, count(*) AS labels, {_BUCKETS} FROM s GROUP BY ALL")
def candidate_boxes(spark, d):
    """Labels and size buckets of each class in each candidate."""
    b = geometry.bucket(geometry.area(), geometry.EXPORT_BUCKETS)
    return boxes(spark, d).groupBy("image_id", "class").agg(F.count(F.lit(1)).alias("labels"), *[F.count_if(b == n).alias(n) for n, _ in geometry.EXPORT_BUCKETS])


def softmax(logits: Column) -> Column:
    e = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def _logits(n: int, factor: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda c: (((F.col("image_id") + c) * (factor + c) % 17 - 8) / 2).cast("double"))


_LOGITS = T + ", l AS (SELECT image_id, c, ((image_id + c) * (7 + c) % 17 - 8) / 2 AS x FROM images CROSS JOIN range(5) t(c))"


@_query(_LOGITS + ", s AS (SELECT image_id, c, exp(x) / sum(exp(x)) OVER (PARTITION BY image_id) AS score, row_number() OVER (PARTITION BY image_id ORDER BY x DESC, c) AS k FROM l) SELECT image_id, k, c AS label, score FROM s WHERE k <= 2 AND (k > 1 OR score > 0.3)")
def classification_topk(spark, d):
    """The two most likely classes (ties: the lower one), the first only above a threshold: one row's array, no shuffle."""
    scored = F.transform(softmax(_logits(5, 7)), lambda p, c: F.struct((-p).alias("p"), c.alias("c")))
    top = images(spark, d).select("image_id", F.posexplode(F.slice(F.sort_array(scored), 1, 2)).alias("k", "s"))
    return top.select("image_id", (F.col("k") + 1).alias("k"), F.col("s.c").alias("label"), (-F.col("s.p")).alias("score")).where("k > 1 or score > 0.3")


@_query(_LOGITS + " SELECT image_id, c AS label, 1 / (1 + exp(-x)) AS score FROM l WHERE 1 / (1 + exp(-x)) > 0.6")
def multilabel_labels(spark, d):
    s = images(spark, d).select("image_id", F.posexplode(_logits(5, 7)).alias("label", "x")).withColumn("score", 1 / (1 + F.exp(-F.col("x"))))
    return s.where("score > 0.6").select("image_id", "label", "score")


@_query(T + """, q AS (SELECT image_id, part, supp, row_number() OVER (PARTITION BY image_id ORDER BY line_no, part, supp) - 1 AS query FROM boxes), l AS (SELECT image_id, query * 3 + c AS idx, ((part * 7 + supp * 3 + c * 5) % 13 - 6) / 3 AS x FROM q CROSS JOIN range(3) t(c)),
s AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY x DESC, idx) AS k FROM l) SELECT image_id, k, idx // 3 AS query, idx % 3 AS label, 1 / (1 + exp(-x)) AS score FROM s WHERE k <= 4""")
def detr_topk(spark, d):
    """Scores of all queries and classes of an image as one list, its four best (ties: the earlier); class and query follow from the place."""
    b = boxes(spark, d)
    q = F.row_number().over(Window.partitionBy("image_id").orderBy("line_no", "part", "supp")) - 1
    logits = F.array(*[((F.col("part") * 7 + F.col("supp") * 3 + c * 5) % 13 - 6) / 3 for c in range(3)])
    s = b.withColumn("query", q).select("image_id", "query", F.posexplode(logits).alias("c", "x")).withColumn("idx", F.col("query") * 3 + F.col("c"))
    s = s.withColumn("k", F.row_number().over(Window.partitionBy("image_id").orderBy(F.desc("x"), "idx"))).where("k <= 4")
    return s.select("image_id", "k", F.floor(F.col("idx") / 3).alias("query"), (F.col("idx") % 3).alias("label"), (1 / (1 + F.exp(-F.col("x")))).alias("score"))


_HEADS = "WITH h AS (SELECT user_id AS run, event_type AS head, max(value) AS hi, min(value) AS lo FROM events GROUP BY ALL)"


@_query(_HEADS + " SELECT run, count(*) AS heads, arg_min(head, (-hi, head)) AS best_by_max, max(hi) AS best_max, arg_min(head, (lo, head)) AS best_by_min, min(lo) AS best_min FROM h WHERE hi IS NOT NULL GROUP BY run")
def best_heads(spark, d):
    """The head with the best watched value in a run, whether more or less is better; the first wins ties, heads without a value do not count."""
    h = read(spark, d, "events").groupBy(F.col("user_id").alias("run"), F.col("event_type").alias("head")).agg(F.max("value").alias("hi"), F.min("value").alias("lo")).where("hi is not null")
    return h.groupBy("run").agg(F.count(F.lit(1)).alias("heads"), F.min_by("head", F.struct(-F.col("hi"), "head")).alias("best_by_max"), F.max("hi").alias("best_max"), F.min_by("head", F.struct("lo", "head")).alias("best_by_min"), F.min("lo").alias("best_min"))


@_query("SELECT CASE WHEN event_type = 'view' THEN 'val_loss' ELSE 'val_loss/' || event_type END AS metric, sum(value * (event_id % 5 + 1)) / sum(event_id % 5 + 1) AS loss FROM events WHERE value IS NOT NULL GROUP BY event_type")
def weighted_losses(spark, d):
    """Mean losses by batch size under the names reports use; the loss itself has no name behind the slash."""
    e = read(spark, d, "events").where("value is not null").withColumn("w", F.col("event_id") % 5 + 1)
    s = e.groupBy("event_type").agg(F.sum(F.col("value") * F.col("w")).alias("s"), F.sum("w").alias("w"))
    return s.select(F.when(F.col("event_type") == "view", "val_loss").otherwise(F.concat(F.lit("val_loss/"), F.col("event_type"))).alias("metric"), ratio(F.col("s"), F.col("w")).alias("loss"))


@_query("""WITH r AS (SELECT event_type AS step, user_id % 8 AS rank, sum(value) AS total, count(value) AS n FROM events GROUP BY ALL) SELECT step, max(total) AS slowest, avg(total) AS mean_total, sum(n)::BIGINT AS calls, max(total / n) AS slowest_mean FROM r WHERE n > 0 GROUP BY step""")
def step_timings(spark, d):
    """Time of each step over eight ranks: the slowest and the mean of their totals, and the slowest mean of a call."""
    r = read(spark, d, "events").groupBy(F.col("event_type").alias("step"), (F.col("user_id") % 8).alias("rank")).agg(F.sum("value").alias("total"), F.count("value").alias("n")).where("n > 0")
    return r.groupBy("step").agg(F.max("total").alias("slowest"), F.avg("total").alias("mean_total"), F.sum("n").alias("calls"), F.max(ratio(F.col("total"), F.col("n"))).alias("slowest_mean"))


@_query(T + ", c AS (SELECT class, count(*) AS boxes, count(*) FILTER (hit) AS hits, max(score) AS top_score FROM boxes GROUP BY class) SELECT metric || '/' || class AS metric, value FROM (UNPIVOT (SELECT class, boxes::DOUBLE AS boxes, hits::DOUBLE AS hits, top_score FROM c) ON boxes, hits, top_score INTO NAME metric VALUE value)")
def classwise_metrics(spark, d):
    """Metrics of each class as one flat list."""
    c = boxes(spark, d).groupBy("class").agg(F.count(F.lit(1)).cast("double").alias("boxes"), F.count_if("hit").cast("double").alias("hits"), F.max("score").alias("top_score"))
    return c.unpivot("class", ["boxes", "hits", "top_score"], "m", "value").select(F.concat_ws("/", "m", "class").alias("metric"), "value")


@_query("""SELECT p_partkey AS id, 'm' || p_partkey % 50 AS model, CASE p_partkey % 5 WHEN 0 THEN 'b' || p_partkey WHEN 1 THEN 'c' WHEN 2 THEN 'NEU' WHEN 3 THEN 'dataset' ELSE 'up' END AS dataset, CASE WHEN p_partkey % 3 = 0 THEN 'class_' || p_partkey ELSE p_brand END AS name FROM part""")
def short_names(spark, d):
    """Short names of models and datasets from their paths, class names filled in."""
    p = read(spark, d, "part")
    k = F.col("p_partkey").cast("string")
    model = F.concat(F.lit("zoo/v3/m"), (F.col("p_partkey") % 50).cast("string"), F.lit("-head-x"))
    path = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("/d/datasets/a/b"), k, F.lit("_DET/dataset_det/data.yaml"))).when(F.col("p_partkey") % 5 == 1, F.lit("datasets/c_dataset/data.yaml")).when(F.col("p_partkey") % 5 == 2, F.lit("x/NEU_dataset/dataset_seg/data/data.yaml")).when(F.col("p_partkey") % 5 == 3, F.lit("/d/datasets/data/data.yaml")).otherwise(F.lit("/up/_seg/data.yaml"))
    own = F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand"))
    return p.select(F.col("p_partkey").alias("id"), names.model_short(model).alias("model"), names.dataset_short(path).alias("dataset"), names.filled(own, F.col("p_partkey")).alias("name"))
