"""Names, strings, geometry and lists: expressions over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import geometry, names
from marlstone.plans.catalog import T, _labelled, _query
from marlstone.sources.tables import boxes, images, read

_NAMES = """WITH n AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN ' Dataset' || p_size || '_' || p_type WHEN 1 THEN p_type || ' (' || p_size || ')' WHEN 2 THEN 'class ' || p_partkey WHEN 3 THEN CASE WHEN p_size < 10 THEN ' None ' ELSE 'ds2-Category_' || p_size END ELSE p_brand || '_' || p_type END AS name FROM part),
f AS (SELECT id, name, lower(trim(name)) AS folded FROM n),
t AS (SELECT *, regexp_replace(folded, '[\\W_]+', '', 'g') AS normalised, regexp_replace(regexp_replace(folded, '^(?:dataset|source|data|ds)\\d+[_\\-\\s]+', ''), '[\\W_]+', '', 'g') AS tail FROM f)
"""


def _names(spark, d) -> DataFrame:
    case = "CASE p_partkey % 5 WHEN 0 THEN concat(' Dataset', p_size, '_', p_type) WHEN 1 THEN concat(p_type, ' (', p_size, ')') WHEN 2 THEN concat('class ', p_partkey) WHEN 3 THEN CASE WHEN p_size < 10 THEN ' None ' ELSE concat('ds2-Category_', p_size) END ELSE concat(p_brand, '_', p_type) END"
    return read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.expr(case).alias("name"))


@_query(_NAMES + "SELECT id, normalised, tail, regexp_full_match(tail, '(?:class|category)\\d+') AS placeholder, folded IN ('', 'none', 'null', 'nil', 'nan', 'void', 'ignore', 'ignored') AS null_like FROM t")
def class_names(spark, d):
    n = _names(spark, d).withColumn("f", names.fold(F.col("name")))
    f = F.col("f")
    return n.select("id", names.compact(f).alias("normalised"), names.tail(f).alias("tail"), names.placeholder(f).alias("placeholder"), names.null_like(f).alias("null_like"))


@_query(_NAMES + """, k AS (SELECT id, name, array_to_string(list_transform(regexp_extract_all(lower(name), '\\d+|\\D+'), lambda x: CASE WHEN regexp_matches(x, '^\\d') THEN lpad(ltrim(x, '0'), 20, '0') ELSE x END), '') AS key FROM n)
SELECT id, dense_rank() OVER (ORDER BY encode(key)) AS place FROM k""")
def natural_order(spark, d):
    """Places of names with numbers by value. Distinct keys are ranked: a row per name, and names are few."""
    n = _names(spark, d).withColumn("key", names.natural_key(F.col("name")))
    from pyspark.sql import Window

    place = n.select("key").distinct().withColumn("place", F.row_number().over(Window.orderBy("key")).cast("long"))
    return n.join(place, "key").select("id", "place")


_TAG = "CASE WHEN {0} = '' THEN 'unknown' ELSE {0} END"
_CLEAN = "regexp_replace(regexp_replace(regexp_replace(trim({0}), '[^\\p{{L}}\\p{{N}}_-]', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), '-{{2,}}', '-', 'g')"


@_query(_NAMES + f"SELECT id, {_TAG.format(_CLEAN.format('name'))} AS tag, {_TAG.format(_CLEAN.format('name'))} || '-' || substr(sha256('/data/' || id || '/' || name), 1, 8) AS identity FROM n")
def tags(spark, d):
    n = _names(spark, d)
    return n.select("id", names.tag(F.col("name")).alias("tag"), names.identity_tag(F.col("name"), F.concat(F.lit("/data/"), F.col("id").cast("string"), F.lit("/"), F.col("name"))).alias("identity"))


_STEMS = "WITH s AS (SELECT p_partkey AS id, regexp_replace(p_type, ' .*', '') || '_' || p_size AS stem FROM part)"


@_query(_STEMS + ", k AS (SELECT *, row_number() OVER (PARTITION BY lower(stem) ORDER BY id) AS n FROM s) SELECT id, CASE WHEN n = 1 THEN stem ELSE stem || '__' || n END AS stem FROM k")
def unique_stems(spark, d):
    """Stems that are alike but for case get __2, __3 and so on; the first keeps its own."""
    from pyspark.sql import Window

    s = read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.regexp_replace("p_type", " .*", ""), F.lit("_"), F.col("p_size").cast("string")).alias("stem"))
    n = F.row_number().over(Window.partitionBy(F.lower("stem")).orderBy("id"))
    return s.withColumn("n", n).select("id", F.when(F.col("n") == 1, F.col("stem")).otherwise(F.concat("stem", F.lit("__"), F.col("n").cast("string"))).alias("stem"))


@_query("SELECT doc_id, trim(regexp_extract_all(text, '(\\d+)', 1)[1]) AS first_number, trim(regexp_extract_all(text, '(\\d+)', 1)[-1]) AS last_number FROM documents")
def log_matches(spark, d):
    docs = read(spark, d, "documents")
    return docs.select("doc_id", names.first_match(F.col("text"), r"(\d+)").alias("first_number"), names.last_match(F.col("text"), r"(\d+)").alias("last_number"))


_DUR = "WITH x AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'took ' || (event_id % 90) || ' min' WHEN 1 THEN 'ETA ' || (event_id % 7) || '.5h left' WHEN 2 THEN (event_id % 50) || 's' ELSE 'no time' END AS text FROM events)"


@_query(_DUR + ", p AS (SELECT event_id, regexp_extract(lower(text), '([0-9]+(?:\\.[0-9]+)?)\\s*(h|hr|hrs|hour|hours|min|m|sec|s)\\b', ['n', 'u']) AS m FROM x) SELECT event_id, CASE WHEN m.u[1] = 'h' THEN TRY_CAST(m.n AS DOUBLE) * 60 WHEN m.u[1] = 'm' THEN TRY_CAST(m.n AS DOUBLE) ELSE TRY_CAST(m.n AS DOUBLE) / 60 END AS minutes FROM p")
def durations(spark, d):
    case = "CASE event_id % 4 WHEN 0 THEN concat('took ', event_id % 90, ' min') WHEN 1 THEN concat('ETA ', event_id % 7, '.5h left') WHEN 2 THEN concat(event_id % 50, 's') ELSE 'no time' END"
    return read(spark, d, "events").select("event_id", F.expr(case).alias("t")).select("event_id", names.minutes(F.col("t")).alias("minutes"))


@_query("""WITH l AS (SELECT p_partkey AS id, (p_size % 5) || ', ' || (p_size % 7) || ',,' || (p_size % 3) AS ids FROM part), e AS (SELECT id, unnest(list_filter(list_transform(string_split(ids, ','), lambda x: trim(x)), lambda x: x <> '')) AS x, generate_subscripts(list_filter(list_transform(string_split(ids, ','), lambda x: trim(x)), lambda x: x <> ''), 1) AS k FROM l)
SELECT id, string_agg(CASE WHEN x::INT < 5 THEN (x::INT * 10)::VARCHAR ELSE 'null' END, ',' ORDER BY k) AS mapped FROM e GROUP BY id""")
def label_ids(spark, d):
    """Delimited ids through the class map, blanks skipped; ids the map lacks stay visible."""
    m = F.create_map(*[F.lit(x) for k in range(5) for x in (k, 10 * k)])
    text = F.concat((F.col("p_size") % 5).cast("string"), F.lit(", "), (F.col("p_size") % 7).cast("string"), F.lit(",,"), (F.col("p_size") % 3).cast("string"))
    ids = F.transform(names.id_list(text, m), lambda x: F.coalesce(x.cast("string"), F.lit("null")))
    return read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.array_join(ids, ",").alias("mapped"))


@_query("SELECT p_partkey AS id, (p_size << 16) | ((p_partkey % 256) << 8) | (p_size * 5 % 256) AS packed, p_size::BIGINT AS r, (p_partkey % 256)::BIGINT AS g, (p_size * 5 % 256)::BIGINT AS b FROM part")
def colours(spark, d):
    p = read(spark, d, "part").select(F.col("p_partkey").alias("id"), geometry.pack_colour(F.col("p_size"), F.col("p_partkey") % 256, F.col("p_size") * 5 % 256).alias("packed"))
    r, g, b = geometry.unpack_colour(F.col("packed"))
    return p.select("id", "packed", r.alias("r"), g.alias("g"), b.alias("b"))


@_query("""WITH i AS (SELECT o_orderkey AS image_id, 300 + o_orderkey % 500 AS w, 260 + o_custkey % 300 AS h FROM orders),
x AS (SELECT image_id, w, h, unnest(generate_series(0, w - 1, 192)) AS s FROM i), y AS (SELECT image_id, h AS h2, unnest(generate_series(0, h - 1, 192)) AS s FROM i)
SELECT x.image_id, least(x.s + 256, w) - 256 AS x, least(y.s + 256, h) - 256 AS y FROM x JOIN y USING (image_id)""")
def tiles(spark, d):
    """Corners of overlapping tiles: two explodes, no join."""
    i = read(spark, d, "orders").select(F.col("o_orderkey").alias("image_id"), (300 + F.col("o_orderkey") % 500).alias("w"), (260 + F.col("o_custkey") % 300).alias("h"))
    return i.withColumn("x", F.explode(geometry.tile_starts(F.col("w"), 256, 0.25))).withColumn("y", F.explode(geometry.tile_starts(F.col("h"), 256, 0.25))).select("image_id", "x", "y")


@_query(T + """, c AS (SELECT image_id, line_no, part, supp, greatest(0.0, least(x1, 640)) AS x1, greatest(0.0, least(y1, 640)) AS y1, greatest(0.0, least(x2, 640)) AS x2, greatest(0.0, least(y2, 640)) AS y2 FROM boxes)
SELECT image_id, line_no, part, supp, x1, y1, x2 - x1 AS w, y2 - y1 AS h, (x1 + x2) / 2 / 640 AS cx, (y1 + y2) / 2 / 640 AS cy FROM c""")
def clipped_boxes(spark, d):
    """Boxes clamped to their image, as corner and size and as normalised centre."""
    b = boxes(spark, d).withColumns({c: geometry.clip(F.col(c), 640.0) for c in ("x1", "y1", "x2", "y2")})
    cx, cy, w, h = geometry.centre(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])
    return b.select("image_id", "line_no", "part", "supp", "x1", "y1", w.alias("w"), h.alias("h"), (cx / 640).alias("cx"), (cy / 640).alias("cy"))


@_query(T + """, p AS (SELECT image_id, line_no, part, supp, x1, y1, x2, y2, (x1 + x2) / 2 AS mx, y2 + (x2 - x1) / 4 AS my FROM boxes)
SELECT image_id, line_no, part, supp, (x2 - x1) * (y2 - y1) + (x2 - x1) * (my - y2) / 2 AS area, x1 AS bx1, y1 AS by1, x2 AS bx2, my AS by2 FROM p""")
def polygon_shapes(spark, d):
    """Shoelace area and bounds of five-cornered outlines: a box with a point below."""
    f = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
    coords = F.array(f["x1"], f["y1"], f["x2"], f["y1"], f["x2"], f["y2"], (f["x1"] + f["x2"]) / 2, f["y2"] + (f["x2"] - f["x1"]) / 4, f["x1"], f["y2"])
    b = boxes(spark, d).withColumn("p", coords).withColumn("b", geometry.polygon_box(F.col("p")))
    return b.select("image_id", "line_no", "part", "supp", geometry.polygon_area(F.col("p")).alias("area"), F.col("b.x1").alias("bx1"), F.col("b.y1").alias("by1"), F.col("b.x2").alias("bx2"), F.col("b.y2").alias("by2"))


@_query("""SELECT p_partkey AS id, greatest(least(1.0 + (4.0 - 1.0) * (p_size - 10) / (40.0 - 10.0), 4.0), 1.0)::DOUBLE AS scaled, CASE WHEN p_size < 10 THEN 1 WHEN p_size < 25 THEN 2 WHEN p_size < 60 THEN 3 END AS bucket,
ln(greatest(p_size / 50, 1e-5) / greatest(1 - p_size / 50, 1e-5)) AS logit, CASE WHEN p_size % 4 > 0 THEN round_even(p_partkey / (p_size % 4), 6) ELSE 0 END AS ratio FROM part""")
def scaling(spark, d):
    s = F.col("p_size")
    ratio = F.when(s % 4 > 0, F.bround(F.col("p_partkey") / F.when(s % 4 > 0, s % 4), 6)).otherwise(F.lit(0.0))
    return read(spark, d, "part").select(F.col("p_partkey").alias("id"), geometry.interpolate(s, 10, 40, 1.0, 4.0).alias("scaled"), geometry.bucket_value(s, ((10, 1), (25, 2), (60, 3))).alias("bucket"), geometry.inverse_sigmoid(s / 50).alias("logit"), ratio.alias("ratio"))


@_query(T + """, c AS (SELECT class, split, count(*) AS n FROM boxes JOIN images USING (image_id) WHERE split <> 'test' GROUP BY ALL) SELECT class, sum(n)::BIGINT AS n FROM c GROUP BY class""")
def merged_counts(spark, d):
    """Counter maps of the splits added up, key by key."""
    c = _labelled(spark, d).groupBy("split", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("split").agg(F.map_from_entries(F.collect_list(F.struct("class", "n"))).alias("m"))  # an entry per class
    a, b = (c.where(F.col("split") == s).select(F.col("m").alias(s)) for s in ("train", "val"))
    add = F.map_zip_with("train", "val", lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    return a.crossJoin(F.broadcast(b)).select(F.explode(add).alias("class", "n"))  # one row each


@_query(T + "SELECT image_id, string_agg(DISTINCT class, '|' ORDER BY class) AS packed, count(DISTINCT class) AS unpacked FROM boxes GROUP BY image_id")
def packed_ids(spark, d):
    p = boxes(spark, d).groupBy("image_id").agg(F.array_join(F.array_sort(F.collect_set("class")), "|").alias("packed"))
    return p.withColumn("unpacked", F.size(F.split("packed", r"\|")).cast("long"))


@_query(T + "SELECT image_id FROM boxes GROUP BY image_id HAVING count(*) FILTER (substr(class, 7, 1) NOT IN ('1', '2', '3')) = 0")
def excess_only(spark, d):
    """Images all of whose classes are in excess: the ones a downsample may drop."""
    e = F.array(*[F.lit(f"Brand#{k}") for k in range(1, 100) if str(k)[0] in "123"])
    return boxes(spark, d).groupBy("image_id").agg(F.collect_set("class").alias("c")).where(F.size(F.array_except("c", e)) == 0).select("image_id")


@_query(T + ", f AS (SELECT image_id, class, min((line_no, part, supp)) AS seen FROM boxes GROUP BY ALL) SELECT image_id, string_agg(class, '|' ORDER BY seen) AS classes FROM f GROUP BY image_id")
def ordered_distinct(spark, d):
    """Classes of an image in the order in which the file names them first."""
    g = boxes(spark, d).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "part", "supp", "class"))).alias("r"))
    return g.select("image_id", F.array_join(F.array_distinct(F.transform("r", lambda x: x["class"])), "|").alias("classes"))


@_query(T + """SELECT split, count(*) AS images, ceil(count(*) / 16)::BIGINT AS steps_per_epoch, ceil(count(*) / 16)::BIGINT * 12 AS steps FROM images GROUP BY split""")
def training_steps(spark, d):
    n = images(spark, d).groupBy("split").agg(F.count(F.lit(1)).alias("images"))
    return n.withColumn("steps_per_epoch", F.ceil(F.col("images") / 16)).withColumn("steps", F.col("steps_per_epoch") * 12)


@_query("""WITH a AS (SELECT p_partkey % 1000 AS k, p_brand, p_type, p_size FROM part WHERE p_partkey < 1000), b AS (SELECT p_partkey % 1000 AS k, p_brand, p_type, p_size FROM part WHERE p_partkey >= 1000 AND p_partkey < 2000)
SELECT coalesce(a.k, b.k) AS k, concat_ws(',', CASE WHEN a.p_brand IS DISTINCT FROM b.p_brand THEN 'p_brand' END, CASE WHEN a.p_size IS DISTINCT FROM b.p_size THEN 'p_size' END, CASE WHEN a.p_type IS DISTINCT FROM b.p_type THEN 'p_type' END) AS differs
FROM a FULL JOIN b ON a.k = b.k WHERE a.p_brand IS DISTINCT FROM b.p_brand OR a.p_size IS DISTINCT FROM b.p_size OR a.p_type IS DISTINCT FROM b.p_type""")
def fingerprint_diff(spark, d):
    """Which parts of two fingerprints differ, missing on one side included."""
    keys = ("p_brand", "p_size", "p_type")
    p = read(spark, d, "part")
    side = lambda lo, s: p.where((F.col("p_partkey") >= lo) & (F.col("p_partkey") < lo + 1000)).select((F.col("p_partkey") % 1000).alias("k"), *[F.col(c).alias(f"{s}_{c}") for c in keys])
    j = side(0, "a").join(side(1000, "b"), "k", "full")
    return j.select("k", F.concat_ws(",", *[F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in keys]).alias("differs")).where("differs <> ''")
