import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.functions import geometry, stats
from marlstone.operators import match, select
from marlstone.sources import labels
from marlstone.streaming import series


def test_split_sizes_give_the_rest_to_one_split():
    assert select.split_sizes(8, {"train": 1, "val": 1, "test": 1}) == {"train": 2, "val": 4, "test": 2}
    assert select.largest_remainder(8, {"train": 1, "val": 1, "test": 1}) == {"train": 3, "val": 3, "test": 2}
    assert select.largest_remainder(4, {"train": 0.9, "val": 0.05, "test": 0.05}) == {"train": 2, "val": 1, "test": 1}
    assert select.largest_remainder(2, {"train": 0.9, "val": 0.1, "test": 0.0}) == {"train": 1, "val": 1, "test": 0}
    assert select.split_sizes(0, {"train": 1}) == {"train": 0, "val": 0, "test": 0}


def test_heaviest_items_go_to_the_lightest_shard():
    assert select.lightest_shard([5, 4, 3, 3, 1], 2) == [0, 1, 1, 0, 1]
    assert select.lightest_shard([], 3) == [] and select.lightest_shard([1, 1, 1], 3) == [0, 1, 2]


def test_lazy_greedy_equals_plain_greedy():
    rng = np.random.default_rng(1)
    images = {f"i{k:02d}": {int(c): int(rng.integers(1, 4)) for c in rng.choice(6, rng.integers(1, 4), replace=False)} for k in range(40)}
    caps = dict.fromkeys(range(6), 12)
    available = {c: sum(x.get(c, 0) for x in images.values()) for c in range(6)}
    have, left, want = {}, set(images), []
    while left and len(want) < 15:
        best = min(left, key=lambda n: (-select.coverage_gain(images[n], have, caps, available), -sum(images[n].values()), len(images[n]), n))
        if select.coverage_gain(images[best], have, caps, available) <= 0:
            break
        left.remove(best), want.append(best)
        for c, x in images[best].items():
            have[c] = have.get(c, 0) + x
    assert select.lazy_greedy(images, 15, caps) == want


@pytest.mark.parametrize("shape", [(3, 3), (2, 5), (5, 2), (1, 1)])
def test_assignment_is_least(shape):
    rng = np.random.default_rng(4)
    for _ in range(30):
        c = rng.random(shape)
        small, large = min(shape), max(shape)
        m = c if shape[0] <= shape[1] else c.T
        best = min(sum(m[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
        assert sum(c[i, j] for i, j in match.assign(c)) == pytest.approx(best)


BOXES = "image_id long, class string, score double, no long, x1 double, y1 double, x2 double, y2 double"


def test_matching_and_suppression(spark):
    p = spark.createDataFrame([(1, "a", 0.9, 1, 0.0, 0.0, 10.0, 10.0), (1, "a", 0.8, 2, 0.0, 0.0, 10.0, 9.0), (1, "b", 0.7, 3, 0.0, 0.0, 10.0, 10.0), (2, "a", 0.5, 4, 0.0, 0.0, 1.0, 1.0)], BOXES)
    g = spark.createDataFrame([(1, "a", 0.0, 1, 0.0, 0.0, 10.0, 10.0)], BOXES).withColumnRenamed("no", "gt_no")
    got = {r.pred_no: r.is_tp for r in match.greedy_match(p.withColumnRenamed("no", "pred_no"), g).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}
    assert [(r.gt_no, r.pred_no, r.same_class) for r in match.hungarian_match(p.withColumnRenamed("no", "pred_no"), g).collect()] == [(1, 1, True)]
    assert {r.pred_no for r in match.suppress(p.withColumnRenamed("no", "pred_no")).collect()} == {1, 3, 4}
    assert {r.pred_no for r in match.suppress(p.withColumnRenamed("no", "pred_no"), by_class=False).collect()} == {1, 4}
    assert match.suppress(p.withColumnRenamed("no", "pred_no").limit(0)).count() == 0


def test_label_readers_differ(spark):
    rows = [("i", 0, "0 0.5 0.5 0.4 0.4"), ("i", 1, "0 0.95 0.5 0.2 0.2"), ("i", 2, "broken line"), ("i", 3, "0 0.5 0.5 0.4 0.4"), ("i", 4, "1.5 0.5 0.5 0.4 0.4")]
    lines = spark.createDataFrame(rows, "image_id string, line_no int, line string")
    p = {r.line_no: (r.valid, r.anomaly) for r in labels.parse_boxes(lines).collect()}
    assert p == {0: (True, False), 1: (True, True), 2: (False, False), 3: (True, False), 4: (True, False)}
    good, bad = labels.parse_boxes_strict(lines)
    assert {r.line_no for r in good.collect()} == {0, 3} and {r.line_no: r.reason for r in bad.collect()} == {1: "outside the image", 2: "not five numbers", 4: "class is no whole number"}
    assert {r.line_no for r in labels.parse_boxes_library(lines).collect()} == {0, 1, 4}
    q = spark.createDataFrame([("i", 0, "2 0 0 1 0 1 1 0 1"), ("i", 1, "2 0 0 1 0")], "image_id string, line_no int, line string")
    assert [(r.class_id, r.area) for r in labels.parse_polygons(q).collect()] == [(2, 1.0)]


def test_label_files_coco_and_paths(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 0.5 0.5 0.4 0.4\n\n1 0.2 0.2 0.1 0.1\n")
    got = labels.read_lines(spark, f"{tmp_path}/*.txt").collect()
    assert [(r.image_id, r.line_no) for r in got] == [("a", 0), ("a", 2)]
    (tmp_path / "c.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "x.jpg", "width": 4, "height": 4}], "annotations": [{"id": 1, "image_id": 1, "category_id": 2, "bbox": [0, 0, 1, 1], "area": 1, "iscrowd": 0}], "categories": [{"id": 2, "name": "cat"}]}))
    i, a, c = labels.read_coco(spark, str(tmp_path / "c.json"))
    assert a.join(c, a.category_id == c.id).select("name").first()[0] == "cat" and i.count() == 1
    p = spark.createDataFrame([("d/images/x/images/t/1.jpg",)], "p string").select(labels.label_path(F.col("p"))).first()[0]
    assert p == "d/images/x/labels/t/1.txt"


def _greedy(preds, truth, threshold):
    free, out = list(truth), {}
    for p in sorted(preds, key=lambda p: (-p[1], p[2])):
        best = max(((match.iou_matrix(np.array([p[3:]]), np.array([g[2:]]))[0, 0], -k, g) for k, g in enumerate(free) if g[0] == p[0]), default=(0, 0, None))
        out[p[2]] = best[0] > 0 and best[0] >= threshold
        if out[p[2]]:
            free.remove(best[2])
    return out


def test_matching_against_brute_force(spark):
    """Random images: greedy matches, suppression and the number and cost of assignments."""
    rng = np.random.default_rng(9)
    box = lambda: [*(a := rng.integers(0, 12, 2).astype(float)), *(a + rng.integers(2, 9, 2))]
    preds = [(int(i), rng.choice(["a", "b"]), float(rng.integers(1, 6)) / 10, k, *map(float, box())) for k, i in enumerate(rng.integers(0, 8, 60))]
    truth = [(int(i), rng.choice(["a", "b"]), 0.0, 100 + k, *map(float, box())) for k, i in enumerate(rng.integers(0, 8, 50))]
    p = spark.createDataFrame([(i, str(c), *r) for i, c, *r in preds], BOXES).withColumnRenamed("no", "pred_no")
    g = spark.createDataFrame([(i, str(c), *r) for i, c, *r in truth], BOXES).withColumnRenamed("no", "gt_no")
    want = {}
    for i in range(8):
        want |= _greedy([(c, s, k, *b) for j, c, s, k, *b in preds if j == i], [(c, k, *b) for j, c, s, k, *b in truth if j == i], 0.3)
    assert {r.pred_no: r.is_tp for r in match.greedy_match(p, g, threshold=0.3).collect()} == want
    kept = {}
    for i, c, s, k, *b in sorted(preds, key=lambda x: (-x[2], x[3])):
        if all(match.iou_matrix(np.array([b]), np.array([o]))[0, 0] <= 0.3 for o in kept.get(i, {}).values()):
            kept.setdefault(i, {})[k] = b
    assert {r.pred_no for r in match.suppress(p, 0.3, by_class=False).collect()} == {k for x in kept.values() for k in x}
    found = {}
    for r in match.hungarian_match(p, g, threshold=0.3).collect():
        found.setdefault(r.image_id, []).append((r.gt_no, r.pred_no))
    for i in range(8):
        a, b = [x for x in preds if x[0] == i], [x for x in truth if x[0] == i]
        iou = match.iou_matrix(np.array([x[4:] for x in a]).reshape(-1, 4), np.array([x[4:] for x in b]).reshape(-1, 4)) * 1.0
        able = iou >= 0.3

        def most(row, used):
            if row == len(a):
                return 0
            return max([most(row + 1, used), *(1 + most(row + 1, used | {j}) for j in range(len(b)) if able[row, j] and j not in used)])

        assert len(found.get(i, [])) == most(0, frozenset())


def test_names(spark):
    from marlstone.functions import names

    s = spark.createDataFrame([("ＤＳ2-Straße",), ("Dataset3_ Cat 1",), (None,), ("类别12",)], "n string")
    r = s.select(names.tail(names.fold_unicode(F.col("n"))).alias("t"), names.placeholder(names.fold_unicode(F.col("n"))).alias("p"), names.null_like(names.fold(F.col("n"))).alias("z")).collect()
    assert [x.t for x in r] == ["strasse", "cat1", None, "类别12"] and [x.p for x in r] == [False, False, None, True] and [x.z for x in r] == [False, False, True, False]
    k = spark.createDataFrame([("a10b",), ("a9b",), ("a009c",)], "n string").orderBy(names.natural_key(F.col("n"))).collect()
    assert [x.n for x in k] == ["a9b", "a009c", "a10b"]
    assert names.parse_ratio("8:1:1", ("train", "val", "test")) == {"train": 0.8, "val": 0.1, "test": 0.1}
    with pytest.raises(ValueError):
        names.parse_ratio("1:2", ("train", "val", "test"))


def test_nearest_rank_and_geometry(spark):
    d = spark.createDataFrame([([0, 10, 20, 30],)], "v array<int>")
    assert d.select(stats.nearest_rank(F.col("v"), 0.5)).first()[0] == 20
    s = [spark.range(1).select(geometry.bucket(F.lit(a), geometry.EXPORT_BUCKETS)).first()[0] for a in (255, 256, 1023, 1024, 9215, 9216)]
    assert s == ["tiny", "small", "small", "medium", "medium", "large"]


def test_streams(spark, tmp_path):
    schema = "k string, t long, v double"
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", 1, 1.0), ("a", 3, 3.0), (None, 1, 0.0)], schema).write.parquet(src)
    args = (spark, schema, src, str(tmp_path / "out"), str(tmp_path / "ck"), str(tmp_path / "bad"), F.col("k").isNull())
    series.scan_new(*args)
    spark.createDataFrame([("a", 2, 2.0), ("b", 1, 5.0)], schema).write.mode("append").parquet(src)
    series.scan_new(*args)
    spark.createDataFrame([("c", None, 1.0)], schema).write.mode("append").parquet(src)
    series.scan_new(*args[:-1], F.col("t") < 0)  # null: not known to be bad
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 5 and spark.read.parquet(str(tmp_path / "bad")).count() == 1
    assert {(r.k, r.t, r.v) for r in series.last_write_wins(out, ["k"], "t", "v").collect()} == {("a", 3, 3.0), ("b", 1, 5.0)}
