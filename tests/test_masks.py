"""Polygons, runs, remaps and selections against known shapes and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from marlstone.functions import names, polygons
from marlstone.operators.running import ordered_ranks
from marlstone.plans import export, masks

POINTS = "array<struct<x double, y double>>"
SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
TRIANGLE = [(1.0, 1.0), (5.0, 1.0), (1.0, 5.0)]
BOW = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)]
ARROW = [(0.0, 0.0), (4.0, 0.0), (1.0, 1.0), (0.0, 4.0)]


def test_polygon_predicates(spark):
    rows = [("square", SQUARE), ("back", SQUARE[::-1]), ("bow", BOW), ("arrow", ARROW), ("line", [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]), ("none", [])]
    d = spark.createDataFrame(rows, f"k string, p {POINTS}")
    p = F.col("p")
    got = {r.k: (r.s, r.c, r.a) for r in d.select("k", polygons.is_simple(p).alias("s"), polygons.is_convex(p).alias("c"), polygons.signed_area(p).alias("a")).collect()}
    assert got == {"square": (True, True, 4.0), "back": (True, True, -4.0), "bow": (False, False, 0.0), "arrow": (True, False, 4.0), "line": (True, False, 0.0), "none": (True, False, 0.0)}


def test_canonical_outlines_agree(spark):
    rows = [(i, TRIANGLE[i % 3 :] + TRIANGLE[: i % 3] if i < 3 else (TRIANGLE[i % 3 :] + TRIANGLE[: i % 3])[::-1]) for i in range(6)]
    d = spark.createDataFrame(rows, f"i int, p {POINTS}").select(polygons.canonical(F.col("p")).alias("c")).distinct().collect()
    assert len(d) == 1 and [tuple(p) for p in d[0].c] == min([TRIANGLE[i:] + TRIANGLE[:i] for i in range(3)] + [(t := TRIANGLE[::-1])[i:] + t[:i] for i in range(3)])


def test_convex_iou(spark):
    far = [(9.0, 9.0), (10.0, 9.0), (9.0, 10.0)]
    rows = [(SQUARE, TRIANGLE, 1 / 11), (SQUARE[::-1], TRIANGLE[::-1], 1 / 11), (SQUARE, SQUARE, 1.0), (SQUARE, far, 0.0), (SQUARE, [(1.0, -1.0), (3.0, 1.0), (1.0, 3.0), (-1.0, 1.0)], 4 / 8)]
    d = spark.createDataFrame(rows, f"p {POINTS}, q {POINTS}, want double")
    for r in d.select(polygons.convex_iou(F.col("p"), F.col("q")).alias("iou"), "want").collect():
        assert r.iou == pytest.approx(r.want)


def test_runs_round_trip(spark):
    r = random.Random(4)
    rows = [(i, [r.random() < 0.4 for _ in range(n)]) for i, n in enumerate([0, 1, 1, 1, 7, 20, 40])] + [(90, [True] * 5), (91, [False] * 5)]
    d = spark.createDataFrame(rows, "i int, v array<boolean>").withColumn("n", polygons.rle_encode(F.col("v")))
    for row in d.withColumn("back", polygons.rle_decode(F.col("n"))).collect():
        want, last = [], False
        for v in row.v:
            if not want or v != last:
                want += [0, 1] if not want and v else [1]
            else:
                want[-1] += 1
            last = v
        assert row.n == want and row.back == row.v, row.v


def test_remap_policies(spark):
    d = spark.createDataFrame([(1,), (2,), (7,), (9,), (None,)], "k long")
    lut = {1: 0, 2: 5}
    assert [r[0] for r in d.select(masks.remap(F.col("k"), lut, source_ignore=9, unknown="ignore")).collect()] == [0, 5, 255, 255, None]
    with pytest.raises(Exception, match="unknown label 7"):
        d.select(masks.remap(F.col("k"), lut, source_ignore=9)).collect()


def test_trim_against_one_by_one(spark):
    r = random.Random(9)
    rows = [(r.randrange(6) if r.random() < 0.5 else 3, k, 0, 0, r.choice("abc")) for k in range(60)]
    b = spark.createDataFrame(rows, "image_id long, line_no int, part int, supp int, class string")
    caps = {"a": 5, "b": 100, "c": 0}
    got = {(x.image_id, x.line_no) for x in export.trim_to_quota(b, spark.createDataFrame(list(caps.items()), "class string, cap long")).collect()}
    want = set()
    for c, cap in caps.items():
        left = {}
        for image, line, _, _, k in rows:
            if k == c:
                left.setdefault(image, []).append(line)
        while sum(map(len, left.values())) > cap:
            image = min(left, key=lambda i: (-len(left[i]), i))
            want.add((image, left[image].pop(0)))
    assert got == want
    assert export.trim_to_quota(b.limit(0), spark.createDataFrame(list(caps.items()), "class string, cap long")).count() == 0


def test_ranks_and_spaced_samples(spark):
    rows = [(g, 7 * i) for g, n in (("a", 1), ("b", 2), ("c", 40), ("d", 333)) for i in range(n)]
    ranked = ordered_ranks(spark.createDataFrame(rows, "g string, k0 long"), ["g"], "k0", [], "k", bands=8)
    assert all(r.k * 7 == r.k0 for r in ranked.collect())
    for quota in (0, 1, 2, 7, 40, 50):
        got: dict = {}
        for r in export.spaced(ranked, quota).collect():
            got.setdefault(r.g, set()).add(r.k)
        for g, n in (("a", 1), ("b", 2), ("c", 40), ("d", 333)):
            q = min(quota, n)
            want = set() if q == 0 else {n // 2} if q == 1 else {round(i * (n - 1) / (q - 1)) for i in range(q)}
            assert got.get(g, set()) == want, (g, quota)


def test_split_targets(spark):
    d = spark.createDataFrame([("x", 10), ("y", 0), ("z", 4)], "class string, n long")
    one = F.lit(1).cast("long")
    got = {(r["class"], r.split): r.target for r in export.split_targets(d, F.col("n"), {s: one for s in ("train", "val", "test")}, F.lit(3)).collect()}
    # equal remainders: the last name takes what is left
    assert got == {("x", "train"): 3, ("x", "val"): 4, ("x", "test"): 3, ("y", "train"): 0, ("y", "val"): 0, ("y", "test"): 0, ("z", "train"): 1, ("z", "val"): 2, ("z", "test"): 1}


def test_short_names(spark):
    paths = {"/r/datasets/NEU_dataset/dataset_det/data.yaml": "NEU", "datasets/data.yaml": "dataset", "/tmp/random/foo/data.yaml": "foo", "data.yaml": "dataset", "a/_Cls/data.yaml": "a"}
    d = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.n for r in d.select("p", names.dataset_short(F.col("p")).alias("n")).collect()} == paths
    assert spark.createDataFrame([("a/vits16-x-y",)], "m string").select(names.model_short(F.col("m"))).first()[0] == "vits16"
