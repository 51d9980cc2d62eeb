import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from detlake.functions import boxes as B
from detlake.functions import camera, text
from detlake.operators import enrich, ingest, quality, splits, tiling
from detlake.plans import library


def one(spark, *cols):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return row[0] if len(cols) == 1 else tuple(row)


def bx(*v):
    return B.Box(*(F.lit(float(x)) for x in v))


def test_boxes(spark):
    a, b, far = bx(0, 0, 10, 10), bx(5, 5, 15, 15), bx(13, 14, 20, 20)
    assert one(spark, B.iou(a, b)) == pytest.approx(25 / 175)
    assert one(spark, B.iou(a, far), B.ios(a, b), B.gap_distance(a, far)) == (0.0, 0.25, 5.0)
    assert one(spark, B.intersect_box(a, bx(10, 0, 20, 10)).x1) is None  # touching only
    assert one(spark, *B.clip_box(bx(-5, -5, -1, 30), 10, 20)) == (0.0, 0.0, 0.0, 20.0)
    assert one(spark, B.aspect_ratio(bx(0, 0, 0, 5))) == math.inf
    assert one(spark, B.visible_ratio(bx(0, 0, 0, 0), a)) == 0.0
    assert one(spark, *B.clip_box_hud(bx(0, 1390, 50, 1430), 2560, 1440, 45)) == (0.0, 1390.0, 50.0, 1395.0)
    clipped, cut = B.clip_with_truncation(bx(-3, 0, 5, 5), 10, 10)
    assert one(spark, clipped.x1, cut) == (0.0, True)


def test_project_to_tile(spark):
    local, ratio, kept = B.project_to_tile(bx(600, 10, 700, 60), 1.0, 1.0, 0, 0, 640)
    assert one(spark, ratio, kept) == (0.4, False)
    local, ratio, kept = B.project_to_tile(bx(600, 10, 700, 60), 1.0, 1.0, 320, 0, 640)
    assert one(spark, local.x1, local.x2, ratio, kept) == (280.0, 380.0, 1.0, True)
    with pytest.raises(ValueError):
        B.project_to_tile(bx(0, 0, 1, 1), 1.0, 1.0, 0, 0, 0)


def test_letterbox_and_resize(spark):
    plan = B.letterbox_plan(F.lit(2560), F.lit(1440), 640)
    assert one(spark, *plan.values()) == (0.25, 640, 360, 0, 140)
    assert one(spark, *B.resize_plan(F.lit(1000), F.lit(500), 500, 500, "fit_aspect").values()) == (500, 250, 0.5, 0.5)
    assert one(spark, B.letterbox_plan(F.lit(640), F.lit(5), 256)["new_height"]) == 2  # 2.0, and half to even elsewhere
    with pytest.raises(ValueError):
        B.resize_plan(F.lit(1), F.lit(1), 1, 1, "stretch")


def test_axis_positions(spark):
    for length, want in ((500, [0]), (640, [0]), (1280, [0, 320, 640]), (1000, [0, 320, 360]), (1440, [0, 320, 640, 800])):
        assert one(spark, tiling.axis_positions(F.lit(length), 640, 320)) == want
    assert one(spark, tiling.axis_positions(F.lit(1000), 640, 320, edges=False)) == [0, 320]
    with pytest.raises(ValueError):
        tiling.axis_positions(F.lit(10), 0, 320)


def test_split_bucket_is_the_sha256_modulus(spark):
    import hashlib
    ids = ["frame_00000001", "a", "pose_sync_unique_01"]
    df = spark.createDataFrame([(i,) for i in ids], "k string").select("k", splits.hash_bucket(F.col("k")).alias("b"))
    assert {r["k"]: r["b"] for r in df.collect()} == {i: int(hashlib.sha256(i.encode()).hexdigest(), 16) % 10000 for i in ids}
    with pytest.raises(ValueError):
        splits.assign_split(F.lit("a"), {"train": 0.5})


def test_six_decimals_match_c_formatting(spark):
    import random
    rng = random.Random(3)
    vals = [k / 2560 for k in range(0, 2560, 7)] + [k / 1440 for k in range(0, 1440, 11)] + [rng.random() * 3 for _ in range(300)] + [0.0, 1.0, 9 / 640, 0.0000005, 12.9999999]
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").select("v", text.fixed_six(F.col("v")).alias("t"))
    assert all(r["t"] == f"{r['v']:.6f}" for r in df.collect())


def test_text(spark):
    assert one(spark, text.file_stem(F.lit("a/b/frame_1.v2.png")), text.file_stem(F.lit(".hidden"))) == ("frame_1.v2", ".hidden")
    names = ["best_ckpt.pth", "epoch_20_ckpt.pth", "last_mosaic_epoch_ckpt.pth", "foo.pth"]
    got = [one(spark, text.checkpoint_kind(F.lit(n)), text.checkpoint_epoch(F.lit(n))) for n in names]
    assert got == [("best", None), ("every_n", 20), ("last_mosaic_epoch", None), ("unknown", None)]
    assert one(spark, text.eta_clock(F.lit(3661.4)), text.eta_clock(F.lit(None).cast("double"))) == ("01:01:01", "?")
    assert one(spark, text.under_protected_root(F.lit("/s/datasets/raw/x")), text.under_protected_root(F.lit("/s/rawish/datasets"))) == (True, False)
    assert one(spark, text.bbox_from_json(F.lit("[1.0, 2, 3]")), text.canonical_double(F.lit(-0.0))) == (None, 0.0)


def test_camera(spark):
    f, u, r = camera.basis_from_angles(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    assert one(spark, *f, *u, *r) == (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0)
    h, p, b = 0.4, 0.2, -0.3
    f, u, r = camera.basis_from_angles(F.lit(h), F.lit(p), F.lit(b))
    v = one(spark, *f, *u, *r)
    fv, uv, rv = v[:3], v[3:6], v[6:]
    dot = lambda a, c: sum(x * y for x, y in zip(a, c))
    assert all(abs(dot(x, x) - 1) < 1e-12 for x in (fv, uv, rv)) and abs(dot(fv, uv)) + abs(dot(fv, rv)) + abs(dot(uv, rv)) < 1e-12
    assert fv[1] == pytest.approx(math.sin(-p))


def test_classes_and_lines(spark):
    names = ["USS Ticonderoga", "Mi-24P", "MiG-29", "tank", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r[0] for r in df.orderBy("i").select(ingest.infer_class(F.col("n"))).collect()]
    assert got == ["ships", "helicopters", "airplanes", None, None]
    lines = {"0 0.5 0.5 0.1 0.1": True, "3 0.5 0.5 0.1 0.1": False, "1 1.2 0.5 0.1 0.1": False, "1 0.5 0.5 0.5 0.1": False, "1 0.5 0.5 0.1": False}
    for line, ok in lines.items():
        assert one(spark, quality.yolo_line_valid(F.lit(line))) is ok


def test_picture_names_keep_all_digits(spark):
    """The query and its SQL name pictures beyond the eight-digit ids alike."""
    ids = [1, 99_999_999, 100_000_000, 1_234_567_890]
    names = spark.createDataFrame([(i,) for i in ids], "i long").select(
        enrich.tile_name(F.col("i"), F.lit("s"), F.lit("final"), F.lit(-1), F.lit(False))).collect()
    digits = re.search(r"(lpad\(new_image_id.*?'0'\))", library.oracles()["enriched_images"]).group(1)
    sql = duckdb.sql(f"SELECT {digits} FROM (SELECT unnest({ids}) AS new_image_id)").fetchall()
    assert [r[0] for r in names] == [f"{i:08d}_s_final.png" for i in ids] and [r[0] for r in sql] == [f"{i:08d}" for i in ids]
