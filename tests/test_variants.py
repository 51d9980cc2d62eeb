"""Variants of axes: views that show the same corners."""

from pyspark.sql import functions as F

from detlake.functions import camera
from detlake.operators import projection


def test_variants_that_show_the_same_corners_are_projected_once(spark, monkeypatch):
    def v(x, y, z):
        return F.struct(*[F.lit(float(c)).alias(n) for c, n in ((x, "x"), (y, "y"), (z, "z"))])

    boxes = [(1, (-2, 0, -1), (2, 3, 1)), (2, (-2, 0, -1), (2, 3, 1.5)), (3, (-2, -1, -1), (2.5, 3, 1)), (4, (-2, 0, -1), (3, 3, 2))]
    rows = None
    for i, low, high in boxes:
        one = spark.range(1).select(
            F.lit(1).alias("image_id"), F.lit(i).alias("object_id"), F.lit("ships").alias("class"), v(0.3, 2, -60).alias("position"), v(0, 0.1, 1).alias("forward"),
            v(0, 1, -0.1).alias("up"), v(1, 0, 0.2).alias("right"), v(3, 1, 2).alias("origin"), v(0.8, 0.1, 0.6).alias("axis_x"), v(0, 1, 0).alias("axis_y"),
            v(-0.6, 0, 0.8).alias("axis_z"), v(*low).alias("low"), v(*high).alias("high"), *[F.lit(c).alias(n) for n, c in (("t_x1", 1200.0), ("t_y1", 600.0), ("t_x2", 1400.0), ("t_y2", 800.0))])
        rows = one if rows is None else rows.unionByName(one)
    cam = projection.CameraColumns(*[F.lit(c) for c in (1200.0, 1200.0, 1280.0, 720.0)], F.lit(2560), F.lit(1440))
    seen, plain = [], projection.project_corners
    monkeypatch.setattr(projection, "project_corners", lambda df, *a, **k: seen.append(df) or plain(df, *a, **k))
    got = {(r["object_id"], r["mapping"]): (r["x1"], r["y1"], r["x2"], r["y2"]) for r in projection.diagnose_variants(rows, cam).collect()}
    assert {r["object_id"]: r["count"] for r in seen[0].groupBy("object_id").count().collect()} == {1: 4, 2: 8, 3: 8, 4: 16}
    want = {}
    for basis, axes in projection.BASIS_VARIANTS:
        for name, order, sign in projection.ORDER_VARIANTS:
            at = [[F.col(f"{c}.{'xyz'[i]}") * s for i, s in zip(order, sign)] for c in ("low", "high")]
            turned = tuple(camera.vec(F.col(f"axis_{'xyz'[a]}")) for a in axes)
            for r in plain(rows, camera.vec(F.col("origin")), turned, *[camera.Vec(*p) for p in at], *cam).collect():
                want[r["object_id"], f"{basis}__{name}"] = (r["x1"], r["y1"], r["x2"], r["y2"])
    assert len(want) == 96 and got == want and len(set(want.values())) > 16
