"""The ways taken by large groups give what the small-group ways and plain Python give."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from detlake.operators import enrich, fragments, grid, ingest, matching, metrics, ordering, skew, suppress, tiling
from detlake.session import apply_runtime, durable, spread

CORNERS = ["x1", "y1", "x2", "y2"]


def _iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h)


@pytest.fixture(scope="module")
def scene():
    """One image with most rows, copies and near copies among them, and a few small images."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(260):
        image = 1 if i < 200 else 2 + i % 5
        x, y = rng.integers(0, 400, 2)
        w, h = rng.integers(10, 80, 2)
        if i % 4 == 1 and rows[-1][0] == image:  # near copy of the one before
            _, _, _, _, px1, py1, px2, py2 = rows[-1]
            x, y, w, h = px1 + 1, py1, px2 - px1, py2 - py1
        if i % 9 == 2 and rows[-1][0] == image:  # exact copy
            _, _, _, _, x1, y1, x2, y2 = rows[-1]
            x, y, w, h = x1, y1, x2 - x1, y2 - y1
        rows.append((image, int(i % 2), i, float(rng.integers(1, 100)) / 100, float(x), float(y), float(x + w), float(y + h)))
    return rows


@pytest.fixture(scope="module")
def detections(spark, scene):
    return spark.createDataFrame(scene, "image_id bigint, class_id int, det_id bigint, confidence double, x1 double, y1 double, x2 double, y2 double")


@pytest.fixture(scope="module")
def truth(spark, scene):
    rows = [(r[0], r[1] if k % 5 else 1 - r[1], 1000 + k, r[4] + k % 3, r[5] - k % 2, r[6] + 2, r[7]) for k, r in enumerate(scene) if k % 3 == 0]
    return spark.createDataFrame(rows, "image_id bigint, class_id int, gt_id bigint, x1 double, y1 double, x2 double, y2 double")


def _rows(df, *cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def _groups(scene):
    out = {}
    for r in scene:
        out.setdefault((r[0], r[1]), []).append(r)
    return {k: sorted(v, key=lambda r: (-r[3], r[2])) for k, v in out.items()}


def test_nms_rounds_equal_greedy(detections, scene):
    want = []
    for group in _groups(scene).values():
        kept = []
        for r in group:
            if all(_iou(k[4:], r[4:]) <= 0.5 for k in kept):
                kept.append(r)
        want += [r[2] for r in kept]
    for rows in (2000, 10):
        got = [r[0] for r in suppress.nms(detections, 0.5, fold_rows=rows).select("det_id").collect()]
        assert sorted(got) == sorted(want)


def test_soft_nms_rounds_equal_greedy(detections, scene):
    want = {}
    for group in _groups(scene).values():
        alive = [[r[3], r] for r in group]
        while alive:
            alive.sort(key=lambda e: (-e[0], e[1][2]))
            s, best = alive.pop(0)
            want[best[2]] = s
            for e in alive:
                v = _iou(best[4:], e[1][4:])
                if v > 0.3:
                    e[0] *= np.exp(-(v * v) / 0.5)
    want = {k: v for k, v in want.items() if v >= 0.05}
    for rows in (2000, 10):
        got = {r[0]: r[1] for r in suppress.soft_nms(detections, 0.3, 0.5, 0.05, fold_rows=rows).select("det_id", "confidence").collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_wbf_parts_equal_sequential(detections, scene):
    want = []
    for group in _groups(scene).values():
        clusters = []
        for r in group:
            box = np.array(r[4:])
            for c in clusters:
                if _iou(c["box"], box) >= 0.4:
                    c["m"].append(r)
                    w = np.array([m[3] for m in c["m"]])
                    c["box"] = (np.array([m[4:] for m in c["m"]]) * w[:, None]).sum(0) / w.sum()
                    break
            else:
                clusters.append({"m": [r], "box": box})
        want += [(c["m"][0][2], round(float(np.mean([m[3] for m in c["m"]])), 6), len(c["m"]), round(float(c["box"][0]), 6)) for c in clusters]
    for rows in (2000, 10):
        got = suppress.wbf(detections, 0.4, fold_rows=rows).select("det_id", F.round("confidence", 6), F.size("merged_from"), F.round("x1", 6)).collect()
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_matching_rounds_equal_greedy(detections, truth, scene):
    gts = [tuple(r) for r in truth.collect()]
    for same in (True, False):
        want = []
        order = sorted(scene, key=lambda r: (-r[3], r[2]))
        used = set()
        for d in order:
            cands = [(-_iou(d[4:], g[3:]), g[2]) for g in gts if g[0] == d[0] and g[2] not in used and (not same or g[1] == d[1])]
            cands = [c for c in cands if -c[0] >= 0.5]
            if cands:
                g = min(cands)[1]
                used.add(g)
                want.append((d[2], g))
        for rows in (2000, 4):
            pairs = matching.iou_pairs(detections, truth, 0.5, same, grid_rows=10 if rows == 4 else 256)
            got = matching.match_pairs(pairs, ["image_id", "class_id"] if same else ["image_id"], [0.5], rows)
            assert _rows(got, "det_id", "gt_id") == sorted(want)
            whole = (matching.match_same_class(detections, truth, group_rows=rows) if same
                     else matching.match_any_class(detections, truth, group_rows=rows))
            assert _rows(whole, "det_id", "gt_id") == sorted(want)


def test_edges_and_components(detections):
    cfg = fragments.Fusion(max_distance_px=3.0)
    direct = fragments.fragment_edges(detections, cfg)
    gridded = fragments.fragment_edges(detections, cfg, group_rows=5)
    assert _rows(direct, "src", "dst") == _rows(gridded, "src", "dst")
    assert direct.count() > 50
    a = fragments.fragment_components(detections, direct)
    b = fragments.fragment_components(detections, direct, group_rows=2)
    assert _rows(a, "det_id", "component") == _rows(b, "det_id", "component")
    fused = fragments.fuse_components(a, cfg)
    assert fused.agg(F.sum("num_members")).first()[0] == detections.count()
    assert fragments.merged_from(a, fused).count() == fused.filter("source = 'merged'").agg(F.sum("num_members")).first()[0]


def _reference_components(rows, cfg):
    """Union by pairs in plain Python: rows are (image, class, det, scale, crop, x1, y1, x2, y2)."""
    parent = {r[2]: r[2] for r in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if a[:2] != b[:2] or (cfg.same_scale and a[3] != b[3]) or (cfg.adjacent_crops and abs(a[4] - b[4]) > 1):
                continue
            dx, dy = max(b[5] - a[7], a[5] - b[7], 0.0), max(b[6] - a[8], a[6] - b[8], 0.0)
            if math.sqrt(dx * dx + dy * dy) <= cfg.max_distance_px:
                low, high = sorted((root(a[2]), root(b[2])))
                parent[high] = low
    return sorted((i, root(i)) for i in parent)


@pytest.mark.parametrize("cfg", [fragments.Fusion(max_distance_px=4.0), fragments.Fusion(max_distance_px=0.0),
                                 fragments.Fusion(max_distance_px=6.0, same_scale=True, adjacent_crops=True)])
def test_components_without_edges(spark, cfg):
    rng = random.Random(11)
    rows = []
    for i in range(420):
        # thin, tiny, empty and long boxes, dense in one corner, sparse elsewhere
        w, h = rng.choice([(1.5, 40.0), (30.0, 1.0), (0.0, 0.0), (5.0, 5.0), (0.25, 0.5), (90.0, 0.5)])
        x, y = (rng.uniform(0, 40), rng.uniform(0, 40)) if i % 3 == 0 else (rng.uniform(0, 700), rng.uniform(0, 700))
        x, y = (round(x), round(y)) if i % 2 else (x, y)
        rows.append((1, i % 2, i, rng.randrange(2), rng.randrange(6), float(x), float(y), float(x + w), float(y + h)))
    schema = "image_id bigint, class_id int, det_id bigint, scale_level int, crop_id int, x1 double, y1 double, x2 double, y2 double"
    want = _reference_components(rows, cfg)
    df = spark.createDataFrame(rows, schema)
    assert 20 < len({c for _, c in want}) < 400
    for group_rows, fold_rows in ((1000, 1000), (5, 1000)):
        assert _rows(fragments.near_components(df, cfg, group_rows, fold_rows), "det_id", "component") == want


def test_components_of_dense_and_broken_boxes(spark):
    # a thousand boxes on one spot beside a second heap just out of reach, that a thin box far below connects; null and
    # NaN corners stay alone, and so does a disabled class
    heap = [(1, 0, i, 0.0 + i % 7, 0.0, 20.0 + i % 7, 20.0) for i in range(500)] + [(1, 0, i, 40.0, 0.0, 60.0 + i % 5, 20.0) for i in range(500, 900)]
    bridge = [(1, 0, 990, 3.0, 24.0, 55.0, 24.5)]
    odd = [(1, 0, 995, None, 0.0, 9.0, 9.0), (1, 0, 996, float("nan"), 0.0, 9.0, 9.0), (1, 3, 997, 0.0, 0.0, 9.0, 9.0), (1, 3, 998, 0.0, 0.0, 9.0, 9.0), (None, 0, 999, 0.0, 0.0, 9.0, 9.0)]
    schema = "image_id bigint, class_id int, det_id bigint, x1 double, y1 double, x2 double, y2 double"
    cfg = fragments.Fusion(max_distance_px=5.0, disabled_classes=(3,))
    for extra, second in (([], 500), (bridge, 0)):
        df = spark.createDataFrame(heap + extra + odd, schema)
        got = dict(_rows(fragments.near_components(df, cfg), "det_id", "component"))
        assert {got[i] for i in range(500)} == {0} and {got[i] for i in range(500, 900)} == {second}
        assert all(got[i] == i for i in range(995, 1000)) and len(got) == len(heap + extra + odd)
    empty = spark.createDataFrame([], schema)
    assert fragments.near_components(empty, cfg).count() == 0


def test_pairs_of_unlike_sizes(spark):
    # one giant box among small ones takes four cells of its own size, and every pair comes once
    rng = random.Random(3)
    boxes = [(1, i, x, y, x + s, y + s) for i, (x, y, s) in enumerate((rng.uniform(-300, 300), rng.uniform(-300, 300), rng.choice([0.0, 2.0, 17.0, 64.0])) for _ in range(150))]
    boxes.append((1, 150, -100000.0, -100000.0, 100000.0, 100000.0))
    df = spark.createDataFrame(boxes, "g int, k int, x1 double, y1 double, x2 double, y2 double")
    got = grid.meeting_pairs(df, df, ["g"], 1.5).select("a_k", "b_k").collect()
    want = {(a[1], b[1]) for a in boxes for b in boxes if max(a[2], b[2]) - min(a[4], b[4]) <= 3.0 and max(a[3], b[3]) - min(a[5], b[5]) <= 3.0}
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want


def test_positions_and_running_sums(spark):
    rows = [(("hot" if i % 3 else "cold"), (i * 7919) % 1000, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    pos = {r["k"]: r["pos"] for r in ordering.global_index(df, [F.col("k")]).collect()}
    assert pos == {k: k + 1 for k in range(1000)}
    got = ordering.running_sums(df, ["g"], [F.col("k")], {"s": F.col("v").cast("bigint")}, block_rows=37).collect()
    for name in ("hot", "cold"):
        total = 0
        mine = sorted((r for r in rows if r[0] == name), key=lambda r: r[1])
        have = {r["k"]: (r["rank"], r["s"]) for r in got if r["g"] == name}
        for i, r in enumerate(mine):
            total += r[2]
            assert have[r[1]] == (i + 1, total)


def _by_hand(rows):
    """(rank, running sum) of every (group, value, tie) with the value falling, missing values last."""
    out, state = {}, {}
    for g, v, k, n in sorted(rows, key=lambda r: (str(r[0]), r[1] is None, -(r[1] or 0.0), r[2])):
        rank, total = state.get(g, (0, 0))
        out[g, k] = state[g] = (rank + 1, total + (n or 0))
    return out


@pytest.mark.parametrize("bins, limit", [(1, 10_000), (7, 10_000), (65_536, 10_000), (7, 5), (65_536, 3)])
def test_binned_sums(spark, bins, limit):
    """Values beyond 0 and 1, a value a third of all rows share, missing values and groups; cells small and cut."""
    values = [0.5, 0.5, 0.5, 0.0, 1.0, 1.5, -2.0, None, float("inf")]
    rows = [((None, "a", "a", "a", "b")[i % 5], values[i % 9] if i % 2 else (i * 37 % 101) / 100.0, i, None if i % 11 == 0 else i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v double, k int, n bigint")
    got = ordering.binned_sums(df, ["g"], "v", ["k"], {"s": F.col("n")}, bins=bins, limit=limit)
    assert {(r["g"], r["k"]): (r["rank"], r["s"]) for r in got.collect()} == _by_hand(rows)
    whole = ordering.binned_sums(df, [], "v", ["k"], bins=bins, limit=limit)
    assert {(None, r["k"]): r["rank"] for r in whole.collect()} == {k: r for k, (r, _) in _by_hand([(None, *r[1:]) for r in rows]).items()}
    assert ordering.binned_sums(df.limit(0), ["g"], "v", ["k"], {"s": F.col("n")}).count() == 0


@pytest.mark.parametrize("limit", [10_000, 20])
def test_nested_index_and_counts_along(spark, limit):
    """One parent holds most rows; a missing split and a missing parent are values like others."""
    rows = [((None, "x", "y")[i % 3], None if i % 17 == 0 else 1 if i % 4 else i % 7, (i * 7919) % 1000) for i in range(600)]
    df = spark.createDataFrame(rows, "split string, image int, tile int")
    got = {(r["split"], r["image"], r["tile"]): r["pos"] for r in
           ordering.nested_index(df, ["split"], ["image"], [F.col("tile")], "pos", limit=limit).collect()}
    want, last = {}, {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2])):
        want[r] = last[r[0]] = last.get(r[0], 0) + 1
    assert got == want
    ranks = [(i % 2, i * 3) for i in range(200)]
    along = ordering.counts_along(spark.createDataFrame(ranks, "g int, rank bigint"), ["g"], "rank", "n", block_rows=limit // 7)
    assert sorted(tuple(r) for r in along.select("g", "rank", "n").collect()) == [(g, r, i // 2 + 1) for i, (g, r) in
                                                                                  sorted(enumerate(ranks), key=lambda e: e[1])]


def test_average_precision_of_many_thresholds(spark):
    """More thresholds than bits, tied confidences, a class outside the list; held against a plain loop."""
    rng = np.random.default_rng(3)
    cuts = [round(0.1 + 0.01 * i, 2) for i in range(70)]
    dets = [(int(rng.integers(0, 4)), float(rng.integers(0, 6)) / 5.0, i % 9, i) for i in range(300)]
    reach = {d[3]: int(rng.integers(0, 71)) for d in dets if rng.random() < 0.6}  # matched at the first so many thresholds
    det = spark.createDataFrame(dets, "class_id int, confidence double, image_id int, det_id int")
    m = spark.createDataFrame([(d, cuts[i]) for d, n in reach.items() for i in range(n)], "det_id int, threshold double")
    gt = spark.createDataFrame([(c,) for c in (0, 1, 2, 3) for _ in range(60)], "class_id int")
    got = {(r["class_id"], r["threshold"]): r["ap"] for r in metrics.average_precision(det, gt, m, cuts).collect()}
    assert len(got) == 3 * len(cuts)
    for c in range(3):
        mine = sorted((d for d in dets if d[0] == c), key=lambda d: (-d[1], d[2], d[3]))
        for i, cut in enumerate(cuts):
            tp, points = 0, []
            for rank, d in enumerate(mine, 1):
                if reach.get(d[3], 0) > i:
                    tp += 1
                    points.append((tp / 60, tp / rank))
            want = sum(max((p for r, p in points if r >= k * 0.01), default=0.0) for k in range(101)) / 101
            assert got[c, cut] == pytest.approx(want)


def test_look_back_blocks(spark):
    df = spark.createDataFrame([(i % 2, i, (i * 31) % 17) for i in range(300)], "g int, k int, v int")
    cols = lambda w: {"p": F.lag("v").over(w), "m": F.min("v").over(w.rowsBetween(-4, -1))}
    plain = ordering.look_back(df, ["g"], ["k"], 4, cols)
    blocks = ordering.look_back(df, ["g"], ["k"], 4, cols, block_rows=23)
    assert _rows(plain.na.fill(-1), "g", "k", "v", "p", "m") == _rows(blocks.na.fill(-1), "g", "k", "v", "p", "m")


def test_nest_keeps_everything(spark):
    df = spark.createDataFrame([(1 if i < 90 else 2, i) for i in range(100)], "k int, v int")
    out = {r["k"]: r["vs"] for r in skew.nest(df.repartition(5), ["k"], F.col("v"), [F.col("v")], "vs").collect()}
    assert out == {1: list(range(90)), 2: list(range(90, 100))}


def test_enrichment_of_large_images(spark):
    """Ids, tiles and dropped tiles by ranges as by windows; pictures have their annotations' ids, tiles are kept or dropped."""
    images = spark.createDataFrame([(i, f"f{i}.png", 1920, 1080, "ab"[i % 2]) for i in range(6)], "image_id long, file_name string, width int, height int, split string")
    anns = spark.createDataFrame([(i, 100 * i + k, k % 3, 97.0 * k % 1700, 61.0 * k % 900, 40.0, 30.0) for i in range(5) for k in range(2 + 3 * i)],
                                 "image_id long, ann_id long, category_id int, x double, y double, w double, h double")
    work = enrich.placed(images, anns)
    assert work.before.count() == 6
    columns = ["split", "image_id", "scale_ord", "crop_id", "ann_id", "new_image_id", "new_annotation_id"]
    rows = sorted(tuple(r) for r in enrich.enriched_annotations(work).select(*columns).collect())
    assert rows == sorted(tuple(r) for r in enrich.enriched_annotations(work, limit=40).select(*columns).collect())
    for split in "ab":
        own = [r for r in rows if r[0] == split]
        assert [r[-1] for r in own] == list(range(1, len(own) + 1))
    pictures = {tuple(r) for r in enrich.enriched_images(images, anns, work, limit=40).select("split", "image_id", "scale_ord", "crop_id", "new_image_id").collect()}
    assert {(*r[:4], r[5]) for r in rows} == {p for p in pictures if p[1] != 5} and len(pictures) == len({p[4] for p in pictures if p[0] == "a"}) + len({p[4] for p in pictures if p[0] == "b"})
    key = ["image_id", "scale_ord", "crop_id", "ox", "oy"]
    pieces = tiling.tile_annotations(anns, images)
    lost = {tuple(r) for r in enrich.dropped_tiles(images, anns, pieces).select(*key).collect()}
    kept, every = ({tuple(r) for r in df.select(*key).collect()} for df in (pieces, enrich.all_tiles(images, anns)))
    assert lost | kept == every and not lost & kept


def test_shuffles_spread_with_the_rows(spark):
    """Partitions follow the rows, and no estimate from file sizes makes a broadcast."""
    apply_runtime(spark)
    spread(spark, 10_000_000)
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) == 200
    many = spark.range(10).select("id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"))
    assert "Broadcast" not in many.join(spark.range(10), "id")._jdf.queryExecution().sparkPlan().toString()
    spread(spark, 0)


def test_sorted_matching_folds_mixed_groups_only(spark):
    """Groups whose detections have one candidate each are matched without a fold, as the fold would match them."""
    rng = random.Random(3)
    rows = []
    for image in range(40):
        for det in range(rng.randint(1, 6)):
            boxes = rng.sample(range(3), 2 if image % 4 == 0 and det == 0 else 1)
            conf = rng.choice([0.3, 0.6, 0.9])
            rows += [(image, 0, 10 * image + det, conf, 10 * image + g, rng.choice([0.0001, 0.5, 0.55, 0.8, 0.95])) for g in boxes]
    pairs = spark.createDataFrame(rows, "image_id long, class_id int, det_id long, confidence double, gt_id long, iou double")
    for cuts in (matching.THRESHOLDS, (0.5,), (0.0, 0.75)):
        got, want = (sorted(tuple(r) for r in f(pairs, ["image_id", "class_id"], cuts).collect()) for f in (matching._sorted_match, matching._fold_match))
        assert got == want and want


def test_matching_makes_its_pairs_once(detections, truth, scene):
    """One join finds the candidates, groups with doubtful detections included, and the classes of both sides come along."""
    plan = matching.match_any_class(detections, truth)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1
    classes = {r[2]: r[1] for r in scene}, {r["gt_id"]: r["class_id"] for r in truth.collect()}
    for rows in (2000, 4):
        got = matching.match_any_class(detections, truth, group_rows=rows).collect()
        assert got and all((r["class_id"], r["gt_class"]) == (classes[0][r["det_id"]], classes[1][r["gt_id"]]) for r in got)


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_confusion_counts_without_joins(spark):
    """No row is joined back to its match; classes outside the list and none are the background, as when every row is looked up."""
    rng = random.Random(5)
    kinds = [0, 1, 2, 7, None]
    det = [(i % 30, rng.choice(kinds), i) for i in range(200)]
    gt = [(i % 30, rng.choice(kinds), 1000 + i) for i in range(150)]
    hits = [(d[0], d[2], g[2], d[1], g[1]) for d, g in zip(det, gt, strict=False) if rng.random() < 0.6]
    dets = spark.createDataFrame(det, "image_id long, class_id int, det_id long")
    truth = spark.createDataFrame(gt, "image_id long, class_id int, gt_id long")
    matches = spark.createDataFrame(hits, "image_id long, det_id long, gt_id long, class_id int, gt_class int")
    want = {(g, p): 0 for g in range(4) for p in range(4)}
    cells = [(h[4], h[3]) for h in hits]
    cells += [(3, d[1]) for d in det if d[2] not in {h[1] for h in hits}] + [(g[1], 3) for g in gt if g[2] not in {h[2] for h in hits}]
    for g, p in cells:
        want[tuple(3 if c in (7, None) else c for c in (g, p))] += 1
    for given in (matches, matches.select("det_id", "gt_id")):
        got = metrics.confusion_matrix(dets, truth, given)
        assert {(r["gt_class"], r["pred_class"]): r["n"] for r in got.collect()} == want
    assert _plan(metrics.confusion_matrix(dets, truth, matches)).count("Join") == 1  # the grid


def test_class_metrics_without_joins(detections, truth):
    matches = durable(matching.match_same_class(detections, truth))
    got = metrics.matched_class_metrics(detections, truth, matches)
    want = metrics.per_class_metrics(matching.labelled_detections(detections, matches), truth)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "det_id" not in [w for line in _plan(got).split("\n") if "Join" in line for w in line.replace("#", " ").replace("[", " ").split()]


def test_taxonomy_reads_the_matching_once(detections, truth, scene):
    """The matching is one part of the plan, with the join that finds its candidates, and no other row is joined."""
    gts = {r["gt_id"]: r["class_id"] for r in truth.collect()}
    matches = matching.match_any_class(detections, truth)
    got = matching.error_taxonomy(detections, truth, matches)
    hit = {r["det_id"]: r["gt_id"] for r in matches.collect()}
    want = [(r[2], "FP" if r[2] not in hit else "TP" if gts[hit[r[2]]] == r[1] else "WC") for r in scene]
    want += [(g, "FN") for g in gts if g not in hit.values()]
    assert _rows(got, "box_id", "tag") == sorted(want) and _plan(got).count("Join") == 1


def test_migration_keeps_datasets_apart_from_tasks(spark):
    """Rows of one dataset never meet in one task by their dataset."""
    apply_runtime(spark)
    images = spark.createDataFrame([("d", "train", i) for i in range(3)], "dataset_id string, split string, image_id long")
    rows = images.withColumns({"ann_id": F.col("image_id"), "category_id": F.lit(0), **{c: F.lit(1.0) for c in "xywh"}})
    cats = spark.createDataFrame([("d", i, n) for i, n in ingest.CANONICAL_SET.items()], "dataset_id string, category_id int, name string")
    tables, report = ingest.migrate_dataset(images, rows, cats, rows.filter(F.lit(False)))
    assert tables["annotations"].count() == 3 and [r["action"] for r in report.collect()] == ["migrate"]
    plan = tables["annotations"]._jdf.queryExecution().sparkPlan().toString().split("\n")
    joins = [line for line in plan if "Join" in line and "dataset_id" in line and ("Inner" in line or "LeftSemi" in line)]
    assert joins and all("BroadcastHashJoin" in line for line in joins)


def test_joins_of_one_image_send_no_rows(spark):
    """Tables that are dealt by image are matched by class where they are."""
    box = "cast(id % 7 AS double) AS x1, cast(0 AS double) AS y1, cast(id % 7 + 9 AS double) AS x2, cast(9 AS double) AS y2"
    own = spark.sql(f"SELECT id % 50 AS image_id, cast(id % 3 AS int) AS class_id, id AS gt_id, id AS det_id, 0.5D AS confidence, {box} FROM range(600)")
    dealt = own.repartition(4, "image_id")
    plan = matching.iou_pairs(dealt, dealt.drop("confidence", "det_id"), 0.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    got = _rows(matching.match_same_class(dealt, dealt.drop("confidence", "det_id")), "det_id", "class_id", "threshold")
    assert {(c, d % 3) for d, c, _ in got} == {(0, 0), (1, 1), (2, 2)}


def test_fusion_of_small_groups_is_that_of_members(spark):
    """Fused without a join, by either strategy, with implausible shapes undone, null corners, ties and a disabled class."""
    rnd = random.Random(6)
    rows = [(i % 9, i % 4, i, rnd.choice([.3, .5, .9]), x, y, x + w, y + h) for i in range(400)
            for x, y, w, h in [(rnd.randrange(0, 900), rnd.randrange(0, 300), rnd.choice([2, 40, 700]), rnd.choice([1, 30]))]]
    rows += [(0, 0, 1000, .5, None, 1.0, 2.0, 3.0), (0, 0, 1001, .5, float("nan"), 1.0, 2.0, 3.0)]
    df = spark.createDataFrame([(a, b, c, d, *[None if v is None else float(v) for v in e]) for a, b, c, d, *e in rows],
                               "image_id long, class_id int, det_id long, confidence double, x1 double, y1 double, x2 double, y2 double")
    names = ("image_id", "class_id", "det_id", "confidence", "x1", "y1", "x2", "y2", "source", "num_members")
    for cfg in (fragments.Fusion(disabled_classes=(3,)), fragments.Fusion(strategy="weighted", max_distance_px=90.0, max_aspect_ratio=8.0)):
        want = fragments.fuse_components(fragments.near_components(df, cfg, 0, 0), cfg)
        merged = fragments.merge_fragments(df, cfg)
        short = [F.round(c, 9).alias(c) if c[0] in "xy" or c == "confidence" else F.col(c) for c in names]
        assert sorted(map(str, merged.select(*short).collect())) == sorted(map(str, want.select(*short).collect()))
        assert {r.source for r in merged.collect()} == {"merged", "tile"}
        plan = fragments._fuse_small(fragments._members(df, cfg, 256, 2000, True)[0], cfg)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan
