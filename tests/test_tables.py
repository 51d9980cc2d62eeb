"""Sources, sinks, registry and streams on small files."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from detlake.operators import hashing, ingest, metrics, matching, quality, registry, retention
from detlake.schemas import REGISTRY
from detlake.sources import readers, sinks, versions
from detlake.streaming import events as live


def _coco(path, split, shift):
    doc = {"images": [{"id": shift + i, "file_name": f"frame_{split}_{i}.png", "width": 2560, "height": 1440} for i in range(3)],
           "annotations": [{"id": shift + k, "image_id": shift + 1 + k % 2, "category_id": k % 3, "bbox": [200 + 100 * k, 200, 80, 60], "area": 7.5 + k, "iscrowd": k % 2,
                            "quality_tier": "strong", "more": {"n": [1, "1", None, True]}} for k in range(4)],
           "categories": [{"id": 0, "name": "ships"}, {"id": 1, "name": "helicopters"}, {"id": 2, "name": "airplanes"}]}
    (path / f"instances_{split}.json").write_text(json.dumps(doc, indent=2))
    return doc


def test_coco_round_trip(spark, tmp_path):
    docs = {s: _coco(tmp_path, s, 100 * i) for i, s in enumerate(("train", "val"))}
    t = readers.read_coco(spark, str(tmp_path))
    assert t["images"].count() == 6 and t["annotations"].filter("split = 'val'").count() == 4
    a = t["annotations"].select("split", "ann_id", "image_id", "category_id", "area", "iscrowd", "props", *[F.get("bbox", i).alias(c) for i, c in enumerate("xywh")])
    out = {r["split"]: json.loads(r["document"]) for r in sinks.coco_documents(t["images"], a, t["categories"]).collect()}
    assert out["val"] == docs["val"] and out["train"] == docs["train"]
    sinks.write_coco_documents(sinks.coco_document_lines(t["images"], a, t["categories"]), str(tmp_path / "lines"))
    for split in docs:
        assert json.loads("".join(f.read_text() for f in sorted((tmp_path / "lines" / f"split={split}").glob("part-*")))) == docs[split]
    assert [i["file_name"] for i in out["train"]["images"]] == [i["file_name"] for i in docs["train"]["images"]]
    (tmp_path / "bad.json").write_text("[1, 2]")
    with pytest.raises(ValueError):
        readers.read_coco(spark, str(tmp_path))


def test_strict_and_tolerant_lines(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "e.jsonl").write_text('{"run_id": "r", "stage": "train", "status": "running"}\n{"run_id": "r", "sta')
    assert readers.read_manifest(spark, str(tmp_path / "m.jsonl"), "a int").count() == 2
    assert readers.count_records(spark, str(tmp_path / "m.jsonl")) == 2 and readers.count_records(spark, str(tmp_path / "none")) == 0
    good, torn = readers.read_events_tolerant(spark, str(tmp_path / "e.jsonl"))
    assert good.count() == 1 and torn.count() == 1
    with pytest.raises(Exception):
        readers.read_manifest(spark, str(tmp_path / "e.jsonl"), "run_id string, stage string").collect()


def test_frames_labels_predictions_files(spark, tmp_path):
    for d in ("frames", "labels", "pred"):
        (tmp_path / d).mkdir()
    frame = {"frame_id": "f1", "usable": True, "image": {"file_name": "f1.png", "width": 100, "height": 50}, "scene": {"mission_id": "m"},
             "objects": [{"id": "o", "class": "ships", "quality_tier": "strong", "validation": {"valid": True}, "projection": {"bbox_xyxy_px": [1, 2, 30, 40]}}]}
    (tmp_path / "frames" / "f1.json").write_text(json.dumps(frame))
    (tmp_path / "frames" / "f2.json").write_text("{oops")
    docs, bad = readers.read_frames(spark, str(tmp_path / "frames"))
    frames, objects = readers.frame_tables(docs)
    assert (docs.count(), bad.count()) == (1, 1)
    assert objects.first()["x2"] == 30.0 and frames.first()["mission_id"] == "m"
    (tmp_path / "labels" / "f1.txt").write_text("0 0.5 0.5 0.1 0.1\nx 1 2\n")
    rows = readers.read_yolo_labels(spark, str(tmp_path / "labels")).orderBy("line_no").collect()
    assert [r["class_id"] for r in rows] == [0, None]
    pred = {"images": [{"image_id": 1, "tiles": [{"scale_name": "s", "crop_offset": [320, 0], "detections": [{"class_id": 1, "confidence": 0.5, "bbox_crop": [1, 2, 3, 4]}]}, {"scale_name": "e", "detections": []}]}]}
    (tmp_path / "pred" / "p.json").write_text(json.dumps(pred))
    keys, boxes = readers.read_tile_predictions(spark, str(tmp_path / "pred"))
    assert keys.count() == 2 and boxes.first()["ox"] == 320 and boxes.first()["b_y2"] == 4.0
    listed = readers.list_files(spark, str(tmp_path), ("*.json", "f1.*"))
    assert sorted(r["relpath"] for r in listed.select("relpath").collect()) == ["frames/f1.json", "frames/f2.json", "labels/f1.txt", "pred/p.json"]


def test_publish_reuse_and_sinks(spark, tmp_path):
    target = str(tmp_path / "t")
    df, state = sinks.materialize_once(spark, target, lambda: spark.range(5))
    again, state2 = sinks.materialize_once(spark, target, lambda: spark.range(99))
    assert (state, state2, again.count()) == ("created", "reused", 5)
    sinks.publish(spark.read.parquet(target).filter("id > 2"), target)  # reads what it replaces
    assert spark.read.parquet(target).count() == 2
    assert sinks.append_manifest(spark.range(3), str(tmp_path / "m")) == 3
    assert sinks.append_manifest(spark.range(2), str(tmp_path / "m")) == 2
    assert len(sinks.init_registry(spark, str(tmp_path / "reg"))) == 8 and sinks.init_registry(spark, str(tmp_path / "reg")) == []
    assert readers.read_registry(spark, str(tmp_path / "reg"), "artifacts").columns[0] == "artifact_id"
    per = spark.createDataFrame([(0, "ships", 1)], "class_id int, class_name string, tp int")
    sinks.write_metric_tables(metrics.key_values(per), per, per, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "summary")).count() == 3


def test_registry_errors(spark):
    runs = spark.createDataFrame([("r1", "d1", "running"), ("r2", None, "failed")], "run_id string, dataset_id string, status string")
    with pytest.raises(registry.IntegrityError):
        registry.insert_unique(runs, runs.limit(1), ["run_id"])
    with pytest.raises(KeyError):
        registry.patch(runs, runs.withColumn("run_id", F.lit("rx")).limit(1), "run_id", ["status"])
    with pytest.raises(registry.IntegrityError):
        registry.fk_check({"pipeline_runs": runs, "datasets": spark.createDataFrame([], REGISTRY["datasets"])})
    used = spark.createDataFrame([("2024_01_02_001",), ("2024_01_02_003",), ("other",)], "run_id string")
    assert registry.next_run_id(used, dt.date(2024, 1, 2)).first()[0] == "2024_01_02_002"
    full = spark.range(1, 1000).select(F.format_string("2024_01_02_%03d", "id").alias("run_id"))
    assert registry.next_run_id(full, dt.date(2024, 1, 2)).first()[0] is None


def test_unmapped_class_and_strict_validation(spark):
    a = spark.createDataFrame([(1, 9)], "ann_id int, category_id int")
    with pytest.raises(ValueError):
        ingest.remap_categories(a)
    images = spark.createDataFrame([(1, "", 0, 5)], "image_id int, file_name string, width int, height int")
    anns = spark.createDataFrame([], "ann_id int, image_id int, category_id int, bbox array<double>, area double, iscrowd int")
    cats = spark.createDataFrame([(0, "ships")], "category_id int, name string")
    assert quality.validate_coco(images, anns, cats).count() == 2
    with pytest.raises(quality.ValidationError):
        quality.validate_coco(images, anns, cats, strict=True)


def test_metrics_by_hand(spark):
    det = spark.createDataFrame([(1, 0, 1, 0.9, 0.0, 0.0, 10.0, 10.0), (1, 0, 2, 0.8, 50.0, 50.0, 60.0, 60.0), (1, 7, 3, 0.7, 0.0, 0.0, 5.0, 5.0)],
                                "image_id bigint, class_id int, det_id bigint, confidence double, x1 double, y1 double, x2 double, y2 double")
    gt = spark.createDataFrame([(1, 0, 1, 0.0, 0.0, 10.0, 10.0), (1, 1, 2, 50.0, 50.0, 60.0, 60.0)],
                               "image_id bigint, class_id int, gt_id bigint, x1 double, y1 double, x2 double, y2 double")
    m = matching.match_same_class(det, gt)
    rows = {r["class_id"]: r for r in metrics.per_class_metrics(matching.labelled_detections(det, m), gt).collect()}
    assert (rows[0]["tp"], rows[0]["fp"], rows[0]["fn"], rows[1]["fn"], rows[2]["f1"]) == (1, 1, 0, 1, 0.0)
    ap = {r["class_id"]: r["ap"] for r in metrics.average_precision(det, gt, m, (0.5,)).collect()}
    assert ap == {0: pytest.approx(1.0), 1: 0.0, 2: 0.0}
    cm = {(r["gt_class"], r["pred_class"]): r["n"] for r in metrics.confusion_matrix(det, gt, matching.match_any_class(det, gt)).collect()}
    assert (cm[0, 0], cm[1, 0], cm[3, 3], cm[3, 0]) == (1, 1, 1, 0)


def test_hashes_match_hashlib(spark):
    import hashlib
    files = {"b.txt": "two", "a/x.txt": "one"}
    df = spark.createDataFrame([("r", k, v) for k, v in files.items()], "root string, relpath string, content string")
    leaves = {}
    for k in sorted(files):
        leaves.setdefault(hashlib.md5(k.encode()).hexdigest()[:3], []).append(k + "\0" + hashlib.sha256(files[k].encode()).hexdigest() + "\n")
    text = "".join(f"{n}:{hashlib.sha256(''.join(leaves[n]).encode()).hexdigest()}\n" for n in sorted(leaves))
    assert hashing.directory_hash(df).first()["sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_hash_of_a_root_depends_on_its_own_files(spark):
    own = [("r", f"f{i:03d}", f"text {i}") for i in range(50)]
    more = [("q", f"g{i:03d}", f"text {i}") for i in range(37)]
    of = lambda rows, n: {r["root"]: r["sha256"] for r in hashing.directory_hash(spark.createDataFrame(rows, "root string, relpath string, content string").repartition(n)).collect()}
    assert of(own, 1)["r"] == of(own[::-1] + more, 4)["r"] != of(own[1:], 2)["r"]


def test_retention(spark):
    runs = spark.createDataFrame([(f"r{i}", dt.datetime(2024, 1, 1 + i), f"tc{i}", float(i % 3)) for i in range(10)], "run_id string, started_at timestamp, tile_cache_id string, best_metric double")
    policy = retention.Policy(keep_last=2, keep_best=1, max_age_days=None)
    kept = retention.keep_runs(runs, policy, F.lit(None).cast("timestamp"))
    assert {r[0] for r in kept.collect()} == {"r9", "r8", "r2"}


def test_commands_stream_once(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    whole = {f: "x" for f in live.COMMAND_FIELDS}
    (src / "b.command.json").write_text(json.dumps(whole, indent=1))
    (src / "a.command.json").write_text('{"run_id": "x"')
    live.ingest_commands(live.stream_command_files(spark, str(src)), out).awaitTermination()
    (src / "c.command.json").write_text(json.dumps({**whole, "extra": 1}))
    (src / "note.json").write_text("{}")
    live.ingest_commands(live.stream_command_files(spark, str(src)), out).awaitTermination()
    rows = {r["file_name"]: (r["accepted"], r["batch"]) for r in live.read_log(spark, out).collect()}
    assert rows == {"a.command.json": (False, 0), "b.command.json": (True, 0), "c.command.json": (True, 1)}


READINGS = "run_id string, seq bigint, iter bigint, t double"


def _feed(spark, folder, name, lines):
    """One file of the log, newer than those before it."""
    (folder / f"{name}.json").write_text("\n".join(json.dumps(e) for e in lines))
    os.utime(folder / f"{name}.json", (1_700_000_000 + name, 1_700_000_000 + name))
    return spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).json(str(folder))


def _throttled(lines, every, seconds):
    want, last = [], {}
    for e in sorted(lines, key=lambda e: e["seq"]):
        if e["iter"] % every == 0 or e["t"] - last.get(e["run_id"], float("-inf")) >= seconds:
            last[e["run_id"]] = e["t"]
            want.append((e["run_id"], e["seq"]))
    return sorted(want)


def test_readings_out_of_order_over_batches(spark, tmp_path):
    """One file a trigger, files and rows shuffled within the lateness, two starts of the query: as if read in order."""
    src, out, rates = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "rates")
    src.mkdir()
    rnd = random.Random(4)
    lines = [{"run_id": rnd.choice("ab"), "seq": i, "iter": i % 97, "t": float(i) + rnd.random()} for i in range(160)]
    parts = [lines[20 * (k ^ 1):20 * (k ^ 1) + 20] for k in range(8)]
    for k, part in enumerate(parts):
        rnd.shuffle(part)
        stream = _feed(spark, src, k, part)
        if k == 3:
            live.to_change_log(live.throttle_progress(stream, 10, 4.0, 60), out, "append").awaitTermination()
    waited = live.read_log(spark, out).count()
    stream = _feed(spark, src, 100, [{"run_id": None, "seq": 1000, "iter": None, "t": None}])
    live.to_change_log(live.throttle_progress(stream, 10, 4.0, 60), out, "append").awaitTermination()
    assert sorted((r.run_id, r.seq) for r in live.read_log(spark, out).collect()) == _throttled(lines, 10, 4.0) and waited < len(_throttled(lines, 10, 4.0))
    live.to_change_log(live.stream_throughput(stream, 60), rates, "append").awaitTermination()
    want = []
    for run in "ab":
        own = [e for e in lines if e["run_id"] == run]
        want += [(run, y["seq"], round((y["iter"] - x["iter"]) / (y["t"] - x["t"]), 6)) for x, y in zip(own, own[1:]) if y["iter"] > x["iter"] and y["t"] > x["t"]]
    assert sorted((r.run_id, r.seq, round(r.iters_per_second, 6)) for r in live.read_log(spark, rates).collect()) == sorted(want)


def test_marks_beside_readings_of_numbered_runs(spark, tmp_path):
    """A mark that shares a batch with readings leaves numbered runs their own states."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    lines = [{"run_id": i % 40, "seq": i, "iter": i % 97, "t": float(i)} for i in range(640)]
    for k, part in enumerate((lines[:500], lines[500:] + [{"run_id": None, "seq": 5000, "iter": None, "t": None}])):
        _feed(spark, src, k, part)
    stream = spark.readStream.schema("run_id long, seq long, iter long, t double").option("maxFilesPerTrigger", 1).json(str(src))
    live.to_change_log(live.throttle_progress(stream, 10, 40.0, 60), out, "append").awaitTermination()
    assert sorted((r.run_id, r.seq) for r in live.read_log(spark, out).collect()) == _throttled(lines, 10, 40.0)


def test_rows_behind_the_watermark_are_late(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    _feed(spark, src, 0, [{"run_id": "a", "seq": 1, "iter": 10, "t": 1.0}, {"run_id": "b", "seq": 900, "iter": 10, "t": 2.0}])
    _feed(spark, src, 1, [{"run_id": "a", "seq": 950, "iter": 10, "t": 3.0}])
    _feed(spark, src, 2, [{"run_id": "a", "seq": 2, "iter": 10, "t": 4.0}])
    stream = _feed(spark, src, 3, [{"run_id": None, "seq": 5000, "iter": None, "t": None}])
    live.to_change_log(live.throttle_progress(stream, 10, 4.0, 60), out, "append").awaitTermination()
    assert sorted((r.run_id, r.seq) for r in live.read_log(spark, out).collect()) == [("a", 1), ("a", 950), ("b", 900)]


def test_state_grows_by_buckets_of_runs(spark, tmp_path):
    """Many runs share a state value and a call; the readings are those of each run on its own."""
    src, out, rates = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "rates")
    src.mkdir()
    lines = [{"run_id": i % 3000, "seq": i, "iter": i // 7, "t": float(i)} for i in range(6000)]
    _feed(spark, src, 0, lines[3000:])
    _feed(spark, src, 1, lines[:3000] + [{"run_id": None, "seq": 20000, "iter": None, "t": None}])
    stream = spark.readStream.schema("run_id long, seq long, iter long, t double").option("maxFilesPerTrigger", 1).json(str(src))
    done = live.to_change_log(live.throttle_progress(stream, 10, 3500.0, 8000), out, "append")
    done.awaitTermination()
    assert sorted((r.run_id, r.seq) for r in live.read_log(spark, out).collect()) == _throttled(lines, 10, 3500.0)
    assert max(p.stateOperators[0].numRowsTotal for p in done.recentProgress if p.stateOperators) < 3000
    live.to_change_log(live.stream_throughput(stream, 8000), rates, "append").awaitTermination()
    want = sorted((i % 3000, i, (i // 7 - (i - 3000) // 7) / 3000) for i in range(3000, 6000))
    assert sorted(map(tuple, live.read_log(spark, rates).select("run_id", "seq", "iters_per_second").collect())) == want


def test_statuses_without_state(spark, tmp_path):
    """Folds of batches, folded again: no state rows, and rows late by any time count."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    rows = [("r", 3, 30, "success", None), ("r", 1, 10, "running", "p1"), ("q", 2, 20, None, "p2"), ("r", 9, 90, "failed", None), ("q", 4, 40, "lost", "p3"), ("r", 2, 20, None, "p0")]
    for i, (run, seq, ts, status, phase) in enumerate(rows):
        (src / f"{i}.json").write_text(json.dumps({"run_id": run, "seq": seq, "ts": ts, "status": status, "phase": phase}))
    stream = spark.readStream.schema("run_id string, seq bigint, ts bigint, status string, phase string").option("maxFilesPerTrigger", 1).json(str(src))
    done = live.partials_log(stream, out, lambda batch: live.status_parts(batch, ["phase"]))
    done.awaitTermination()
    assert all(not p["stateOperators"] for p in (json.loads(x.json) if hasattr(x, "json") else x for x in done.recentProgress))
    want = [("q", None, "p2", None), ("r", "failed", "p0", 30)]
    log = live.read_log(spark, out)
    assert sorted(tuple(r) for r in live.merge_status(log, ["phase"]).collect()) == want
    small = live.compact(spark, out, lambda parts: live.merge_parts(parts, ["phase"]), str(tmp_path / "compact"))
    assert small.count() == 2 and sorted(tuple(r) for r in live.merge_status(small, ["phase"]).collect()) == want


def test_event_stream_drops_torn_lines(spark, tmp_path):
    src = tmp_path / "ev"
    src.mkdir()
    (src / "e.jsonl").write_text('{"run_id":"r","stage":"train","status":"running"}\n{"run_id":"r","st')
    out = str(tmp_path / "log")
    live.to_change_log(live.stream_events(spark, str(src)), out, "append").awaitTermination()
    assert live.read_log(spark, out).count() == 1


def test_equal_entries_of_a_document_keep_their_commas(spark):
    images = spark.createDataFrame([("a", 1, "x.png", 4, 4)] * 3 + [("a", 2, "y.png", 4, 4), ("b", 5, "z.png", 4, 4)], "split string, image_id long, file_name string, width int, height int")
    anns = spark.createDataFrame([("a", 9, 1, 0, 0.0, 0.0, 1.0, 1.0)] * 2 + [("a", None, 1, 0, 0.0, 0.0, 1.0, 1.0)] * 2, "split string, ann_id long, image_id long, category_id int, x double, y double, w double, h double")
    cats = spark.createDataFrame([("a", 0, "ships"), ("b", 0, "ships")], "split string, category_id int, name string")
    text = {}
    for r in sinks.coco_document_lines(images, anns, cats).collect():
        text[r.split] = text.get(r.split, "") + r.line + "\n"
    documents = {k: json.loads(v) for k, v in text.items()}
    assert [e["id"] for e in documents["a"]["images"]] == [1, 1, 1, 2] and sorted(str(e.get("id")) for e in documents["a"]["annotations"]) == ["9", "9", "None", "None"]
    assert documents["b"] == {"images": [{"id": 5, "file_name": "z.png", "width": 4, "height": 4}], "annotations": [], "categories": [{"id": 0, "name": "ships"}]}


def test_migration_keeps_refuses_and_reports(spark):
    images = spark.createDataFrame([(d, "train", 1) for d in ("new", "same", "other", "odd")], "dataset_id string, split string, image_id long")
    old = list(ingest.LEGACY_SET.items())
    cats = spark.createDataFrame([(d, i, n) for d in ("new", "same", "other") for i, n in old] + [("odd", 0, "trees")], "dataset_id string, category_id int, name string")
    rows = spark.createDataFrame([(d, "train", 1, a, 0, 0.0, 0.0, 1.0, float(a)) for d in ("new", "same", "other", "odd") for a in (1, 2, 2)],
                                 "dataset_id string, split string, image_id long, ann_id long, category_id int, x double, y double, w double, h double")
    stored = ingest.migrate_dataset(images, rows, cats)[0]["annotations"].where("dataset_id <> 'new'")
    stored = stored.withColumn("w", F.when((F.col("dataset_id") == "other") & (F.col("ann_id") == 1), 7.0).otherwise(F.col("w")))
    tables, report = ingest.migrate_dataset(images, rows, cats, stored)
    assert {r.dataset_id: r.action for r in report.collect()} == {"new": "migrate", "same": "keep", "other": "refuse", "odd": "unknown"}
    assert {r.dataset_id for name in ("images", "annotations", "categories") for r in tables[name].select("dataset_id").collect()} == {"new"}
    assert tables["annotations"].count() == 3


def test_versions_survive_crashes(spark, tmp_path):
    root = str(tmp_path / "caches")
    hashes = {"dataset_hash": "a" * 64, "split_hash": "b" * 64, "tile_config_hash": "c" * 64}
    key = "__".join(c * 12 for c in "abc")
    assert versions.cache_meta(spark, root).count() == 0

    def tiles(n, split="train"):
        return lambda: spark.range(n).withColumn("split", F.lit(split))

    rows, info = versions.build_or_reuse(spark, root, hashes, tiles(5))
    assert (info["status"], info["num_train_tiles"], info["num_val_tiles"], rows.count()) == ("created", 5, 0, 5)
    rows, info = versions.build_or_reuse(spark, root, hashes, tiles(9))
    assert (info["status"], rows.count()) == ("reused", 5)

    # a build that fails leaves the table as it was
    with pytest.raises(Exception):
        versions.build_or_reuse(spark, root, hashes, lambda: tiles(3)().withColumn("x", F.raise_error(F.lit("no"))), force=True)
    # so does a version that was written but not committed, and a commit cut off in the middle
    os.makedirs(f"{root}/{key}/data/v-left")
    for number, text in ((7, ""), (8, '{"number": 8, "version": "v-left", "ro')):
        with open(f"{root}/{key}/commits/{number:012d}.json", "w") as f:
            f.write(text)
    assert versions.read_current(spark, f"{root}/{key}").count() == 5
    rows, info = versions.build_or_reuse(spark, root, hashes, tiles(9))
    assert (info["status"], rows.count()) == ("reused", 5)

    # by force, from the version before; then other splits, layouts and hashes under one id
    rows, info = versions.build_or_reuse(spark, root, hashes, lambda: rows.filter("id > 1"), force=True)
    assert (info["status"], info["number"], rows.count()) == ("rebuilt", 9, 3)
    other = {**hashes, "split_hash": "b" * 12 + "d" * 52}
    rows, info = versions.build_or_reuse(spark, root, other, tiles(4, "val"))
    assert (info["status"], info["num_val_tiles"], rows.count()) == ("rebuilt", 4, 4)
    versions.commit(tiles(2)(), f"{root}/{key}", {**info, "layout_version": 0})
    assert versions.build_or_reuse(spark, root, other, tiles(6))[1]["status"] == "rebuilt"

    # the table of commits serves the state and the path of any number of caches
    meta = versions.cache_meta(spark, root)
    wanted = spark.createDataFrame([(key, *other.values()), (key, *hashes.values())], "tile_cache_id string, dataset_hash string, split_hash string, tile_config_hash string")
    assert sorted(r["state"] for r in hashing.cache_state(wanted, meta).collect()) == ["rebuild", "reused"]
    assert spark.read.parquet(hashing.resolve_cache(wanted, meta).first()["storage_path"]).count() == 6

    # a version that has lost files is not read, and older ones go only on demand
    assert len(versions.drop_superseded(spark, f"{root}/{key}")) == 4
    assert versions.read_current(spark, f"{root}/{key}").count() == 6
    part = next((tmp_path / "caches" / key / "data").glob(f"{versions.current(spark, f'{root}/{key}').version}/split=train/*.parquet"))
    os.truncate(part, 0)
    assert versions.current(spark, f"{root}/{key}") is None
    assert versions.build_or_reuse(spark, root, other, tiles(1))[1]["status"] == "created"

    rows, info = versions.build_or_reuse(spark, root, {**hashes, "dataset_hash": "e" * 64}, tiles(0))
    assert (info["rows"], rows.columns, rows.count()) == (0, ["id", "split"], 0)
    with pytest.raises(ValueError, match="empty"):
        versions.build_or_reuse(spark, root, {**hashes, "dataset_hash": hashing.EMPTY_SHA256}, tiles(1))
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, str(tmp_path / "none"))


def test_evaluation_without_names_reads_truth_once(spark):
    """Ground truth without class names is evaluated as with them, and is computed one time for all results."""
    from detlake.operators import evalmap
    annotations = spark.createDataFrame([(i % 3, i, i % 3, float(40 * i), 0.0, 30.0, 30.0) for i in range(12)], "image_id long, ann_id long, category_id int, x double, y double, w double, h double")
    names = spark.createDataFrame([(0, "ships"), (1, "helicopters"), (2, "airplanes")], "category_id int, name string")
    dets = annotations.selectExpr("image_id", "category_id AS class_id", "ann_id AS det_id", "0.9D - ann_id / 100 AS confidence", "x AS x1", "y AS y1", "x + w AS x2", "y + h AS y2").filter("det_id <> 5")
    rows, found = spark.sparkContext.accumulator(0), []

    def seen(batches):
        for b in batches:
            rows.add(len(b))
            yield b

    for truth in (evalmap.build_gt(annotations, names), evalmap.build_gt(annotations.mapInPandas(seen, annotations.schema))):
        found.append(sorted(map(str, evalmap.evaluate(dets, truth, results=("per_class",))["per_class"].select("class_id", "num_gt", "tp", "ap5095").collect())))
    assert found[0] == found[1] and rows.value == 12
