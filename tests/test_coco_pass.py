"""COCO documents read in one pass."""

import json

import pytest

from detlake.sources import readers


def test_entries_equal_the_three_tables_and_documents_are_read_once(spark, tmp_path):
    doc = {"images": [{"id": 1, "file_name": "a }.png", "width": 4, "height": 3}, {"id": None, "file_name": "b.png", "width": 4, "height": 3, "note": "}"}],
           "annotations": [{"id": 7, "image_id": 1, "category_id": 0, "bbox": [1, 2, 3, 4], "area": 12.5, "iscrowd": 1},
                           {"id": 8, "image_id": 1, "category_id": 2, "bbox": [0, 0, 1, 1], "area": None, "more": {"n": [1, None]}, "tier": "strong"}],
           "categories": [{"id": 0, "name": "ships"}, {"id": 2, "name": "airplanes", "supercategory": "air"}]}
    (tmp_path / "instances_val.json").write_text(json.dumps(doc))
    (tmp_path / "instances_test.json").write_text(json.dumps({**doc, "annotations": []}))
    three, one = readers.read_coco(spark, str(tmp_path)), readers.read_coco_entries(spark, str(tmp_path))
    for name, df in three.items():
        flat = one.filter(one["kind"] == name).select("path", "split", f"{name}.*", "props").withColumnsRenamed(readers.COCO_IDS[name])
        assert flat.columns == df.columns and sorted(map(str, flat.collect())) == sorted(map(str, df.collect()))
    assert [json.loads(r["props"]) if r["props"] else None for r in three["annotations"].orderBy("ann_id").collect()] == [None, {"more": {"n": [1, None]}, "tier": "strong"}]
    assert sorted(map(str, readers.read_coco_categories(spark, str(tmp_path)).collect())) == sorted(map(str, three["categories"].collect()))
    assert one._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    (tmp_path / "instances_bad.json").write_text('{"images": [], "annotations": []}')
    with pytest.raises(Exception, match="not a COCO document"):
        readers.read_coco_entries(spark, str(tmp_path)).collect()
