"""Registered queries against DuckDB at the smallest scale. DETLAKE_ALL=1 runs all of them."""

import os

import pytest

from detlake.plans import library
from tools.compare import compare

FOLDER = "/root/testdata/sf0.001"
CORE = ("box_geometry", "tile_annotations", "background_images", "nms", "fragment_components", "match_same_class", "per_class_metrics",
        "average_precision", "assign_split", "frames_to_coco", "validate_coco", "mission_report", "project_corners", "select_components",
        "upsert_dataset", "patch_run", "directory_hash", "split_hash", "plan_retention", "stage_states", "loss_trend", "stream_stage_states",
        "lookup_predictions", "index_by_image")
JOBS, SQL = library.jobs(), library.oracles()


def test_oracle_names():
    assert set(SQL) <= set(JOBS) and set(JOBS) - set(SQL) == {"evaluation_report"}


@pytest.mark.parametrize("name", list(JOBS) if os.environ.get("DETLAKE_ALL") else CORE)
def test_query(spark, name):
    text = compare(spark, FOLDER, name, JOBS[name], SQL.get(name))
    assert not text.startswith("FAIL"), text
