"""Schemas of the tables this package owns, as DDL."""

from __future__ import annotations

# fixed values: registry tables, keys and references
REGISTRY = {
    "datasets": ("dataset_id string, name string, created_at timestamp, source string, storage_path string, annotation_format string, "
                   "num_images bigint, num_annotations bigint, num_classes int, status string, content_hash string, notes string"),
    "images": ("image_id string, dataset_id string, split string, file_name string, width int, height int, storage_path string, "
                 "has_objects boolean, source_frame_id string"),
    "annotations": ("annotation_id string, dataset_id string, image_id string, category_id int, bbox_xywh string, area double, "
                      "iscrowd boolean, source_annotation_id string"),
    "pipeline_runs": ("run_id string, dataset_id string, started_at timestamp, finished_at timestamp, status string, config_path string, "
                        "config_snapshot_path string, mlflow_run_id string, error string, current_stage string, model_name string, "
                        "tile_cache_id string"),
    "tile_caches": ("tile_cache_id string, dataset_id string, dataset_hash string, split_hash string, tile_config_hash string, "
                      "storage_path string, num_train_tiles bigint, num_val_tiles bigint, num_test_tiles bigint, created_at timestamp, "
                      "status string, config_snapshot_path string"),
    "artifacts": ("artifact_id string, run_id string, artifact_type string, storage_path string, created_at timestamp, content_hash string"),
    "model_checkpoints": ("checkpoint_id string, run_id string, checkpoint_type string, epoch int, metric_name string, metric_value double, "
                            "storage_path string, created_at timestamp"),
    "evaluation_reports": ("report_id string, run_id string, checkpoint_id string, metrics_path string, report_path string, "
                             "created_at timestamp, primary_metric_name string, primary_metric_value double"),
}
PRIMARY_KEYS = {"datasets": "dataset_id", "images": "image_id", "annotations": "annotation_id", "pipeline_runs": "run_id",
                "tile_caches": "tile_cache_id", "artifacts": "artifact_id", "model_checkpoints": "checkpoint_id",
                "evaluation_reports": "report_id"}
FOREIGN_KEYS = (
    ("images", "dataset_id", "datasets", "dataset_id"),
    ("annotations", "dataset_id", "datasets", "dataset_id"),
    ("annotations", "image_id", "images", "image_id"),
    ("pipeline_runs", "dataset_id", "datasets", "dataset_id"),
    ("tile_caches", "dataset_id", "datasets", "dataset_id"),
    ("artifacts", "run_id", "pipeline_runs", "run_id"),
    ("model_checkpoints", "run_id", "pipeline_runs", "run_id"),
    ("evaluation_reports", "run_id", "pipeline_runs", "run_id"),
    ("evaluation_reports", "checkpoint_id", "model_checkpoints", "checkpoint_id"),
)
PARTITIONS = {"images": ["dataset_id", "split"], "annotations": ["dataset_id"], "artifacts": ["run_id"],
              "model_checkpoints": ["run_id"], "evaluation_reports": ["run_id"], "tile_caches": ["dataset_id"]}

# fields of a COCO document's lists; others are kept as JSON text
COCO = {"images": "id bigint, file_name string, width int, height int",
        "annotations": "id bigint, image_id bigint, category_id int, bbox array<double>, area double, iscrowd int",
        "categories": "id int, name string"}
FRAME = ("schema_version string, frame_id string, timestamp_utc string, usable boolean, invalid_reasons array<string>, "
           "scene struct<scene_id:string,mission_id:string,weather:string,time_of_day:string,sea_state:int,scenario_mode:string>, "
           "sync struct<frame_token:string,strict_sync_valid:boolean,stale_screenshot_check_passed:boolean>, "
           "image struct<file_name:string,width:int,height:int>, "
           "camera struct<height_asl_m:double,euler_deg:struct<yaw:double,pitch:double,roll:double>,"
           "world_position_m:struct<x:double,y:double,z:double>>, "
           "objects array<struct<id:string,class:string,type_name:string,quality_tier:string,confidence_source:string,"
           "dimensions_source:string,distance_to_camera_m:double,validation:struct<valid:boolean>,"
           "projection:struct<bbox_xyxy_px:array<double>>>>")
TILE_PREDICTIONS = ("images array<struct<image_id:bigint,tiles:array<struct<scale_name:string,crop_offset:array<int>,"
                      "detections:array<struct<class_id:int,confidence:double,bbox_crop:array<double>>>>>>>")
EVENT = ("event_schema_version int, run_id string, stage string, status string, current bigint, total bigint, message string, "
           "payload struct<epoch:int,max_epoch:int,iter:int,max_iter:int,loss:double,lr:double,eta_seconds:double,error:string>, created_at string")
COMMAND = ("run_id string, dataset_id string, mission_path string, dcs_config_path string, dcs_source_dataset_dir string, "
             "target_dataset_dir string, num_frames int, timeout_sec int")
STATUSES = ("queued", "running", "success", "failed", "stopped")
