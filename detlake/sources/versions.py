"""Tables as versions with one commit each: a version is a folder of its own, written first; the commit is one small file with
a number, written last and never replaced.

Readers follow the highest complete commit, so a crash between the steps leaves the table before it readable, and no rename
is needed. Two writers cannot take the same number. A commit names its version, so nothing is read that was not committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from detlake.operators.hashing import EMPTY_SHA256, LAYOUT_VERSION, SCHEMA_VERSION
from detlake.operators.splits import SPLITS
from detlake.sources.sinks import _fs, _path, exists

HASHES = ("dataset_hash", "split_hash", "tile_config_hash")
ENTRY = ("number bigint, version string, rows bigint, files bigint, bytes bigint, tile_cache_id string, dataset_hash string, split_hash string, "
         "tile_config_hash string, status string, schema_version int, layout_version int, splits array<string>, storage_path string")


class Commit(NamedTuple):
    number: int
    version: str
    entry: dict[str, Any]


def _size(spark: SparkSession, path: str) -> tuple[int, int]:
    found = _fs(spark, path).getContentSummary(_path(spark, path))
    return found.getFileCount(), found.getLength()


def _numbers(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the commits, the latest first."""
    folder = f"{target}/commits"
    if not exists(spark, folder):
        return []
    names = [s.getPath().getName() for s in _fs(spark, folder).listStatus(_path(spark, folder))]
    return sorted((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), reverse=True)


def _entry(spark: SparkSession, target: str, number: int) -> dict[str, Any] | None:
    """What a commit says; None for one that was not written to its end."""
    name = f"{target}/commits/{number:012d}.json"
    size = _fs(spark, name).getFileStatus(_path(spark, name)).getLen()
    if not size:
        return None
    stream = _fs(spark, name).open(_path(spark, name))
    try:
        return json.loads(bytes(stream.readNBytes(size)).decode())
    except ValueError:
        return None
    finally:
        stream.close()


def current(spark: SparkSession, target: str) -> Commit | None:
    """The latest complete commit whose version still has the files and bytes it was committed with."""
    for number in _numbers(spark, target):
        entry = _entry(spark, target, number)
        if entry is None:
            continue
        folder = f"{target}/data/{entry['version']}"
        if exists(spark, folder) and _size(spark, folder) == (entry["files"], entry["bytes"]):
            return Commit(number, entry["version"], entry)
    return None


def _read(spark: SparkSession, target: str, found: Commit) -> DataFrame:
    # with the schema of the commit, so that a version without rows can be read and partition columns keep their type
    return spark.read.schema(StructType.fromJson(found.entry["schema"])).parquet(f"{target}/data/{found.version}")


def read_current(spark: SparkSession, target: str) -> DataFrame:
    found = current(spark, target)
    if found is None:
        raise FileNotFoundError(f"{target} has no complete commit")
    return _read(spark, target, found)


def commit(df: DataFrame, target: str, about: Mapping[str, Any] | None = None, counts: Mapping[str, Any] | None = None,
           partition_by: list[str] | None = None) -> Commit:
    """Write `df` as a new version and commit it; `df` may read the version before. `counts` are aggregates taken while
    writing, and go into the commit beside `about`."""
    spark = df.sparkSession
    before = max(_numbers(spark, target), default=0)
    version = f"v-{uuid.uuid4().hex}"
    folder, seen = f"{target}/data/{version}", Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()])
    writer = watched.write.partitionBy(*partition_by) if partition_by else watched.write
    writer.parquet(folder)
    files, size = _size(spark, folder)
    number = before + 1
    entry = {**(about or {}), **seen.get, "number": number, "version": version, "files": files, "bytes": size, "storage_path": folder,
             "schema": df.schema.jsonValue()}
    name = f"{target}/commits/{number:012d}.json"
    # fails where another writer has taken the number meanwhile; its version stays
    stream = _fs(spark, name).create(_path(spark, name), False)
    try:
        stream.write(bytearray(json.dumps(entry).encode()))
    finally:
        stream.close()
    return Commit(number, version, entry)


def drop_superseded(spark: SparkSession, target: str) -> list[str]:
    """Delete the versions of commits before the current one; folders no commit names may be builds under way and stay."""
    now, gone = current(spark, target), []
    for number in _numbers(spark, target) if now else []:
        entry = _entry(spark, target, number) if number < now.number else None
        if entry and exists(spark, f"{target}/data/{entry['version']}"):
            _fs(spark, target).delete(_path(spark, f"{target}/data/{entry['version']}"), True)
            gone.append(entry["version"])
    return gone


def _valid(entry: Mapping[str, Any], hashes: Mapping[str, str]) -> bool:
    return (entry.get("status") == "complete" and entry.get("schema_version") == SCHEMA_VERSION and entry.get("layout_version") == LAYOUT_VERSION
            and all(entry.get(h) == hashes[h] for h in HASHES) and set(SPLITS) <= set(entry.get("splits") or ()))


def build_or_reuse(spark: SparkSession, root: str, hashes: Mapping[str, str], build: Callable[[], DataFrame], force: bool = False) -> tuple[DataFrame, dict[str, Any]]:
    """The tiles of one cache and what is known of it: `status` (`created`, `reused`, `rebuilt`), id, hashes and tiles a split.

    `hashes` holds the three hashes that name the cache. A commit is reused if it is complete, of the same schema and layout,
    with the same hashes and all splits. `build` gives rows with a column `split` and runs only otherwise, or with `force`.
    A dataset with the empty hash is refused.
    """
    if hashes["dataset_hash"] == EMPTY_SHA256:
        raise ValueError("the dataset is empty: no cache is built from it")
    key = "__".join(hashes[h][:12] for h in HASHES)
    target = f"{root}/{key}"
    found, status = current(spark, target), "reused"
    if force or found is None or not _valid(found.entry, hashes):
        status = "rebuilt" if found else "created"
        about = {"tile_cache_id": key, **{h: hashes[h] for h in HASHES}, "status": "complete", "schema_version": SCHEMA_VERSION,
                 "layout_version": LAYOUT_VERSION, "splits": list(SPLITS)}
        counts = {f"num_{s}_tiles": F.count_if(F.col("split") == s) for s in SPLITS}
        found = commit(build(), target, about, counts, ["split"])
    return _read(spark, target, found), {**found.entry, "status": status}


def cache_meta(spark: SparkSession, root: str) -> DataFrame:
    """The latest complete commit of every cache below `root`, as `hashing.cache_state` and `hashing.resolve_cache` take it."""
    if not exists(spark, root) or not _fs(spark, root).globStatus(_path(spark, f"{root}/*/commits/*.json")):
        return spark.createDataFrame([], ENTRY)
    rows = spark.read.schema(ENTRY).json(f"{root}/*/commits/*.json").filter(F.col("number").isNotNull() & F.col("storage_path").isNotNull())
    return rows.groupBy("tile_cache_id").agg(F.max_by(F.struct("*"), "number").alias("m")).select("m.*")
