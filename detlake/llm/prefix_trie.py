"""Prefix trie of rebuilt conversations, by truncation peeling.

Rebuilding: the turns of conversations that share a base (c - c % `block`) are sorted in one shuffle, the base first, and
stream through their task, so no conversation is held but its path: for each turn a chained 128-bit hash of all turns so far
and the code points of its text, 24 bytes, one after the other. A prefix of a path is a node, and stripping a turn is cutting
24 bytes. Texts are hashed before they are shuffled.

Peeling: equal paths are one row before they are sent (a conversation repeated in a third of all rows costs one row a task).
Paths are dealt out by range, so a subtree is a stretch of them. A task peels its stretch from the deepest turn up: paths that
end at a depth join the nodes that survive there, each node is done, its last turn is stripped, and what it leaves its parent
(members, smallest id, one child, leaves, saved tokens) is regrouped one turn higher. Nodes that may reach beyond the stretch
(beginnings of its first and of its last path) stay open: their partial sums, and nothing else, go to the next round, which is
dealt to an eighth of the tasks, until one bounded task closes what is left. So rounds follow the logarithm of the data,
not the depth, and no subtree is ever collected.

The ids that end at a node are sorted by range, joined into texts per task, and these are hashed in order by one stream a node.

Defined cases: rows without a conversation id belong to no conversation and are left out; turns are ordered by turn (null
first), then by the hash of role and text; null roles and texts are empty; repeated rows are turns of their own; other columns
are ignored; without conversations there is no node, not even the root."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from detlake.llm.hot import attach
from detlake.session import work_folder

BLOCK, HEAD = 100, 6
UNIT = 24
#: bytes of paths that one task peels
STRETCH = 32 << 20
SHRINK = 8
#: bytes of ids joined into one row
TEXT = 1 << 16

OPEN = "path binary, n long, conv long, ended long, kids long, leaves long, saved long"
NODE = "id binary, parent binary, depth long, conv long, n long, kids long, leaves long, saved long, ended long"


def paths(turns: DataFrame, block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """(conv_id, path) of every rebuilt conversation: the first h turns of its base, h = crc32(id) % `head`, then its own
    turns after its first h."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    conv = F.col("conv_id").cast("long")
    rows = turns.where("conv_id IS NOT NULL").select((conv - conv % block).alias("base"), conv.alias("conv"), F.col("turn").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("points"))
    dealt = rows.repartition("base").sortWithinPartitions("base", F.col("conv") != F.col("base"), "conv", F.asc_nulls_first("turn"), "digest")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = base = None
        opening: list[tuple[bytes, int]] = []
        path, last, place, skip = bytearray(), b"", 0, 0
        done: list[tuple[int, bytes]] = []

        def add(digest, points):
            nonlocal last
            last = hashlib.blake2b(last + digest, digest_size=16).digest()
            path.extend(last)
            path.extend(points.to_bytes(8, "big"))

        for batch in batches:
            for b, c, digest, points in zip(*(batch.column(k).to_pylist() for k in ("base", "conv", "digest", "points"))):
                if c != owner:
                    if owner is not None:
                        done.append((owner, bytes(path)))
                    if b != base:
                        base, opening = b, []
                    owner, path, last, place = c, bytearray(), b"", 0
                    skip = 0 if c == b else zlib.crc32(str(c).encode()) % head
                    for turn in opening[:skip]:
                        add(*turn)
                if c == b and len(opening) < head - 1:
                    opening.append((digest, points))
                if place >= skip:
                    add(digest, points)
                place += 1
            if done:
                yield _paths(done)
                done = []
        if owner is not None:
            yield _paths([(owner, bytes(path))])

    return dealt.select("base", "conv", "digest", "points").mapInArrow(chain, "conv_id long, path binary")


def _paths(done: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([p for _, p in done], pa.binary())], names=["conv_id", "path"])


def _merge(held: dict, path: bytes, state: tuple) -> None:
    old = held.get(path)
    if old is None:
        held[path] = state
    else:
        held[path] = (old[0] + state[0], min(old[1], state[1]), *(a + b for a, b in zip(old[2:], state[2:])))


def peel(rows: dict[bytes, tuple], last_round: bool) -> tuple[list[tuple], list[tuple]]:
    """(finished nodes, open nodes) of a stretch of paths, each with (members, smallest id, ended here, children, leaves, saved)."""
    first, final = (min(rows), max(rows)) if rows else (b"", b"")
    levels: dict[int, dict[bytes, tuple]] = {}
    for path, state in rows.items():
        levels.setdefault(len(path), {})[path] = state
    nodes, waiting = [], []
    depth = max(levels, default=-1)
    while depth >= 0:
        above = levels.setdefault(depth - UNIT, {}) if depth else {}
        for path, (n, conv, ended, kids, leaves, saved) in levels.pop(depth, {}).items():
            if not last_round and (first.startswith(path) or final.startswith(path)):
                waiting.append((path, n, conv, ended, kids, leaves, saved))
                continue
            leaves = leaves if kids else 1
            saved += (n - 1) * int.from_bytes(path[-8:], "big") if path else 0
            nodes.append((path[-UNIT:-8], path[-2 * UNIT:-UNIT - 8] if depth else None, depth // UNIT, conv, n, kids, leaves, saved, ended))
            if depth:
                _merge(above, path[:-UNIT], (n, conv, 0, 1, leaves, saved))
        depth -= UNIT
    return nodes, waiting


def _round(last_round: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[bytes, tuple] = {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for path, *state in zip(*columns):
                _merge(rows, path, tuple(state))
        nodes, waiting = peel(rows, last_round)
        kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 7]
        for at in range(0, len(nodes), 10_000):
            part = list(zip(*nodes[at:at + 10_000]))
            held = pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(part, kinds)], [f.split()[0] for f in NODE.split(", ")])
            yield pa.RecordBatch.from_arrays([held, pa.nulls(len(held), pa.struct([(f.split()[0], pa.binary() if "binary" in f else pa.int64()) for f in OPEN.split(", ")]))], names=["node", "open"])
        for at in range(0, len(waiting), 10_000):
            part = list(zip(*waiting[at:at + 10_000]))
            held = pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(part, [pa.binary(), *[pa.int64()] * 6])], [f.split()[0] for f in OPEN.split(", ")])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(held), pa.struct([(f.split()[0], pa.binary() if "binary" in f else pa.int64()) for f in NODE.split(", ")])), held], names=["node", "open"])
    return run


def peeled(ended: DataFrame, folder: str, stretch: int = STRETCH) -> DataFrame:
    """Nodes (`NODE`) of all paths (conv_id, path); rounds are written to `folder`."""
    spark = ended.sparkSession
    todo = ended.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv")).select("path", "n", "conv", F.col("n").alias("ended"), *(F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")))
    parts, i, made = None, 0, []
    while True:
        # written, so that the ranges are drawn from the very rows that are dealt
        todo.write.parquet(f"{folder}/round{i}")
        todo = spark.read.parquet(f"{folder}/round{i}")
        size = todo.agg(F.sum(F.octet_length("path") + 64)).first()[0] or 0
        wanted = -(-size // stretch)
        # the tasks shrink from round to round even where the paths left are long
        parts = max(wanted, spark.sparkContext.defaultParallelism) if parts is None else max(1, min(wanted, parts // SHRINK))
        out = todo.repartitionByRange(parts, "path") if parts > 1 else todo.repartition(1)
        out.mapInArrow(_round(parts == 1), f"node struct<{NODE.replace(' ', ':').replace(',:', ',')}>, open struct<{OPEN.replace(' ', ':').replace(',:', ',')}>").write.parquet(f"{folder}/peeled{i}")
        done = spark.read.parquet(f"{folder}/peeled{i}")
        made.append(f"{folder}/peeled{i}")
        if parts == 1:
            return spark.read.parquet(*made).where("node IS NOT NULL").select("node.*")
        todo, i = done.where("open IS NOT NULL").select("open.*"), i + 1


def end_hashes(ended: DataFrame, parts: int) -> DataFrame:
    """(id, sha): for each node at which conversations end, the SHA-256 of their ids as text, ascending, comma-joined."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, 0, [], 0
        for batch in batches:
            out = []
            for id, conv in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()):
                if id != node or size > TEXT:
                    if node is not None:
                        out.append((node, first, ",".join(held)))
                    node, first, held, size = id, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            yield _rows(out, pa.int64())
        if node is not None:
            yield _rows([(node, first, ",".join(held))], pa.int64())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            out = []
            for id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if id != node:
                    if node is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = id, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(text.encode())
            yield _rows(out)
        if node is not None:
            yield _rows([(node, sha.hexdigest())])

    def _rows(rows, *middle):
        columns = list(zip(*rows)) or [()] * (2 + len(middle))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), *(pa.array(columns[1], k) for k in middle), pa.array(columns[-1], pa.string())],
                                          names=["id", "first", "text"] if middle else ["id", "sha"])

    slim = ended.select(F.when(F.octet_length("path") > 0, F.expr(f"substring(path, -{UNIT}, {UNIT - 8})")).otherwise(F.col("path")).alias("id"), "conv_id")
    texts = slim.repartitionByRange(parts, "id", "conv_id").sortWithinPartitions("id", "conv_id").mapInArrow(join, "id binary, first long, text string")
    return texts.repartition("id").sortWithinPartitions("id", "first").select("id", "text").mapInArrow(digest, "id binary, sha string")


def trie(turns: DataFrame, block: int = BLOCK, head: int = HEAD, stretch: int = STRETCH) -> DataFrame:
    """One row for each node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    spark = turns.sparkSession
    folder = work_folder(spark)
    paths(turns, block, head).write.parquet(f"{folder}/paths")
    ended = spark.read.parquet(f"{folder}/paths")
    nodes = peeled(ended, folder, stretch)
    size = ended.agg(F.sum(F.octet_length("path") + 64)).first()[0] or 0
    hashes = end_hashes(ended, max(1, -(-size // stretch), spark.sparkContext.defaultParallelism))
    total = nodes.count()
    # a node may have a large share of all nodes as children
    parents = nodes.where("kids > 0").select(F.col("id").alias("parent"), F.col("conv").alias("parent_conv_id"), F.col("kids").alias("_kids"))
    rows = attach(nodes, parents, ["parent"], "_kids", total).join(hashes, "id", "left")
    none = hashlib.sha256(b"").hexdigest()
    return rows.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
                       F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(none)).alias("ends_sha256"))
