"""Variable-capacity best fit: packing into bins of several permitted lengths.

A document's tokens are the bytes of its UTF-8 text and one end mark. A document longer than the largest length is split into
pieces of that length and a rest. A bin of length c costs c, a fixed `overhead`, and c² / `attention` for attention, which grows
with the square of the length.

Pieces come in falling size. Each goes into the open bin that it leaves least room in (`best_fit`); where none holds it, a bin
is opened in the length that its size class asks for, and at the end every bin shrinks to the smallest length that holds its
contents. Which length a class opens is chosen for all classes together (`pack_jointly`): from the shortest lengths on, one
class after the other tries every length that holds it, everything is packed anew, and a change stays when the total cost of
the shrunk bins falls. So padding and attention are weighed over the whole group, not bin by bin.

Documents are dealt into groups by a hash, about `group_tokens` tokens each, and groups are packed apart, so no task holds
more than its group; a group's bins but the last few are full, so the groups cost little. Only ids and lengths are
shuffled, never texts, and ids travel as Arrow columns, so none changes.

Defined cases: null and empty texts have no tokens and take no bin; repeated rows are packed as rows of their own; null ids
are kept; other columns are ignored; an empty table has no bins."""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LENGTHS = (512, 1024, 2048, 4096, 8192, 16384)
OVERHEAD = 32
GROUP_TOKENS = 16_000_000
#: length at which attention costs as much as everything else that grows with the tokens
ATTENTION = 8192
#: size classes between two lengths, and rounds of moves over all classes
CLASSES, ROUNDS = 8, 3


def bin_cost(length: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    return length + overhead + length * length / attention


def best_fit(sizes: Sequence[int], limits: Sequence[int], opened: Sequence[int]) -> tuple[list[tuple[int, int]], list[int]]:
    """For sizes in falling order: (bin, offset) of each; tokens in each bin. A size up to `limits[i]` (rising) and above the
    limit before opens a bin of length `opened[i]`."""
    rooms: list[tuple[int, int]] = []
    used: list[int] = []
    placed = []
    for size in sizes:
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, name = rooms.pop(at)
        else:
            room, name = opened[bisect.bisect_left(limits, size)], len(used)
            used.append(0)
        placed.append((name, used[name]))
        used[name] += size
        if room > size:
            bisect.insort(rooms, (room - size, name))
    return placed, used


def pack_jointly(sizes: Sequence[int], lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, attention: int = ATTENTION, classes: int = CLASSES,
                 rounds: int = ROUNDS) -> tuple[list[tuple[int, int]], list[int]]:
    """For sizes in falling order, each within the largest length: (bin, offset) of each; length of each bin."""
    lengths = sorted(lengths)
    cost = {c: bin_cost(c, overhead, attention) for c in lengths}
    limits = sorted({low + (c - low) * (i + 1) // classes for low, c in zip([0, *lengths], lengths) for i in range(classes)} - {0})
    least = [bisect.bisect_left(lengths, n) for n in limits]

    def held(n: int) -> int:
        return lengths[bisect.bisect_left(lengths, n)]

    def tried(choice: list[int]):
        placed, used = best_fit(sizes, limits, [lengths[i] for i in choice])
        shrunk = [held(n) for n in used]
        return sum(cost[c] for c in shrunk), placed, shrunk

    choice = list(least)
    best = tried(choice)
    present = sorted({bisect.bisect_left(limits, n) for n in sizes})
    for _ in range(rounds):
        before = best[0]
        for k in present:
            for i in range(least[k], len(lengths)):
                if i != choice[k]:
                    other = [*choice[:k], i, *choice[k + 1:]]
                    found = tried(other)
                    if found[0] < best[0]:
                        best, choice = found, other
        if best[0] == before:
            break
    return best[1], best[2]


def packed(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, group_tokens: int = GROUP_TOKENS, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row for each piece: (id, piece, start, n_tokens, bin, bin_length, bin_offset): bytes `start` on of the text lie
    `bin_offset` tokens into a bin of `bin_length`. The last piece of a document ends with its end mark."""
    largest = max(lengths)
    rows = docs.select(F.col(id).alias("id"), (F.octet_length(text) + 1).cast("long").alias("n"), F.crc32(F.col(text).cast("binary")).alias("crc")).where("n > 1")
    total = rows.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    pieces = (rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {largest}"))))
              .select("id", "crc", "piece", (F.col("piece") * largest).alias("start"), F.least(F.lit(largest).cast("long"), F.col("n") - F.col("piece") * largest).alias("size")))
    # pieces of one document may go to different groups, so a long one fills no group alone
    pieces = pieces.withColumn("group", F.pmod(F.xxhash64("id", "crc", "piece"), F.lit(groups)))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("id", "ascending"), ("crc", "ascending"), ("piece", "ascending")])
        placed, length = pack_jointly(table.column("size").to_pylist(), lengths, overhead)
        group = table.column("group")[0].as_py()
        made = [[f"{group}-{name}" for name, _ in placed], [length[name] for name, _ in placed], [at for _, at in placed]]
        return pa.table([*(table.column(c) for c in ("id", "piece", "start", "size")), *(pa.array(v, k) for v, k in zip(made, (pa.string(), pa.int64(), pa.int64())))],
                        names=["id", "piece", "start", "size", "bin", "bin_length", "bin_offset"])

    kind = docs.schema[id].dataType.simpleString()
    out = pieces.groupBy("group").applyInArrow(place, f"id {kind}, piece long, start long, size long, bin string, bin_length long, bin_offset long")
    return out.select(F.col("id").alias(id), "piece", "start", F.col("size").alias("n_tokens"), "bin", "bin_length", "bin_offset")
