"""Removal of repeated passages by a distributed merge sort of suffixes that never compares a known common prefix again.

A byte goes when a string of `length` bytes that covers it also starts anywhere else. Every such string holds an anchor: the
smallest hash among its 32-byte grams. Anchors depend on the string alone, so equal strings hold equal anchors at equal
places, and only the suffixes that start at anchors need sorting, about one in eighty-five.

1. Anchors whose gram is an anchor once in the corpus cannot belong to a repeat and are dropped. Grams meet by their hash, as arrays; a gram seen twice in one block is settled there and sent once.
2. What is left is sorted in runs: the suffix from the anchor on, no longer than a string can reach, with the bytes before it.
   Equal ones of a run are settled at once and sent once. A run is front-coded (length shared with the suffix before it, and
   the rest) and goes to the part its gram hash names, so a part holds all suffixes with equal grams.
3. A part merges its runs with a loser tree. Each contender keeps the length it shares with the last winner: of two, the one
   that shares more is smaller, and only equal ones compare bytes, from that length on. The merge thus gives the order and
   the common prefix of neighbours. A string that starts d bytes before an anchor repeats if another anchor agrees in
   length - d bytes to the right and d bytes to the left; both are ranges of sorted orders, so all offsets are tested exactly.

Defined cases: null and empty texts have no bytes; texts below `length` lose nothing; all rows with equal texts of at least
`length` bytes lose everything; other columns do not matter. No text is cut: long ones are worked on in overlapping pieces.
A part holds the distinct surroundings of its grams; copies and the inside of common passages are settled before."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from detlake.llm.columns import fresh
from detlake.llm.words import column_bytes, mix, pieces

LENGTH = 200
GRAM = 32
#: bytes whose hashes are in memory at a time; about twenty arrays of 8 bytes for each of them are
PIECE = 1 << 18
RUN = 20_000
ANCHORS = 1_000_000


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD6E8FEB86659FD93
    return (np.cumprod(np.append(np.uint64(1), np.full(n - 1, base, np.uint64))),
            np.cumprod(np.append(np.uint64(1), np.full(n - 1, pow(base, -1, 1 << 64), np.uint64))))


def _sliding(values: np.ndarray, width: int, worst: int, pick: np.ufunc) -> np.ndarray:
    """pick (minimum or maximum) over each `width` values, by prefixes and suffixes of blocks of that width."""
    n = len(values)
    padded = np.append(values, np.full(-n % width, worst, np.uint64)).reshape(-1, width)
    ahead = pick.accumulate(padded, axis=1).ravel()
    behind = pick.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[:n - width + 1], ahead[width - 1:n])


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, powers: tuple) -> tuple[np.ndarray, ...]:
    """(positions in `data`, gram hashes, first and last start of the strings of which it is the anchor) of the anchors of
    the texts between `offsets`. Equal smallest grams of a string are all its anchors."""
    n, width, none = len(data), length - GRAM + 1, np.uint64(0xFFFFFFFFFFFFFFFF)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[0][:n]))
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers[1][:n - GRAM + 1])
    inner = offsets[1:-1]
    across = (inner[:, None] - np.arange(1, GRAM)[None, :]).ravel()
    grams[across[(across >= 0) & (across < len(grams))]] = none
    least = _sliding(grams, width, int(none), np.minimum)
    across = np.zeros(n + 1, np.int64)
    np.add.at(across, np.maximum(inner - length + 1, 0), 1)
    np.add.at(across, inner, -1)
    least[np.cumsum(across)[:len(least)] > 0] = 0
    edge = np.zeros(width - 1, np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), width, 0, np.maximum)
    at = np.flatnonzero((most == grams) & (most > 0))
    # the strings of an anchor are the stretch of starts with its hash as their smallest
    heads = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    tails = np.append(heads[1:], len(least)) - 1
    values, rank = np.unique(least[heads], return_inverse=True)
    keys = rank * (n + 1) + heads
    order = np.argsort(keys)
    own = order[np.searchsorted(keys[order], np.searchsorted(values, grams[at]) * (n + 1) + at, "right") - 1]
    # smallest hashes crowd near zero; mixed again they deal evenly
    return at, mix(grams[at]), np.maximum(heads[own], at - width + 1), np.minimum(tails[own], at)


def text_anchors(data: np.ndarray, offsets: np.ndarray, length: int, powers: tuple) -> Iterator[tuple]:
    """For ranges of texts (first, after last): text of each anchor, then as arrays its place in the text, its gram hash
    and the first and last start of its strings."""
    for i, j in pieces(offsets, PIECE):
        begin, end = int(offsets[i]), int(offsets[j])
        if end - begin <= PIECE:
            at, grams, low, high = _anchors(data[begin:end], offsets[i:j + 1] - begin, length, powers)
            owner = np.searchsorted(offsets[i:j + 1] - begin, at, "right") - 1 + i
            shift = begin - offsets[owner]
            yield i, j, owner, at + shift, grams, low + shift, high + shift
            continue
        found = []
        for core in range(begin, end, PIECE):
            first, last = max(begin, core - 2 * length), min(end, core + PIECE + 2 * length)
            at, grams, low, high = _anchors(data[first:last], np.array([0, last - first]), length, powers)
            keep = (at + first >= core) & (at + first < core + PIECE)
            found.append((at[keep] + first - begin, grams[keep], low[keep] + first - begin, high[keep] + first - begin))
        at, grams, low, high = (np.concatenate(x) for x in zip(*found))
        yield i, j, np.full(len(at), i), at, grams, low, high


def _deal(keys: np.ndarray, parts: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def repeated_anchors(texts: DataFrame, length: int, parts: int) -> DataFrame:
    """(tid, at binary): places of anchors whose gram occurs again, some of them per row. `texts`: (tid, text, copies)."""

    def emit(batches):
        powers = _powers(PIECE + 4 * length)

        def flush(grams, tids, at):
            grams, tids, at = np.concatenate(grams), np.concatenate(tids), np.concatenate(at)
            order = np.argsort(grams, kind="stable")
            grams, tids, at = grams[order], tids[order], at[order]
            head = np.append(True, grams[1:] != grams[:-1])
            twice = ~head | np.append(~head[1:], False)
            part = _deal(grams[head], parts)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            rows = [(int(p), grams[head][cuts[p]:cuts[p + 1]].tobytes(), tids[head][cuts[p]:cuts[p + 1]].tobytes(), at[head][cuts[p]:cuts[p + 1]].tobytes())
                    for p in np.flatnonzero(np.diff(cuts))]
            # places settled here go without grams, spread over the parts
            for x in np.array_split(np.flatnonzero(twice), min(parts, 1 + int(twice.sum()) // 10_000)):
                if len(x):
                    rows.append((int(tids[x[0]] % parts), b"", tids[x].tobytes(), at[x].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[c] for r in rows], pa.binary()) for c in (1, 2, 3))],
                                              names=["part", "grams", "tids", "at"])

        held, n = ([], [], []), 0
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            tids = batch.column("tid").to_numpy(zero_copy_only=False)
            for _, _, owner, at, grams, _, _ in text_anchors(data, offsets, length, powers):
                for x, y in zip(held, (grams, tids[owner], at.astype(np.int32))):
                    x.append(y)
                n += len(at)
                if n > ANCHORS:
                    yield flush(*held)
                    held, n = ([], [], []), 0
        if n:
            yield flush(*held)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        tids, at = [], []
        full = pdf["grams"].str.len() > 0
        if full.any():
            grams = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["grams"][full]])
            own = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["tids"][full]])
            places = np.concatenate([np.frombuffer(x, np.int32) for x in pdf["at"][full]])
            order = np.argsort(grams, kind="stable")
            same = grams[order][1:] == grams[order][:-1]
            order = order[np.append(same, False) | np.append(False, same)]
            tids.append(own[order])
            at.append(places[order])
        for x, y in zip(pdf["tids"][~full], pdf["at"][~full]):
            tids.append(np.frombuffer(x, np.int64))
            at.append(np.frombuffer(y, np.int32))
        tids, at = np.concatenate(tids), np.concatenate(at)
        order = np.lexsort((at, tids))
        tids, at = tids[order], at[order]
        heads = np.flatnonzero(np.append(True, tids[1:] != tids[:-1])) if len(tids) else np.zeros(0, np.int64)
        return pd.DataFrame({"tid": tids[heads], "at": [x.tobytes() for x in np.split(at, heads[1:])] if len(heads) else []})

    blocks = texts.mapInArrow(emit, "part int, grams binary, tids binary, at binary")
    return blocks.groupBy("part").applyInPandas(meet, "tid long, at binary")


def _shared(strings: list[bytes]) -> np.ndarray:
    """Length of the prefix that each string of a sorted list shares with the one before it."""
    if not strings:
        return np.zeros(0, np.int64)
    lengths = np.array([len(s) for s in strings])
    wide = int(lengths.max()) + 1
    table = np.frombuffer(b"".join(s.ljust(wide, b"\0") for s in strings), np.uint8).reshape(-1, wide)
    differ = table[1:] != table[:-1]
    differ[:, -1] = True
    return np.append(0, np.minimum(differ.argmax(1), np.minimum(lengths[1:], lengths[:-1])))


def suffix_runs(texts: DataFrame, length: int, parts: int) -> DataFrame:
    """Sorted, front-coded runs of the suffixes at repeated anchors, and spans settled on the way.
    `texts`: (tid, text, copies, places array<binary>)."""
    columns = "part int, n int, shared binary, sizes binary, tails binary, left_sizes binary, lefts binary, tids binary, at binary, open binary"
    names = [c.split()[0] for c in columns.split(", ")]

    def emit(batches):
        powers = _powers(PIECE + 4 * length)

        def flush(found: dict):
            rows, settled = [], []
            by_part: dict[int, list] = {}
            for (part, suffix, left), owners in found.items():
                # what occurs twice in this run is settled for all its owners; others only need to see it
                waiting = len(owners) == 1 and owners[0][2]
                if len(owners) > 1:
                    settled.extend((tid, at - len(left), at + len(suffix)) for tid, at, unsettled in owners if unsettled)
                by_part.setdefault(part, []).append((suffix, left, owners[0][0], owners[0][1], waiting))
            for part, run in by_part.items():
                run.sort(key=lambda r: r[:2])
                shared = _shared([r[0] for r in run])
                rows.append((part, len(run), shared.astype(np.int16).tobytes(), np.array([len(r[0]) for r in run], np.int16).tobytes(),
                             b"".join(r[0][s:] for r, s in zip(run, shared.tolist())), np.array([len(r[1]) for r in run], np.int16).tobytes(), b"".join(r[1] for r in run),
                             np.array([r[2] for r in run], np.int64).tobytes(), np.array([r[3] for r in run], np.int32).tobytes(), bytes(r[4] for r in run)))
            for x in range(0, len(settled), 10_000):
                table = np.array(settled[x:x + 10_000], np.int64)
                rows.append((int(table[0, 0] % parts), 0, b"", b"", b"", b"", b"", table.tobytes(), b"", b""))
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int32() if c < 2 else pa.binary()) for c in range(len(names))], names=names)

        found, n = {}, 0
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            tids, copies = batch.column("tid").to_pylist(), batch.column("copies").to_pylist()
            places = batch.column("places")
            for i, j, owner, at, grams, low, high in text_anchors(data, offsets, length, powers):
                cuts = np.searchsorted(owner, np.arange(i, j + 1))
                for t in range(i, j):
                    text = data[offsets[t]:offsets[t + 1]].tobytes()
                    repeated = np.concatenate([np.frombuffer(x, np.int32) for x in places[t].as_py()])
                    own = cuts[t - i] + np.flatnonzero(np.isin(at[cuts[t - i]:cuts[t - i + 1]], repeated))
                    for p, a, x, y in zip(_deal(grams[own], parts).tolist(), at[own].tolist(), low[own].tolist(), high[own].tolist()):
                        found.setdefault((p, text[a:y + length], text[x:a][::-1]), []).append((tids[t], a, copies[t] == 1))
                        n += 1
                    if n > RUN:
                        yield flush(found)
                        found, n = {}, 0
        if n:
            yield flush(found)

    return texts.mapInArrow(emit, columns)


def _common(x: bytes, y: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes need no comparison."""
    n = min(len(x), len(y))
    differ = int.from_bytes(x[known:n], "big") ^ int.from_bytes(y[known:n], "big")
    return n - (differ.bit_length() + 7) // 8 if differ else n


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge sorted runs (strings, prefix shared with the string before): (run, index) in order, prefix shared with the one
    before. In the loser tree each run's head keeps the prefix it shares with the last winner."""
    k = len(runs)
    heads, shared = [0] * k, [0] * k
    done = [not strings for strings, _ in runs]
    tree = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        if done[a] or done[b]:
            return (b, a) if done[a] else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = runs[a][0][heads[a]], runs[b][0][heads[b]]
        common = _common(x, y, shared[a])
        if x[common:common + 1] <= y[common:common + 1]:
            shared[b] = common
            return a, b
        shared[a] = common
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        winner, tree[node] = play(a, b)
        return winner

    order, prefix = [], []
    if not k:
        return order, prefix
    winner = build(1) if k > 1 else 0
    while not done[winner]:
        at = heads[winner]
        order.append((winner, at))
        prefix.append(shared[winner])
        if at + 1 < len(runs[winner][0]):
            heads[winner] = at + 1
            shared[winner] = runs[winner][1][at + 1]
        else:
            done[winner] = True
        node = (winner + k) // 2
        while node:
            other = tree[node]
            # the common case without a call: one of the two shares more with the last winner
            if not done[winner] and not done[other] and shared[winner] > shared[other]:
                pass
            else:
                winner, tree[node] = play(winner, other)
            node //= 2
    return order, prefix


def _groups(shared: np.ndarray, least: int) -> np.ndarray:
    return np.cumsum(shared < least)


def repeats(suffixes: list[bytes], shared: np.ndarray, lefts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes in order: the least and the largest d such that the string of `length` bytes from d bytes before the
    anchor on is at another anchor too; -1 where there is none."""
    n = len(suffixes)
    rights, before = np.array([len(s) for s in suffixes]), np.array([len(s) for s in lefts])
    order = sorted(range(n), key=lefts.__getitem__)
    left_shared = _shared([lefts[i] for i in order])
    near = np.maximum(shared, np.append(shared[1:], 0))
    near_left = np.zeros(n, np.int64)
    near_left[order] = np.maximum(left_shared, np.append(left_shared[1:], 0))
    first, last = np.full(n, -1), np.full(n, -1)
    of_left = np.zeros(n, np.int64)
    for d in range(length - GRAM + 1):
        able = np.flatnonzero((before >= d) & (rights >= length - d) & (near >= length - d) & ((near_left >= d) if d else True))
        if len(able) < 2:
            continue
        of_left[order] = _groups(left_shared, d)
        keys = _groups(shared, length - d)[able] * (n + 1) + of_left[able]
        _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
        hit = able[counts[back] > 1]
        first[hit] = np.where(first[hit] < 0, d, first[hit])
        last[hit] = d
    return first, last


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(tid, spans array<struct<start, end>>): bytes to remove, as spans that may overlap. `texts`: (tid, text, copies), each
    text once with the number of its rows."""
    parts = 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        out, runs, lefts, tids, at, waiting = [], [], [], [], [], []
        for row in pdf.itertuples(index=False):
            if not row.n:
                out.append(np.frombuffer(row.tids, np.int64).reshape(-1, 3))
                continue
            strings, previous, place = [], b"", 0
            shared = np.frombuffer(row.shared, np.int16).tolist()
            for s, size in zip(shared, np.frombuffer(row.sizes, np.int16).tolist()):
                previous = previous[:s] + row.tails[place:place + size - s]
                place += size - s
                strings.append(previous)
            ends = np.cumsum(np.frombuffer(row.left_sizes, np.int16), dtype=np.int64).tolist()
            lefts.append([row.lefts[a:b] for a, b in zip([0, *ends], ends)])
            runs.append((strings, shared))
            tids.append(np.frombuffer(row.tids, np.int64))
            at.append(np.frombuffer(row.at, np.int32))
            waiting.append(np.frombuffer(row.open, np.uint8))
        order, shared = merge(runs)
        if order:
            bases = np.cumsum([0, *(len(r[0]) for r in runs)])
            index = np.array([bases[r] + i for r, i in order])
            first, last = repeats([runs[r][0][i] for r, i in order], np.array(shared), [lefts[r][i] for r, i in order], length)
            tid, place, wait = np.concatenate(tids)[index], np.concatenate(at)[index].astype(np.int64), np.concatenate(waiting)[index]
            hit = (first >= 0) & (wait > 0)
            out.append(np.stack([tid[hit], place[hit] - last[hit], place[hit] - first[hit] + length], 1))
        rows = np.concatenate(out)
        return pd.DataFrame({"tid": rows[:, 0], "start": rows[:, 1], "end": rows[:, 2]})

    places = repeated_anchors(texts, length, parts).groupBy("tid").agg(F.collect_list("at").alias("places"))
    runs = suffix_runs(texts.join(places, "tid"), length, parts)
    spans = runs.groupBy("part").applyInPandas(join, "tid long, start long, end long")
    return spans.groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def distinct_texts(docs: DataFrame, text: str, length: int) -> DataFrame:
    """(tid, text, copies): each text of at least `length` bytes once. Copies meet before they are sent."""
    rows = docs.select(F.xxhash64(text).alias("tid"), F.col(text).alias("text")).where(F.octet_length("text") >= length)
    return rows.groupBy("tid").agg(F.first("text").alias("text"), F.count("*").alias("copies"))


def _merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    joined: list[list[int]] = []
    for a, b in sorted((s["start"], min(s["end"], size)) for s in spans):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    return [(a, b) for a, b in joined]


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def removals(docs: DataFrame, length: int = LENGTH, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: (id, n_bytes, n_removed, n_spans, kept_sha256)."""

    def digest(batches):
        for batch in batches:
            rows = []
            for tid, value, copies, spans in zip(*(batch.column(c).to_pylist() for c in ("tid", "text", "copies", "spans"))):
                raw = value.encode()
                cut = [(0, len(raw))] if copies > 1 else _merged(spans, len(raw))
                kept = _kept(raw, cut)
                rows.append((tid, len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string() if c == 3 else pa.int64()) for c in range(4)], names=["tid", "n_removed", "n_spans", "sha"])

    texts = distinct_texts(docs, text, length)
    spans = repeated_spans(texts, length)
    cut = texts.join(spans, "tid", "left").where("spans IS NOT NULL OR copies > 1").mapInArrow(digest, "tid long, n_removed long, n_spans long, sha string")
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id), F.xxhash64(text).alias("tid"), F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole.cast("binary"), 256).alias("whole"))
    return rows.join(cut, "tid", "left").select(id, "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
                                                F.coalesce("sha", "whole").alias("kept_sha256"))


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """`docs` with the repeated bytes cut out of their texts (bytes of characters cut through go too) and, where `chars` is
    a column, the number of characters counted anew. All rows and other columns stay as they are."""

    @F.pandas_udf("string")
    def cut(values: pd.Series, spans: pd.Series) -> pd.Series:
        def one(value, found):
            raw = value.encode()
            return _kept(raw, _merged(found, len(raw))).decode("utf-8", "ignore")
        return pd.Series([v if s is None else one(v, s) for v, s in zip(values, spans)], dtype=object)

    texts = distinct_texts(docs, text, length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(1 << 40).cast("long").alias("end")))
    spans = repeated_spans(texts, length)
    own, cuts = fresh(docs, "_tid"), fresh(docs, "_spans")
    found = (spans.unionByName(texts.where("copies > 1").select("tid", whole.alias("spans")))
             .groupBy("tid").agg(F.flatten(F.collect_list("spans")).alias(cuts)).withColumnRenamed("tid", own))
    rows = docs.withColumn(own, F.xxhash64(text)).join(found, own, "left").withColumn(text, cut(F.col(text), F.col(cuts)))
    if chars in docs.columns:
        rows = rows.withColumn(chars, F.when(F.col(cuts).isNull(), F.col(chars)).otherwise(F.length(text)).cast(docs.schema[chars].dataType))
    return rows.select(*docs.columns)
