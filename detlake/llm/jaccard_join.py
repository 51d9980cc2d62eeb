"""N-gram Jaccard join: clusters of documents that may be similar come from an exact prefix exchange; within a cluster
signature trees (nodes with OR-combined token bitmaps and size ranges) are traversed in pairs, and every surviving pair of
documents is checked exactly.

Candidates, without loss, for thresholds from PARTS_FROM on. Two sets of sizes a and b with Jaccard >= t differ in at most
D = (1 - t) / (1 + t) * (a + b) tokens. Sizes fall into classes; for the largest size of a class D is fixed, and tokens are
dealt into m > D parts by their hash, so at least m - D parts of two similar sets are equal. A set with at most m - 1 - D
empty parts hence agrees with any similar set in a part that is not empty, and one 64-bit sum per part finds it. Sets with
more empty parts also emit the tokens of their hash-ordered prefix. A set emits for its own class and for classes of larger
sets within reach.

For lower thresholds parts would hold one token or two and pair unlike texts. Put all tokens in one fixed order. Two sets with Jaccard >= t share more than they can lose, so
they share one of their first n - ceil(t * n) + 1 tokens (n the size of each). Any order is right; one with rare tokens
first makes few false candidates, as common passages come late. Rarity is how many documents of the whole corpus have a
token in its slot of a table of `SLOTS` counters, filled by one pass and of fixed size whatever the corpus; clashes in
it, or of token hashes, cost time, never a link. Prefixes longer by `SHARED` - 1 tokens have `SHARED` tokens in common (sets
that small, all that two similar ones share), so a pair counts as candidate from so many on: in a large corpus unlike texts
share one by chance, and one alone would join most texts in one cluster. Pairs are counted where sizes, and the places of
the token in both orders, allow the overlap needed. A token of more than `PAIRED` texts links all of them to one, so it costs no
more than its rows. The connected components of candidates are the clusters: every link lies within one.

Defined cases: null and empty texts have no shingles and link with nothing; equal texts link; repeated rows and repeated
or null ids stay rows of their own; other columns are ignored. Nothing is sampled or capped: clusters beyond `block` texts
are cut into blocks, and all pairs of blocks are traversed but those whose texts are linked already."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from detlake.llm.columns import fresh
from detlake.llm.components import components
from detlake.llm.words import SPACES, column_bytes, mix, pieces, shingle_sets, word_hashes
from detlake.session import durable

BITS = 2048
FANOUT = 8
BLOCK = 8000
_PART = np.uint64(0xC2B2AE3D27D4EB4F)
#: from this threshold on, candidates agree in a part; below, in a rare token
PARTS_FROM = 0.85
SLOT_BITS = 24
SLOTS = 1 << SLOT_BITS
CHUNKS = 64
#: tokens that prefixes of two similar sets share; a pair needs WHOLE, of which one token is the share its sizes ask for
SHARED, WHOLE = 4, 12
#: most texts of one prefix token whose pairs are counted
PAIRED = 32
#: texts to a group of prefix tokens
PART_TEXTS = 10_000


def rarity(texts: DataFrame, k: int) -> np.ndarray:
    """How many texts have a token in each slot, as steps of a logarithmic scale (uint8). `texts`: (text)."""
    width = SLOTS // CHUNKS

    def tally(batches):
        counts, held, n = np.zeros(SLOTS, np.uint16), [], 0

        def add():
            slots, times = np.unique(np.concatenate(held), return_counts=True)
            counts[slots] = np.minimum(counts[slots] + times, 65535).astype(np.uint16)

        for batch in batches:
            for tokens in _sets(batch, "text", k):
                held.append((tokens >> np.uint64(64 - SLOT_BITS)).astype(np.uint32))
                n += len(tokens)
                if n > 2_000_000:
                    add()
                    held, n = [], 0
        if n:
            add()
        yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array([zlib.compress(counts[c * width:(c + 1) * width].tobytes(), 1) for c in range(CHUNKS)], pa.binary())],
                                         names=["chunk", "counts"])

    def total(batches):
        sums = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(counts), np.uint16).astype(np.uint64)
        steps = [np.minimum(np.round(16 * np.log2(1.0 + c)), 255).astype(np.uint8).tobytes() for c in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(steps, pa.binary())], names=["chunk", "counts"])

    sums = texts.select("text").mapInArrow(tally, "chunk int, counts binary").repartition(CHUNKS, "chunk").mapInArrow(total, "chunk int, counts binary")
    # CHUNKS rows of a fixed size
    rows = {r["chunk"]: bytes(r["counts"]) for r in sums.collect()}
    return np.frombuffer(b"".join(rows.get(c, bytes(width)) for c in range(CHUNKS)), np.uint8)


def prefix(tokens: np.ndarray, steps: np.ndarray, num: int, den: int, shared: int = 1) -> np.ndarray:
    """The rarest tokens of a set, of which it shares `shared` with every similar set, or all that the two have in common."""
    n = len(tokens)
    order = np.argsort(steps[(tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], kind="stable")
    return tokens[order[:n - -(-n * num // den) + shared]]


class Classes:
    """Size classes for a threshold of num / den: bounds, allowed differences, number of parts."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.rows = num, den, []
        low = 1
        while low < 1 << 40:
            high = max(low, low * 8 // 5)
            self.rows.append((low, high, *self._parts(low, high)))
            low = high + 1
        self.lows = np.array([r[0] for r in self.rows])

    def _parts(self, low: int, high: int) -> tuple[int, int]:
        differ = (self.den - self.num) * 2 * high // (self.den + self.num)
        if not differ:
            return 0, 1
        parts = differ + 1
        while parts < 4 * differ + 8:
            empty = parts * math.exp(-low / parts)
            if parts - differ - 1 >= empty + 3 * math.sqrt(empty):
                break
            parts += max(1, parts // 64)
        return differ, parts

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        n, found = len(tokens), []
        own = int(np.searchsorted(self.lows, n, "right")) - 1
        spread = mix(tokens ^ _PART)
        for c in range(own, len(self.rows)):
            low, _, differ, parts = self.rows[c]
            if c > own and n * self.den < low * self.num:
                break
            part = (tokens >> np.uint64(1)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            heads = np.flatnonzero(np.diff(part[order], prepend=np.uint64(parts)))
            sums = np.add.reduceat(spread[order], heads)
            found.append(mix(sums ^ mix(part[order][heads] + np.uint64(c << 44))))
            if parts - len(heads) > parts - 1 - differ:
                first = n - -(-n * self.num // self.den) + 1
                found.append(mix(tokens[:first] ^ mix(np.array([c + (1 << 60)], np.uint64))))
        return np.concatenate(found)


def star(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One owner (the smallest) for each key, and distinct links (smallest, other) to its other owners."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    leader = owners[head][np.cumsum(head) - 1]
    other = leader != owners
    links = np.unique(np.stack([leader[other], owners[other]], 1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return keys[head], owners[head], links[:, 0], links[:, 1]


def _sets(batch: pa.RecordBatch, text: str, k: int):
    data, offsets = column_bytes(batch.column(text))
    for i, j in pieces(offsets):
        hashes, counts = word_hashes(data, offsets[i:j + 1], SPACES)
        yield from shingle_sets(hashes, counts, k)


def _part_links(texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b): links of texts that agree in a part to one of them."""
    spark = texts.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    classes = Classes(num, den)

    def emit(batches):
        def flush(keys, owners):
            keys, owners, a, b = star(np.concatenate(keys), np.concatenate(owners))
            part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(cuts))
            rows = [(int(p), keys[cuts[p]:cuts[p + 1]].tobytes(), owners[cuts[p]:cuts[p + 1]].tobytes()) for p in full]
            # links found here travel as a row without keys, to the part of their first text
            if len(a):
                rows.append((int(a[0] % parts), b"", np.stack([a, b]).tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                               pa.array([r[2] for r in rows], pa.binary())], names=["part", "keys", "owners"])

        keys, owners, held = [], [], 0
        for batch in batches:
            tids = batch.column("tid").to_numpy(zero_copy_only=False)
            for tid, tokens in zip(tids, _sets(batch, "text", k)):
                if len(tokens):
                    own = classes.signatures(tokens)
                    keys.append(own)
                    owners.append(np.full(len(own), tid, np.int64))
                    held += len(own)
                if held > 2_000_000:
                    yield flush(keys, owners)
                    keys, owners, held = [], [], 0
        if held:
            yield flush(keys, owners)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        full = pdf["keys"].str.len() > 0
        a, b = [], []
        if full.any():
            keys = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["keys"][full]])
            owners = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["owners"][full]])
            _, _, x, y = star(keys, owners)
            a.append(x)
            b.append(y)
        for x in pdf["owners"][~full]:
            pair = np.frombuffer(x, np.int64).reshape(2, -1)
            a.append(pair[0])
            b.append(pair[1])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    blocks = texts.select("tid", "text").mapInArrow(emit, "part int, keys binary, owners binary")
    return blocks.groupBy("part").applyInPandas(meet, "a long, b long").distinct()


def _cut(part: np.ndarray, parts: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each part that occurs: its number and, per column, the bytes of its values."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=part.dtype))
    full = np.flatnonzero(np.diff(cuts))
    values = {n: c[order] for n, c in columns.items()}
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32())] + [pa.array([v[cuts[p]:cuts[p + 1]].tobytes() for p in full], pa.binary()) for v in values.values()], names=["part", *values])


def _joined(pdf: pd.DataFrame, types: dict[str, type]) -> list[np.ndarray]:
    return [np.concatenate([np.frombuffer(x, t) for x in pdf[c]]) for c, t in types.items()]


def _parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def pair_shares(keys: np.ndarray, owners: np.ndarray, sizes: np.ndarray, places: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, share): pairs of texts that share a prefix token, once a pair; shares of a similar pair add up to `WHOLE` at least.

    Token `keys[i]` stands at `places[i]` in the order of the set of `owners[i]`, which has `sizes[i]` tokens. Two similar sets of
    sizes n and m share num / (num + den) * (n + m) tokens, and their first `SHARED` ones have enough tokens behind them in both."""
    order = np.lexsort((places, owners, sizes, keys))
    keys, owners, sizes, places = keys[order], owners[order], sizes[order].astype(np.int64), places[order].astype(np.int64)
    # a text that occurs in several tasks is sent by each
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1]) | (places[1:] != places[:-1])
    keys, owners, sizes, places = keys[new], owners[new], sizes[new], places[new]
    _, first, times = np.unique(keys, return_index=True, return_counts=True)
    many = np.repeat(times > PAIRED, times)
    _, _, low, high = star(keys[many], owners[many])
    a, b, share = [low], [high], [np.full(len(low), WHOLE, np.int64)]
    last = np.repeat(first + times, times)
    at, step = np.flatnonzero(~many), 1
    while len(at):
        # sizes rise within a key: once one is too large for a set, all further ones are
        at = at[at + step < last[at]]
        at = at[sizes[at] * den >= num * sizes[at + step]]
        to = at + step
        left = np.minimum(sizes[at] - places[at], sizes[to] - places[to])
        fit = ((num + den) * (SHARED - 1 + left) >= num * (sizes[at] + sizes[to])) & (owners[at] != owners[to])
        u, v = at[fit], to[fit]
        a.append(np.minimum(owners[u], owners[v]))
        b.append(np.maximum(owners[u], owners[v]))
        share.append(WHOLE // np.minimum(SHARED, -(-sizes[v] * num // den)))
        step += 1
    return summed(np.concatenate(a), np.concatenate(b), np.concatenate(share))


def summed(a: np.ndarray, b: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once, with the sum of its shares, `WHOLE` at most."""
    if not len(a):
        return a, b, share.astype(np.uint8)
    order = np.lexsort((b, a))
    a, b, share = a[order], b[order], share[order].astype(np.int64)
    head = np.ones(len(a), bool)
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    sums = np.add.reduceat(share, np.flatnonzero(head))
    return a[head], b[head], np.minimum(sums, WHOLE).astype(np.uint8)


def _prefix_links(texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b): pairs that share enough prefix tokens. Keys are 32 bits of a token's hash beside those that choose its part."""
    spark = texts.sparkSession
    parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), texts.count() // PART_TEXTS)
    steps = spark.sparkContext.broadcast(rarity(texts, k))

    def emit(batches):
        def flush(rows):
            hashes = np.concatenate([r[1] for r in rows])
            counts = [len(r[1]) for r in rows]
            return _cut(_parts(hashes, parts), parts, {
                "keys": hashes.astype(np.uint32), "owners": np.repeat(np.array([r[0] for r in rows], np.int64), counts),
                "sizes": np.repeat(np.array([r[2] for r in rows], np.uint32), counts),
                "places": np.concatenate([np.arange(c, dtype=np.uint32) for c in counts])})

        rows, held = [], 0
        for batch in batches:
            tids = batch.column("tid").to_numpy(zero_copy_only=False)
            for tid, tokens in zip(tids, _sets(batch, "text", k)):
                if len(tokens):
                    rows.append((tid, mix(prefix(tokens, steps.value, num, den, SHARED)), len(tokens)))
                    held += len(rows[-1][1])
                if held > 1_000_000:
                    yield flush(rows)
                    rows, held = [], 0
        if held:
            yield flush(rows)

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, share = pair_shares(*_joined(pdf, {"keys": np.uint32, "owners": np.int64, "sizes": np.uint32, "places": np.uint32}), num, den)
        part = _parts(mix(a.view(np.uint64) ^ mix(b.view(np.uint64))), parts)
        return _cut(part, parts, {"a": a, "b": b, "shares": share}).to_pandas()

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, share = summed(*_joined(pdf, {"a": np.int64, "b": np.int64, "shares": np.uint8}))
        return pd.DataFrame({"a": a, "b": b})[share >= WHOLE]

    tokens = texts.select("tid", "text").mapInArrow(emit, "part int, keys binary, owners binary, sizes binary, places binary")
    pairs = tokens.groupBy("part").applyInPandas(meet, "part int, a binary, b binary, shares binary")
    return pairs.groupBy("part").applyInPandas(total, "a long, b long")


def candidate_links(texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b): text ids of which every pair of similar texts is joined by a path. `texts`: (tid long, text)."""
    return _part_links(texts, k, num, den) if num >= PARTS_FROM * den else _prefix_links(texts, k, num, den)


class Tree:
    """Signature tree over token sets: levels of nodes, each with the OR of its bitmaps, its range of sizes, and the most
    tokens of one set that share a bit with another of its own."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        n = len(sets)
        bits = np.zeros((n, BITS), bool)
        for i, tokens in enumerate(sets):
            bits[i, (tokens % np.uint64(BITS)).astype(np.int64)] = True
        sizes = np.array([len(s) for s in sets])
        self.levels = [(np.packbits(bits, axis=1), sizes, sizes, sizes - bits.sum(1), np.arange(n), np.arange(n) + 1)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, spare, first, last = self.levels[-1]
            at = np.arange(0, len(maps), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.maximum.reduceat(spare, at), first[at], last[np.minimum(at + FANOUT, len(maps)) - 1]))


def root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return up
        parent = up


def traverse(sets: list[np.ndarray], num: int, den: int, linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the similar pairs of `sets` (ordered by size), beyond those that `linked` (a parent array) has.

    Both sides of the dual traversal walk the same tree. A pair of nodes goes when the sizes cannot fit, when the bits both
    have plus the tokens that may share a bit are fewer than the least overlap needed, or when all their sets are linked."""
    tree, parent, found = Tree(sets), linked, []
    if not len(sets):
        return found
    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, u, v = stack.pop()
        maps, low, high, spare, first, last = tree.levels[level]
        if level == 0:
            if u != v and root(parent, u) != root(parent, v):
                both = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
                if both and den * both >= num * (len(sets[u]) + len(sets[v]) - both):
                    parent[root(parent, v)] = root(parent, u)
                    found.append((u, v))
            continue
        names = roots(parent)
        of_u, of_v = names[first[u]:last[u]], names[first[v]:last[v]]
        if (of_u == of_u[0]).all() and (of_v == of_u[0]).all():
            continue
        maps, low, high, spare, first, last = tree.levels[level - 1]
        left = np.arange(u * FANOUT, min((u + 1) * FANOUT, len(maps)))
        right = np.arange(v * FANOUT, min((v + 1) * FANOUT, len(maps)))
        x, y = (g.ravel() for g in np.meshgrid(left, right, indexing="ij"))
        keep = (x <= y) if u == v else np.ones(len(x), bool)
        keep &= (high[x] * den >= low[y] * num) & (high[y] * den >= low[x] * num)
        common = np.bitwise_count(maps[x] & maps[y]).sum(1).astype(np.int64)
        most = np.minimum(np.minimum(common + spare[x], common + spare[y]), np.minimum(high[x], high[y]))
        keep &= most * (num + den) >= num * (low[x] + low[y])
        # pairs of a node with itself come first: what they link spares the rest
        order = np.argsort((x == y)[keep], kind="stable")
        stack.extend((level - 1, int(a), int(b)) for a, b in zip(x[keep][order], y[keep][order]))
    return found


def _ordered(pdf: pd.DataFrame, k: int) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
    """(text ids, token sets, rows) of a group, ordered by size; texts without tokens are left out."""
    sets = list(_sets(pa.RecordBatch.from_arrays([pa.array(pdf["text"], pa.string())], names=["text"]), "text", k))
    ids = pdf["tid"].to_numpy()
    order = sorted((i for i in range(len(sets)) if len(sets[i])), key=lambda i: (len(sets[i]), int(ids[i])))
    return ids[order], [sets[i] for i in order], order


def exact_groups(members: DataFrame, k: int, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """(tid, group): the smallest id that links between similar texts reach. `members`: (cluster, tid long, text), with each
    text once; links only join texts of one cluster."""

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, sets, _ = _ordered(pdf, k)
        linked = np.arange(len(ids))
        traverse(sets, num, den, linked)
        least = pd.Series(ids, dtype="int64").groupby(roots(linked)).transform("min")
        return pd.DataFrame({"tid": ids, "group": least.to_numpy()}, dtype="int64")

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, sets, order = _ordered(pdf, k)
        # texts with one and the same known group are linked already
        linked = pd.Series(range(len(ids)), dtype="int64").groupby(pdf["known"].to_numpy()[order]).transform("min").to_numpy().copy()
        links = traverse(sets, num, den, linked)
        return pd.DataFrame({"a": [int(ids[u]) for u, _ in links], "b": [int(ids[v]) for _, v in links]}, dtype="int64")

    sizes = members.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks"))
    blocks = members.join(sizes, "cluster").withColumn("_block", F.pmod(F.xxhash64("tid"), F.col("_blocks")).cast("int"))
    within = blocks.groupBy("cluster", "_block").applyInPandas(whole, "tid long, group long")
    large = sizes.where("_blocks > 1")
    if large.isEmpty():
        return within
    # clusters of several blocks: then pairs of blocks, of which one has texts outside the main group of the cluster
    within = durable(within)
    large = blocks.where("_blocks > 1").join(within.withColumnRenamed("group", "known"), "tid")
    main = large.groupBy("cluster", "known").count().groupBy("cluster").agg(F.max_by("known", F.struct("count", "known")).alias("_main"))
    busy = (large.join(main, "cluster").where("known <> _main").groupBy("cluster").agg(F.collect_set("_block").alias("_busy")))
    pairs = (large.join(busy, "cluster").withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).where("_with <> _block")
             .where(F.array_contains("_busy", F.col("_block")) | F.array_contains("_busy", F.col("_with")))
             .withColumn("_low", F.least("_block", "_with")).withColumn("_high", F.greatest("_block", "_with")))
    links = pairs.groupBy("cluster", "_low", "_high").applyInPandas(across, "a long, b long")
    own = within.select(F.col("tid").alias("a"), F.col("group").alias("b"))
    return components(own.unionByName(links)).select(F.col("node").alias("tid"), F.col("component").alias("group"))


def similar_texts(docs: DataFrame, k: int, num: int, den: int, text: str = "text") -> DataFrame:
    """(tid, group): for each text that may be similar to another one its id and its group, the smallest id that links reach.
    A text id is the 64-bit xxhash of the text; that any two of n texts share one has a chance of n * n / 2 ** 65."""
    rows = docs.select(F.xxhash64(text).alias("tid"), F.col(text).alias("text")).where("text IS NOT NULL AND text <> ''")
    clusters = components(candidate_links(rows, k, num, den)).select(F.col("node").alias("tid"), F.col("component").alias("cluster"))
    # copies of a text meet before they are sent
    texts = rows.groupBy("tid").agg(F.first("text").alias("text")).join(durable(clusters), "tid")
    # callers join the groups more than once
    return durable(exact_groups(texts.select("cluster", "tid", "text"), k, num, den))


def similarity_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: (id, n_shingles, component_id): the size of its set of k-word shingles and the smallest
    id among the rows that links (Jaccard >= num / den, or equal texts) reach; its own id where there are none."""

    def count(batches):
        for batch in batches:
            sizes = [len(s) for s in _sets(batch, "text", k)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tid"), pa.array(sizes, pa.int64())], names=["id", "tid", "n_shingles"])

    groups = similar_texts(docs, k, num, den, text)
    rows = (docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("tid"), F.col(text).alias("text"))
            .mapInArrow(count, "id long, tid long, n_shingles long"))
    rows = rows.join(groups, "tid", "left").withColumn("group", F.coalesce("group", "tid"))
    least = rows.where("n_shingles > 0").groupBy("group").agg(F.min("id").alias("component"))
    return rows.join(least, "group", "left").select(
        F.col("id").alias(id), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))


def one_per_group(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text: str = "text", id: str = "doc_id") -> DataFrame:
    """`docs` with one row of each group of similar or equal texts: the one with the smallest id (of rows that share even
    the id, one; null ids last). Rows without words all stay. Columns are those of `docs`."""
    groups = similar_texts(docs, k, num, den, text)
    tid = F.xxhash64(text)
    worded = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    slim = docs.where(worded).select(F.col(id).cast("long").alias("_id"), tid.alias("_tid"))
    slim = slim.join(groups.withColumnRenamed("tid", "_tid"), "_tid", "left").withColumn("group", F.coalesce("group", "_tid"))
    pick = F.struct(F.col("_id").isNull().alias("x"), F.col("_id").alias("i"), F.col("_tid").alias("t"))
    best = slim.groupBy("group").agg(F.min(pick).alias("best"), F.count("*").alias("rows"))
    kept = best.select(F.col("best.i").alias("_id"), F.col("best.t").alias("_tid"), F.col("rows").alias("_rows"))
    gone = slim.join(kept, (slim["_tid"] == kept["_tid"]) & slim["_id"].eqNullSafe(kept["_id"]), "left_anti").select("_id", "_tid").distinct()
    own = fresh(docs, "_tid")
    rows = docs.withColumn(own, tid)
    rest = rows.join(gone, (rows[own] == gone["_tid"]) & rows[id].cast("long").eqNullSafe(gone["_id"]), "left_anti")
    # rows with equal id and equal text: one of them
    twice = slim.groupBy("_id", "_tid").agg(F.count("*").alias("_c")).where("_c > 1")
    once = rest.join(twice, (rest[own] == twice["_tid"]) & rest[id].cast("long").eqNullSafe(twice["_id"]), "left_anti")
    many = rest.join(twice, (rest[own] == twice["_tid"]) & rest[id].cast("long").eqNullSafe(twice["_id"]), "left_semi").dropDuplicates([id, own])
    return once.unionByName(many).select(*docs.columns)
