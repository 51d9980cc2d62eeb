"""Benchmark decontamination by greedy string tiling: which benchmark items a document holds, in any order of passages.

Words are runs of letters and digits (other ASCII characters part them), A-Z lower-cased. Hashes of every `seed` words of a
document are looked up in the hashes of the benchmark; items that share a seed with the document are tiled against it by
running Karp-Rabin: longest unmarked matches first, each marks its words on both sides, down to `seed` words. The share of an
item's words that tiles cover is its coverage; order plays no part. An item counts where tiles cover at least `least` of it
and `least_words` words, so items of a word or two prove nothing by default; with a smaller `least_words`, an item of fewer
words than `seed` is a seed of its own length.

The benchmark goes to the tasks in blocks of at most `block` words, one pass over the documents for each block, so what
travels is bounded whatever its size; documents are never shuffled, and a document counts whole.

Defined cases: null and empty texts, and items without words, match nothing; repeated documents or items give repeated rows;
other columns are ignored; an empty benchmark or table gives no rows."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from detlake.llm.words import PUNCTUATION, column_bytes, mix, ngrams, pieces, word_hashes

SEED = 5
COVERAGE = 0.5
#: words of an item that tiles must cover, whatever its length
LEAST_WORDS = 5
BLOCK = 2_000_000
MAP_BITS = 22
#: base of the rolling hashes, odd, and its inverse modulo 2 ** 64
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def benchmark_blocks(benchmark: DataFrame, text: str, id: str, block: int) -> Iterator[list[tuple]]:
    """Items as (id, word hashes), in blocks of about `block` words; read one partition at a time."""
    held, n = [], 0
    for row in benchmark.select(F.col(id).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL").toLocalIterator():
        hashes, _ = word_hashes(*column_bytes(pa.array([row["text"]], pa.string())), PUNCTUATION)
        if len(hashes):
            held.append((row["id"], hashes))
            n += len(hashes)
        if n >= block:
            yield held
            held, n = [], 0
    if held:
        yield held


class Seeds:
    """Hashes of the seeds of a block of items with how often each item has them: sorted, with a bitmap before them."""

    def __init__(self, items: list[tuple], seed: int):
        self.items, self.sizes = items, sorted({min(seed, len(w)) for _, w in items})
        self.tables = {}
        for size in self.sizes:
            found = [(i, *np.unique(ngrams(w, size), return_counts=True)) for i, (_, w) in enumerate(items) if min(seed, len(w)) == size]
            hashes, times = np.concatenate([h for _, h, _ in found]), np.concatenate([n for *_, n in found])
            owner = np.concatenate([np.full(len(h), i) for i, h, _ in found])
            order = np.argsort(hashes, kind="stable")
            bitmap = np.zeros(1 << MAP_BITS, bool)
            bitmap[(hashes & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)] = True
            self.tables[size] = (hashes[order], owner[order], times[order], bitmap)

    def meet(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(seed size, document, item, places of the item whose seed the document holds) of all pairs that share a seed. Each
        seed counts once for a document, so repeated seeds make no more pairs."""
        ends = np.cumsum(counts)
        for size, (hashes, owner, times, bitmap) in self.tables.items():
            grams = ngrams(words, size)
            maybe = np.flatnonzero(bitmap[(grams & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)])
            low = np.searchsorted(hashes, grams[maybe], "left")
            doc = np.searchsorted(ends, maybe, "right")
            found = (low < len(hashes)) & (maybe + size <= ends[np.minimum(doc, len(ends) - 1)])
            found[found] = hashes[low[found]] == grams[maybe[found]]
            doc, low = np.divmod(np.unique(doc[found] * len(hashes) + low[found]), len(hashes))
            owners = np.searchsorted(hashes, hashes[low], "right") - low
            index = np.repeat(low, owners) + np.arange(owners.sum()) - np.repeat(np.cumsum(owners) - owners, owners)
            pairs, of = np.unique(np.repeat(doc, owners) * len(self.items) + owner[index], return_inverse=True)
            doc, item = np.divmod(pairs, len(self.items))
            yield size, doc, item, np.bincount(of, times[index], len(pairs)).astype(np.int64)


def _spread(places: np.ndarray, size: int, n: int) -> np.ndarray:
    """True for the `size` words from each place on."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + size, -1)
    return np.cumsum(edges[:n]) > 0


class Words:
    """Words with marks, and hashes of their windows of any length that hold no marked word."""

    def __init__(self, words: np.ndarray, used: np.ndarray):
        n = len(words)
        self.words, self.used = words, used
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.append(np.uint64(1), np.full(n, BASE)))[:n]
            self.back = np.cumprod(np.append(np.uint64(1), np.full(n, INVERSE)))
            self.sums = np.append(np.uint64(0), np.cumsum(mix(words) * powers))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes), rolled from running sums."""
        taken = np.append(0, np.cumsum(self.used))
        at = np.flatnonzero(taken[size:] == taken[:-size])
        return at, (self.sums[at + size] - self.sums[at]) * self.back[at]


def tiles(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in the text, place in the item, length), longest first, no word used twice.

    Running Karp-Rabin: the greatest length at which both sides have an equal unmarked window is searched by halving, its
    windows are marked in order of their places, and the search goes on below it. Memory follows the lengths of the two."""
    seeds_text, seeds_item = ngrams(text, least), ngrams(item, least)
    in_text, in_item = np.flatnonzero(np.isin(seeds_text, seeds_item)), np.flatnonzero(np.isin(seeds_item, seeds_text))
    if not len(in_text):
        return []
    # of the text only words that shared seeds cover, with a marked word in each gap
    at = np.flatnonzero(_spread(in_text, least, len(text)))
    at = np.insert(at, np.flatnonzero(np.diff(at) > 1) + 1, -1)
    a, b = Words(text[at], at < 0), Words(item, ~_spread(in_item, least, len(item)))

    def common(size: int):
        x, hx = a.windows(size)
        y, hy = b.windows(size)
        both = np.intersect1d(hx, hy)
        return (x, hx, y, hy, both) if len(both) else None

    out, most = [], min(len(at), len(item))
    while most >= least:
        low, high = least - 1, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if common(middle) else (low, middle - 1)
        if low < least:
            break
        x, hx, y, hy, both = common(low)
        free: dict[int, deque[int]] = {}
        keep = np.isin(hy, both)
        for place, value in zip(y[keep].tolist(), hy[keep].tolist()):
            free.setdefault(value, deque()).append(place)
        keep, begin = np.isin(hx, both), 0
        for place, value in zip(x[keep].tolist(), hx[keep].tolist()):
            if place < begin:
                continue
            starts = free[value]
            while starts and b.used[starts[0]:starts[0] + low].any():
                starts.popleft()
            if starts and np.array_equal(a.words[place:place + low], b.words[starts[0]:starts[0] + low]):
                start = starts.popleft()
                a.used[place:place + low] = b.used[start:start + low] = True
                out.append((int(at[place]), start, low))
                begin = place + low
        most = low - 1
    return out


def matches(index: Seeds, data: np.ndarray, offsets: np.ndarray, least: float, least_words: int) -> Iterator[tuple[int, int, float, int, int]]:
    """(document, item, coverage, tiles, longest tile) for the documents between `offsets` and the items they hold."""
    words, counts = word_hashes(data, offsets, PUNCTUATION)
    ends = np.cumsum(counts)
    for size, docs, items, places in index.meet(words, counts):
        for d, i, n in zip(docs.tolist(), items.tolist(), places.tolist()):
            own = index.items[i][1]
            # the seeds alone bound the coverage
            if max(least * len(own), least_words) > n * size or len(own) < least_words:
                continue
            found = tiles(words[ends[d] - counts[d]:ends[d]], own, size)
            covered = sum(n for _, _, n in found)
            if covered >= max(least * len(own), least_words):
                yield d, i, covered / len(own), len(found), max(n for _, _, n in found)


def contaminated(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, least: float = COVERAGE, text: str = "text", id: str = "doc_id", item_text: str = "text",
                 item_id: str = "item_id", block: int = BLOCK, least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, item id, coverage, n_tiles, longest): one row for each document and item of which tiles cover at least `least`."""
    kinds = f"id {docs.schema[id].dataType.simpleString()}, item_id {benchmark.schema[item_id].dataType.simpleString()}, coverage double, n_tiles int, longest int"
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    out = docs.sparkSession.createDataFrame([], kinds).toDF(id, item_id, "coverage", "n_tiles", "longest")
    for items in benchmark_blocks(benchmark, item_text, item_id, block):
        out = out.unionByName(rows.mapInArrow(_search(items, seed, least, least_words), kinds).toDF(*out.columns))
    return out


def _search(items: list[tuple], seed: int, least: float, least_words: int):
    index = Seeds(items, seed)
    names = pa.array([name for name, _ in items])

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            rows = [(i + d, *rest) for i, j in pieces(offsets) for d, *rest in matches(index, data, offsets[i:j + 1], least, least_words)]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), names.take(pa.array([r[1] for r in rows], pa.int64())), pa.array([r[2] for r in rows], pa.float64()),
                                              pa.array([r[3] for r in rows], pa.int32()), pa.array([r[4] for r in rows], pa.int32())],
                                             names=["id", "item_id", "coverage", "n_tiles", "longest"])

    return run


def without_benchmark(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, least: float = COVERAGE, text: str = "text", block: int = BLOCK, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of `docs` of which no benchmark item reaches coverage `least`."""
    for items in benchmark_blocks(benchmark, "text", "item_id", block):
        docs = docs.where(~_holds(items, seed, least, least_words)(F.col(text)))
    return docs


def _holds(items: list[tuple], seed: int, least: float, least_words: int):
    index = Seeds(items, seed)

    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        data, offsets = column_bytes(pa.array([t if isinstance(t, str) else None for t in texts], pa.string()))
        hit = np.zeros(len(texts), bool)
        for i, j in pieces(offsets):
            for d, item, _, _, _ in matches(index, data, offsets[i:j + 1], least, least_words):
                hit[i + d] = True
        return pd.Series(hit)

    return holds
