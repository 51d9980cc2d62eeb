"""Embedding whitening from exact integer cross-products, counted on bit planes.

Each entry c becomes the integer floor(`scale` * c) + `offset`. The fit list is each distinct integer vector once. A task takes
its vectors in chunks: every dimension is shifted by the chunk's smallest value, its bit planes are packed across the rows into
64-bit words, and the population counts of ANDed planes, weighted by the planes' powers of two, are the exact cross-products.
The shifts are taken back in whole numbers. One row for each pair of dimensions and task goes to the sum, so what is shuffled
and what the driver receives follows the square of the dimensions, not the rows. The driver centres in whole numbers, divides
once and decomposes the covariance (eigh). Vectors never leave their tasks but for the distinct list.

Defined cases: rows whose vector is null, empty, or holds a null, NaN or infinite entry are left out; so are vectors of another
length than most have (of lengths equally frequent, the longest counts). Entries beyond ±2^61 after scaling are held at that.
Components whose eigenvalue is below `LEAST` of the largest carry no information and are left out, so one distinct vector, or
none, gives no rows. Repeated rows are whitened each, null ids are kept, other columns are ignored. A deviation beyond a 64-bit
integer is null."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from detlake.session import work_folder

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: rows whose planes are packed together: 256 words a plane
CHUNK = 16_384
LEAST = 1e-12
_HELD = 2.0 ** 61


def whole(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    def entry(c):
        return F.greatest(F.lit(-_HELD), F.least(F.lit(_HELD), F.floor(c.cast("double") * F.lit(float(scale))).cast("double"))).cast("long") + F.lit(offset)
    return F.transform(vector, entry)


def usable(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c.cast("double"))), F.lit(False))


def matrices(batches: Iterator[pa.RecordBatch], column: str, rows: int = CHUNK) -> Iterator[np.ndarray]:
    """The vectors of an Arrow column as integer matrices of up to `rows` rows."""
    for batch in batches:
        vectors = batch.column(column)
        for at in range(0, len(vectors), rows):
            part = vectors.slice(at, rows)
            yield np.asarray(part.flatten(), np.int64).reshape(len(part), -1)


def cross_products(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """(sums, upper triangle of the cross-products) of the columns of an integer matrix, exact whatever their size."""
    n, d = x.shape
    low = x.min(0)
    u = (x - low).astype(np.uint64)
    padded = np.zeros((-(-n // 64) * 64, d), np.uint64)
    padded[:n] = u
    depth = [int(v).bit_length() for v in u.max(0)]
    dims = [i for i in range(d) for _ in range(depth[i])]
    shifts = [p for i in range(d) for p in range(depth[i])]
    planes = np.zeros((len(dims), len(padded) // 64), np.uint64)
    for at, (i, p) in enumerate(zip(dims, shifts)):
        planes[at] = np.packbits(((padded[:, i] >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)).view(np.uint64)
    sums = [0] * d
    inner = [[0] * d for _ in range(d)]
    first = np.cumsum([0, *depth])
    # plane powers in whole numbers of any size where 64 bits could overflow
    wide = 2 * max(depth, default=0) + n.bit_length() > 62
    power = np.array([1 << p for p in shifts], object if wide else np.int64)
    ones = np.bitwise_count(planes).sum(1).astype(np.int64)
    for i in range(d):
        sums[i] = int(sum(int(ones[a]) << shifts[a] for a in range(first[i], first[i + 1])))
        if first[i] == first[i + 1]:
            continue
        total = 0
        for a in range(first[i], first[i + 1]):
            both = np.bitwise_count(planes[first[i]:] & planes[a]).sum(1).astype(np.int64)
            total = total + (both.astype(object) if wide else both) * power[first[i]:] * (1 << shifts[a])
        edges = first[i:] - first[i]
        for j in range(i, d):
            inner[i][j] = int(total[edges[j - i]:edges[j - i + 1]].sum()) if edges[j - i] < edges[j - i + 1] else 0
    # back from the shift: x = u + low
    low = [int(v) for v in low]
    for i in range(d):
        for j in range(i, d):
            inner[i][j] += low[i] * sums[j] + low[j] * sums[i] + n * low[i] * low[j]
    return [s + n * v for s, v in zip(sums, low)], inner


def scatter(fit: DataFrame, column: str = "x") -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, upper triangle of cross-products) of a table of integer vectors of one length."""

    def count(batches):
        n, sums, inner = 0, None, None
        for x in matrices(batches, column):
            s, q = cross_products(x)
            n += len(x)
            sums = s if sums is None else [a + b for a, b in zip(sums, s)]
            inner = q if inner is None else [[a + b for a, b in zip(u, v)] for u, v in zip(inner, q)]
        if not n:
            return
        cells = [(-1, 0, n), *((-1, i + 1, s) for i, s in enumerate(sums)), *((i, j, inner[i][j]) for i in range(len(sums)) for j in range(i, len(sums)))]
        # in steps of 31 bits, whose sums over all tasks fit a long
        parts = []
        for _ in range(5):
            parts.append([v & (1 << 31) - 1 for *_, v in cells])
            cells = [(i, j, v >> 31) for i, j, v in cells]
        top = [v for *_, v in cells]
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()), *(pa.array(p, pa.int64()) for p in (*parts, top))],
                                         names=["i", "j", *(f"v{k}" for k in range(6))])

    parts = fit.select(column).mapInArrow(count, "i int, j int, " + ", ".join(f"v{k} long" for k in range(6)))
    cells = {(r.i, r.j): sum(r[f"s{k}"] << (31 * k) for k in range(6)) for r in parts.groupBy("i", "j").agg(*(F.sum(f"v{k}").alias(f"s{k}") for k in range(6))).collect()}
    if not cells:
        return 0, [], []
    d = max(j for i, j in cells if i == -1)
    return cells[-1, 0], [cells[-1, i + 1] for i in range(d)], [[cells[i, j] if j >= i else 0 for j in range(d)] for i in range(d)]


class Whitening:
    """Components of a covariance, from whole numbers: `n` vectors, their sums and cross-products."""

    def __init__(self, n: int, sums: list[int], inner: list[list[int]], components: int = COMPONENTS):
        d = len(sums)
        self.n, self.sums = n, sums
        v = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                v[i, j] = v[j, i] = (n * inner[i][j] - sums[i] * sums[j]) / (n * n)
        e, q = np.linalg.eigh(v)
        order = np.argsort(-e, kind="stable")
        e, q = e[order], q[:, order]
        keep = int((e > LEAST * e[0]).sum()) if d and e[0] > 0 else 0
        k = min(components, keep)
        # one sign for all: the largest entry of a component is positive
        q = q[:, :k] * np.sign(q[np.abs(q[:, :k]).argmax(0), range(k)])
        self.projection, self.explained = q / np.sqrt(e[:k]), e[:k] / np.trace(v) if k else np.zeros(0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in whole numbers."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        if bound < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        if centred.size and centred.dtype != object and float(np.abs(centred).max()) ** 2 * centred.shape[1] < 2.0 ** 62:
            return (centred * centred).sum(1).tolist()
        found = (centred.astype(object) ** 2).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in found]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ self.projection


def identity_error(fit: DataFrame, model: Whitening, column: str = "x") -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, from the whitened values."""
    k = model.projection.shape[1]

    def total(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for x in matrices(batches, column):
            w = model.whitened(model.centred(x))
            first += w.sum(0)
            second += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * (k + 1)), pa.int32()), pa.array(np.append(first, second.ravel()), pa.float64())], names=["i", "v"])

    sums = {r.i: r.v for r in fit.select(column).mapInArrow(total, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    values = np.array([sums[i] for i in range(k * (k + 1))])
    mean = values[:k] / model.n
    return float(np.abs(values[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row for each usable row and component."""
    kind = rows.schema[id].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [id, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    good = rows.select(F.col(id).alias("id"), F.col(vector).alias("v")).where(usable(F.col("v")))
    # one row for each length there is; only the first is read
    most = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return rows.sparkSession.createDataFrame([], schema).toDF(*names)
    whole_rows = good.where(F.size("v") == most.d).select("id", whole(F.col("v"), scale, offset).alias("x"))
    # equal vectors of one task are one row before they are sent; the list is written once and read twice
    folder = work_folder(rows.sparkSession)
    whole_rows.select("x").distinct().write.parquet(f"{folder}/fit")
    fit = rows.sparkSession.read.parquet(f"{folder}/fit")
    model = Whitening(*scatter(fit), components)
    k = model.projection.shape[1]
    if not k:
        return rows.sparkSession.createDataFrame([], schema).toDF(*names)
    error = identity_error(fit, model)

    def apply(batches):
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.slice(at, CHUNK)
                x = next(matrices([part], "x"))
                centred = model.centred(x)
                own = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(own)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array([model.n] * len(own), pa.int64()),
                                                  pa.array(model.deviations(centred), pa.int64()).take(pa.array(own)), pa.array(model.whitened(centred).ravel()), pa.array(np.tile(model.explained, len(x))),
                                                  pa.array([error] * len(own), pa.float64())], names=["id", *names[1:]])

    return whole_rows.mapInArrow(apply, schema).toDF(*names)
