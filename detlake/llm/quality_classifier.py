"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates and
scored as sparse dot products.

Features of a text are its words and word pairs (A-Z lower-cased, split at ASCII white space), hashed into `SLOTS` slots (pairs of
a word with itself into one); a slot's value is its count divided by the Euclidean length of all counts. Training deals a bounded sample of labelled texts
into fixed shards by the hash of their id; each round every shard takes a pass of updates from the common state and the
changed slots are averaged over the shards that touched them, as a Spark aggregation. The model has `SLOTS` weights whatever
the corpus, so it travels with the scoring tasks.

Defined cases: null and empty texts score by the bias alone; without any labelled text all scores are 0.5; repeated rows score
alike; other columns are ignored; long texts count whole."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from detlake.llm.sampling import TRAINING_ROWS, crc_of, training_rows
from detlake.llm.words import SPACES, column_bytes, mix, pieces, word_hashes
from detlake.session import durable

BITS = 18
SLOTS = 1 << BITS
SHARDS = 8
ROUNDS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.001, 0.0
#: the slot of every pair of a word with itself
TWICE = 1


def features(hashes: np.ndarray, counts: np.ndarray):
    """Per text (slots, values)."""
    shift = np.uint64(64 - BITS)
    pairs = (mix(mix(hashes[:-1]) + hashes[1:]) >> shift).astype(np.int64)
    pairs[hashes[:-1] == hashes[1:]] = TWICE
    ones, at = (hashes >> shift).astype(np.int64), 0
    for n in counts.tolist():
        slots, times = np.unique(np.append(ones[at:at + n], pairs[at:at + max(n - 1, 0)]), return_counts=True)
        yield slots, times / np.sqrt(float((times * times).sum())) if n else times.astype(float)
        at += n


def _slots(batch: pa.RecordBatch):
    data, offsets = column_bytes(batch.column("text"))
    for i, j in pieces(offsets):
        yield from features(*word_hashes(data, offsets[i:j + 1], SPACES))


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def update(z: np.ndarray, n: np.ndarray, slots: np.ndarray, values: np.ndarray, label: int) -> None:
    """One FTRL-proximal step for one text; the last slot is the bias."""
    slots, values = np.append(slots, SLOTS), np.append(values, 1.0)
    w = weights(z[slots], n[slots])
    g = (1 / (1 + np.exp(-float(w @ values))) - label) * values
    after = n[slots] + g * g
    z[slots] += g - (np.sqrt(after) - np.sqrt(n[slots])) / ALPHA * w
    n[slots] = after


def _pass(z: np.ndarray, n: np.ndarray, step: int):
    """One pass of updates over a shard, from the state given: the slots it touched and their state after."""

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        own_z, own_n, touched = z.copy(), n.copy(), np.zeros(SLOTS + 1, bool)
        order = pdf.assign(_by=mix(pdf["id"].to_numpy().astype(np.uint64) + np.uint64(step))).sort_values("_by")
        for label, slots, values in zip(order["label"], order["slots"], order["vals"]):
            slots = np.frombuffer(slots, np.int32)
            touched[slots] = True
            update(own_z, own_n, slots, np.frombuffer(values, np.float32).astype(float), label)
        touched[SLOTS] = True
        at = np.flatnonzero(touched)
        return pd.DataFrame({"slot": at, "z": own_z[at], "n": own_n[at]})

    return learn


def train(rows: DataFrame) -> np.ndarray:
    """SLOTS + 1 weights, the bias last. `rows`: (id, label, text), a bounded sample."""

    def featurise(batches):
        for batch in batches:
            slots, values = zip(*_slots(batch)) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([s.astype(np.int32).tobytes() for s in slots], pa.binary()),
                                              pa.array([v.astype(np.float32).tobytes() for v in values], pa.binary())], names=["id", "label", "slots", "vals"])

    sample = rows.mapInArrow(featurise, "id long, label int, slots binary, vals binary")
    sample = durable(sample.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(SHARDS)).cast("int")))
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for step in range(ROUNDS):
        mixed = sample.groupBy("shard").applyInPandas(_pass(z, n, step), "slot int, z double, n double").groupBy("slot").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toPandas()
        z[mixed["slot"]], n[mixed["slot"]] = mixed["z"], mixed["n"]
    return weights(z, n)


def score(docs: DataFrame, model: np.ndarray, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, crc, score) for every row of `docs`."""
    model = model.astype(np.float32)

    def dot(batches):
        bias = float(model[SLOTS])
        for batch in batches:
            scores = [1 / (1 + np.exp(-(bias + float(model[s] @ v)))) for s, v in _slots(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("crc"), pa.array(scores, pa.float64())], names=["id", "crc", "score"])

    return docs.select(F.col(id).alias("id"), crc_of(id).alias("crc"), F.col(text).alias("text")).mapInArrow(dot, f"id {docs.schema[id].dataType.simpleString()}, crc long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0, least: float = 0.3,
                   rows: int = TRAINING_ROWS, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: (id, held_out, score, predicted). Ids with crc32(id) mod `folds` = `held` (and null ids)
    take no part in training."""
    model = train(training_rows(docs, labels, label, F.pmod(crc_of("id"), F.lit(folds)) != held, rows, text, id))
    return score(docs, model, text, id).select(F.col("id").alias(id), F.coalesce(F.pmod("crc", F.lit(folds)) == held, F.lit(True)).alias("held_out"),
                                               "score", (F.col("score") >= least).cast("int").alias("predicted"))
