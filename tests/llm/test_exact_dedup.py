"""Exact duplicates against grouping by text, also where hashes collide."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from detlake.llm import exact_dedup as E

SMALL = {c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def norm(text):
    return "".join(SMALL.get(c, c) for c in text or "")


def expected(rows, largest):
    groups = {}
    for id, text in rows:
        groups.setdefault(norm(text), []).append(id)
    key = lambda i: (i is not None, i or 0)
    return sorted((str(id), str((max if largest else min)(groups[norm(text)], key=key)), len(groups[norm(text)]), hashlib.sha256(norm(text).encode()).hexdigest()) for id, text in rows)


def weak(value):
    """A hash of four bits, so unlike texts share it."""
    return F.unhex(F.substring(F.md5(value.cast("binary")), 1, 1))


@pytest.mark.parametrize("largest", [False, True])
@pytest.mark.parametrize("digest", [E.md5_of, weak])
def test_copies(spark, largest, digest):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice("aBcÄß \n") for _ in range(rnd.randint(0, 3)))) for i in range(300)]
    rows += [(1000 + i, "the same text") for i in range(150)] + [(2000, None), (2001, ""), (None, "the same text"), (None, "alone"), (2003, "x" * 200_000), (2004, "X" * 200_000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 7, 7) for r in rows], "doc_id long, text string, n int, digest int").repartition(3)
    out = E.copies(df, largest, digest).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in out) == expected(rows, largest)
    assert sum(r.kept for r in out) == len({norm(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def test_repeated_rows_keep_one(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "A"), (2, "b"), (2, "b")], "doc_id long, text string")
    out = E.copies(df, True).collect()
    assert sorted((r.doc_id, r.group_size) for r in out if r.kept) == [(1, 3), (2, 2)] and len(out) == 5


def test_no_rows(spark):
    assert E.copies(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def test_bitmap_lets_every_repeated_hash_through(spark):
    texts = spark.range(2000).select(E.md5_of(F.col("id").cast("string")).alias("digest"), F.col("id").alias("norm"))
    repeated = texts.where("norm % 7 = 0").select("digest")
    found = {r.norm for r in E.suspects(texts, repeated).collect()}
    assert {i for i in range(2000) if i % 7 == 0} <= found and len(found) < 320
