"""Repeated passages against brute force over all strings, and the merge against sorting."""

import hashlib
import os
import random
from collections import Counter

import pytest

from detlake.llm import suffix_dedup as S


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(1, 9)))
    passage = [" ".join(word() for _ in range(n)) for n in (36, 40, 45, 60, 200)]
    texts = []
    for _ in range(50):
        parts = [" ".join(word() for _ in range(rnd.choice([1, 10, 60, 300]))) for _ in range(rnd.randint(1, 3))]
        for _ in range(rnd.choice([0, 1, 1, 2])):
            p = rnd.choice(passage)
            a = rnd.randint(0, 12)
            parts.insert(rnd.randint(0, len(parts)), p[a:len(p) - rnd.randint(0, 12)])
        texts.append(rnd.choice([" ", "", "\n"]).join(parts))
    near = list(texts[3] * 2)
    near[len(near) // 3] = "Z"
    return texts + [None, "", "a" * 199, "a" * 200, "b" * 500, "ab" * 300 + "c" + "ab" * 99, texts[0], texts[0], "".join(near), "x" * 201, "y" + "x" * 200 + "z"]


@pytest.mark.parametrize("seed,length", [(1, 200), (2, 64)])
def test_removals(spark, seed, length, monkeypatch):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, tid long").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.removals(docs, length).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_stage(spark):
    texts = corpus(3)
    docs = spark.createDataFrame([(i, t, len(t or ""), None) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, spans string")
    out = S.without_repeats(docs)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs.columns and len(got) == len(texts)
    for i, (size, removed, _, _) in enumerate(brute(texts, 200)):
        if not removed:
            assert got[i].text == texts[i]
        else:
            assert size - removed - 3 <= len((got[i].text or "").encode()) <= size - removed and got[i].n_chars == len(got[i].text)


def test_empty_table(spark):
    assert S.removals(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_merge(seed):
    rnd = random.Random(seed)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(0, 60))]
    runs = [[] for _ in range(rnd.randint(1, 9))]
    for s in strings:
        rnd.choice(runs).append(s)
    runs = [(sorted(r), S._shared(sorted(r)).tolist()) for r in runs]
    order, prefix = S.merge(runs)
    got = [runs[r][0][i] for r, i in order]
    assert got == sorted(strings)
    assert prefix[1:] == [len(os.path.commonprefix([a, b])) for a, b in zip(got, got[1:])]
