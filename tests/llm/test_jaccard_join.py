"""The join and its stage against all pairs, on small tables."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from detlake.llm import jaccard_join as J


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    name = list(range(len(rows)))
    find = lambda i: i if name[i] == i else find(name[i])
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                name[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted((rows[i][0] is None, rows[i][0] or 0, len(sets[i]),
                   (min((d for d in groups[find(i)] if d is not None), default=None) if sets[i] else rows[i][0]) or 0) for i in range(len(rows)))


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5))) for _ in range(300)]
    texts = []
    for _ in range(60):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 4, 8, 20, 60, 200, 700]))]
        for _ in range(rnd.choice([1, 1, 2, 6])):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, len(words) // 40))):
                at = rnd.randrange(len(words))
                words[at:at + rnd.randint(0, 2)] = [rnd.choice(vocabulary)] * rnd.randint(0, 2)
            texts.append(rnd.choice([" ", "\n", " \t"]).join(w.upper() if rnd.random() < .02 and w.isascii() else w for w in words))
    texts += [None, "", " \n ", texts[0], texts[0], "x", "x", "X", "a b", "a  b", "y " * 5000, "y " * 5001, "long" * 3000]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,k,num,den", [(1, 3, 90, 100), (2, 5, 80, 100), (3, 1, 50, 100)])
def test_components(spark, seed, k, num, den):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, "s", d) for d, t in rows], "doc_id long, text string, tid string, component long").repartition(5)
    got = J.similarity_components(docs, k, num, den).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == brute(rows, k, num, den)


def test_large_cluster_in_blocks(spark):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(40):
        words = list(base)
        for _ in range(rnd.randint(1, 9)):
            words[rnd.randrange(300)] = f"n{rnd.randrange(10 ** 6)}"
        texts.append(" ".join(words))
    members = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "cluster long, tid long, text string")
    whole = J.exact_groups(members, 3, 90, 100).collect()
    split = J.exact_groups(members, 3, 90, 100, block=7).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, split)) and 1 < len({r.group for r in whole}) < len(whole) == 40


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.similarity_components(docs).count() == 0 and J.one_per_group(docs).count() == 0


def test_stage_keeps_one_row(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text, 1), (2, text + " more", 2), (2, text + " more", 3), (7, "other words stand here today", 4), (8, None, 5), (9, "", 6),
            (None, "other words stand here today", 7), (None, "alone and without any id here", 8), (5, "twice the same words and id", 9), (5, "twice the same words and id", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _tid long")
    got = J.one_per_group(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 2), (False, 5), (False, 7), (False, 8), (False, 9), (True, 0)]


def test_prefixes_meet():
    rnd = np.random.default_rng(3)
    steps = rnd.integers(0, 9, J.SLOTS).astype(np.uint8)
    for n in range(1, 200):
        a = np.unique(rnd.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2))
        for drop in range(len(a) // 5 + 1):
            b = np.delete(a, rnd.permutation(len(a))[:drop])
            if 100 * len(b) >= 80 * len(a):
                assert np.intersect1d(J.prefix(a, steps, 80, 100), J.prefix(b, steps, 80, 100)).size


def test_chance_tokens_join_no_clusters(spark):
    """A passage that one other text has by chance, as in large corpora: nothing is a candidate but the real copies."""
    rnd, texts = random.Random(8), []
    for i in range(300):
        words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(60)]
        words[:5] = [f"p{i}{j}" for j in range(5)]
        words[-5:] = [f"p{(i + 1) % 300}{j}" for j in range(5)]
        texts.append(words)
    copies = [(i, words[:30] + ["new"] + words[31:]) for i, words in enumerate(texts[:9])]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)] + [(1000 + i, " ".join(w)) for i, w in copies]
    docs = spark.createDataFrame(rows, "tid long, text string").repartition(7)
    links = J.candidate_links(docs, 5, 80, 100).collect()
    assert sorted((r.a, r.b) for r in links) == [(i, 1000 + i) for i, _ in copies]


def test_shares_of_similar_sets_are_whole():
    rnd = np.random.default_rng(4)
    steps = rnd.integers(0, 9, J.SLOTS).astype(np.uint8)
    for n in (*range(1, 60), 150, 400):
        a = np.unique(rnd.integers(0, 2 ** 62, n).astype(np.uint64) * np.uint64(4))
        for part in (0, 1, 2):
            # as many tokens go and come as the threshold allows, or half of them, or none
            gone = next(g for g in range(len(a), -1, -1) if 100 * (len(a) - g) >= 80 * (len(a) + (g if part == 1 else 0))) * (part < 2)
            come = rnd.integers(0, 2 ** 61, gone if part == 1 else 0).astype(np.uint64) * np.uint64(4) + np.uint64(1)
            b = np.union1d(rnd.permutation(a)[gone:], come)
            sides = [(J.prefix(s, steps, 80, 100, J.SHARED), len(s)) for s in (a, b)]
            cols = [np.concatenate(c) for c in zip(*[(p, np.full(len(p), 7 + i), np.full(len(p), m), np.arange(len(p))) for i, (p, m) in enumerate(sides)])]
            x, y, share = J.pair_shares(*cols, 80, 100)
            assert (x.tolist(), y.tolist(), share.tolist()) == ([7], [8], [J.WHOLE])
