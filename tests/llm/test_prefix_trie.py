"""The trie against one built turn by turn; stretches so short that nodes stay open over several rounds."""

import hashlib
import random
import zlib

import pytest

from detlake.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, path string"


def digest(turn):
    return hashlib.sha256(f"{len(turn[0])}:{turn[0]}{turn[1]}".encode()).hexdigest()[:32]


def expected(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1], digest(t[2:])))] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(built) + 1):
            nodes.setdefault(built[:d], []).append((c, d == len(built)))
    kids = {}
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        below = kids.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) or 1
        saved[k] = sum(saved[x] for x in below) + ((len(nodes[k]) - 1) * len(k[-1][1]) if k else 0)
    low = {k: min(c for c, _ in v) for k, v in nodes.items()}
    return sorted((low[k], len(k), low[k[:-1]] if k else -10 ** 9, len(v), len(kids.get(k, [])), leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(c for c, e in v if e))).encode()).hexdigest())
                  for k, v in nodes.items())


def found(spark, rows, **options):
    out = P.trie(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3), **options).collect()
    return sorted((r.conv_id, r.depth, -10 ** 9 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in out)


@pytest.mark.parametrize("stretch", [32 << 20, 3000])
def test_trie(spark, stretch):
    rnd = random.Random(5)
    rows = []
    for c in [*range(-120, 250), 1000, 1001, 5003]:
        for turn in range(rnd.choice([1, 2, 3, 5, 8])):
            rows.append((c, turn, rnd.choice(["user", "", None]), rnd.choice(["hello", "ä", "", None, "one\ntwo"])))
    # one conversation in very many copies, a deep one, ties, null turns, rows of no conversation
    rows += [(10_000 + 100 * i, t, "user", "same") for i in range(60) for t in range(3)]
    rows += [(77_700, t, "user", f"deep {t}") for t in range(120)] + [(77_701, t, "user", f"deep {t}") for t in range(90)]
    rows += [(88_800, None, "user", "b"), (88_800, None, "user", "a"), (88_800, 0, "user", "a"), (88_800, 0, "user", "a"), (None, 0, "user", "nobody"), (88_900, 4, None, None)]
    rnd.shuffle(rows)
    assert found(spark, rows, stretch=stretch) == expected(rows)


def test_long_texts_and_no_rows(spark):
    rows = [(1, 0, "user", "é" * 100_000), (2, 0, "user", "é" * 100_000)]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == [] == found(spark, [(None, 1, "user", "x")])


def test_ids_of_a_node_are_hashed_in_order_over_several_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "TEXT", 20)
    rows = [(100 * i, 0, "user", "same") for i in range(1, 400)]
    assert found(spark, rows, stretch=2000) == expected(rows)


def test_peel_merges_partial_nodes():
    unit = lambda i: bytes([i]) * 16 + (3).to_bytes(8, "big")
    a, b = unit(1), unit(2)
    rows = {a + b: (2, 5, 2, 0, 0, 0), a: (1, 7, 1, 0, 0, 0)}
    nodes, waiting = P.peel(rows, True)
    assert waiting == [] and {(n[2], n[3], n[4], n[5], n[6], n[7]) for n in nodes} == {(2, 5, 2, 0, 1, 3), (1, 5, 3, 1, 1, 9), (0, 5, 3, 1, 1, 9)}
    nodes, waiting = P.peel(rows, False)
    assert nodes == [] and sorted(w[0] for w in waiting) == [a, a + b]
