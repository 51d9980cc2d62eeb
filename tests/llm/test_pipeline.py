"""The pipeline on planted cases: what must go goes, everything else stays; stages against brute force."""

import random

import corpus_pipeline
from test_jaccard_join import brute

SF = "/root/testdata/sf0.01"


def test_planted(spark, tmp_path):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("bcdfghklmnprstvz") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(3).collect()]
    original, passage = prose(300), prose(70)
    near = original.split()
    near[150] = "changed"
    half = items[1].split()
    planted = {
        1_000_000: original, 1_000_001: original, 1_000_002: " ".join(near),
        1_000_010: f"{prose(80)} {items[0]} {prose(80)}", 1_000_011: f"{prose(30)} {' '.join(half[len(half) // 2:])} {prose(20)} {' '.join(half[:len(half) // 2])}",
        1_000_020: f"{prose(60)} {passage} {prose(60)}", 1_000_021: f"{prose(90)} {passage} {prose(20)}",
        1_000_030: f"{prose(10)} you idiot and moron {prose(10)} stupid loser, scum and trash {prose(5)}",
        1_000_040: prose(200), 1_000_041: prose(20), 1_000_042: "", 1_000_043: None}
    schema = base.schema
    rows = [(d, t, "en", "planted", len(t or "")) for d, t in planted.items()]
    base.unionByName(spark.createDataFrame(rows, schema)).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / "out" / str(i)))
        docs = spark.read.parquet(str(tmp_path / "out" / str(i)))
        seen[name] = {r["doc_id"]: r for r in docs.collect() if (r["doc_id"] or 0) >= 1_000_000}
        if i < 4:
            assert docs.columns == columns
        if name == "near_duplicates":
            groups = brute([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80, 100)
            assert docs.count() == len({g[3] for g in groups})
    assert set(seen["toxicity"]) == set(planted) - {1_000_030}
    assert set(seen["near_duplicates"]) == set(seen["toxicity"]) - {1_000_001, 1_000_002}
    assert set(seen["suffix_dedup"]) == set(seen["near_duplicates"])
    for d in (1_000_020, 1_000_021):
        assert passage not in seen["suffix_dedup"][d]["text"] and seen["suffix_dedup"][d]["n_chars"] == len(seen["suffix_dedup"][d]["text"])
    assert all(seen["suffix_dedup"][d]["text"] == planted[d] for d in (1_000_000, 1_000_040, 1_000_041, 1_000_042, 1_000_043))
    assert set(seen["decontamination"]) == set(seen["suffix_dedup"]) - {1_000_010, 1_000_011}
    assert set(seen["packing"]) == set(seen["decontamination"]) - {1_000_042, 1_000_043}


def test_columns_with_names_of_helpers(spark, tmp_path):
    """Columns that the stages use inside come back as they went in, from every stage."""
    names = ["_tid", "_spans", "_id", "group", "tid", "id", "label", "crc", "score", "n_rows", "cluster", "piece"]
    texts = {1: "alpha beta " * 200, 2: "alpha beta " * 200, 3: "one two three four five six", 4: None, 5: ""}
    rows = [(d, t, "en", "s", len(t or ""), *[11 * d + i for i in range(len(names))]) for d, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert [r[n] for n in names] == [11 * r.doc_id + i for i in range(len(names))], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "bin" in out.columns and corpus_pipeline.ORACLE_SQL is None
