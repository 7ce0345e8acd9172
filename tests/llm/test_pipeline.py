"""The corpus pipeline on documents with planted toxic rows, near copies and benchmark passages: the ids
that every stage keeps, against brute force on that stage's own input."""

import random

import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")
from derivspark.llm import mixing, sharding  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(t, k=5):
    w = t.lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """(folder, documents, ids by kind): invented prose; every fifth document is labelled."""
    rng = random.Random(4)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "mp")]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, kind, labels = [], {"clean": set(), "toxic": set(), "copy": set(), "leak": set()}, []
    for i in range(600):
        text = prose(rng.randint(60, 200))
        if i % 6 == 1:
            w = text.split()
            for at in range(0, len(w), 7):
                w[at] = rng.choice(["scumvile", "hateslur", "killfilth"])
            text = " ".join(w)
            kind["toxic"].add(i)
        else:
            kind["clean"].add(i)
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        if i % 2 == 0 or i < 300:
            labels.append((i, 1, int(i in kind["toxic"])))
    for i in range(600, 640):  # near copies of clean documents: one word in forty changed
        source = rows[6 * (i - 600)][1].split()
        for at in range(10, len(source), 80):
            source[at] = "changed"
        text = " ".join(source)
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        kind["copy"].add(i)
    bench = [(j, prose(45)) for j in range(12)]
    for i in range(640, 664):
        text = prose(50) + " " + bench[i % 12][1] + " " + prose(50)
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        kind["leak"].add(i)
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, spark.read.parquet(f"{folder}/documents.parquet"), kind


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_every_stage_takes_what_it_is_for_and_leaves_the_rest(spark, planted):
    folder, docs, kind = planted
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]

    kept = spark.createDataFrame(stages["toxicity"](spark, docs, folder).collect(), docs.schema)
    gone = ids(docs) - ids(kept)
    assert len(gone & kind["toxic"]) >= 0.95 * len(kind["toxic"]) and len(gone - kind["toxic"]) <= 0.01 * docs.count()

    texts = {r.doc_id: shingles(r.text) for r in kept.collect()}
    first = {}
    for i in sorted(texts):
        near = [j for j in first if first[j] == j and 100 * len(texts[i] & texts[j]) >= 80 * len(texts[i] | texts[j])]
        first[i] = near[0] if near else i
    kept = spark.createDataFrame(stages["near_dedup"](spark, kept, folder).collect(), docs.schema)
    assert ids(kept) == {i for i in first if first[i] == i}
    assert not ids(kept) & {i for i in kind["copy"] if first.get(i, i) != i} and len(kind["copy"] - ids(kept)) >= 38

    bench = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in kept.collect() if any(b in r.text for b in bench)}
    assert leaks
    kept = spark.createDataFrame(stages["decontamination"](spark, kept, folder).collect(), docs.schema)
    assert ids(kept) == set(first[i] for i in first if first[i] == i) - leaks

    plan = {r.doc_id: r.passes for r in mixing.mix_plan(kept).collect()}
    mixed = spark.createDataFrame(stages["mixing"](spark, kept, folder).collect(), docs.schema)
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in plan.items() if n}

    out = stages["sharding"](spark, mixed, folder)
    assert out.count() == mixed.count() and ids(out) == ids(mixed)
    assert out.agg(F.max("shard_bytes")).first()[0] <= sharding.MAX_BYTES


def test_run_applies_all_stages(spark, planted):
    folder, docs, kind = planted
    out = pipeline.run(spark, folder)
    assert set(docs.columns) <= set(out.columns) and {"shard", "shard_bytes"} <= set(out.columns)
    left = ids(out)
    assert not left & kind["leak"] and len(left & kind["toxic"]) <= 0.05 * len(kind["toxic"])
    assert len(left & kind["copy"]) <= 2 and len(left & kind["clean"]) > 0.4 * len(kind["clean"])


def test_pipeline_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = pipeline.run(spark, SF)
    assert set(docs.columns) <= set(out.columns) and {"shard", "shard_bytes"} <= set(out.columns)
    n, left = out.count(), ids(out)
    assert 0 < len(left) <= docs.count() and n >= len(left)


def test_stages_take_awkward_and_empty_tables(spark):
    rows = [(1, "a b c d e f", "en", "s", 11), (2, None, None, None, None), (None, "x y", "en", "s", 3), (1, "a b c d e f", "en", "s", 11)]
    odd = spark.createDataFrame(rows, COLUMNS)
    for docs in (odd, odd.limit(0)):
        for name, step in pipeline.STAGES:
            out = step(spark, docs, SF)
            assert set(docs.columns) <= set(out.columns), name
            out.count()
