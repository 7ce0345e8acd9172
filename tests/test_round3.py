"""Findings of round 3."""

import os
from decimal import Decimal

import pytest

import __spark_entry__ as E

from conftest import SF001
from oracle_harness import duck_conn


@pytest.fixture(scope="module")
def dear(spark, tmp_path_factory):
    """The small tables with prices so high that sums of money exceed the cents of a DOUBLE."""
    path = tmp_path_factory.mktemp("dear")
    for name in ("part", "supplier", "nation"):
        os.symlink(f"{SF001}/{name}.parquet", path / f"{name}.parquet")
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet")
    kind = lines.schema["l_extendedprice"].dataType.simpleString()
    (lines.selectExpr(*[f"CAST(l_extendedprice * 50000.37 AS {kind}) AS l_extendedprice" if c == "l_extendedprice" else c
                        for c in lines.columns]).coalesce(1).write.parquet(str(path / "lineitem.parquet")))
    return str(path)


@pytest.mark.parametrize("key", ["archive_slice", "retention_keep", "runner_q3_cross_exchange"])
def test_sums_beyond_the_cents_of_a_double_are_reported(spark, dear, key):
    column = "total_value_lakh" if key == "runner_q3_cross_exchange" else "value"
    got = sorted(r[column] for r in E.queries()[key](spark, dear).collect())
    con = duck_conn(SF001)
    con.execute(f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM read_parquet('{dear}/lineitem.parquet/*.parquet')")
    want = con.sql(E.oracle_sql()[key]).df()
    assert got == pytest.approx(sorted(want[column]), rel=1e-15)
    assert max(got) > 2 ** 53 / 100
    assert isinstance(got[0], float) and all(Decimal(g).is_finite() for g in got)


def test_range_sorts_take_more_tasks_for_more_rows(spark, monkeypatch, tmp_path):
    from derivspark.operators import ids
    monkeypatch.setattr(ids, "ROWS_A_TASK", 100)
    rows = spark.range(5000).selectExpr("id % 7 AS k", "id AS v")
    assert ids.by_range(rows, ["k", "v"], 5000).rdd.getNumPartitions() == 50
    got = ids.dense_ids(rows, ["v"], "n", ["k"], stage_dir=str(tmp_path), rows=5000)
    assert [r.n for r in got.orderBy("k", "v").select("n").collect()] == list(range(1, 5001))


def test_deliveries_have_more_files_for_more_rows(spark, monkeypatch):
    from derivspark.plans import model_jobs as MJ
    from derivspark.sources.fs import file_stats
    monkeypatch.setattr(MJ, "DELIVERY_ROWS", 500)
    names = {len([n for n, _, _ in file_stats(spark, inbox) if "exchange_id=1/" in n and n.endswith(".csv")])
             for inbox in MJ._deliveries(spark, SF001)}
    files = -(-spark.read.parquet(f"{SF001}/lineitem.parquet").count() // 500)
    assert names == {files, 2 * files}


def test_builds_read_small_pieces_and_leave_the_settings(spark):
    from derivspark.session import BOUNDED, bounded_tasks
    before = {k: spark.conf.get(k, None) for k in BOUNDED}
    with pytest.raises(ZeroDivisionError), bounded_tasks(spark):
        assert {k: spark.conf.get(k) for k in BOUNDED} == BOUNDED
        1 / 0
    assert {k: spark.conf.get(k, None) for k in BOUNDED} == before


def test_new_days_are_those_of_the_built_model(spark):
    from derivspark.plans import model_jobs as MJ
    from derivspark.sources.store import open_model
    assert MJ._new_days(spark, SF001)[-1] == open_model(spark, SF001).last_trade_date()


def test_the_factors_take_in_every_document(spark, monkeypatch):
    import numpy as np

    from derivspark.llm import decontaminate as D
    texts = [f"w{i % 11} w{i % 7} w{i % 5} other w{i % 3}" for i in range(60)] + [None, "", "w1 " * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(11)))], "item_id long, text string")
    seen = []
    product = D._corpus_product

    def record(docs, text, terms, idf, q):
        seen.append((terms, idf, q, product(docs, text, terms, idf, q)))
        return seen[-1][-1]

    monkeypatch.setattr(D, "_corpus_product", record)
    monkeypatch.setattr(D, "SLICE", 4)
    D.fit(docs, items)
    terms, idf, q, got = seen[0]
    find, want = D.Lookup(terms), np.zeros(q.shape)
    for text in texts:
        t = find.find(D.words(D.pa.array([text or ""]))[0])
        for i in range(0, len(t), D.BLOCK * D.SPAN):
            x = np.bincount(t[i:i + D.BLOCK * D.SPAN][t[i:i + D.BLOCK * D.SPAN] >= 0], minlength=len(terms)) * idf
            if x.any():
                x /= np.linalg.norm(x)
                want += np.outer(x, x @ q)
    assert np.allclose(got, want, atol=1e-4) and np.abs(want).max() > 1


def test_toxicity_features_are_made_in_small_pieces(spark, monkeypatch):
    from derivspark.llm import toxicity as X
    assert X.PIECE <= 1 << 20


def test_comparing_words_first_loses_no_leak(spark, monkeypatch):
    import random

    from derivspark.llm import decontaminate as D
    rng = random.Random(5)
    items = [(i, " ".join(f"q{rng.randrange(300)}" for _ in range(rng.choice([1, 5, 30, 70])))) for i in range(30)]
    texts = []
    for i in range(150):
        filler = [f"q{rng.randrange(900)}" for _ in range(rng.choice([0, 3, 200, 900]))]
        at, leak = rng.randrange(len(filler) + 1), [w for w in rng.choice(items)[1].split() if rng.random() < 0.9]
        texts.append((i, " ".join(filler[:at] + leak + filler[at:])))
    docs = spark.createDataFrame([*texts, (900, None), (901, " ")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect())
    monkeypatch.setattr(D, "MAX_SHARES", 0)
    assert found == sorted((r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()) and len(found) > 100
