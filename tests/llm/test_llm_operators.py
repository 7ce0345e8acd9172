"""Each operator against a brute-force version, and on awkward tables: nulls, empty and
very long texts, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import os
import re
import sys
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("derivspark.llm")
from derivspark.llm import (chat_format, common, decontaminate, gru_lm, hyperminhash, mixing, quality, sharding,  # noqa: E402
                            textvec, token_count, toxicity, url_filter)
from derivspark.llm.common import crc_mod  # noqa: E402

SF = "/root/testdata/sf0.001"
SPACE = re.compile("[\x20\x09-\x0d]+")


def words(t):
    return [w for w in SPACE.split(t or "") if w]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
            (4, " \n\t ", "en", "b"), (5, "word " * 30000, "en", "b"), (6, "alpha beta gamma delta epsilon zeta", "en", "a"),
            (6, "alpha beta gamma delta epsilon zeta", "en", "a"), (None, "no id here at all", "en", None),
            (7, "x" * 200000, "en", "b"), (8, "été | naïve  <|endoftext|> \U0001f600 fin", "fr", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("doc_id", -F.col("doc_id"))
    for extra in ("size", "n", "comp", "key", "p", "score", "shard", "class", "bytes"):
        df = df.withColumn(extra, F.lit("mine"))
    return df


def oracle(name, sf=SF):
    from derivspark.llm.queries import ORACLE
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.execute(ORACLE[name]).df()


@pytest.mark.parametrize("name", ["op1_sharding", "op2_quality_lines", "op5_url_filter", "op8_chat_format", "op10_hyperminhash",
                                  "op11_ngram_join"])
def test_sql_oracles(spark, name):
    from derivspark.llm.queries import QUERIES
    got, want = QUERIES[name](spark, SF).toPandas(), oracle(name)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = lambda d: sorted(map(repr, d[cols].astype(object).where(d[cols].notna(), None).values.tolist()))
    assert rows(got) == rows(want)


def test_shards_fit_and_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    limit = 20_000
    got = sharding.shard_documents(docs, max_bytes=limit).select("doc_id", "n_bytes", "shard").toPandas()
    bits = {d: bin(int(hashlib.md5(str(d).encode()).hexdigest()[:15], 16))[2:].zfill(60) for d in got.doc_id}
    size = dict(zip(got.doc_id, got.n_bytes))
    for r in got.itertuples():
        depth = next(k for k in range(61) if sum(size[d] for d in size if bits[d][:k] == bits[r.doc_id][:k]) <= limit
                     or k == 60)
        assert r.shard == (bits[r.doc_id][:depth] or "root")


def test_shards_split_copies_of_one_key(spark, odd):
    many = spark.range(4000).select(F.lit(9).alias("doc_id"), F.lit("z" * 100).alias("text"))
    got = sharding.shard_documents(many, max_bytes=10_000)
    assert got.count() == 4000 and got.groupBy("shard").agg(F.sum("n_bytes").alias("b")).agg(F.max("b")).first()[0] <= 10_000
    out = sharding.shard_documents(odd, max_bytes=1000)
    assert out.count() == odd.count() and set(odd.columns) <= set(out.columns)
    assert sharding.shard_documents(odd.limit(0)).count() == 0


def test_quality_base_counts(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = quality.quality(docs).toPandas()
    text = {(r.doc_id, zlib.crc32((r.text or "").encode())): r.text for r in docs.collect()}
    by_id = {}
    for (d, _), t in text.items():
        by_id[d] = t
    for r in got.itertuples():
        t = by_id.get(None if np.isnan(r.doc_id) else int(r.doc_id)) or ""
        w = words(t)
        tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        seen = {}
        for x in tri:
            seen[x] = seen.get(x, 0) + 1
        hit = {j for i, x in enumerate(tri) if seen[x] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit))
        assert r.n_symbols == len(re.findall("[#*$%&|<>]", t))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality.quality(odd.limit(0)).count() == 0


FURNITURE = ["All rights reserved.", "Sign in", "» Read more", "This work is licensed under the GNU General Public License, version 3.",
             "Copyright 2019 Somebody", "Alle Rechte vorbehalten", "Diese Webseite verwendet Cookies", "Weiterlesen …",
             "Tous droits réservés", "Lire la suite", "Todos los derechos reservados", "Leer más"]
PROSE = ["the catalog in the library", "Dialog in der Oper", "The design in the corner", "People spread more rumours",
         "the copyright of his late father's novel", "We sign in blue ink and read more books.", "Sie melden sich anmelden zu wollen an",
         "Il faut se connecter au monde", "Quiere leer más libros de historia", "A newsletter arrived", "Contact us was all he said"]


def test_line_rules_take_furniture_and_leave_prose(spark):
    rows = [(0, x, True) for x in FURNITURE] + [(1, x, False) for x in PROSE] + [
        (2, "Home | News | Sport | Contact", True), (3, "BUY!! NOW!! CHEAP!! ", True), (4, "$$$ ### *** a", True),
        (5, " ".join(f"w{i}" for i in range(25)), True), (6, " ".join(f"w{i}" for i in range(25)) + ".", False),
        (7, "a b. " * 15, True), (8, " ".join(f"w{i}" for i in range(19)), False)]
    got = spark.createDataFrame(rows, "k int, line string, bad boolean").select("line", "bad", quality.line_reason(F.col("line")).alias("r"))
    assert [(r.line, r.r) for r in got.collect() if (r.r is not None) != r.bad] == []


def test_quality_verdict_and_clean_text(spark):
    prose = [" ".join(f"word{i}x{j}" for j in range(8)) + "." for i in range(12)]
    few, many = prose + FURNITURE[:3], prose[:8] + [f"a{i} home | b{i} news | c{i} sport | d{i} contact | e{i} about | f{i} help" for i in range(24)]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(
        [(1, "\n".join(few)), (2, "\n".join(many)), (3, "\n".join(few) + "\n \n")], "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].n_removed_lines == 3 and got[1].clean_text == "\n".join(prose)
    assert abs(got[1].lost_fraction - (1 - len("\n".join(prose)) / len("\n".join(few)))) < 1e-12 and got[3].n_lines == got[1].n_lines
    assert not got[2].kept and not got[2].base_failed and got[2].n_navigation_lines == 24 and got[2].lost_fraction > 0.5


def test_ftrl_learns_words_and_scores_every_row(spark, odd):
    rows = [(i, f"plain text number {i} " + ("awful scum " if i % 4 == 0 else "kind words ") * 2, int(i % 4 == 0))
            for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    w = toxicity.fit(docs.filter("doc_id < 300"))
    got = docs.filter("doc_id >= 300").select("toxic", toxicity.score(docs, w).alias("s")).toPandas()
    assert ((got.s >= 0.5) == (got.toxic == 1)).all()
    scores = [r.s for r in odd.select(toxicity.score(odd, w).alias("s")).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert not toxicity.fit(docs.limit(0)).any()


def test_leaks_exact_and_paraphrased(spark, odd):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    some = items.orderBy("item_id").limit(6).collect()
    changed = []
    for i, r in enumerate(some):  # every sixth word replaced, one inserted in front of each tenth
        w = [("qqx" if k % 6 == 5 else x) for k, x in enumerate(words(r.text))]
        changed.append((10_000_000 + i, "filler begin words here " * 20 + " ".join(w) + " and some more text behind " * 20))
    planted = spark.createDataFrame(changed, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs.unionByName(planted), items).collect()}
    text = {r.doc_id: " " + " ".join(words((r.text or "").lower())) + " " for r in docs.collect()}
    exact = {(d, r.item_id) for r in items.collect() for d, t in text.items() if " " + " ".join(words(r.text.lower())) + " " in t}
    assert exact <= got and {(10_000_000 + i, r.item_id) for i, r in enumerate(some)} <= got
    assert len(got) <= len(exact) + len(some) + 2
    assert decontaminate.find_leaks(odd.select("doc_id", "text"), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(odd, items).count() == odd.count()


def test_leaks_of_hot_items_and_of_frequent_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("text is not null").orderBy("doc_id").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()
    n = {}
    for r in docs:
        for w in set(words(r.text.lower())):
            n[w] = n.get(w, 0) + 1
    frequent = " ".join(sorted(n, key=lambda w: (-n[w], w))[:40])
    assert min(n[w] for w in frequent.split()) > 0.05 * len(docs)
    rows = [(r.doc_id, r.text + (" " + items[0].text if k % 3 == 0 else "") + (" " + frequent if k % 40 == 0 else ""))
            for k, r in enumerate(docs)]
    bench = [(r.item_id, r.text) for r in items] + [(10_000_000, frequent)]
    docs_df, items_df = (spark.createDataFrame(x, f"{k} long, text string") for x, k in ((rows, "doc_id"), (bench, "item_id")))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs_df, items_df).collect()}
    want = {(d, items[0].item_id) for k, (d, _) in enumerate(rows) if k % 3 == 0}
    want |= {(d, 10_000_000) for k, (d, _) in enumerate(rows) if k % 40 == 0}
    assert want <= got
    kept = {r.doc_id for r in decontaminate.drop_leaks(docs_df, items_df).collect()}
    assert not kept & {d for d, _ in want}


def test_group_sums_of_rows_cost_less_than_adding_row_by_row():
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((500, 144)).astype(np.float32)
    sizes = rng.integers(1, 40, 3000)
    sizes[7] = 5000  # more rows than are held at once
    heads = np.cumsum(sizes) - sizes
    rows, weights = rng.integers(0, 500, sizes.sum()), rng.random(sizes.sum()).astype(np.float32)
    took, out = {}, {}
    for name, f in (("plain", lambda: np.add.reduceat(matrix[rows] * weights[:, None], heads, axis=0)),
                    ("sums", lambda: decontaminate._sums(matrix, rows, weights, heads))):
        took[name] = []
        for _ in range(3):
            begun = time.process_time()
            out[name] = f()
            took[name].append(time.process_time() - begun)
    assert np.allclose(out["sums"], out["plain"], rtol=1e-3, atol=1e-2) and out["sums"].dtype == np.float32
    assert min(took["sums"]) < min(took["plain"]) / 2
    assert decontaminate._sums(matrix, rows[:0], weights[:0], heads[:0]).shape == (0, 144)


def test_automaton_equals_regular_expressions(spark):
    globs = ["*.com/**", "a*b/**x", "**", "abc", "*/en/*", "é*" + "z" * 70 + "**"]
    strings = ["x.com/", "x.com", "a/b/x", "aXXb/yyx", "", "abc", "q/en/", "q/en/a/b", "é" + "z" * 75, "a" * 3000 + "b/x"]
    to_re = lambda g: re.compile("".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p)
                                         for p in re.split(r"(\*\*|\*)", g)), re.S)
    got = url_filter.Automaton(globs).accepts(pa.array(strings))
    assert got.tolist() == [[bool(to_re(g).fullmatch(s)) for g in globs] for s in strings]
    odd = spark.createDataFrame([(1, None), (2, "no scheme"), (None, "http://X.NET/es/?q"), (3, "http://")], "page_id long, url string")
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(odd).collect()}
    assert rows == {1: ("", "", None, "block"), 2: ("", "", None, "block"), None: ("x.net", "/es/", "net/es/", "block"),
                    3: ("", "", None, "block")}


def test_language_model_base_and_probability(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = gru_lm.score(docs, train_on=crc_mod("doc_id", 7) != 2).toPandas()
    rows = docs.collect()
    learn = [r for r in rows if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    c = {}
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    for r in learn:
        for w in words(low(r.text)):
            c[w] = c.get(w, 0) + 1
    n, v = sum(c.values()) + len(learn), len(c) + 1
    want = sorted((len(words(low(r.text))) + 1, sum(w in c for w in words(low(r.text))) + 1,
                   round(sum(np.log10((c.get(w, 0) + 1) / (n + v + 1)) for w in words(low(r.text)))
                         + np.log10((len(learn) + 1) / (n + v + 1)), 4)) for r in rows)
    have = sorted((a, b, round(x, 4)) for a, b, x in zip(got.n_tokens, got.n_known, got.base_score))
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 2e-3 * max(1, abs(a[2]) / 1000) for a, b in zip(have, want))
    assert set(got.train_tokens) == {n} and got.score.sum() > got.base_score.sum()


def test_network_is_fitted_on_every_whole_text(spark):
    head, tail = " ".join(f"w{i % 50}" for i in range(1000)), [f"w{i % 7}" for i in range(500)]
    nets = [gru_lm.fit(spark.createDataFrame([(1, head + " " + " ".join(x))], "doc_id long, text string"), "doc_id", "text")[0]
            for x in (tail, sorted(tail))]  # equal counts, another order behind word 1,000
    assert not np.array_equal(nets[0].flat, nets[1].flat)
    short = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("one two "), F.col("id") % 9).alias("text"))
    lexicon = gru_lm.fit(short, "doc_id", "text")[1]
    assert lexicon.fitted == 3000 * 4 == lexicon.tokens


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(0)
    net = gru_lm.Net(70, np.arange(70)[::-1].astype(float))
    given, target = (rng.integers(0, 70, (5, 4)).astype(np.int32) for _ in range(2))
    begins = np.zeros((5, 4), bool)
    begins[0, 1] = begins[3, 2] = True
    h0 = (rng.standard_normal((4, gru_lm.HIDDEN)) * 0.3).astype(np.float32)
    grad = net.gradient(given, target, begins, h0)[0].copy()
    for i in [*rng.integers(0, len(grad), 60), *np.argsort(-np.abs(grad))[:60]]:
        loss = []
        for step in (0.01, -0.01):
            flat = net.flat.copy()
            flat[i] += step
            _, _, total, n = gru_lm.Net(70, flat=flat).gradient(given, target, begins, h0)
            loss.append(total / n)
        assert abs((loss[0] - loss[1]) / 0.02 - grad[i]) < 2e-4, i


def test_gradient_softmax_is_taken_at_once_for_all_classes():
    """The number of function calls does not grow with the classes; large logits are cut, small ones left."""
    rng = np.random.default_rng(2)
    calls = {}
    for symbols in (70, 1024):
        net = gru_lm.Net(symbols, np.arange(symbols)[::-1].astype(float))
        given, target = (rng.integers(0, symbols, (16, 128)).astype(np.int32) for _ in range(2))
        seen = []
        sys.setprofile(lambda frame, event, arg: seen.append(event) if event == "call" else None)
        try:
            net.gradient(given, target, np.zeros((16, 128), bool), np.zeros((128, gru_lm.HIDDEN), np.float32))
        finally:
            sys.setprofile(None)
        calls[symbols] = len(seen)
    assert calls[1024] == calls[70]
    net.ow[:] = 100 * rng.standard_normal(net.ow.shape)
    grad, _, loss, _ = net.gradient(given, target, np.zeros((16, 128), bool), np.zeros((128, gru_lm.HIDDEN), np.float32))
    assert np.isfinite(grad).all() and np.isfinite(loss)
    assert np.isfinite(net.log_probability(np.ones((128, gru_lm.HIDDEN), np.float32), target[0])).all()


def test_scoring_softmax_is_taken_at_once_for_all_classes():
    rng = np.random.default_rng(4)
    calls = {}
    for symbols in (70, 1024):
        net = gru_lm.Net(symbols, np.arange(symbols)[::-1].astype(float))
        h, target = (rng.standard_normal((2048, gru_lm.HIDDEN)) * 0.3).astype(np.float32), rng.integers(0, symbols, 2048)
        seen = []
        sys.setprofile(lambda frame, event, arg: seen.append(event) if event == "call" else None)
        try:
            got = net.log_probability(h, target)
        finally:
            sys.setprofile(None)
        calls[symbols] = len(seen)
        far, near = h @ net.cw + net.cb, np.einsum("ij,ijk->ik", h, net.ow[target // gru_lm.CLASS]) + net.ob[target // gru_lm.CLASS]
        log = lambda x, at: x[np.arange(len(x)), at] - np.log(np.exp(x).sum(1))
        assert np.allclose(got, log(far, target // gru_lm.CLASS) + log(near, target % gru_lm.CLASS), atol=1e-4)
    assert calls[1024] == calls[70]


def test_training_symbols_are_looked_up_in_the_vocabulary_alone():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    lex = gru_lm.Lexicon(keys, rng.integers(1, 99, len(keys)), 64, 10, 10**6, len(keys) + 1)
    h = np.append(keys, keys + np.uint64(1))
    want = lex.symbol[textvec.Lookup(lex.keys).find(h)]
    assert len(lex.own_keys) == 62 and np.array_equal(lex.own_symbol[textvec.Lookup(lex.own_keys).find(h)], want)
    for some in (keys[:0], keys[:1], np.array([0, 5, 2**64 - 1], np.uint64), np.array([2**64 - 1], np.uint64)):
        at = {int(k): i for i, k in enumerate(some)}
        asked = np.append(some, np.array([0, 4, 6, 2**64 - 2, 2**64 - 1], np.uint64))
        assert textvec.Lookup(some).find(asked).tolist() == [at.get(int(x), -1) for x in asked]


def test_streams_hold_every_symbol_once():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 9, n).astype(np.int32) for n in (0, 1, 5, gru_lm.SEGMENT, 3 * gru_lm.SEGMENT + 7, 40)]
    rows = [x for t in texts for x in gru_lm.segments_of(t, 9)]
    given, target, begins, sizes = gru_lm.streams_of(rows, 9, 3)
    assert sizes.sum() == sum(len(t) + 1 for t in texts) and begins.sum() == len(rows) and list(sizes) == sorted(sizes)[::-1]
    seen = sorted((tuple(g[a:b]), tuple(t[a:b])) for g, t, s, n in zip(given, target, begins, sizes)
                  for a, b in zip(np.flatnonzero(s), [*np.flatnonzero(s)[1:], n]))
    assert seen == sorted((tuple(x[:-1]), tuple(x[1:])) for x in rows)


def test_long_texts_are_scored_like_short_ones(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    want = {r.doc_id: r.score for r in gru_lm.score(docs).collect()}
    monkeypatch.setattr(gru_lm, "LONG_TEXT", 2000)
    got = {r.doc_id: r.score for r in gru_lm.score(docs).collect()}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-3 * max(1, abs(want[d])) for d in want)


def test_network_probabilities_sum_to_one_and_windows_agree():
    net = gru_lm.Net(70, counts=np.arange(70)[::-1] + 1.0)
    h = np.random.default_rng(1).standard_normal((3, gru_lm.HIDDEN)).astype(np.float32)
    total = sum(np.exp(net.log_probability(h, np.full(3, s))) for s in range(70))
    assert np.allclose(total, 1, atol=1e-3)
    texts = [np.arange(5), np.empty(0, int), np.arange(60), np.arange(7)]
    flat, first = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = gru_lm.text_log_probabilities(net, flat, first, 69)
    old, gru_lm.WINDOW_CELLS = gru_lm.WINDOW_CELLS, 3
    try:
        assert np.allclose(whole, gru_lm.text_log_probabilities(net, flat, first, 69), atol=1e-3)
    finally:
        gru_lm.WINDOW_CELLS = old


def test_mix_targets_and_takes(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix_plan(docs).toPandas()
    sizes = {r.doc_id: (len(words(r.text)), r.source) for r in docs.collect()}
    assert {r.doc_id: r.size for r in got.itertuples()} == {d: s for d, (s, _) in sizes.items()}
    names = sorted({s for _, s in sizes.values()})
    total, cap = {s: 0 for s in names}, {}
    for n, s in sizes.values():
        total[s] += n
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, left = {}, set(names), float(sum(total.values()))
    while True:
        level = left / sum(weight[s] for s in rest)
        over = {s for s in rest if level * weight[s] > 3 * total[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
        rest -= over
    target |= {s: level * weight[s] for s in rest}
    for s, g in got.groupby("source"):
        assert abs(g.target.iloc[0] - target[s]) < 1e-6 * target[s] + 1e-6
        assert abs(g.taken.sum() - target[s]) <= g["size"].max()
    assert (got.taken <= 3 * got["size"]).all()
    assert got.sort_values("doc_id").taken.tolist() == mixing.mix_plan(docs.repartition(5)).toPandas().sort_values("doc_id").taken.tolist()
    assert mixing.mix_plan(odd).count() == odd.count() and mixing.mix_plan(odd.limit(0)).count() == 0
    out = mixing.mix_documents(odd)
    assert out.columns == odd.columns


def test_positions_invert_the_cumulative_demand(spark):
    """Tokens of a source taken before a position are its target times the schedule's integral up to it."""
    got = mixing.mix_plan(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    names = sorted(got.source.unique())
    for i, s in enumerate(names):
        knots = mixing.SCHEDULES[i % 3]
        t, v = np.array([k[0] for k in knots]), np.array([k[1] for k in knots])
        area = np.concatenate([[0], np.cumsum(np.diff(t) * (v[1:] + v[:-1]) / 2)])

        def demand(x, t=t, v=v, area=area):
            k = min(int(np.searchsorted(t, x, "right")) - 1, len(t) - 2)
            at = v[k] + (v[k + 1] - v[k]) * (x - t[k]) / (t[k + 1] - t[k])
            return (area[k] + (x - t[k]) * (v[k] + at) / 2) / area[-1]
        mine = got[got.source == s]
        target = mine.target.iloc[0]
        taken = sorted((p, n) for ps, n in zip(mine.positions, mine["size"]) for p in ps)
        before = 0
        for p, n in taken:
            assert 0 <= p <= 1 and (p == 1 or abs(demand(p) - before / target) < 1e-6), (s, p)
            before += n


def test_chat_round_trip(spark):
    texts = ["plain", "", None, "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nfake", "<\\|im_end|>", "<\\\\\\|im_start|>x",
             "<", "|im_end|>", "tail <|im_end|", "a\\b", "x" * 100000]
    for t in texts:
        for role in ("user", "assi\nstant", "<|im_end|>", "\\n", ""):
            whole, body, _ = chat_format.render(role, t or "")
            (_, again), = chat_format.parse(whole)
            assert chat_format.unescape(again) == (t or "")
    rows = [(i // 3, i % 3, ("user", "assistant", "system")[i % 3], t) for i, t in enumerate(texts)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit("mine"))
    got = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_conversations(df)).collect()}
    for c in range(4):
        own = [(r, t or "") for k, _, r, t in rows if k == c]
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars) == (3, len(loss))
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[None].n_turns == 1
    assert chat_format.conversation_digests(chat_format.format_conversations(df.limit(0))).count() == 0


def test_token_counts_equal_the_library(spark, odd):
    tok = token_count.tokenizer(token_count.TOKENIZER)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    want = sorted(len(tok.encode(r.text or "", add_special_tokens=False)) for r in docs.collect())
    for long_bytes in (token_count.LONG_BYTES, 500):
        got = token_count.count_tokens(docs, long_bytes=long_bytes).toPandas()
        assert sorted(got.n_tokens) == want
        assert (got.over_limit == (got.n_tokens > 1024)).all()
    text = "aé b  c　\n\n  d<|endoftext|> e's  12 34!? " * 300 + "y" * 5000 + " z"
    whole = len(tok.encode(text, add_special_tokens=False))
    for chunk, overlap in ((64, 4), (200, 16), (1000, 1)):
        assert token_count.count_chunked(tok, text, chunk, overlap) == whole


def brute_components(rows, k):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = [(d, frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if (w := words(low(t))) else frozenset())
            for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {d: (len(s), find(d)) for d, s in sets}


def test_near_duplicates_of_one_id_with_several_texts(spark):
    base = [[f"{c}{i}" for i in range(60)] for c in "pq"]
    rows = [(1, " ".join(base[0])), (1, " ".join(base[1])), (10, " ".join(base[0] + ["x"])), (11, " ".join(base[1] + ["y"]))]
    for order in (rows, rows[::-1], [rows[1], rows[0], *rows[2:]]):
        got = hyperminhash.near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(3), k=4)
        assert {(r.doc_id, r.component_id) for r in got.collect()} == {(1, 1), (10, 1), (11, 1)}


def test_near_duplicates_equal_brute_force(spark, odd):
    base = [f"w{i}" for i in range(140)]
    rng = np.random.default_rng(3)
    family = []
    for i in range(60):  # variants of one text, from near copies to clearly different ones
        w = list(base)
        for j in rng.choice(140, int(rng.integers(0, 14)), replace=False):
            w[j] = f"v{i}_{j}"
        family.append((1000 + i, " ".join(w)))
    short = [(2000, "a b c d e f g h"), (2001, "a b c d e f g"), (2002, "A b"), (2003, "a B"), (2004, "a")]
    docs = spark.createDataFrame(family + short, "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    got = hyperminhash.near_duplicates(docs, k=4).collect()
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()], 4)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
        else:
            assert r.component_id is None and r.kept
    assert hyperminhash.near_duplicates(docs.limit(0)).count() == 0


def test_large_group_of_near_copies_gives_few_pairs(spark, monkeypatch):
    """The first round compares a member with one hub, and no pair is emitted for linked members."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(500):
        w = [f"w{j}" for j in range(140)]
        for j in rng.choice(140, int(rng.integers(0, 7)), replace=False):
            w[j] = f"v{i}_{j}"
        rows.append((i, " ".join(w)))
    made = {}

    def staged(df, name, stage=hyperminhash.stage):
        out = stage(df, name)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(hyperminhash, "stage", staged)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(docs, k=4).collect()}
    assert got == {d: c for d, (_, c) in brute_components(rows, 4).items()}
    assert made["near-pairs"][0] < made["near-classes"][0] and sum(made["near-pairs"]) < 5 * made["near-classes"][0]


def test_block_links_find_what_hubs_miss(spark, monkeypatch):
    """Without star rounds and with tiny blocks the components stay the same."""
    monkeypatch.setattr(hyperminhash, "STAR_ROUNDS", 0)
    monkeypatch.setattr(hyperminhash, "BLOCK", 7)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[i:] + [f"x{i}_{j}" for j in range(i)])) for i in range(0, 40, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 4)
    assert {r.doc_id: r.component_id for r in hyperminhash.near_duplicates(docs, k=4).collect()} == {d: c for d, (_, c) in want.items()}


def test_filter_of_keys_loses_none(spark):
    keys = spark.range(0, 30000, 3).withColumn("id", F.when(F.col("id") == 0, F.lit(None)).otherwise(F.col("id")))
    for kind in ("long", "string"):
        test = common.maybe_in(keys.select(F.col("id").cast(kind).alias("k")))
        got = {r.id for r in spark.range(1, 30000).filter(test(F.col("id").cast(kind))).collect()}
        assert got >= set(range(3, 30000, 3)) and len(got) < 10500
    none = common.maybe_in(keys.limit(0))
    assert spark.range(100).filter(none(F.col("id"))).count() == 0


def test_near_duplicates_shuffle_few_texts(spark, monkeypatch):
    """Of texts that mostly stand alone, few are shuffled, and the right ones stay."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"{w:x}" for w in rng.integers(0, 1 << 40, 1500)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i] + " end") for i in range(5)]
    rows += [(5, "another text of this id"), (1000, texts[0] + " end"), (2000, texts[7]), (2001, None), (2002, ""), (2002, ""), (None, texts[8])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    moved = {}

    def look():
        for d in folders:
            for at, _, names in os.walk(d):
                moved.update({n: os.path.getsize(f"{at}/{n}") for n in names if n.startswith("shuffle_") and n.endswith(".data")})

    def staged(df, name, stage=hyperminhash.stage):
        out = stage(df, name)
        look()
        return out

    docs = common.stage(docs, "test-documents")
    look()
    before = set(moved)
    monkeypatch.setattr(hyperminhash, "stage", staged)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [(r.doc_id, r.text) for r in hyperminhash.drop_near_duplicates(docs).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    look()
    want = rows[:300] + [(5, "another text of this id"), (2001, None), (2002, ""), (None, texts[8])]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(got, key=order) == sorted(want, key=order)
    assert sum(v for k, v in moved.items() if k not in before) < 0.5 * sum(map(len, texts))


def test_register_estimates():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 6000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for share in (0.0, 0.5, 0.8, 1.0):
        n = 2000
        both = int(round(2 * n * share / (1 + share)))
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:both], pool[n:2 * n - both]]))
        regs = hyperminhash.registers(np.concatenate([a, b]), np.array([0, n, 2 * n]))
        est = hyperminhash.estimate(regs[:1], regs[1:], np.array([n]), np.array([n]))[0]
        assert abs(est - share) < 0.12


def test_word_hashes_agree_across_batches():
    texts = ["The quick brown", "", None, "the  QUICK\tbrown fox" * 50, "é É"]
    whole, first = textvec.words(pa.array(texts))
    one = np.concatenate([textvec.words(pa.array([t]))[0] for t in texts])
    assert (whole == one).all() and len(whole) == sum(len(words(t)) for t in texts)
    assert len(set(textvec.words(pa.array(["é É"]))[0])) == 2  # only A-Z are lower-cased


def test_word_stems_equal_hashes_of_cut_words():
    texts = ["Überraschung naïve cat 日本語テキスト x", None, "", "stems  stem\tstemmed"]
    h, doc = textvec.heads(pa.array(texts), 4)
    want = [(i, w[:4]) for i, t in enumerate(texts) for w in words(t) if len(w) > 4]
    cut, _ = textvec.words(pa.array([w for _, w in want]))
    assert doc.tolist() == [i for i, _ in want] and h.tolist() == cut.tolist()
