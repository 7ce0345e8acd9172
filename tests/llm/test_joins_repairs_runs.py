"""The similarity join, conversation repair and periodic runs against brute force, and on awkward
tables: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("derivspark.llm")
from derivspark.llm import conversation_repair as C  # noqa: E402
from derivspark.llm import ngram_join as J  # noqa: E402
from derivspark.llm import periodic_runs as R  # noqa: E402
from derivspark.llm.common import stage  # noqa: E402
from derivspark.llm.queries import QUERIES, _damaged, _made_periodic  # noqa: E402

SF = "/root/testdata/sf0.001"
SPACE = re.compile("[\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(t):
    return [w for w in SPACE.split(t or "") if w]


def clashing(df):
    for extra in ("n", "f", "token", "comp", "size", "parts", "first", "key", "id", "audit", "state", "runs", "block", "linked"):
        df = df.withColumn(extra, F.lit("mine"))
    return df


# ------------------------------------------------------------------ similarity join ----

def ngrams(t, k):
    w = words((t or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def joined(rows, k, percent):
    """(number of n-grams, smallest id reached, direct links) of each (id, text), all pairs."""
    held = [(i, ngrams(t, k)) for i, t in rows]
    n, up, links = len(held), list(range(len(held))), [0] * len(held)

    def top(a):
        while up[a] != a:
            a = up[a]
        return a
    for a in range(n):
        for b in range(a):
            x, y = held[a][1], held[b][1]
            if x and y and held[a][0] is not None and held[b][0] is not None and 100 * len(x & y) >= percent * len(x | y):
                up[top(a)] = top(b)
                links[a] += 1
                links[b] += 1
    low = {}
    for a in range(n):
        if held[a][0] is not None:
            low[top(a)] = min(low.get(top(a), held[a][0]), held[a][0])
    return sorted((repr(i), len(s), low[top(a)] if i is not None else None, links[a]) for a, (i, s) in enumerate(held))


def got_join(df, k, percent):
    return sorted((repr(r.doc_id), r.n_shingles, r.component_id, r.n_links) for r in J.ngram_join(df, k=k, percent=percent).collect())


def family(rng, core, copies, changes):
    """Near copies of one text."""
    out = []
    for _ in range(copies):
        w = list(core)
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (2, 60)])
def test_join_equals_all_pairs(spark, k, percent):
    rng = random.Random(k)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(80).collect()]
    core = [f"w{i}" for i in range(120)]
    texts += family(rng, core, 150, 4)  # n-grams in more prefixes than are expanded into pairs
    texts += family(rng, core[:60] + [f"v{i}" for i in range(50)], 80, 6)
    texts += [" ".join(core[a:a + n]) for a, n in ((0, 9), (0, 10), (0, 20), (0, 21), (1, 20), (5, 2), (5, 1), (6, 1))] * 2
    rows = list(enumerate(texts, 100))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got_join(df, k, percent) == joined(rows, k, percent)


def test_join_of_a_drifting_chain_and_of_blocks(spark, monkeypatch):
    """A chain of texts, each near the next only, goes through hubs and blocks of small size."""
    monkeypatch.setattr(J, "HOT", 4)
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "HUB_ROUNDS", 1)
    rows, w = [], [f"c{i}" for i in range(80)]
    for i in range(60):
        w = w[:i] + [f"d{i}"] + w[i + 1:]
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join([f"c{j}" for j in range(70)] + [f"e{i}-{j}" for j in range(9)])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = joined(rows, 3, 90)
    assert got_join(df, 3, 90) == want and len({c for _, _, c, _ in want}) < 60


def test_join_of_awkward_rows(spark):
    long = "word " * 30000 + " ".join(f"u{i}" for i in range(3000))
    rows = [(1, "a b c d e f g h i j k"), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, long + " end"), (7, "A B C d e f g h i j k"),
            (None, "a b c d e f g h i j k"), (8, "one"), (9, "ONE"), (10, "one two"), (7, "A B C d e f g h i j k"),
            (11, " ".join(map(str, range(60)))), (12, " ".join(map(str, range(61)))), (13, " ".join(map(str, range(62))))]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got_join(df, 3, 90) == joined(rows, 3, 90)
    assert J.ngram_join(df.limit(0)).count() == 0


def test_join_of_one_id_with_several_texts(spark):
    """An id that stands for two texts: the classes of both have their own sets."""
    base = [[f"{c}{i}" for i in range(60)] for c in "pq"]
    rows = [(1, " ".join(base[0])), (1, " ".join(base[1])), (10, " ".join(base[0] + ["x"])), (11, " ".join(base[1] + ["y"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_join(df, 3, 90) == joined(rows, 3, 90)


def test_positional_and_part_filters_refuse_no_link():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(5, 400))
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.97], rng.integers(0, 2 ** 63, int(rng.integers(0, 8))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 90 * (len(x) + len(y) - both):
            continue
        px, py = (J.part_sizes(v, np.array([0, len(v)])) for v in (x, y))
        assert J.parts_fit(px, py, len(x), len(y), 90).all()
        # The first common n-gram in a common order lies in both prefixes and passes the positional filter.
        i, j = (np.flatnonzero(np.isin(v, w))[0] for v, w in ((x, y), (y, x)))
        if len(x) != len(y) or both != len(x):
            assert i < J.prefix_length(np.array([len(x)]), 90)[0] and j < J.prefix_length(np.array([len(y)]), 90)[0]
        assert J.fits(len(x), len(y), i, j, 90)


# -------------------------------------------------------------------- conversations ----

NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
TO = {"u": 2, "a": 3}
ROLE = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, kept or made turns) by trying all ways, best strings per state."""
    def inserted(best):
        moved = True
        while moved:
            moved = False
            for s, (c, a, r) in list(best.items()):
                x = NEXT[s]
                way = (c + 2, a + "I", (*r, ("I", x)))
                if TO[x] not in best or way[:2] < best[TO[x]][:2]:
                    best[TO[x]], moved = way, True
        return best
    best = {0: (0, "", ())}
    for role, fault in rows:
        new = {}
        for s, (c, a, r) in inserted(dict(best)).items():
            ways = [(s, (c + 3, a + "D", r))]
            if fault not in (1, 2):
                more, x = int(fault == 3), NEXT[s]
                ways.append((TO[x], (c + 2 + more, a + "R", (*r, ("R", x)))))
                if role[:1] == x or (role[:1] == "s" and s == 0):
                    ways.append((1 if role[:1] == "s" else TO[x], (c + more, a + "K", (*r, ("K", role)))))
            for t, w in ways:
                if t not in new or w[:2] < new[t][:2]:
                    new[t] = w
        best = new
    best = inserted(dict(best))
    return min((best[s] for s in (0, 3) if s in best), key=lambda w: w[:2])


def repaired(ids, rows):
    out = {}
    for conv in ids:
        mine = sorted((r for r in rows if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        seen, kinds, counts = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            said = text.rstrip("\x20\t\n\x0b\x0c\r")
            fault = 1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0
            seen.add((role, text))
            counts[fault - 1] += fault > 0
            kinds.append((role, fault))
        turns = [r[1] for r in mine if r[1] is not None]
        cost, audit, made = cheapest(kinds)
        lines, at, steps = [], 0, iter(made)
        for e in audit:
            if e != "D":
                kind, x = next(steps)
                lines.append(f"{x if e == 'K' else ROLE[x]}:{'' if e == 'I' else mine[at][3]}")
            at += e != "I"
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts,
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def digests(edited):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in C.repair_digests(edited).collect()}


def test_vectors_meet_where_the_best_edits_go():
    rng = random.Random(5)
    for _ in range(4000):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 9))]
        kinds = [(r[:1], f, False) for r, f in rows] + [("", 0, True)]
        last = C.forward(kinds, C.unit(0))
        end = min((0, 3), key=lambda s: last[s])
        cost, audit, _ = cheapest(rows)
        assert (last[end][0], "".join(C.repair(kinds, 0, end))) == (cost, audit)
        cuts = sorted(rng.sample(range(1, len(kinds)), min(3, len(kinds) - 1)))
        pieces = [kinds[i:j] for i, j in zip([0, *cuts], [*cuts, len(kinds)])]
        edges = C.fold([[C.forward(p, C.unit(s)) for s in range(4)] for p in pieces])
        assert "".join("".join(C.repair(p, a, b)) for p, (a, b) in zip(pieces, edges)) == audit


def test_repair_of_conversations_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 16)
    rng = random.Random(2)
    rows = []
    for i in range(60):
        for t in range(rng.choice([1, 3, 8, 50])):
            rows.append((None if i == 7 else i, None if rng.random() < .05 else rng.randint(-2, 12),
                         rng.choice(["user", "assistant", "system", "tool", " "]), rng.choice(["a.", "b. ", " ", "", "cut", "x!\n"])))
    rows += [(99, t, rng.choice(["user", "assistant"]), rng.choice([f"t{t}.", "same."])) for t in range(1, 400)]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(4)
    edited = stage(C.repaired_rows(C.with_faults(df)), "test-edits")
    want = repaired({r[0] for r in rows}, rows)
    got = digests(edited)
    assert got == want
    turns = C.repaired_turns(edited).orderBy("id", "place").collect()
    said = {c: hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in g).encode()).hexdigest()
            for c, g in groupby(turns, key=lambda r: r.conv_id)}
    assert all(said.get(c, hashlib.sha256(b"").hexdigest()) == w[-1] for c, w in want.items())
    for c, g in groupby(turns, key=lambda r: r.conv_id):
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[:1] for x in g)), c


def test_repair_of_empty_tables_nulls_and_long_texts(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 1, None, "no role."), (1, 2, "assistant", None), (2, 1, "user", "long " * 100000 + "."), (2, 2, "assistant", "Ok.")]
    edited = C.repaired_rows(C.with_faults(spark.createDataFrame(rows, schema)))
    want = repaired({1, 2}, [(c, t, r or "", x or "") for c, t, r, x in rows])
    assert digests(edited) == want and want[2][5] == 0
    empty = spark.createDataFrame([], schema)
    assert C.repair_conversations(empty).count() == 0
    nothing = digests(C.repaired_rows(C.with_faults(empty, originals=spark.createDataFrame(rows, schema))))
    assert nothing == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in (1, 2)}


def test_query_of_damaged_conversations(spark):
    raw = spark.read.parquet(f"{SF}/conversations.parquet")
    damaged = [tuple(r) for r in _damaged(raw).collect()]
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in QUERIES["op12_conversation_repair"](spark, SF).collect()}
    assert got == repaired({r.conv_id for r in raw.collect()}, damaged)
    odd = spark.createDataFrame([(None, None, None, None)] * 2 + [(1, 5, "user", "a.")], raw.schema)
    assert {(r.role, r.text) for r in _damaged(odd).where("conv_id is null").collect()} <= {(" ", " "), (" ", ""), ("user", " ")}


# --------------------------------------------------------------------- periodic runs ----

def all_runs(w, least, exponent):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j - i + q >= max(least, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1) if j > i else i + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(600):
        texts = []
        for _ in range(rng.randint(0, 4)):
            k, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 60)
            t = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < .6:
                a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
                t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
            texts.append(t)
        least, exponent = rng.choice([(24, 3), (2, 2), (6, 3), (1, 2)])
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = list(zip(*(v.tolist() for v in R.runs(np.array(sum(texts, []), np.uint64), first, least, exponent))))
        assert got == [(int(f) + s, n, q) for t, f in zip(texts, first) for s, n, q in all_runs(t, least, exponent)], texts


def test_runs_of_extreme_texts():
    n = 20000
    fib = [0, 1]
    while len(fib) < n:
        fib = fib + fib[:len(fib) // 2 + 1]
    for t in (np.zeros(n), np.arange(n), np.tile(np.arange(n // 4), 4), np.repeat(np.arange(n // 30), 30)):
        s, length, q = R.runs(t.astype(np.uint64), np.array([0, len(t)]))
        for a, m, p in list(zip(s, length, q))[:50]:
            assert (t[a:a + m - p] == t[a + p:a + m]).all() and m >= max(24, 3 * p)
    assert [x.tolist() for x in R.runs(np.zeros(n, np.uint64), np.array([0, n]))] == [[0], [n], [1]]
    assert len(R.runs(np.repeat(np.arange(n // 30), 30).astype(np.uint64), np.array([0, n // 30 * 30]))[0]) == n // 30


def digest_of(w):
    found = all_runs(w, 24, 3)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    return (len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def digest_rows(df):
    return {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in df.collect()}


def test_query_of_periodic_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got, n = digest_rows(QUERIES["op13_periodic_runs"](spark, SF)), 0
    for d, t in docs:
        w = words(t)
        if len(w) > 3000:
            continue
        at = _made_periodic(d, len(w)) if w else None
        want = digest_of(w if at is None else [w[i] for i in at])
        assert got[d] == want, d
        n += want[0]
    assert len(got) == len(docs) and n > 5


def test_runs_of_awkward_rows(spark):
    rows = [(1, "a b " * 40 + "c"), (2, None), (3, ""), (4, " \n\t "), (None, "x " * 30), (5, "word " * 50000), (1, "a b " * 40 + "c"),
            (6, "A a " * 12), (7, "été b " * 24), (8, "no run here")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    found = R.periodic_runs(df)
    got = defaultdict(list)
    for r in R.run_digests(found).collect():
        got[r.doc_id].append((r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256))
    for d, t in rows:
        if d != 5:
            assert got[d][0] == digest_of(words(t)), d
    assert got[5][0][:5] == (1, 0, 50000, 1, 50000000) and len(got[1]) == 2
    assert {r.doc_id: r.collapsed for r in found.collect()}[5] == "word"
    assert R.run_digests(R.periodic_runs(df.limit(0))).count() == 0
    assert _made_periodic(None, 5) is None
