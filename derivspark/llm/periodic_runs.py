"""Maximal periodic runs of words, found in an enhanced suffix array.

The words of a batch of texts form one array; suffixes end with their text, and those of
different texts never compare equal. Everything is done on whole arrays:

1. **Suffix array** by prefix doubling; a round sorts only suffixes that aren't told apart
   yet, so common text takes a few rounds. The rounds' ranks are kept: two stretches of
   2^k words are equal where their ranks of round k are.
2. **LCP array** of neighbours, by descending through those ranks.
3. **LCP intervals** without tree nodes: boundary k, with LCP value d, joins the ranks from
   the previous smaller value up to k - 1 with those from k up to the next smaller one.
4. **Branching tandem test**: a suffix i of the smaller child starts a square of period d
   that can't be rotated to the right if ISA[i + d] lies in the other child, and ends one
   if ISA[i - d] does. Smaller children alone make O(n log n) tests.
5. **Rotation and merging**: rotating a branching square to the left as far as words agree
   gives the run that it ends. A period that is a multiple of a shorter one of the same
   run is merged into it.

Memory: some 100 bytes a word of a batch, and 4 bytes a word for every doubling of the
longest repeated stretch. A batch holds a few MB of text, or one text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .textvec import T_EXACT, pieces, words

MIN_LENGTH, MIN_EXPONENT = 24, 3
CHUNK = 1 << 21  # suffixes tested at once
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_ranks(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of the texts ``symbols[first[t]:first[t + 1]]``, text by text, and the
    ranks by the first 1, 2, 4, ... symbols (-1 after the end), the last ones all different."""
    n = len(symbols)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][text]
    order = np.lexsort((symbols, text))
    new = np.ones(n, bool)
    new[1:] = (symbols[order][1:] != symbols[order][:-1]) | (text[order][1:] != text[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [], 1
    while True:
        levels.append(np.append(rank, -1).astype(np.int32 if n < 2 ** 31 else np.int64))
        sizes = np.bincount(rank, minlength=n)
        left = np.flatnonzero(sizes[rank] > 1)
        if not len(left):
            order[rank] = np.arange(n)
            return order, levels
        after = np.where(left + step < end[left], rank[np.minimum(left + step, n - 1)], -1)
        key = rank[left] * (n + 1) + after + 1
        by = np.argsort(key, kind="stable")
        left, key = left[by], key[by]
        at = np.arange(len(left))
        group = rank[left]
        start = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), at, 0))
        part = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), at, 0))
        rank = rank.copy()
        rank[left] = group + part - start
        step *= 2


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of the suffixes at a and b (a != b)."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        out += (levels[k][a + out] == levels[k][b + out]).astype(np.int64) << k
    return out


def common_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Length of the common end of the words before a and b (a < b), not going below ``start``."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a - out - (1 << k), b - out - (1 << k)
        ok = x >= start
        out += (ok & (levels[k][np.where(ok, x, 0)] == levels[k][np.where(ok, y, -1)])).astype(np.int64) << k
    return out


def smaller_before(v: np.ndarray, strict: bool) -> np.ndarray:
    """Index of the nearest earlier value below v[i] (or equal, unless strict) for all v[i] > 0;
    v[0] must be below all."""
    p = np.maximum(np.arange(len(v)) - 1, 0)
    todo = np.flatnonzero(v > 0)
    while len(todo):
        far = v[p[todo]] >= v[todo] if strict else v[p[todo]] > v[todo]
        todo = todo[far]
        p[todo] = p[p[todo]]  # what lies between is not below either
    return p


def squares(order: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all branching squares."""
    n = len(order)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    isa = levels[-1]
    lcp = np.concatenate([[-1], common(levels, order[:-1], order[1:]), [-1]])  # -1 at both ends
    left = smaller_before(lcp[:-1], strict=True)
    right = n - smaller_before(lcp[::-1][:-1], strict=False)[::-1]
    right = np.append(0, right)[:n]  # right[k] for k in 1..n-1
    node = np.flatnonzero(lcp[:n] > 0)
    lo, hi, depth = left[node], right[node], lcp[node]
    small = node - lo <= hi - node
    a, b = np.where(small, lo, node), np.where(small, node, hi)  # the smaller child
    c, d = np.where(small, node, lo), np.where(small, hi, node)  # the other one
    starts, periods = [], []
    total = np.concatenate([[0], np.cumsum(b - a)])
    i = 0
    while i < len(node):
        j = max(i + 1, int(np.searchsorted(total, total[i] + CHUNK, "right")) - 1)
        count = (b - a)[i:j]
        owner = np.repeat(np.arange(i, j), count)
        at = a[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        x, q = order[at], depth[owner]
        for sign in (1, -1):
            y = x + sign * q
            inside = (y >= 0) & (y < n)
            r = isa[np.where(inside, y, n)]
            hit = inside & (r >= c[owner]) & (r < d[owner])
            starts.append(np.minimum(x, y)[hit])
            periods.append(q[hit])
        i = j
    return np.concatenate(starts or [np.zeros(0, np.int64)]), np.concatenate(periods or [np.zeros(0, np.int64)])


def runs(symbols: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH,
         min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in ``symbols``), length and smallest period of every run of the texts of at
    least ``min_length`` words and ``min_exponent`` periods (2 or more), by start, then period."""
    order, levels = suffix_ranks(symbols, first)
    p, q = squares(order, levels)
    end = p + 2 * q
    by = np.lexsort((q, end))
    p, q, end = p[by], q[by], end[by]
    begin = first[:-1][np.searchsorted(first, p, "right") - 1]
    out = []
    while len(p):  # the shortest period of each end, then the next one that isn't a multiple of it
        lead = np.append(True, end[1:] != end[:-1])
        at = np.flatnonzero(lead)
        start = p[at] - common_before(levels, p[at], p[at] + q[at], begin[at])
        out.append(np.stack([start, end[at] - start, q[at]]))
        which = np.cumsum(lead) - 1
        same = (q % q[at][which] == 0) & (2 * q <= (end - start[which]))
        p, q, end, begin = (v[~lead & ~same] for v in (p, q, end, begin))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = np.concatenate(out, axis=1)
    keep = (length >= min_length) & (length >= min_exponent * period)
    by = np.lexsort((period[keep], start[keep]))
    return start[keep][by], length[keep][by], period[keep][by]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT,
                  places: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row a row: ``doc_id, n_words, runs`` (array of ``start, length, period``, in words
    from 0, by start, then period) and ``collapsed`` (the words that no run holds after its
    first period, joined by one space).

    A run is a stretch of words with smallest period q, of at least ``min_length`` words and
    ``min_exponent`` periods, that no neighbouring word extends keeping q. Words are compared
    byte by byte. ``places(id, n)`` may give other words to look at, as places in the text of
    n words (None: the text as it is). Null and blank texts have no words and no runs; a null
    id is passed to ``places`` as None. Repeated rows give equal rows, an empty table none;
    other columns, whatever their names, are not looked at. A text is handled whole by one task.
    """
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for b in pieces(whole, 1):
                h, at = words(b.column(1), T_EXACT)
                chosen = [None] * b.num_rows
                if places is not None:
                    chosen = [places(i, n) if n else None for i, n in zip(b.column(0).to_pylist(), np.diff(at).tolist())]
                parts = [np.arange(s, e) if c is None else s + c for c, s, e in zip(chosen, at, at[1:])]
                first = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
                h = h[np.concatenate(parts)] if parts else h
                start, length, period = runs(h, first, min_length, min_exponent)
                owner = np.searchsorted(first, start, "right") - 1
                cut = np.searchsorted(owner, np.arange(b.num_rows + 1))
                start -= first[:-1][owner]
                found, kept = [], []
                for i, t in enumerate(b.column(1)):
                    held = [] if not t.is_valid else t.as_py().encode().split()
                    mine = slice(cut[i], cut[i + 1])
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in
                                  zip(start[mine].tolist(), length[mine].tolist(), period[mine].tolist())])
                    if chosen[i] is not None:
                        held = [held[j] for j in chosen[i].tolist()]
                    if found[-1]:
                        drop = np.zeros(len(held) + 1, np.int64)
                        np.add.at(drop, start[mine] + period[mine], 1)
                        np.add.at(drop, start[mine] + length[mine], -1)
                        held = [held[j] for j in np.flatnonzero(np.cumsum(drop)[:-1] == 0).tolist()]
                    kept.append(b" ".join(held).decode())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.diff(first)), pa.array(found, pa.list_(RUN)), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    d = ship(docs).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(run, f"doc_id {kind}, n_words long, "
                             "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(found: DataFrame) -> DataFrame:
    """Of each row of ``periodic_runs``: the number of runs, the run of the greatest exact
    length / period (ties: smallest start, then period; nulls without a run) with its exponent
    in thousandths, and sha256 digests of the list of runs and of the collapsed text."""
    better = ("(a, b) -> case when a is null or cast(b.length as decimal(19,0)) * a.period > "
              "cast(a.length as decimal(19,0)) * b.period then b else a end")
    best = F.expr(f"aggregate(runs, cast(null as struct<start: long, length: long, period: long>), {better})")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("cast(1000L * best.length div best.period as long)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
