"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the distinct hashes of its words, word pairs, skip pairs
(one word left out) and word stems (the first ``STEMS`` code points of longer words,
for languages that compound and inflect), folded to ``DIMENSIONS``. Per-coordinate learning
rates and L1 make the weights sparse; they are broadcast, which is bounded by
the number of dimensions.

Fitting takes a bounded sample of the labelled rows (``max_rows``, the smallest
hashes of the key), dealt into shards. A round runs FTRL over each shard from the
common state; the changes of a coordinate are averaged over the shards that
touched it. Scoring covers every row and its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import P, ship, stage
from .textvec import U, heads, mix, pieces, words

DIMENSIONS = 1 << 18
STEMS = (4, 6)
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.001
PIECE = 1 << 20  # bytes of text whose features are held at once
MAX_ROWS, ROWS_A_SHARD, SHARDS, ROUNDS = 32_000, 4_000, 8, 6


def features(arr: pa.Array, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(document index, feature) of every n-gram of a string array, repeats included."""
    h, first = words(arr)
    doc = np.repeat(np.arange(len(arr)), np.diff(first))
    ids, docs = [h], [doc]
    for gap, salt in ((1, 0x632BE59BD9B4E019), (2, 0x8CB92BA72F3D8DD7)):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            ids.append(mix(h[:-gap] * U(salt | 1) + h[gap:])[same])
            docs.append(doc[gap:][same])
    for k in STEMS:
        h, doc = heads(arr, k)
        ids.append(mix(h ^ U(0xA24BAED4963EE407 * k & 0xFFFFFFFFFFFFFFFF)))
        docs.append(doc)
    return np.concatenate(docs), (np.concatenate(ids) % U(dimensions)).astype(np.int64)


def weights_of(z: np.ndarray, n: np.ndarray, alpha=ALPHA, beta=BETA, l1=L1, l2=L2) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def ftrl_pass(z: np.ndarray, n: np.ndarray, rows, alpha=ALPHA, beta=BETA, l1=L1, l2=L2) -> None:
    """One pass over (features, label) rows, in place. The last coordinate is the bias (no L1)."""
    bias = len(z) - 1
    for idx, y in rows:
        zi, ni = z[idx], n[idx]
        w = weights_of(zi, ni, alpha, beta, l1, l2)
        b = -z[bias] / ((beta + np.sqrt(n[bias])) / alpha + l2)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -30, 30))) - y
        root = np.sqrt(ni + g * g)
        z[idx] = zi + g - (root - np.sqrt(ni)) / alpha * w
        n[idx] = ni + g * g
        root = np.sqrt(n[bias] + g * g)
        z[bias] += g - (root - np.sqrt(n[bias])) / alpha * b
        n[bias] += g * g


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = MAX_ROWS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Weights (``dimensions`` + bias) from labelled rows. Rows with a null label are
    left out; repeated rows count each time. Without rows all weights are 0."""
    rows = (labelled.filter(F.col(label).isNotNull())
            .select(F.xxhash64(F.lit("fit"), F.col(key).cast("string")).alias("h"),
                    F.col(text).alias("text"), F.col(label).cast("int").alias("y")))

    def extract(batches):
        for whole in batches:
            for b in pieces(whole, 1, PIECE):
                doc, f = features(b.column(1), dimensions)
                both = np.unique(doc * dimensions + f)
                cuts = np.searchsorted(both // dimensions, np.arange(b.num_rows + 1))
                ids = (both % dimensions).astype("<i4")
                packed = pa.array([ids[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), packed, b.column(2)], ["h", "f", "y"])

    rows = ship(rows)
    cut, count = rows.select("h").orderBy("h").limit(max_rows).agg(F.max("h"), F.count("*")).first()
    chosen = rows.filter(F.col("h") <= cut) if count else rows.limit(0)
    shards = max(1, min(SHARDS, count // ROWS_A_SHARD))
    sample = chosen.mapInArrow(extract, "h long, f binary, y int")
    sample = stage(sample.repartition(shards) if shards > 1 else sample, "toxicity-sample")
    sample = sample if shards > 1 else sample.coalesce(1)
    z, n = np.zeros(dimensions + 1), np.zeros(dimensions + 1)
    for _ in range(rounds):
        state = sample.sparkSession.sparkContext.broadcast((z, n))

        def shard(batches, state=state):
            z0, n0 = state.value
            z1, n1 = z0.copy(), n0.copy()
            rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
            rows.sort(key=lambda r: (r[0], r[2]))
            ftrl_pass(z1, n1, ((np.frombuffer(f, "<i4"), y) for _, f, y in rows))
            i = np.flatnonzero((z1 != z0) | (n1 != n0))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array((z1 - z0)[i]), pa.array((n1 - n0)[i])], ["i", "z", "n"])

        merged = (sample.mapInArrow(shard, "i long, z double, n double").groupBy("i")
                  .agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow())
        i = merged["i"].to_numpy()
        z[i] += merged["z"].to_numpy()
        n[i] += merged["n"].to_numpy()
        state.unpersist()
    w = weights_of(z, n)
    w[-1] = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA + L2)
    return w


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> Column:
    """Score column (0 to 1) for the whole text; null and empty texts get the bias alone."""
    dimensions = len(weights) - 1
    used = np.flatnonzero(weights[:-1])
    shared = ship(docs).sparkSession.sparkContext.broadcast((used, weights[used], float(weights[-1])))

    @F.arrow_udf("double")
    def scored(t: pa.Array) -> pa.Array:
        at, value, bias = shared.value
        w = np.zeros(dimensions)
        w[at] = value
        out = []
        for b in pieces(pa.RecordBatch.from_arrays([t], ["t"]), 0, PIECE):
            doc, f = features(b.column(0), dimensions)
            hit = w[f] != 0
            both = np.unique(doc[hit] * dimensions + f[hit])
            total = np.bincount(both // dimensions, w[both % dimensions], b.num_rows) + bias
            out.append(1.0 / (1.0 + np.exp(-np.clip(total, -30, 30))))
        return pa.array(np.concatenate(out) if out else np.empty(0))

    return scored(F.col(text))


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  label: str = "toxic", keep: Column | None = None) -> DataFrame:
    """Labelled rows for ``fit``: texts joined to labels by key; ``keep`` selects label rows."""
    chosen = labels.filter(keep) if keep is not None else labels
    chosen = chosen.select(F.col(key).alias(P + "k"), F.col(label).alias(label))
    return docs.select(F.col(key), F.col(text)).join(chosen, F.col(key) == F.col(P + "k")).drop(P + "k")
