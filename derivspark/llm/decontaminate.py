"""Benchmark decontamination by latent semantic retrieval.

Terms are the benchmark's words (A-Z lower-cased), weighted by idf over all
documents and never less than ``FLOOR``, so that an item in most documents, or of
frequent words only, is searched too. A matrix of TF-IDF passages (the benchmark's and those of
every document) is factored: subspace iteration on the benchmark's passages gives a start, which is then
multiplied once with all passages of the corpus, each task adding up its own. The driver keeps
(terms x rank) matrices only. Every document's overlapping
passages are projected to the latent space and searched for benchmark passages
by cosine, scaled to the share of the benchmark passage that they hold.

Candidates are checked on words: the longest common subsequence (weighted by
idf, so that function words alone prove nothing) of the whole item with the
surrounding region, and of the item's end, its answer. That finds paraphrases
with inserted, dropped and replaced words.

The benchmark is a stated query set; its size is checked before it is sent to
the executors, and a larger one is searched in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stage
from .textvec import Lookup, pieces, words

BLOCK, SPAN = 16, 3  # words a block; blocks a passage (passages start at every block)
QUERY = 32  # words of a benchmark passage
RANK, OVERSAMPLE, POWER = 128, 16, 2
CORPUS_DOCS, FIT_PARTS = 512, 4  # all documents together weigh like this many in the factors
PIECE, SLICE = 1 << 20, 256  # bytes of text searched or multiplied at once; terms of a slice of a matrix
CELLS = 1 << 18  # of gathered rows held at once, few enough for the processor's cache
FLOOR = 0.05  # least weight of a term
CONTAINED = 0.4  # share of a benchmark passage's weight that makes a candidate
LCS_ALONE, LCS_WITH_ANSWER, ANSWER_SHARE, ANSWER_WORDS = 0.75, 0.5, 0.75, 8
MAX_ITEM_WORDS = 2_000_000  # benchmark words searched in one block
MAX_SHARES = 8_000_000  # terms times items up to which texts are first compared by their words


def _document_frequency(docs: DataFrame, text: str, terms: np.ndarray) -> tuple[int, np.ndarray]:
    """Documents, and documents with each term, over all rows and whole texts."""
    def run(batches):
        find = Lookup(terms)
        df, n = np.zeros(len(terms), np.int64), 0
        for whole in batches:
            for b in pieces(whole, 0, PIECE):
                h, first = words(b.column(0))
                t = find.find(h)
                doc = np.repeat(np.arange(b.num_rows), np.diff(first))[t >= 0]
                both = np.unique(doc * len(terms) + t[t >= 0])
                df += np.bincount(both % max(len(terms), 1), minlength=len(terms))
                n += b.num_rows
        i = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1)), pa.array(np.append(df[i], n))], ["t", "n"])

    got = ship(docs).select(text).mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    t, n = got["t"].to_numpy(), got["n"].to_numpy()
    out = np.zeros(len(terms) + 1, np.int64)
    out[t] = n  # -1: the number of documents
    return int(out[-1]), out[:-1]


def _rows(term: np.ndarray, group: np.ndarray, idf: np.ndarray):
    """(terms, values) of each passage that holds a term, of unit length."""
    order = np.lexsort((term, group))
    term, group = term[order], group[order]
    for g in np.split(np.arange(len(term)), np.flatnonzero(np.diff(group)) + 1):
        if len(g):
            t, n = np.unique(term[g], return_counts=True)
            v = n * idf[t]
            size = np.linalg.norm(v)
            if size > 0:
                yield t, v / size


def _sums(matrix: np.ndarray, rows: np.ndarray, weights: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Weighted sum of the matrix's rows of each group, in the weights' precision; ``heads`` are the groups' first
    entries. Groups of one size are multiplied together."""
    sizes = np.diff(np.append(heads, len(rows)))
    out = np.empty((len(heads), matrix.shape[1]), np.result_type(matrix, weights))
    order = np.argsort(sizes, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        k = int(sizes[same[0]]) if len(same) else 1
        most = max(1, CELLS // (k * max(matrix.shape[1], 1)))
        for i in range(0, len(same), most):
            some = same[i:i + most]
            at = heads[some][:, None] + np.arange(k)
            out[some] = np.matmul(weights[at][:, None], matrix[rows[at]])[:, 0]
    return out


def _product(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """X' X q of the staged rows X."""
    shared = rows.sparkSession.sparkContext.broadcast(q)

    def multiply(batches):
        out = np.zeros(shared.value.shape, np.float32)
        for b in batches:
            for t, v in zip(b.column(0), b.column(1)):
                t, v = t.values.to_numpy(), v.values.to_numpy().astype(np.float32)
                out[t] += v[:, None] * (v @ shared.value[t])[None]
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["g"])

    total = np.zeros(q.shape, np.float64)
    for r in rows.mapInArrow(multiply, "g binary").toLocalIterator():
        total += np.frombuffer(r.g, np.float32).reshape(q.shape)
    shared.unpersist()
    return total


def _corpus_product(docs: DataFrame, text: str, terms: np.ndarray, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """X' X q of the unit-length TF-IDF passages X of every document. A task adds up its passages; the
    tasks' matrices are added in slices of terms, so the driver gets one (terms x width) matrix."""
    shared = ship(docs).sparkSession.sparkContext.broadcast((terms, idf.astype(np.float32), q))

    def multiply(batches):
        terms, idf, q = shared.value
        find, out = Lookup(terms), np.zeros(q.shape, np.float32)
        for whole in batches:
            for b in pieces(whole, 0, PIECE):
                h, first = words(b.column(0))
                t = find.find(h)
                sizes = np.diff(first)
                passages = -(-sizes // (BLOCK * SPAN))
                doc = np.repeat(np.arange(len(sizes)), sizes)
                at = (np.cumsum(passages) - passages)[doc] + (np.arange(len(t)) - first[:-1][doc]) // (BLOCK * SPAN)
                key, n = np.unique((at * len(terms) + t)[t >= 0], return_counts=True)
                if not len(key):
                    continue
                at, t = key // len(terms), key % len(terms)
                heads = np.flatnonzero(np.diff(at, prepend=-1))
                row = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(at))))
                v = n * idf[t]
                v /= np.sqrt(np.add.reduceat(v * v, heads))[row]
                y = _sums(q, t, v, heads)
                order = np.argsort(t, kind="stable")
                heads = np.flatnonzero(np.diff(t[order], prepend=-1))
                out[t[order][heads]] += _sums(y, row[order], v[order], heads)
        for i in range(0, len(out), SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([out[i:i + SLICE].astype(np.float64).tobytes()], pa.binary())],
                                             ["i", "g"])

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(g.as_buffer(), np.float64) for g in parts["g"])
        return pa.table({"i": parts["i"][:1], "g": pa.array([total.tobytes()], pa.binary())})

    summed = docs.select(text).mapInArrow(multiply, "i long, g binary").groupBy("i").applyInArrow(add, "i long, g binary")
    total = np.zeros(q.shape, np.float64)
    for r in summed.collect():  # one row a slice of terms
        part = np.frombuffer(r.g, np.float64).reshape(-1, q.shape[1])
        total[r.i:r.i + len(part)] = part
    shared.unpersist()
    return total


def _leading(total: np.ndarray) -> np.ndarray:
    """Left singular vectors that carry weight."""
    u, s, _ = np.linalg.svd(total, full_matrices=False)
    return u[:, s > max(s[0], 1e-12) * 1e-6].astype(np.float32) if s[0] > 0 else u[:, :0].astype(np.float32)


def _factor(rows: DataFrame, terms: int, rank: int) -> np.ndarray:
    """An orthonormal start (terms x (rank + OVERSAMPLE)): the staged rows' leading right singular vectors by
    randomised power iteration, filled up with random directions."""
    width = min(terms, rank + OVERSAMPLE)
    noise = np.random.default_rng(7).standard_normal((terms, width))
    q = np.linalg.qr(noise)[0].astype(np.float32)
    for _ in range(POWER):
        q = _leading(_product(rows, q))
        if not q.shape[1]:
            break
    return np.linalg.qr(np.concatenate([q, noise[:, :width - q.shape[1]]], axis=1))[0].astype(np.float32)


class Model:
    """Terms, their latent vectors and the benchmark's passages."""

    def __init__(self, ids, items, terms, idf, vectors, typical):
        self.ids, self.items, self.terms, self.idf, self.vectors, self.typical = ids, items, terms, idf, vectors, typical
        self.latent = (vectors * idf[:, None]).astype(np.float32)
        self.query_item, self.query_at, rows = [], [], []
        for i, item in enumerate(items):
            for at in range(0, max(1, len(item) - QUERY // 2), QUERY):
                self.query_item.append(i)
                self.query_at.append(at)
                rows.append(self.latent[item[at:at + QUERY]].sum(0))
        self.queries = np.array(rows, np.float32).reshape(len(rows), vectors.shape[1])
        self.norms = np.linalg.norm(self.queries, axis=1)
        self.usable = self.norms > 1e-6
        # Share of each item's weight that a term holds; the blocks that an item's region can span.
        self.shares = None
        if len(terms) * len(items) <= MAX_SHARES:
            self.shares = np.zeros((len(terms), len(items)), np.float32)
            for i, item in enumerate(items):
                np.add.at(self.shares[:, i], item, idf[item] / idf[item].sum())
        self.reach = -(-(max(map(len, items)) + (SPAN + 2) * BLOCK) // BLOCK) + 1

    def lookup(self):
        return Lookup(self.terms)


def _common_weight(region: np.ndarray, item: np.ndarray, w: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of two term sequences."""
    row = np.zeros(len(item) + 1)
    for t in region[np.isin(region, item)]:
        best = row.copy()
        best[1:] = np.maximum(row[1:], (row[:-1] + w) * (item == t))
        row = np.maximum.accumulate(best)
    return float(row[-1])


def _promising(model: Model, t: np.ndarray, block: np.ndarray, blocks: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Blocks around which the words suffice for some item: a leak's region holds at least ``LCS_WITH_ANSWER`` of
    the item's weight, and lies in two adjacent stretches of ``reach`` blocks. No leak is lost."""
    if model.shares is None:
        return np.ones(base[-1], bool)
    stretches = -(-blocks // model.reach)
    first = np.concatenate([[0], np.cumsum(stretches)])
    owner = np.repeat(np.arange(len(blocks)), blocks)
    at = first[:-1][owner] + (np.arange(base[-1]) - base[:-1][owner]) // model.reach
    held = np.zeros((first[-1] + 1, len(model.terms)), bool)  # the last row stays empty
    held[at[block[t >= 0]], t[t >= 0]] = True
    after = np.arange(1, first[-1] + 1)
    after[first[1:][stretches > 0] - 1] = first[-1]  # a text's last stretch has none after it
    enough = np.zeros(first[-1] + 1, bool)
    for i in range(0, first[-1], 2048):
        both = held[i:min(i + 2048, first[-1])] | held[after[i:i + 2048]]
        enough[i:i + len(both)] = (both.astype(np.float32) @ model.shares).max(1) >= LCS_WITH_ANSWER - 1e-3
    before = np.zeros(first[-1], bool)
    before[1:] = enough[:-2]
    before[first[:-1][stretches > 0]] = False
    return (enough[:-1] | before)[at]


def search(model: Model, find: Lookup, texts: pa.Array):
    """(row, item, cosine, lcs share, answer share) of every leak in the texts."""
    h, first = words(texts)
    t = find.find(h)
    if not len(t) or not len(model.queries):
        return
    sizes = np.diff(first)
    blocks = -(-sizes // BLOCK)
    base = np.concatenate([[0], np.cumsum(blocks)])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    block = base[:-1][doc] + (np.arange(len(t)) - first[:-1][doc]) // BLOCK
    promising = _promising(model, t, block, blocks, base)
    needed = promising.copy()  # passages start at promising blocks
    for j in range(1, SPAN):
        needed[j:] |= promising[:-j]
    good = np.flatnonzero((t >= 0) & needed[block])
    dense = np.zeros((base[-1] + SPAN, model.latent.shape[1]), np.float32)
    if len(good):
        heads = np.flatnonzero(np.diff(block[good], prepend=-1))
        dense[block[good][heads]] = np.add.reduceat(model.latent[t[good]], heads, axis=0)
    square = np.bincount(block, np.where(t >= 0, model.idf[t], model.typical) ** 2, base[-1] + SPAN)
    owner = np.repeat(np.arange(len(sizes)), blocks)
    passage, length = dense[:base[-1]].copy(), square[:base[-1]].copy()
    for j in range(1, SPAN):
        inside = np.append(owner[j:], np.full(min(j, len(owner)), -1)) == owner
        passage += dense[j:j + base[-1]] * inside[:, None]
        length += square[j:j + base[-1]] * inside
    least = CONTAINED * model.norms[model.usable].min() if model.usable.any() else np.inf
    hot = np.flatnonzero(promising & (np.einsum("ij,ij->i", passage, passage) >= least * least))
    best: dict = {}
    for i in range(0, len(hot), 8192):
        some = hot[i:i + 8192]
        inner = passage[some] @ model.queries.T
        share = inner / np.maximum(model.norms ** 2, 1e-9)
        for r, c in zip(*np.nonzero((share >= CONTAINED) & model.usable)):
            p, item = int(some[r]), model.query_item[c]
            cosine = float(inner[r, c] / (model.norms[c] * np.sqrt(max(length[p], 1e-9))))
            best.setdefault((int(owner[p]), item), []).append((float(share[r, c]), p, c, cosine))
    for (d, i), found in sorted(best.items()):
        item, w = model.items[i], model.idf[model.items[i]]
        tail = item[-ANSWER_WORDS:]
        outcome = None
        found.sort(reverse=True)
        seen = set()
        for _, p, c, cosine in found:
            at = (p - base[d]) * BLOCK - model.query_at[c]
            lo, hi = max(0, at - BLOCK), min(sizes[d], at + len(item) + (SPAN + 1) * BLOCK)
            if (lo // (4 * BLOCK)) in seen:
                continue
            seen.add(lo // (4 * BLOCK))
            region = t[first[d] + lo:first[d] + hi]
            if w[np.isin(item, region)].sum() < LCS_WITH_ANSWER * w.sum():  # bounds the common subsequence
                continue
            share = _common_weight(region, item, w) / w.sum()
            answer = _common_weight(region, tail, w[-len(tail):]) / w[-len(tail):].sum()
            if outcome is None or share > outcome[1]:
                outcome = (cosine, share, answer)
            if share >= LCS_ALONE:
                break
        if outcome is None:
            continue
        cosine, share, answer = outcome
        if share >= LCS_ALONE or (share >= LCS_WITH_ANSWER and answer >= ANSWER_SHARE):
            yield d, i, cosine, share, answer


def fit(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
        item_text: str = "text", rank: int = RANK) -> list[Model]:
    """Models of the benchmark, one a block of at most ``MAX_ITEM_WORDS`` words. Null and
    wordless items are left out; an empty benchmark gives none."""
    rows = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t")).filter(F.col("t").isNotNull())
    models, ids, texts, held = [], [], [], 0

    def close():
        if texts:
            model = _fit_block(docs, key, text, list(ids), pa.array(texts), rank)
            models.extend([model] if model else [])
        ids.clear(), texts.clear()

    for r in rows.orderBy("i", "t").toLocalIterator():  # a block at a time
        ids.append(r.i), texts.append(r.t)
        held += len(r.t) // 4 + 1
        if held > MAX_ITEM_WORDS:
            close()
            held = 0
    close()
    return models


def _fit_block(docs, key, text, ids, texts, rank):
    h, first = words(texts)
    full = [i for i in range(len(ids)) if first[i + 1] > first[i]]
    if not full:
        return None
    terms = np.unique(h)
    find = Lookup(terms)
    n, df = _document_frequency(docs, text, terms)
    idf = np.maximum(np.log((n + 1) / (df + 1)), FLOOR)
    item_terms = [find.find(h[first[i]:first[i + 1]]) for i in full]

    spark = docs.sparkSession
    schema = "t array<int>, v array<double>"
    own_terms = np.concatenate(item_terms)
    own_group = np.concatenate([i * (1 << 32) + np.arange(len(x)) // QUERY for i, x in enumerate(item_terms)])
    own = list(_rows(own_terms, own_group, idf))
    weight = 10.0  # benchmark passages lead the factors; the corpus shapes the rest
    own = spark.createDataFrame([([int(x) for x in t], [float(x) * weight for x in v]) for t, v in own], schema)
    own = stage(own.repartition(FIT_PARTS), "leak-rows").coalesce(FIT_PARTS)
    start = _factor(own, len(terms), rank)
    total = _product(own, start) + min(1.0, CORPUS_DOCS / max(n, 1)) * _corpus_product(docs, text, terms, idf, start)
    vectors = _leading(total)[:, :rank]
    return Model([ids[i] for i in full], item_terms, terms, idf, vectors, float(idf.mean()))


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
               item_text: str = "text", rank: int = RANK) -> DataFrame:
    """One row a document and benchmark item that it leaks: ``doc_id, item_id, cosine,
    lcs`` (share of the item's weight in the common subsequence), ``answer``.

    Null and empty texts leak nothing. Repeated rows are reported each time, as
    are equal items. An empty table or benchmark gives no rows.
    """
    kinds = [docs.select(key).schema[0].dataType.simpleString(), items.select(item_key).schema[0].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, cosine double, lcs double, answer double"
    d = ship(docs).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    item_type = items.select(item_key).limit(0).toArrow().schema.field(0).type
    out = d.sparkSession.createDataFrame([], schema)
    for model in fit(docs, items, key, text, item_key, item_text, rank):
        shared = d.sparkSession.sparkContext.broadcast(model)

        def run(batches, shared=shared):
            m = shared.value
            find = m.lookup()
            for whole in batches:
                for b in pieces(whole, 1, PIECE):
                    hits = list(search(m, find, b.column(1)))
                    if hits:
                        r, i, *rest = zip(*hits)
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array(r)), pa.array([m.ids[x] for x in i], item_type),
                             *[pa.array(x, pa.float64()) for x in rest]], ["doc_id", "item_id", "cosine", "lcs", "answer"])

        out = out.unionByName(d.mapInArrow(run, schema))
    return out


def leaked(docs: DataFrame, models: list[Model], text: str = "text") -> Column:
    """Boolean column: the row's text leaks an item of some model."""
    result = F.lit(False)
    for model in models:
        result = result | _judge(ship(docs).sparkSession.sparkContext.broadcast(model))(F.col(text))
    return result


def _judge(shared):
    @F.arrow_udf("boolean")
    def judged(t: pa.Array) -> pa.Array:
        m, out, at = shared.value, np.zeros(len(t), bool), 0
        find = m.lookup()
        for b in pieces(pa.RecordBatch.from_arrays([t], ["t"]), 0, PIECE):
            for d, *_ in search(m, find, b.column(0)):
                out[at + d] = True
            at += b.num_rows
        return pa.array(out)

    return judged


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item."""
    models = fit(docs, items, text=text, **options)
    return docs.filter(~leaked(docs, models, text)) if models else docs
