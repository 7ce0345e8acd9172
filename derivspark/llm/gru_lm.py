"""Gated recurrent language model with a class-factored softmax.

Word counts come from all training texts. The model's vocabulary is the most
frequent words, an end mark and one symbol for every other word; symbols are
binned into classes by frequency, and log P(word) = log P(class) + log P(word |
class). Output biases start at the corpus's unigram model. A word outside the
vocabulary has the symbol's probability times its share of the add-one counts
outside the vocabulary, so every text has a proper probability.

The network is fitted in numpy by truncated backpropagation on every whole
training text, by tasks whose parameters are averaged after each round (on the
executors, weighted by tokens). Scoring runs every whole text through it: many
texts in step, in windows, with the hidden state carried from window to window.

Counts of the ``SHARED`` most frequent words are broadcast (a fixed bound);
those of rarer words are joined by word hash.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stage
from .textvec import BATCH_BYTES, U, Lookup, pieces, words

VOCABULARY, CLASS = 1024, 32  # symbols (two of them: end, other), symbols a class
HIDDEN = 16
SHARED = 1 << 18
LEAST_SHARDS, ROUNDS, STEP, STREAMS, RATE = 6, 1, 16, 128, 0.01
SEGMENT = 512  # symbols of a text that one stream reads on end
FULL = 512  # symbols a window from which on its step has its whole length
SHARD = 1 << 21  # tokens that a task trains on
SLICES = 16  # of the parameters, added up by as many groups
LONG_TEXT = 1 << 14  # bytes; longer texts are scored together, in step
LONG_BYTES = 64 << 20  # bytes of long texts held at once
ADAM_CELLS = 1 << 14  # parameters changed at once, few enough for the processor's cache
WINDOW_CELLS = 1 << 15  # (text, position) pairs whose states are held at once
LN10 = np.log(10.0)


def count_words(texts: DataFrame, text: str) -> DataFrame:
    """``h, c``: count of every word of all texts, by word hash."""
    def run(batches):
        keys, counts = [np.empty(0, U)], [np.empty(0, np.int64)]
        held = 0

        def merged():
            h, n = np.concatenate(keys), np.concatenate(counts)
            k, back = np.unique(h, return_inverse=True)
            return k, np.bincount(back, n, len(k)).astype(np.int64)

        for whole in batches:
            for b in pieces(whole, 0):
                k, n = np.unique(words(b.column(0))[0], return_counts=True)
                keys.append(k), counts.append(n)
                held += len(k)
                if held > 1 << 21:
                    k, n = merged()
                    if len(k) > 1 << 20:  # the table is large: pass it on, start anew
                        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], ["h", "c"])
                        k, n = k[:0], n[:0]
                    keys[:], counts[:], held = [k], [n], len(k)
        k, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], ["h", "c"])

    # A task has a word a few times at most, so its counts are added up behind the shuffle only.
    counted = ship(texts).select(text).mapInArrow(run, "h long, c long")
    return counted.repartition("h").groupBy("h").agg(F.sum("c").alias("c"))


CUT = 60.0  # of logits: biases are log shares, so they stay small; the cut keeps any finite


def exponentials(logits: np.ndarray, reach: float) -> np.ndarray:
    """In place; ``reach`` bounds the logits' size, and none is cut where it is within ``CUT``."""
    if not reach < CUT:
        np.clip(logits, -CUT, CUT, out=logits)
    return np.exp(logits, out=logits)


class Net:
    """Parameters by name in one flat float32 vector, and the model's arithmetic. A symbol's row of
    ``x`` holds what it adds to the gates (its embedding times the input weights)."""

    def __init__(self, symbols: int, counts: np.ndarray | None = None, flat: np.ndarray | None = None):
        self.symbols, self.classes = symbols, -(-symbols // CLASS)
        shapes = {"x": (symbols, 3 * HIDDEN), "wh": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
                  "cw": (HIDDEN, self.classes), "cb": (self.classes,),
                  "ow": (self.classes, HIDDEN, CLASS), "ob": (self.classes, CLASS)}
        size = sum(int(np.prod(s)) for s in shapes.values())
        fresh = flat is None
        self.flat = np.zeros(size, np.float32) if fresh else flat.astype(np.float32, copy=True)
        at = 0
        for name, s in shapes.items():
            setattr(self, name, self.flat[at:at + int(np.prod(s))].reshape(s))
            at += int(np.prod(s))
        if fresh:
            rng = np.random.default_rng(11)
            for name, scale in (("x", 0.2), ("wh", HIDDEN ** -0.5)):
                p = getattr(self, name)
                p[:] = rng.standard_normal(p.shape) * scale
            c = np.zeros(self.classes * CLASS)
            c[:symbols] = counts + 1.0
            c = c.reshape(self.classes, CLASS)
            own = c.sum(1, keepdims=True)  # shares, so that no logit starts above 0
            self.cb[:] = np.log(own[:, 0] / c.sum())
            self.ob[:] = np.where(c > 0, np.log(np.maximum(c, 1e-9) / own), -30.0)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What each symbol (a row) adds to the gates, and the states' weights (a column each), both sigmoids' negated."""
        sign = np.repeat(np.array([-1, -1, 1], np.float32), HIDDEN)
        table = self.x + self.b
        table *= sign
        return table, self.wh.T * sign[:, None]

    def step(self, gates: np.ndarray, h: np.ndarray, wh: np.ndarray, u=None, zr=None, cand=None, new=None) -> np.ndarray:
        """Next states, a column each, by rows (turned to columns) and weights of ``tables``. The states' part, both
        sigmoids, the candidate and the result are left in the arrays given for them."""
        u = np.matmul(wh, h, out=u)
        zr = np.add(gates[:2 * HIDDEN], u[:2 * HIDDEN], out=zr)
        np.exp(zr, out=zr)
        zr += 1.0
        np.divide(1.0, zr, out=zr)
        cand = np.multiply(zr[HIDDEN:], u[2 * HIDDEN:], out=cand)
        cand += gates[2 * HIDDEN:]
        np.tanh(cand, out=cand)
        new = np.subtract(h, cand, out=new)
        new *= zr[:HIDDEN]
        new += cand
        return new

    def reach(self) -> tuple[float, float]:
        """Bounds of the logits of classes and of their words: a state's cells lie within -1 and 1."""
        return (float(np.abs(self.cw).sum(0).max() + np.abs(self.cb).max()),
                float(np.abs(self.ow).sum(1).max() + np.abs(self.ob).max()))

    def by_class(self, symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Order of rows by their symbols' classes; each class that occurs, with its first row and its end."""
        cls = (symbols // CLASS).astype(np.int16)
        order = np.argsort(cls, kind="stable")
        cuts = np.append(0, np.bincount(cls, minlength=self.classes).cumsum()).tolist()
        return order, [(c, i, j) for c, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]

    def log_probability(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target symbol given each state."""
        cls, inner = target // CLASS, target % CLASS
        far, near = self.reach()

        def picked(logits, bound, column):
            e = exponentials(logits, bound)
            return np.log(e[np.arange(len(e)), column] / (e @ np.ones(e.shape[1], np.float32)) + 1e-30)

        logits = h @ self.cw
        logits += self.cb
        out = picked(logits, far, cls).astype(np.float64)
        # Rows of a class together: a product for each class, all else on all rows at once.
        order, spans = self.by_class(target)
        s, logits = h[order], np.empty((len(h), CLASS), np.float32)
        for c, i, j in spans:
            np.matmul(s[i:j], self.ow[c], out=logits[i:j])
            logits[i:j] += self.ob[c]
        out[order] += picked(logits, near, inner[order])
        return out

    @staticmethod
    def off_target(e: np.ndarray, at: np.ndarray) -> float:
        """Rows of exponentials become the mean loss's slopes by their logits; ``at`` are the targets' cells. The loss."""
        total, flat = e @ np.ones(e.shape[1], np.float32), e.ravel()
        loss = -np.log(flat[at] / total + 1e-30).sum()
        total *= len(e)
        np.divide(1.0, total, out=total)
        e *= total[:, None]
        flat[at] -= np.float32(1 / len(e))
        return loss

    def gradient(self, given, target, begins, h0, g=None):
        """Truncated backpropagation over one window (steps x streams) of full streams: gradient (in
        ``g``), last states, loss. Where ``begins`` is set a text starts, from a state of zeros."""
        steps, streams = given.shape
        g = Net(self.symbols, flat=np.zeros_like(self.flat)) if g is None else g
        g.flat[:] = 0
        n, starts = steps * streams, begins.any(1)
        # Steps x cells x streams, so that a step's work lies together, in long rows.
        table, wh = self.tables()
        gates = np.ascontiguousarray(np.take(table, given, axis=0).transpose(0, 2, 1))
        states, before, cand = (np.empty((steps, HIDDEN, streams), np.float32) for _ in range(3))
        u, zr, h = np.empty((steps, 3 * HIDDEN, streams), np.float32), np.empty((steps, 2 * HIDDEN, streams), np.float32), h0.T
        for t in range(steps):
            before[t] = h
            if starts[t]:
                before[t][:, begins[t]] = 0
            h = self.step(gates[t], before[t], wh, u[t], zr[t], cand[t], states[t])
        given, target, rows = given.ravel(), target.ravel(), np.arange(n)
        far, near = self.reach()
        flat = np.ones((n, HIDDEN + 1), np.float32)  # the last column takes the biases
        flat.reshape(steps, streams, -1)[:, :, :HIDDEN] = states.transpose(0, 2, 1)
        cls, inner = target // CLASS, target % CLASS
        p = exponentials(flat @ np.vstack([self.cw, self.cb]), far)
        loss = self.off_target(p, rows * self.classes + cls)
        both = flat.T @ p
        g.cw[:], g.cb[:] = both[:HIDDEN], both[HIDDEN]
        dstates = p @ self.cw.T
        # Rows of a class together: its products on its slice of them, all else on all rows at once.
        order, spans = self.by_class(target)
        s, q, down = flat[order], np.empty((n, CLASS), np.float32), np.empty((n, HIDDEN), np.float32)
        weights = np.concatenate([self.ow, self.ob[:, None]], axis=1)
        back, tuned = np.ascontiguousarray(self.ow.transpose(0, 2, 1)), np.zeros_like(weights)
        for c, i, j in spans:
            np.matmul(s[i:j], weights[c], out=q[i:j])
        exponentials(q, near)
        loss += self.off_target(q, rows * CLASS + inner[order])
        for c, i, j in spans:
            np.matmul(s[i:j].T, q[i:j], out=tuned[c])
            np.matmul(q[i:j], back[c], out=down[i:j])
        g.ow[:], g.ob[:] = tuned[:, :HIDDEN], tuned[:, HIDDEN]
        dstates[order] += down
        dstates = dstates.reshape(steps, streams, HIDDEN).transpose(0, 2, 1)
        z, r, dh = zr[:, :HIDDEN], zr[:, HIDDEN:], np.zeros((HIDDEN, streams), np.float32)
        # Slopes of the candidate and of the first gate by the state's, then of the second gate and of the state's part
        # of the candidate by the candidate's: two products a step.
        factors, made = (np.empty((steps, 4, HIDDEN, streams), np.float32) for _ in range(2))
        rest, change, turned = 1 - z, before - cand, u[:, 2 * HIDDEN:] * r
        change *= z
        np.multiply(rest, 1 - cand * cand, out=factors[:, 0])
        np.multiply(change, rest, out=factors[:, 1])
        np.multiply(turned, 1 - r, out=factors[:, 2])
        factors[:, 3] = r
        dc, du = made[:, 0], made.reshape(steps, 4 * HIDDEN, streams)[:, HIDDEN:]
        for t in range(steps - 1, -1, -1):
            dh += dstates[t]
            np.multiply(dh, factors[t, :2], out=made[t, :2])
            np.multiply(dc[t], factors[t, 2:], out=made[t, 2:])
            dh *= z[t]
            dh += self.wh @ du[t]
            if starts[t]:
                dh[:, begins[t]] = 0
        g.wh[:] = (before @ du.transpose(0, 2, 1)).sum(0)
        order, spans = self.by_class(given)
        mine, d = np.zeros((n, CLASS), np.float32), np.empty((n, 3 * HIDDEN), np.float32)
        d.reshape(steps, streams, -1)[:, :, :2 * HIDDEN] = du[:, :2 * HIDDEN].transpose(0, 2, 1)
        d.reshape(steps, streams, -1)[:, :, 2 * HIDDEN:] = dc.transpose(0, 2, 1)
        g.b[:] = np.ones(n, np.float32) @ d
        d = d[order]
        mine.ravel()[rows * CLASS + given[order] % CLASS] = 1
        for c, i, j in spans:
            to = g.x[c * CLASS:(c + 1) * CLASS]
            np.matmul(mine[i:j, :len(to)].T, d[i:j], out=to)
        return g.flat, h.T, float(loss), n


def segments_of(symbols: np.ndarray, end: int) -> list[np.ndarray]:
    """A text as training rows of at most ``SEGMENT`` targets: the symbol given first, then the
    targets. A text starts with the end mark given, and its last target is the end mark."""
    whole = np.concatenate([[end], symbols, [end]]).astype(np.int32)
    return [whole[i:i + SEGMENT + 1] for i in range(0, len(whole) - 1, SEGMENT)]


def streams_of(segments: list[np.ndarray], end: int, streams: int) -> tuple[np.ndarray, ...]:
    """Segments dealt to streams, longest first, each to the shortest stream: symbols given, targets and
    starts (streams x steps, longest stream first), and each stream's length."""
    heap = [(0, i) for i in range(min(streams, len(segments)))]
    dealt = [[] for _ in heap]
    for x in sorted(segments, key=lambda x: (-len(x), x.tobytes())):
        size, i = heapq.heappop(heap)
        dealt[i].append(x)
        heapq.heappush(heap, (size + len(x) - 1, i))
    sizes = np.array([sum(len(x) - 1 for x in d) for d in dealt])
    order = np.argsort(-sizes, kind="stable")
    mix = np.random.default_rng(5)
    given, target = (np.full((len(dealt), int(sizes.max())), end, np.int32) for _ in range(2))
    begins = np.zeros(target.shape, bool)
    for row, i in enumerate(order):
        at = 0
        for k in mix.permutation(len(dealt[i])):
            x = dealt[i][k]
            n = len(x) - 1
            begins[row, at] = True
            given[row, at:at + n], target[row, at:at + n] = x[:-1], x[1:]
            at += n
    return given, target, begins, sizes[order]


def train(net: Net, segments: list[np.ndarray], end: int, rate: float = RATE, moments: dict | None = None) -> float:
    """One pass over segments (Adam, in place); loss per token in nats. They run one after another in
    ``STREAMS`` streams, in windows of ``STEP`` symbols; states pass from window to window, up to
    the segment's end. ``moments`` carries Adam's state from call to call."""
    moments = {} if moments is None else moments
    m, v = (moments.setdefault(k, np.zeros_like(net.flat)) for k in "mv")
    turn, total, seen = moments.get("turn", 0), 0.0, 0
    given, target, begins, sizes = streams_of(segments, end, STREAMS)
    h, g = np.zeros((len(sizes), HIDDEN), np.float32), Net(net.symbols, flat=np.zeros_like(net.flat))
    part, root = np.empty((2, ADAM_CELLS), np.float32)
    at, longest = 0, int(sizes[0])
    while at < longest:
        live = int(np.searchsorted(-sizes, -at, "left"))  # streams longer than what was read
        to = min(at + STEP, int(sizes[live - 1]))  # up to the end of the shortest of them
        view = (slice(0, live), slice(at, to))
        grad, h, loss, n = net.gradient(given[view].T, target[view].T, begins[view].T, h[:live], g)
        # The norm is cut at 1; short windows at the streams' ends count by their size.
        norm = float(np.linalg.norm(grad))
        if norm > 1.0:
            grad *= 1.0 / norm
        pace = rate * min(1.0, n / FULL)
        turn += 1
        # Adam with rates 0.1 and 0.01; m and v hold sums, 1 / 0.1 and 1 / 0.01 times the usual means.
        scale = np.sqrt(0.01 / (1 - 0.99 ** turn))
        speed, least = float(0.1 * pace / (1 - 0.9 ** turn) / scale), float(1e-6 / scale)
        for i in range(0, len(grad), ADAM_CELLS):
            x, y, w, own = (k[i:i + ADAM_CELLS] for k in (grad, m, v, net.flat))
            a, b = part[:len(x)], root[:len(x)]
            y *= 0.9
            y += x
            np.multiply(x, x, out=a)
            w *= 0.99
            w += a
            np.sqrt(w, out=b)
            b += least
            np.divide(y, b, out=a)
            a *= speed
            own -= a
        total += loss
        seen += n
        at = to
    moments["turn"] = turn
    return total / max(seen, 1)


def text_log_probabilities(net: Net, symbols: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """Natural log probability of each text (its symbols, then the end mark). Texts run
    in step, longest first; the state of each is carried across windows."""
    sizes = np.diff(first) + 1
    order = np.argsort(-sizes, kind="stable")
    starts, longest = first[:-1][order], sizes[order]
    shorter = -longest  # ascending
    table, wh = net.tables()
    out = np.zeros(len(order))
    h = np.zeros((HIDDEN, len(order)), np.float32)
    given = np.full(len(order), end)
    cells = np.insert(symbols, first[1:], end)  # each text, then the end mark
    starts += order  # of the marks before it
    t, total = 0, int(longest[0]) if len(order) else 0
    while t < total:
        live = int(np.searchsorted(shorter, -t, "left"))  # texts longer than t
        states, targets, owner, held = [], [], [], 0
        while t < total and held < WINDOW_CELLS:
            live = int(np.searchsorted(shorter[:live], -t, "left"))
            h = net.step(np.ascontiguousarray(np.take(table, given[:live], axis=0).T), h[:, :live], wh)
            target = cells[starts[:live] + t]
            states.append(h), targets.append(target), owner.append(np.arange(live))
            given[:live] = target
            held += live
            t += 1
        lp = net.log_probability(np.ascontiguousarray(np.concatenate(states, axis=1).T), np.concatenate(targets))
        out += np.bincount(np.concatenate(owner), lp, len(order))
    back = np.empty(len(order))
    back[order] = out
    return back


def long_together(batches):
    """The batches without their long texts, then those, many at a time: a text's states follow one
    another, so a long text alone would make as many small products as it has words."""
    held, size = [], 0
    for b in batches:
        long = pc.fill_null(pc.greater(pc.binary_length(b.column(1)), LONG_TEXT), False)
        yield b.filter(pc.invert(long)), BATCH_BYTES
        some = b.filter(long)
        held.append(some)
        size += pc.sum(pc.binary_length(some.column(1))).as_py() or 0
        if size > LONG_BYTES:
            yield from ((x, LONG_BYTES) for x in pa.Table.from_batches(held).combine_chunks().to_batches())
            held, size = [], 0
    if size:
        yield from ((x, LONG_BYTES) for x in pa.Table.from_batches(held).combine_chunks().to_batches())


class Lexicon:
    """Shared word counts and the symbols of the model."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, vocabulary: int, n_texts: int, tokens: int, distinct: int):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order].astype(np.int64)
        frequent = np.argsort(-self.counts, kind="stable")[:vocabulary - 2]
        self.tokens, self.distinct, self.n_texts = tokens, distinct, n_texts
        self.other_tokens = tokens - n_texts - int(self.counts[frequent].sum())
        self.other_distinct = distinct - (n_texts > 0) - len(frequent)
        counted = np.concatenate([self.counts[frequent], [self.other_tokens, n_texts]])
        rank = np.empty(len(counted), np.int64)
        rank[np.argsort(-counted, kind="stable")] = np.arange(len(counted))
        self.fitted = 0  # tokens that a round of fitting has read
        self.symbols, self.other, self.end = len(counted), int(rank[-2]), int(rank[-1])
        self.symbol = np.full(len(keys) + 1, self.other)  # the last entry: words that aren't shared
        self.symbol[frequent] = rank[:-2]
        self.symbol_counts = np.empty(len(counted))
        self.symbol_counts[rank] = counted
        own = np.sort(frequent)
        self.own_keys, self.own_symbol = self.keys[own], np.append(self.symbol[own], self.other)  # the vocabulary alone


def fit(train_docs: DataFrame, key: str, text: str, vocabulary: int = VOCABULARY) -> tuple[Net, Lexicon, DataFrame]:
    """The network, the lexicon and the staged word counts, from training texts."""
    counts = stage(count_words(train_docs, text), "lm-counts")
    n_texts = train_docs.count()
    total = counts.agg(F.sum("c"), F.count("*")).first()
    top = counts.orderBy(F.desc("c"), "h").limit(SHARED).toArrow()
    lexicon = Lexicon(top["h"].to_numpy().view(U), top["c"].to_numpy(), vocabulary, n_texts,
                      (total[0] or 0) + n_texts, total[1] + (n_texts > 0))
    net = Net(lexicon.symbols, lexicon.symbol_counts)
    if not n_texts:
        return net, lexicon, counts
    sc = train_docs.sparkSession.sparkContext
    shared = sc.broadcast(lexicon)

    def symbols(batches):
        lex = shared.value
        find = Lookup(lex.own_keys)
        for whole in batches:
            for b in pieces(whole, 0):
                h, first = words(b.column(0))
                s = lex.own_symbol[find.find(h)].astype(np.int32)
                rows = [x for i, j in zip(first, first[1:]) for x in segments_of(s[i:j], lex.end)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["s"])

    # Segments are dealt evenly over shards of about SHARD tokens, whatever the input's size, so a shard is
    # like the whole: copies, long texts and sources are spread. Within a shard they have one order.
    made = train_docs.select(text).mapInArrow(symbols, "s array<int>")
    shards = max(LEAST_SHARDS, -(-lexicon.tokens // SHARD))
    rows = made.repartition(shards).sortWithinPartitions(F.xxhash64("s"))
    flat = net.flat
    for turn in range(ROUNDS):
        now = sc.broadcast(flat)

        def shard(batches, now=now, turn=turn):
            lex = shared.value
            own = Net(lex.symbols, flat=now.value)
            segments = [x.values.to_numpy() for b in batches for x in b.column(0)]
            n = sum(map(len, segments)) - len(segments)
            if segments:
                train(own, segments, lex.end, RATE * 0.6 ** turn)
            if n:
                cut = np.array_split(own.flat.astype(np.float64) * n, SLICES)
                yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([c.tobytes() for c in cut], pa.binary()),
                                                  pa.array([n] * SLICES)], ["slice", "p", "n"])

        def add(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(p.as_buffer(), np.float64) for p in group["p"])
            return pa.table({"slice": group["slice"][:1], "p": pa.array([total.tobytes()], pa.binary()),
                             "n": [sum(group["n"].to_pylist())]})

        # The tasks' parameters, weighted by their tokens, are averaged on the executors; the driver gets one set.
        tuned = stage(rows.mapInArrow(shard, "slice int, p binary, n long"), "lm-round")
        some = tuned.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(16)))
        sums = some.groupBy("slice", "salt").applyInArrow(add, "slice int, p binary, n long")
        parts = sorted(sums.groupBy("slice").applyInArrow(add, "slice int, p binary, n long").collect(), key=lambda r: r["slice"])
        lexicon.fitted = parts[0]["n"]
        flat = (np.concatenate([np.frombuffer(r["p"], np.float64) for r in parts]) / lexicon.fitted).astype(np.float32)
        now.unpersist()
    return Net(lexicon.symbols, flat=flat), lexicon, counts


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", train_on: Column | None = None,
          vocabulary: int = VOCABULARY) -> DataFrame:
    """One row a row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``
    (log10 probabilities of the whole text under the add-one unigram model and
    the recurrent model), ``other_tokens``.

    ``train_on`` selects the rows learned from (all by default; rows where it is
    null are not). Null text is empty: its one token is the end mark. Without
    training texts every probability is that of a single unknown symbol. An
    empty table gives no rows.
    """
    chosen = docs.filter(train_on) if train_on is not None else docs
    net, lexicon, counts = fit(chosen.select(key, text), key, text, vocabulary)
    shared = ship(docs).sparkSession.sparkContext.broadcast((net.symbols, net.flat, lexicon))
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches):
        symbols, flat, lex = shared.value
        own, find = Net(symbols, flat=flat), Lookup(lex.keys)
        logs = np.append(np.log10(lex.counts + 1.0), 0.0)
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for whole, limit in long_together(batches):
            for b in pieces(whole, 1, limit):
                h, first = words(b.column(1))
                at = find.find(h)
                s = lex.symbol[at]
                doc = np.repeat(np.arange(b.num_rows), np.diff(first))
                n = b.num_rows
                base = np.bincount(doc, logs[at], n) + np.log10(lex.n_texts + 1.0)
                other = s == lex.other
                model = text_log_probabilities(own, s, first, lex.end) / LN10
                model += np.bincount(doc[other], logs[at[other]], n)
                known = np.bincount(doc, at >= 0, n).astype(np.int64) + (lex.n_texts > 0)
                rare = np.flatnonzero(at < 0)
                order = np.lexsort((h[rare], doc[rare]))
                rh, rd = h[rare][order], doc[rare][order]
                new = np.ones(len(rh), bool)
                new[1:] = (rh[1:] != rh[:-1]) | (rd[1:] != rd[:-1])
                heads = np.flatnonzero(new)
                times = np.diff(np.append(heads, len(rh)))
                cuts = pa.array(np.searchsorted(rd[heads], np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(row + np.arange(n)), pa.array(np.diff(first) + 1), pa.array(known),
                     pa.array(np.bincount(doc[other], minlength=n)), pa.array(base), pa.array(model),
                     pa.ListArray.from_arrays(cuts, pa.array(rh[heads].view(np.int64))),
                     pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32)))],
                    ["doc_id", "row", "n_tokens", "known", "other_tokens", "base", "model", "rare", "times"])
                row += n

    part = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, row long, n_tokens long, known long, other_tokens long, base double, model double, "
             "rare array<long>, times array<int>")
    part = stage(part, "lm-scores")
    pairs = part.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", "x.rare", "x.times")
    seen = pairs.join(counts.withColumnRenamed("h", "rare"), "rare")
    add = seen.groupBy("row").agg(F.sum(F.log10(F.col("c") + 1) * F.col("times")).alias("add"),
                                  F.sum("times").alias("found"))
    out = part.drop("rare", "times").join(add, "row", "left").fillna({"add": 0.0, "found": 0})
    whole = float(np.log10(lexicon.tokens + lexicon.distinct + 1))
    outside = float(np.log10(lexicon.other_tokens + lexicon.other_distinct + 1))
    return out.select("doc_id", "n_tokens", (F.col("known") + F.col("found")).alias("n_known"),
                      F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
                      (F.col("base") + F.col("add") - F.col("n_tokens") * whole).alias("base_score"),
                      (F.col("model") + F.col("add") - F.col("other_tokens") * outside).alias("score"), "other_tokens")
