"""Near duplicates by HyperMinHash.

A text's set holds its distinct word shingles as 64-bit hashes. The first
``BUCKET_BITS`` bits of a hash name a bucket; of each bucket's smallest rest the
sketch keeps the count of leading zeros and ``MANTISSA`` bits after them, 16
bits in all. Buckets that stay empty borrow the register of another bucket, in
an order that depends on the bucket only, so that two sketches agree in a
register with a probability near the sets' similarity for sets of any size.

1. Texts with equal sets form a class; only one of a class goes on.
2. Runs of registers form bands; classes that share a band are candidates. With
   64 bands of 8 a pair at 0.8 is missed with probability 8e-6, while a pair at
   0.4 meets with probability 0.04.
3. A bucket of candidates is not expanded into pairs. Its hub is its member with
   the fullest buckets. First every class is compared with one hub, the heaviest of
   all its buckets; the links found join classes into components, and buckets within
   one component are done. In the others, members are then compared with each hub of
   another component. Buckets that
   still hold several components after ``STAR_ROUNDS`` are compared in blocks of
   bounded size: the overlaps of a block's full sets are one matrix product, and
   only links between components come out. So no link between two components is
   lost to the hubs' choice, and no pairs are emitted.
4. A pair's similarity is estimated from its registers, corrected for
   registers that agree by chance; clear misses go, and all others are
   verified on their full sets.

Sketches and texts are large and stay where they are: rows that a step needs
are picked by a Bloom filter of their keys (``common.KeyFilter``), and only
those are shuffled to the exact join. No task runs two Python steps at a time,
which would take two workers' memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import P, KeyFilter, maybe_in, ship, stage
from .graph import components
from .textvec import U, mix, pieces, shingles, words

SHINGLE, PERCENT = 5, 80
BUCKET_BITS, MANTISSA = 9, 10
BUCKETS = 1 << BUCKET_BITS
BANDS, BAND = 64, 8
STAR_ROUNDS = 2
BLOCK = 768  # members of a block; a task compares two blocks at most
DRAWS = 2000  # donors tried for an empty bucket before its text's first register is taken
PRUNE_SIGMAS, PRUNE_SIZE = 5, 64  # estimates that far under the threshold go, for sets of that size on


def sets(arr: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their bounds."""
    h, at = shingles(*words(arr), k)
    parts = [np.unique(h[a:b]) for a, b in zip(at, at[1:])]
    return (np.concatenate(parts) if parts else h), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def fingerprints(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each set."""
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(values ^ U(0x5851F42D4C957F2D)))])
    return mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(U)).view(np.int64)


def registers(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts x BUCKETS) registers, 0 only for texts without shingles."""
    texts = len(at) - 1
    out = np.zeros((texts, BUCKETS), np.uint16)
    if not len(values):
        return out
    doc = np.repeat(np.arange(texts), np.diff(at))
    bucket = (values >> U(64 - BUCKET_BITS)).astype(np.int64)
    first = np.ones(len(values), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (doc[1:] != doc[:-1])
    rest = (values[first] << U(BUCKET_BITS)) >> U(11)  # 53 bits: exact as a float
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    up, down = np.maximum(MANTISSA + 1 - bits, 0).astype(U), np.maximum(bits - MANTISSA - 1, 0).astype(U)
    low = ((rest << up) >> down) & U((1 << MANTISSA) - 1)
    out[doc[first], bucket[first]] = ((54 - bits).astype(U) << U(MANTISSA) | low).astype(np.uint16)
    filled = out.copy()
    row, col = np.nonzero((out == 0) & (np.diff(at) > 0)[:, None])
    for draw in range(DRAWS):
        if not len(row):
            break
        donor = (mix((np.arange(BUCKETS) + draw * BUCKETS + 1).astype(U) * U(0x9E3779B97F4A7C15))
                 >> U(64 - BUCKET_BITS)).astype(np.int64)
        got = out[row, donor[col]]
        ok = got != 0
        filled[row[ok], col[ok]] = got[ok]
        row, col = row[~ok], col[~ok]
    if len(row):
        filled[row, col] = out[row, (out != 0).argmax(1)[row]]
    return filled


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(texts x BANDS) 64-bit keys of the bands."""
    w = np.ascontiguousarray(regs).view(np.uint64).reshape(len(regs), BANDS, BAND // 4)
    key = np.arange(1, BANDS + 1, dtype=U)[None] * U(0xD1B54A32D192ED03)
    for i in range(w.shape[2]):
        key = mix(key ^ w[:, :, i]) + U(i + 1)
    return key


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of unrelated sets of n and m elements agree: the
    sum over register values of the product of both sets' probabilities (minima
    of n/BUCKETS uniform values), a geometric series for each count of zeros."""
    a, b = n / BUCKETS, m / BUCKETS
    total = np.zeros(len(a))
    for zeros in range(40):
        lo, width = 2.0 ** -(zeros + 1), 2.0 ** -(zeros + 1 + MANTISSA)
        ratio = np.exp(-(a + b) * width)
        series = np.where(ratio < 1 - 1e-12, (1 - ratio ** (1 << MANTISSA)) / np.maximum(1 - ratio, 1e-300), 1 << MANTISSA)
        total += (1 - np.exp(-a * width)) * (1 - np.exp(-b * width)) * np.exp(-(a + b) * lo) * series
    return total


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of register rows, corrected for chance agreement."""
    c = chance(n.astype(float), m.astype(float))
    return ((x == y).mean(1) - c) / (1 - c)


def sketch(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """``doc_id, n, f`` (fingerprint of the set; null for an empty set), ``regs`` a row."""
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for b in pieces(whole, 1):
                values, at = sets(b.column(1), k)
                n = np.diff(at)
                f = fingerprints(values, at)
                regs = registers(values, at)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n), pa.array(f, mask=n == 0),
                     pa.array([r.tobytes() if c else None for r, c in zip(regs, n)], pa.binary())],
                    ["doc_id", "n", "f", "regs"])

    d = ship(docs).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(run, f"doc_id {kind}, n long, f long, regs binary")


def _bands(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, f``: the bands of each class once; only sketches of classes of several rows are shuffled."""
    several = KeyFilter(classes.filter("rows > 1").select("f"))

    def run(batches, alone):
        for b in batches:
            if alone:
                b = b.filter(pa.array(~several.has(b.column(2).to_numpy())))
            for i in range(0, b.num_rows, 2048):
                p = b.slice(i, 2048)
                regs = np.frombuffer(b"".join(p.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                keys = band_keys(regs).ravel().view(np.int64)
                f = np.repeat(p.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(f)], ["key", "f"])

    rows = sketches.select("f", "regs", F.xxhash64("f").alias("h"))
    again = rows.filter(maybe_in(several)(F.col("f"))).dropDuplicates(["f"])
    return (rows.mapInArrow(lambda batches: run(batches, True), "key long, f long")
            .unionByName(again.mapInArrow(lambda batches: run(batches, False), "key long, f long")))


def _nodes(pairs: DataFrame) -> DataFrame:
    """``f``: the classes of pairs once, staged, as several steps read them."""
    return stage(pairs.select(F.explode(F.array("a", "b")).alias("f")).distinct(), "near-nodes")


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                p = b.slice(i, 2048)
                x, y = (np.frombuffer(b"".join(p.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in (3, 5))
                n, m = p.column(2).to_numpy(), p.column(4).to_numpy()
                level, small = percent / 100, np.minimum(n, m)
                own = BUCKETS * (1 - np.exp(-small / BUCKETS))  # registers that aren't borrowed
                slack = PRUNE_SIGMAS * np.sqrt(level * (1 - level) / np.maximum(own, 1))
                good = (estimate(x, y, n, m) >= level - slack) | (small < PRUNE_SIZE)
                good &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
                yield pa.RecordBatch.from_arrays([p.column(0), p.column(1)], ["a", "b"]).filter(pa.array(good))

    near = sketches.select("f", "n", "regs").filter(maybe_in(_nodes(pairs))(F.col("f"))).dropDuplicates(["f"])
    x = near.select(F.col("f").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    y = near.select(F.col("f").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    return (pairs.join(x, "a").join(y, "b").select("a", "b", "na", "ra", "nb", "rb")
            .mapInArrow(run, "a long, b long"))


def _full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """``f, s``: the full sets of classes (``nodes.f``), made again from their texts, staged. Of an id
    with several texts the one with the class's own set is taken; a task makes a class's set once
    (rows that repeat an id and a text may give it in several tasks, which the comparisons bear)."""
    need = classes.join(nodes, "f").select(F.col("first").alias(P + "first"), F.col("f").alias(P + "f"))

    def full(batches):
        seen = set()
        for whole in batches:
            for b in pieces(whole, 1):
                values, at = sets(b.column(1), k)
                f = fingerprints(values, at)
                own = f == b.column(0).to_numpy()
                for i, x in enumerate(f.tolist()):
                    own[i] &= x not in seen
                    if own[i]:
                        seen.add(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([values[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())],
                    ["f", "s"]).filter(pa.array(own))

    texts = (docs.select(F.col(key).alias(P + "k"), F.col(text).alias(P + "t"))
             .filter(maybe_in(need.select(P + "first"))(F.col(P + "k")))
             .join(need.hint("merge"), F.col(P + "k") == F.col(P + "first")).select(P + "f", P + "t"))
    return stage(texts.mapInArrow(full, "f long, s binary"), "near-sets")


def _verified(pairs: DataFrame, full_sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    def check(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = (full_sets.select(F.col("f").alias(c), F.col("s").alias("s" + c)) for c in "ab")
    return pairs.join(x, "a").join(y, "b").select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def _block_links(members: DataFrame, full_sets: DataFrame, percent: int) -> DataFrame:
    """Links between members (key, f, comp) of one bucket and different components, found
    block by block on full sets; one link a member and other component. Buckets of
    the same members are compared once."""
    whole = members.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("f")).alias("x"),
                                       F.bit_xor(F.xxhash64("f", F.lit(1))).alias("y"))
    members = members.join(whole.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = (members.join(sizes, "key").withColumn("i", F.pmod(F.xxhash64("f"), F.col("blocks")).cast("int"))
            .withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("key", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "f", "comp")
            .join(full_sets, "f"))

    def compare(group: pa.Table) -> pa.Table:
        f, comp = group["f"].to_numpy(), group["comp"].to_numpy()
        parts = [np.frombuffer(x.as_buffer(), U) for x in group["s"]]
        n = np.array([len(x) for x in parts])
        values, back, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(parts)), n)
        column = np.cumsum(times > 1) - 1
        common = times[back] > 1  # a shingle of one set only overlaps with nothing
        both = np.zeros((len(parts), len(parts)), np.float32)
        for at in range(0, int((times > 1).sum()), 8192):
            use = common & (column[back] >= at) & (column[back] < at + 8192)
            x = np.zeros((len(parts), 8192), np.float32)
            x[owner[use], column[back][use] - at] = 1
            both += x @ x.T
        linked = (100 * both >= percent * (n[:, None] + n[None] - both)) & (comp[:, None] < comp[None])
        a, b = np.nonzero(linked)
        keep = np.unique(np.stack([a, comp[b]]), axis=1, return_index=True)[1] if len(a) else a
        a, b = f[a[keep]], f[b[keep]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return rows.groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()


def links(classes: DataFrame, sketches: DataFrame, docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame | None:
    """Verified links between classes that suffice for the components; None without any."""
    rows = _bands(sketches, classes)  # one shuffle; a join with the sizes takes a second
    members = stage(rows.withColumn("size", F.count("*").over(Window.partitionBy("key"))).filter("size > 1"), "near-members")
    weight = members.groupBy("f").agg(F.sum("size").alias("weight"))
    members = members.drop("size").join(weight, "f").withColumn("comp", F.col("f"))
    tested = found = comp = None
    for turn in range(STAR_ROUNDS + 1):
        if comp is not None:
            old = members.drop("comp")
            members = old.join(comp.withColumnRenamed("node", "f"), "f", "left") \
                         .withColumn("comp", F.coalesce("comp", "f"))
        rank = F.col("weight") if turn < 2 else F.xxhash64("key", "f", F.lit(turn))
        hubs = (members.groupBy("key").agg(F.max(F.struct(rank.alias("rank"), "f", "comp")).alias("hub"),
                                           F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                .filter("lo < hi").select("key", F.col("hub.rank").alias("rank"), F.col("hub.f").alias("hub"),
                                          F.col("hub.comp").alias("hub_comp")))
        open_rows = stage(members.join(hubs, "key"), "near-open")
        members = open_rows.drop("rank", "hub", "hub_comp")
        if open_rows.isEmpty():
            break
        if turn < STAR_ROUNDS:
            pairs = open_rows.filter("comp <> hub_comp").select("f", "hub", "rank")
            if turn == 0:  # one hub a member, the heaviest of all its buckets: a large group mostly links by these
                pairs = pairs.groupBy("f").agg(F.max(F.struct("rank", "hub")).alias("best")).select("f", F.col("best.hub").alias("hub"))
            pairs = pairs.select(F.least("f", "hub").alias("a"), F.greatest("f", "hub").alias("b")).distinct()
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = stage(pairs, "near-pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
            likely = stage(_estimated(pairs, sketches, percent), "near-likely")
            good = _verified(likely, _full_sets(_nodes(likely), classes, docs, key, text, k), percent)
        else:
            left = members.select("key", "f", "comp")
            good = _block_links(left, _full_sets(left.select("f").distinct(), classes, docs, key, text, k), percent)
        good = stage(good, "near-links")
        if not good.isEmpty():
            found = good if found is None else found.unionByName(good)
            comp = components(found)
    return comp


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """One row a row: ``doc_id, n_shingles`` (distinct k-word shingles, A-Z lower-cased),
    ``component_id`` (smallest id linked, over any number of steps, itself included),
    ``kept`` (doc_id = component_id).

    Texts of fewer than k words have one shingle, their whole sequence; null and
    blank texts have none and link with nothing. A row without an id links with
    nothing, has no component and is kept. Rows that repeat an id with one text
    give equal rows. An empty table gives no rows.
    """
    s = stage(sketch(docs, key, text, k), "near-sketch")
    named = s.filter(F.col("f").isNotNull() & F.col("doc_id").isNotNull())
    classes = stage(named.groupBy("f").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), "near-classes")
    comp = links(classes, named, docs, key, text, k, percent)
    named_class = classes.select("f", "first")
    if comp is None:
        label = named_class.withColumnRenamed("first", "component_id")
    else:
        node = named_class.join(comp.withColumnRenamed("node", "f"), "f", "left").withColumn("comp", F.coalesce("comp", "f"))
        low = node.groupBy("comp").agg(F.min("first").alias("component_id"))
        label = node.join(low, "comp").select("f", "component_id")
    label = stage(label, "near-labels")
    out = s.select("doc_id", F.col("n").alias("n_shingles"), "f").join(label, "f", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    out = out.withColumn("component_id", own)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id
    (repeated rows of one id and text stay once; rows without an id all stay)."""
    near = near_duplicates(docs, key, text, **options).filter("doc_id is not null")
    ids = stage(near.groupBy(F.col("doc_id").alias(P + "k")).agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "near-ids")
    some = maybe_in(ids.filter("not kept or rows > 1").select(P + "k"))(F.col(key))
    rest = docs.filter(F.col(key).isNotNull() & some)
    rest = rest.join(ids.filter("kept").select(P + "k"), F.col(key) == F.col(P + "k"), "left_semi")
    rest = rest.withColumn(P + "h", F.xxhash64(text)).dropDuplicates([key, P + "h"]).drop(P + "h")
    return rest.unionByName(docs.filter(F.col(key).isNull() | ~some))  # those occur once and stay
