"""Similarity self-join of texts on their word n-grams by rare-first prefix filtering.

A text's set holds its distinct k-word n-grams as 64-bit hashes; texts with equal
sets form a class, and only classes are joined. With a threshold of P percent:

* **Order.** All n-grams have one fixed order, rarest first. Frequencies come from
  two rows of counters (count-min), added up on the executors; an estimate is never
  below the truth and only decides how rare the prefixes are, not what is found.
* **Prefix filter.** Of n n-grams the first n - ceil(P n / 100) + 1 are the prefix:
  two sets that link share an n-gram of both prefixes. Classes are joined on them.
* **Length filter.** 100 * smaller >= P * larger.
* **Positional filter.** If two sets' first common n-gram stands at i and j, the
  overlap is at most min(n - i, m - j); a pair is tested where its first common
  n-gram is, so a pair refused at a later one isn't lost.
* **Suffix filter.** The n-grams of a set are dealt to ``PARTS`` parts by hash; the
  differences of the parts' sizes bound the sets' difference from below.
* **Verification** of the distinct pairs left, once each, on their full sets.

An n-gram in more than ``HOT`` prefixes isn't expanded into pairs. Its hub (the class
that stands in most of such groups) is verified with the other members, and groups
within one component are done. Groups that span several components after
``HUB_ROUNDS`` are tested in blocks of bounded size, where only pairs of different
components that pass all filters come out. The number of links of a class is counted
inside its component, in blocks of bounded bytes: links are counted there, not listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import P, ship, stage
from .graph import components
from .textvec import U, mix, pieces, shingles, words

SHINGLE, PERCENT = 5, 80
CELL_BITS, ROWS = 20, 2  # counters: 2 rows of 2^20, 8 MB in all, whatever the input
SLICES = 64
PARTS = 256
HOT = 64  # members of a prefix n-gram that are expanded into pairs
HOT_ROWS = 1 << 20  # n-grams estimated beyond this skip the grouping in one task
HUB_ROUNDS = 2
BLOCK = 512  # classes of a block; a task compares two blocks at most
BLOCK_BYTES = 32 << 20  # bytes of full sets of a block
BROADCAST_ROWS = 500_000  # (id, fingerprint) rows sent to every task; beyond that a shuffle join
GROUP = "token long, f long, n int, pos int"


def sets(arr: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, their bounds, and each set's fingerprint."""
    h, at = shingles(*words(arr), k)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    at = np.searchsorted(doc, np.arange(len(at)))
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(h ^ U(0x2545F4914F6CDD1D)))])
    return h, at, mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(U)).view(np.int64)


def cells(h: np.ndarray) -> list[np.ndarray]:
    """The counter of each hash in every row of counters."""
    return [(mix(h + U(r * 0x9E37 + 1)) >> U(64 - CELL_BITS)).astype(np.int64) for r in range(ROWS)]


def part_sizes(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts x PARTS) sizes of the parts, cut at 255 (which keeps their differences lower bounds)."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    flat = np.bincount(doc * PARTS + (h & U(PARTS - 1)).astype(np.int64), minlength=(len(at) - 1) * PARTS)
    return np.minimum(flat, 255).astype(np.uint8).reshape(len(at) - 1, PARTS)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Length of the prefix; 0 for sets so small that only an equal set can link."""
    alone = 100 * n < percent * (n + 1)  # one n-gram more or less is already too much
    return np.where(alone, 0, n - (percent * n + 99) // 100 + 1)


def fits(n, m, i, j, percent: int):
    """Length and positional filter of two sets of n and m that meet at positions i and j."""
    most = np.minimum(n - i, m - j)
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * most >= percent * (n + m))


def parts_fit(x: np.ndarray, y: np.ndarray, n, m, percent: int) -> np.ndarray:
    """Suffix filter: the part sizes' differences must not exceed what linked sets may differ by."""
    apart = np.abs(x.astype(np.int16) - y).sum(1, dtype=np.int64)
    return (100 + percent) * apart <= (100 - percent) * (n + m)


def _scan(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """A row a document: ``doc_id, n, f`` (null for an empty set), ``parts``; then a task's
    counters in slices (``slice, counts``). A task counts a set once."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    names = ["doc_id", "n", "f", "parts", "slice", "counts"]

    def run(batches):
        counts, seen, id_type = np.zeros((ROWS, 1 << CELL_BITS), np.uint32), set(), None
        for whole in batches:
            id_type = whole.column(0).type
            for b in pieces(whole, 1):
                h, at, f = sets(b.column(1), k)
                n = np.diff(at)
                parts = part_sizes(h, at)
                fresh = np.zeros(len(n), bool)
                for i, value in enumerate(f.tolist()):
                    if n[i] and value not in seen:
                        seen.add(value)
                        fresh[i] = True
                for row, cell in enumerate(cells(h[np.repeat(fresh, n)])):
                    counts[row] += np.bincount(cell, minlength=1 << CELL_BITS).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(f, mask=n == 0),
                     pa.array([p.tobytes() if c else None for p, c in zip(parts, n)], pa.binary()),
                     pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names)
        if seen:
            cut = counts.reshape(SLICES, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SLICES, id_type), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()),
                 pa.nulls(SLICES, pa.binary()), pa.array(range(SLICES), pa.int32()),
                 pa.array([c.tobytes() for c in cut], pa.binary())], names)

    d = ship(docs).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(run, f"doc_id {kind}, n long, f long, parts binary, slice int, counts binary")


def _frequencies(scan: DataFrame) -> np.ndarray:
    """The tasks' counters added up on the executors, slice by slice; ROWS x 2^CELL_BITS."""
    def add(group: pa.Table) -> pa.Table:
        total = np.zeros((ROWS << CELL_BITS) // SLICES, np.uint64)
        for c in group["counts"]:
            total += np.frombuffer(c.as_buffer(), np.uint32)
        total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.table({"slice": group["slice"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    rows = scan.filter("slice is not null").select("slice", "counts")
    some = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(16)))
    sums = some.groupBy("slice", "salt").applyInArrow(add, "slice int, counts binary")
    sums = sums.groupBy("slice").applyInArrow(add, "slice int, counts binary")
    out = np.zeros((SLICES, (ROWS << CELL_BITS) // SLICES), np.uint32)
    for r in sums.collect():  # SLICES rows, 8 MB
        out[r["slice"]] = np.frombuffer(r["counts"], np.uint32)
    return out.reshape(ROWS, -1)


def _prefixes(docs: DataFrame, key: str, text: str, k: int, percent: int, counts: np.ndarray) -> DataFrame:
    """``token, f, n, pos, heavy``: the prefixes; a task gives a class once."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        table, seen = shared.value, set()
        for whole in batches:
            for b in pieces(whole.filter(whole.column(0).is_valid()), 1):
                h, at, f = sets(b.column(1), k)
                n = np.diff(at)
                length = prefix_length(n, percent)
                for i, value in enumerate(f.tolist()):
                    if value in seen:
                        length[i] = 0
                    seen.add(value)
                use = np.repeat(length > 0, n)
                h, doc = h[use], np.repeat(np.arange(len(n)), n)[use]
                often = np.minimum(*(table[row][cell] for row, cell in enumerate(cells(h))))
                order = np.lexsort((h, often, doc))
                h, doc, often = h[order], doc[order], often[order]
                pos = np.arange(len(h)) - np.searchsorted(doc, doc)
                keep = (pos < length[doc]) & (often > 1)  # counted once: in no other class
                h, doc, often, pos = h[keep], doc[keep], often[keep], pos[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(f[doc]), pa.array(n[doc].astype(np.int32)),
                     pa.array(pos.astype(np.int32)), pa.array(often > HOT_ROWS)], ["token", "f", "n", "pos", "heavy"])

    d = ship(docs).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(run, GROUP + ", heavy boolean")


def _meet(prefixes: DataFrame, percent: int) -> DataFrame:
    """Rows sorted by token -> candidate pairs ``a, b`` of the groups of up to HOT members
    (``token`` null) and the members of larger groups (``token, a, n, pos``)."""
    names = ["token", "a", "b", "n", "pos"]

    def pairs(token, f, n, pos):
        for step in range(1, HOT):
            i = np.flatnonzero(token[step:] == token[:-step]) if step < len(token) else []
            if not len(i):
                return
            i = i[fits(n[i], n[i + step], pos[i], pos[i + step], percent)]
            if len(i):
                a, b = f[i], f[i + step]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(i), pa.int64()), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)),
                     pa.nulls(len(i), pa.int32()), pa.nulls(len(i), pa.int32())], names)

    def hot(token, f, n, pos):
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(f), pa.nulls(len(f), pa.int64()), pa.array(n),
                                           pa.array(pos)], names)

    def run(batches):
        rest, large = None, None  # rows of the last token so far; the token known to be large
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy() for c in b.columns]
            if rest is not None:
                cols = [np.concatenate(p) for p in zip(rest, cols)]
            new = np.ones(len(cols[0]), bool)  # equal rows come from copies in several tasks
            new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
            token, f, n, pos = cols = [c[new] for c in cols]
            last = int(np.searchsorted(token, token[-1]))
            yield from flush([c[:last] for c in cols], large, pairs, hot)
            rest = [c[last:] for c in cols]
            if len(rest[0]) > HOT:  # the last row stays, to know a repeated one
                large = token[-1]
                yield hot(*(c[:-1] for c in rest))
                rest = [c[-1:] for c in rest]
        if rest is not None:
            yield from flush(rest, large, pairs, hot)

    def flush(cols, large, pairs, hot):
        if len(cols[0]):
            _, back, size = np.unique(cols[0], return_inverse=True, return_counts=True)
            many = (size[back] > HOT) | (cols[0] == large if large is not None else False)
            if many.any():
                yield hot(*(c[many] for c in cols))
            yield from pairs(*(c[~many] for c in cols))

    light = prefixes.filter(~F.col("heavy")).drop("heavy").repartition("token").sortWithinPartitions("token", "f")
    heavy = prefixes.filter("heavy").select("token", F.col("f").alias("a"), F.lit(None).cast("long").alias("b"), "n", "pos")
    return light.mapInArrow(run, "token long, a long, b long, n int, pos int").unionByName(heavy)


def _parts_filtered(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                p = b.slice(i, 4096)
                x, y = (np.frombuffer(b"".join(p.column(c).to_pylist()), np.uint8).reshape(-1, PARTS) for c in (3, 5))
                n, m = p.column(2).to_numpy(), p.column(4).to_numpy()
                good = fits(n, m, 0, 0, percent) & parts_fit(x, y, n, m, percent)
                yield pa.RecordBatch.from_arrays([p.column(0), p.column(1)], ["a", "b"]).filter(pa.array(good))

    x = classes.select(F.col("f").alias("a"), F.col("n").alias("na"), F.col("parts").alias("pa"))
    y = classes.select(F.col("f").alias("b"), F.col("n").alias("nb"), F.col("parts").alias("pb"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "na", "pa", "nb", "pb").mapInArrow(run, "a long, b long")


def _full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """``f, s``: the full sets of the classes in ``nodes.f``, made again from a text of each, staged.
    Of an id with several texts the one with the class's own set is taken."""
    need = stage(classes.join(nodes, "f").select(F.col("first").alias(P + "first"), F.col("f").alias(P + "f")), "join-need")
    if need.count() <= BROADCAST_ROWS:
        need = F.broadcast(need)

    def full(batches):
        for whole in batches:
            for b in pieces(whole, 1):
                h, at, f = sets(b.column(1), k)
                own = pa.array(f == b.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([h[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())], ["f", "s"]).filter(own)

    texts = (docs.select(F.col(key).alias(P + "k"), F.col(text).alias(P + "t"))
             .join(need, F.col(P + "k") == F.col(P + "first")).select(P + "f", P + "t"))
    return stage(texts.mapInArrow(full, "f long, s binary").dropDuplicates(["f"]), "join-sets")


def _verified(pairs: DataFrame, full_sets: DataFrame, percent: int) -> DataFrame:
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


def _block_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of members (token, f, n, pos, comp) of one token and different components that
    pass all filters, found block by block."""
    sizes = members.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = (members.join(sizes, "token").withColumn("i", F.pmod(F.xxhash64("f"), F.col("blocks")).cast("int"))
            .withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("token", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "f", "n", "pos", "comp")
            .join(classes.select("f", "parts"), "f"))

    def compare(group: pa.Table) -> pa.Table:
        f, n, pos, comp = (group[c].to_numpy() for c in ("f", "n", "pos", "comp"))
        parts = np.frombuffer(b"".join(group["parts"].to_pylist()), np.uint8).reshape(-1, PARTS)
        a, b = [], []
        for i in range(len(f)):
            j = np.flatnonzero((comp > comp[i]) & fits(n[i], n, pos[i], pos, percent))
            j = j[parts_fit(parts[i][None], parts[j], n[i], n[j], percent)]
            a.append(np.full(len(j), f[i]))
            b.append(f[j])
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return rows.groupBy("token", "lo", "hi").applyInArrow(compare, "a long, b long").distinct()


def _links(classes, docs, key, text, k, percent, met) -> DataFrame | None:
    """``node, comp``: components of the linked classes; None without a link."""
    found = comp = None

    def test(pairs, name):
        nonlocal found, comp
        likely = stage(_parts_filtered(pairs, classes, percent), f"join-{name}")
        nodes = likely.select(F.explode(F.array("a", "b")).alias("f")).distinct()
        good = stage(_verified(likely, _full_sets(nodes, classes, docs, key, text, k), percent), f"join-{name}-links")
        if not good.isEmpty():
            found = good if found is None else found.unionByName(good)
            comp = components(found)

    test(met.filter("token is null").select("a", "b").distinct(), "pairs")
    members = met.filter("token is not null").select("token", F.col("a").alias("f"), "n", "pos").distinct()
    for turn in range(HUB_ROUNDS + 1):
        if comp is None:
            members = members.withColumn("comp", F.col("f"))
        else:
            members = (members.drop("comp").join(comp.withColumnRenamed("node", "f"), "f", "left")
                       .withColumn("comp", F.coalesce("comp", "f")))
        weight = members.groupBy("f").agg(F.count("*").alias("weight"))
        rank = F.col("weight") if turn == 0 else F.xxhash64("token", "f", F.lit(turn))
        hubs = (members.join(weight, "f").groupBy("token")
                .agg(F.max(F.struct(rank.alias("rank"), "f", "comp")).alias("hub"), F.min("comp").alias("lo"),
                     F.max("comp").alias("hi"))
                .filter("lo < hi").select("token", F.col("hub.f").alias("hub"), F.col("hub.comp").alias("hub_comp")))
        open_rows = stage(members.join(hubs, "token"), "join-open")
        members = open_rows.drop("hub", "hub_comp")
        if open_rows.isEmpty():
            break
        if turn < HUB_ROUNDS:
            test(open_rows.filter("comp <> hub_comp")
                 .select(F.least("f", "hub").alias("a"), F.greatest("f", "hub").alias("b")).distinct(), f"hub-{turn}")
        else:
            test(_block_pairs(members, classes, percent), "blocks")
    return comp


def _link_counts(classes: DataFrame, comp: DataFrame, docs: DataFrame, key: str, text: str, k: int,
                 percent: int) -> DataFrame:
    """``f, linked``: documents of other classes that link with a class, counted inside its
    component. Two classes of a component of two are linked; larger ones are compared in blocks."""
    named = comp.withColumnRenamed("node", "f").join(classes.select("f", "n", "copies"), "f")
    size = named.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("all_n"), F.sum("copies").alias("all_copies"))
    named = stage(named.join(size, "comp"), "join-comp")
    two = named.filter("m = 2").select("f", (F.col("all_copies") - F.col("copies")).alias("linked"))
    many = named.filter("m > 2")
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("all_n") * 8 / BLOCK_BYTES)).cast("int")
    rows = (many.withColumn("blocks", blocks).withColumn("i", F.pmod(F.xxhash64("f"), F.col("blocks")).cast("int"))
            .withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("comp", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "f", "copies")
            .join(_full_sets(many.select("f"), classes, docs, key, text, k), "f"))

    def count(group: pa.Table) -> pa.Table:
        f, copies, side = (group[c].to_numpy() for c in ("f", "copies", "i"))
        inner = group["lo"][0].as_py() == group["hi"][0].as_py()
        held = [np.frombuffer(x.as_buffer(), U) for x in group["s"]]
        n = np.array([len(x) for x in held])
        _, back, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        owner, column = np.repeat(np.arange(len(held)), n), np.cumsum(times > 1) - 1
        common = times[back] > 1
        both = np.zeros((len(held), len(held)), np.float32)
        for at in range(0, int((times > 1).sum()), 8192):
            use = common & (column[back] >= at) & (column[back] < at + 8192)
            x = np.zeros((len(held), 8192), np.float32)
            x[owner[use], column[back][use] - at] = 1
            both += x @ x.T
        linked = 100 * both >= percent * (n[:, None] + n[None] - both)
        linked &= ~np.eye(len(f), dtype=bool) if inner else side[:, None] != side[None]
        return pa.table({"f": f, "linked": (linked * copies[None]).sum(1)})

    counted = rows.groupBy("comp", "lo", "hi").applyInArrow(count, "f long, linked long")
    return two.unionByName(counted.groupBy("f").agg(F.sum("linked").alias("linked")))


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE,
               percent: int = PERCENT) -> DataFrame:
    """One row a row of ``docs``: ``doc_id, n_shingles`` (distinct k-word n-grams, A-Z
    lower-cased), ``component_id`` (smallest id reachable by links, itself included),
    ``n_links`` (other rows that it links with directly, copies included).

    Texts of fewer than k words have one n-gram, their whole sequence; null and blank
    texts have none and link with nothing. A row without an id links with nothing, has
    no component and 0 links. Rows that repeat an id are rows of their own, which count
    as links of each other where their texts link; an id whose rows link differently
    takes its own text's component in each row. An empty table gives no rows. Other
    columns of ``docs``, whatever their names, are not looked at.
    """
    scan = stage(_scan(docs, key, text, k), "join-scan")
    s = scan.filter("slice is null").select("doc_id", "n", "f", "parts")
    named = s.filter(F.col("f").isNotNull() & F.col("doc_id").isNotNull())
    classes = stage(named.groupBy("f").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"),
                                           F.max("n").alias("n"), F.any_value("parts").alias("parts")), "join-classes")
    met = stage(_meet(_prefixes(docs, key, text, k, percent, _frequencies(scan)), percent), "join-met")
    comp = _links(classes, docs, key, text, k, percent, met)
    label = classes.select("f", "first", "copies")
    if comp is None:
        label = label.select("f", F.col("first").alias("component_id"), (F.col("copies") - 1).alias("n_links"))
    else:
        linked = _link_counts(classes, comp, docs, key, text, k, percent)
        node = label.join(comp.withColumnRenamed("node", "f"), "f", "left").withColumn("comp", F.coalesce("comp", "f"))
        low = node.groupBy("comp").agg(F.min("first").alias("component_id"))
        label = node.join(low, "comp").join(linked, "f", "left").select(
            "f", "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = s.select("doc_id", F.col("n").alias("n_shingles"), "f").join(stage(label, "join-labels"), "f", "left")
    absent = F.col("doc_id").isNull()
    return out.select("doc_id", "n_shingles",
                      F.when(~absent, F.coalesce("component_id", "doc_id")).alias("component_id"),
                      F.when(absent, F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"))
