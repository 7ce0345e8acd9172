"""Mixing sources to target weights along a time-varying curriculum.

Targets: each source's share of the total size follows its weight; a target
stops at ``max_repeats`` times its source and the excess is shared again by
weight (water filling, in one pass over the per-source table). Whole documents
are taken, in hash order, as often as the target needs.

Positions: a source's demand per unit of training time is its target times a
piecewise linear schedule with integral 1. Its cumulative demand is therefore
known in closed form, and the training position of a document occurrence is
the time at which the cumulative demand reaches the tokens before it. Documents
are range-sorted by position.

All of it is DataFrame expressions. Prefix sums over a source (which may hold a
third of all rows) run over hash cells first, then inside a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import P, n_words, stage

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
# Weight over training time for each entry of WEIGHTS: (time, weight) knots.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
CELLS = 1024


def position(x: Column, schedule) -> Column:
    """Time in [0, 1] at which the schedule's integral reaches ``x`` of its total."""
    area = sum((t1 - t0) * (v0 + v1) / 2 for (t0, v0), (t1, v1) in zip(schedule, schedule[1:]))
    done, out = 0.0, None
    for (t0, v0), (t1, v1) in zip(schedule, schedule[1:]):
        part = (t1 - t0) * (v0 + v1) / 2 / area
        v, slope = v0 / area, (v1 - v0) / (t1 - t0) / area
        need = F.greatest(x - F.lit(done), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(v * v) + F.lit(2 * slope) * need, F.lit(0.0)))
        at = F.least(F.lit(t0) + F.when(need > 0, 2 * need / (F.lit(v) + root)).otherwise(0.0), F.lit(t1))
        done += part
        out = F.when(x < done, at) if out is None else out.when(x < done, at)
    return out.otherwise(F.lit(float(schedule[-1][0])))


def source_targets(sources: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size`` (one row a source) -> the same with ``weight``,
    ``class`` (index of the weight) and ``target``.

    With sources ordered by cap/weight, the capped ones are a prefix; the first
    source whose cap is not under its share of what is left ends it.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("class") + 1)
    s = (sources.withColumn("class", ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
         .withColumn("weight", w).withColumn("cap", (F.col("source_size") * max_repeats).cast("double")))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumns({
        "left": F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    s = s.withColumn("level", F.when(F.col("cap") / F.col("weight") >= F.col("left") / F.col("open"),
                                     F.col("left") / F.col("open")))
    s = s.withColumn("level", F.max("level").over(whole))  # falls from there on
    return s.withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))) \
            .select("source", "source_size", "weight", "class", "target")


def mix_plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
             weights=WEIGHTS, schedules=SCHEDULES, max_repeats: int = MAX_REPEATS,
             cells: int = CELLS) -> DataFrame:
    """One row a row of ``docs``: ``doc_id, source, size, source_size, target,
    passes`` (how often it is taken), ``taken`` (size x passes) and
    ``positions`` (training position of each pass).

    Null text has size 0; a null source is a source of its own, ordered last.
    Rows sharing (source, key) are taken together, so repeated rows and null
    keys need no order among themselves. Documents of size 0 are taken once if
    their source's place in the order is reached. An empty table gives no rows.
    """
    sized = stage(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"),
                              n_words(F.col(text)).alias("size")), "mix-sizes")
    targets = stage(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                                   weights, max_repeats), "mix-targets")
    units = (sized.groupBy("source", "doc_id").agg(F.sum("size").alias("unit"))
             .withColumn("h", F.xxhash64(F.lit("mix"), F.col("doc_id").cast("string")))
             .withColumn("cell", F.pmod("h", F.lit(cells)).cast("int")))
    units = stage(units, "mix-units")
    cell_sums = units.groupBy("source", "cell").agg(F.sum("unit").alias("cell_size"))
    ahead = F.sum("cell_size").over(W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1))
    cell_sums = cell_sums.select("source", "cell", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    offset = F.sum("unit").over(W.partitionBy("source", "cell").orderBy("h", "doc_id")
                                .rowsBetween(W.unboundedPreceding, -1))
    units = units.withColumn("offset", F.coalesce(offset, F.lit(0)))
    c, t = cell_sums.alias("c"), targets.alias("t")
    units = (units.alias("u").join(c, F.col("u.source").eqNullSafe(F.col("c.source")) & (F.col("u.cell") == F.col("c.cell")))
             .join(t, F.col("u.source").eqNullSafe(F.col("t.source")))
             .select("u.source", "u.doc_id", "u.unit", (F.col("c.ahead") + F.col("u.offset")).alias("offset"),
                     "t.source_size", "t.target", "t.class"))
    full = F.least(F.lit(max_repeats), F.floor(F.col("target") / F.col("source_size"))).cast("int")
    full = F.when(F.col("source_size") > 0, full).otherwise(0)
    units = units.withColumn("full", full)
    rest = F.col("target") - F.col("full") * F.col("source_size")
    extra = (F.col("full") < max_repeats) & (F.col("offset") + F.col("unit") / 2 < rest)
    units = units.withColumn("passes", F.col("full") + extra.cast("int"))

    def when(p: Column) -> Column:
        x = (p * F.col("source_size") + F.col("offset")) / F.greatest(F.col("target"), F.lit(1e-9))
        out = position(x, schedules[0])
        for i, s in enumerate(schedules[1:], 1):
            out = F.when(F.col("class") == i, position(x, s)).otherwise(out)
        return out

    passes = [F.when(F.col("passes") > i, when(F.lit(i))) for i in range(max_repeats)]
    units = units.withColumn("positions", F.array_compact(F.array(*passes)))
    u, d = units.alias("u"), sized.alias("d")
    return (d.join(u, F.col("d.source").eqNullSafe(F.col("u.source")) & F.col("d.doc_id").eqNullSafe(F.col("u.doc_id")))
            .select("d.doc_id", "d.source", "d.size", "u.source_size", "u.target", "u.passes",
                    (F.col("d.size") * F.col("u.passes")).alias("taken"), "u.positions"))


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                  **options) -> DataFrame:
    """The mixed stream: every taken occurrence of every row of ``docs``, with all
    its columns, range-sorted by training position. Rows not taken are absent,
    rows taken twice or three times occur as often (see ``mix_plan``)."""
    plan = (mix_plan(docs, key, text, source, **options).filter("passes > 0")
            .select(F.col("doc_id").alias(P + "k"), F.col("source").alias(P + "s"), F.col("positions").alias(P + "p"))
            .dropDuplicates([P + "k", P + "s"]))
    rows = docs.join(plan, docs[key].eqNullSafe(F.col(P + "k")) & docs[source].eqNullSafe(F.col(P + "s")))
    return (rows.withColumn(P + "at", F.explode(P + "p"))
            .orderBy(P + "at", P + "k").select(*[docs[f"`{c}`"] for c in docs.columns]))
