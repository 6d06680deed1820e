"""Mixing sources to target weights by capped water-filling.

The target of a source is ``min(cap, weight * level)`` with cap = ``max_epochs``
times its size: a source over its cap is clamped and its excess goes to the
others by weight, until none is above.  The rounds need only the water level,
so each is one aggregate over the per-source sums; no list of sources reaches
the driver.  Each source then repeats every document ``floor(target / size)``
times and takes the fractional rest as a seeded sample: documents are ordered by
a hash of (seed, id), and taken as long as they fit into what is missing; up to
``TOP_UPS`` more, each the nearest to what is still missing, make up the remainder.

The point is found in steps, so that a source or an id holding most rows never meets
in one task: sums per (source, hash bucket) and a running sum over those buckets; in
the bucket that holds the point, counts per kind of row (equal source, id and size) and
a running sum over the kinds; of the kind that is taken in part, counts per partition
of the input, and an order of the rows of one partition.  What comes back to the
documents is one row per source, so texts are never shuffled.

Defined results
* null text: size 0; a null source is a source (ordered last); documents of
  size 0 are in the result with 0 taken words;
* repeated and null ids and equal rows are separate documents, k of m alike are taken; ties
  of the hash are ordered by id, size, then place in the input (its partitions and rows in
  them should come again when it is read again, as those of files do);
* an empty table gives no rows; a source without words has target 0;
* other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, free_prefix, table, word_count

#: Rows of a per-source table up to which it is broadcast (about 100 bytes a row).
BROADCAST_SOURCES = 50_000
#: Hash buckets of one source in the search for its fractional cut.
BUCKETS = 4096
#: Documents that may fill what a source's sample leaves open.
TOP_UPS = 3


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a per-source table of a counted size; beyond it, joins shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def source_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Give the distinct ``source`` rows the weights in turn, by code point, null last.

    Positions come from counts per range of the order, not from one sorted list:
    the window runs inside a range and over one row per range.
    """
    ranges = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn(
        "_r", F.spark_partition_id())
    ranges = cut(ranges, "mix-sources")
    per = ranges.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_r").orderBy(F.col("source").asc_nulls_last())
    at = F.row_number().over(inside) - 1 + F.col("_off")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(at, F.lit(len(weights))) + 1).cast("int"))
    return ranges.join(offsets, "_r").select("source", "source_size", turn.alias("weight"))


def water_fill(sources: DataFrame, max_epochs: float, total: float | None = None) -> DataFrame:
    """Add ``target`` to (source, source_size, weight): the capped shares of ``total``.

    ``total`` defaults to the sum of all sizes.  If even all caps together stay
    below it, every source gets its cap.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    if total is None:
        total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        clamped = cap <= F.col("weight") * F.lit(level)
        fixed, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0.0))).first()
        if not open_weight:
            break
        rise = (total - fixed) / open_weight
        if rise <= level:
            break
        level = rise
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def mix_plan(sized: DataFrame, weights: Sequence[float], max_epochs: float) -> tuple[DataFrame, int]:
    """One row per source: source_size, target, whole repetitions, and up to which
    (hash, id, size, row) its documents get one more; and the number of sources.

    ``sized`` has doc_id, source, size, u, rid.
    """
    bucketed = sized.withColumn("_b", F.pmod("u", F.lit(BUCKETS)))
    buckets = cut(bucketed.groupBy("source", "_b").agg(F.sum("size").alias("_sum")), "mix-buckets")
    per_source = buckets.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    weighed = cut(source_weights(per_source, weights), "mix-weights")
    n = weighed.count()
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(epochs)
    plan = cut(water_fill(weighed, max_epochs).select(
        F.col("source").alias("_s"), "source_size", "target", whole.alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("_rest")), "mix-plan")
    same = F.col("source").eqNullSafe(F.col("_s"))

    # The bucket in which the running sum passes the rest.
    upto = Window.partitionBy("source").orderBy("_b")
    run = buckets.withColumn("_end", F.sum("_sum").over(upto)).withColumn("_base", F.col("_end") - F.col("_sum"))
    edge = cut(run.join(_small(plan, n), same).where((F.col("_base") <= F.col("_rest")) & (
        F.col("_end") > F.col("_rest"))).select("_s", "_rest", "_base", F.col("_b").alias("_edge")), "mix-edges")
    # Inside it rows are taken as long as all of them fit: whole kinds of rows, then k of one kind.
    kinds = bucketed.join(_small(edge, n), same & (F.col("_b") == F.col("_edge"))).groupBy(
        "source", "_rest", "_base", "u", "doc_id", "size").agg((F.count(F.lit(1)) * F.col("size")).alias("_words"))
    order = Window.partitionBy("source").orderBy("u", "doc_id", "size")
    kinds = kinds.withColumn("_after", F.col("_base") + F.sum("_words").over(order))
    first = kinds.where(F.col("_after") > F.col("_rest")).groupBy("source").agg(F.min(F.struct(
        "u", "doc_id", "size", (F.col("_after") - F.col("_words")).alias("before"), "_rest")).alias("f"))
    part = cut(first.select(
        F.col("source").alias("_s"), *[F.col(f"f.{c}").alias(f"_{c}") for c in ("u", "doc_id", "size", "before")],
        F.floor((F.col("f._rest") - F.col("f.before")) / F.col("f.size")).alias("_k")), "mix-part")
    # The k-th row of that kind: in which partition of the input, and which of its rows.
    alike = sized.join(_small(part, n), same & F.col("u").eqNullSafe(F.col("_u")) & F.col("doc_id").eqNullSafe(
        F.col("_doc_id")) & (F.col("size") == F.col("_size"))).select("_s", "_k", F.shiftright("rid", 33).alias("_p"), "rid")
    alike = cut(alike, "mix-alike")
    per = alike.groupBy("_s", "_k", "_p").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_upto", F.sum("_n").over(Window.partitionBy("_s").orderBy("_p")))
    here = per.where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_n") < F.col("_k"))).select(
        F.col("_s").alias("_h"), F.col("_p").alias("_hp"), (F.col("_k") - F.col("_upto") + F.col("_n")).alias("_nth"))
    nth = alike.join(_small(here, n), F.col("_s").eqNullSafe(F.col("_h")) & (F.col("_p") == F.col("_hp"))).withColumn(
        "_at", F.row_number().over(Window.partitionBy("_s").orderBy("rid"))).where(F.col("_at") == F.col("_nth")).select(
        F.col("_s").alias("_n"), "rid")
    last = part.join(nth, F.col("_s").eqNullSafe(F.col("_n")), "left").select(
        "_s", F.struct(F.col("_u").alias("u"), F.col("_doc_id").alias("doc_id"), F.col("_size").alias("size"),
                       F.coalesce("rid", F.lit(-1)).cast("bigint").alias("rid")).alias("last"),
        (F.col("_before") + F.col("_k") * F.col("_size")).alias("_used"))
    plan = plan.join(edge.select(F.col("_s").alias("_e"), "_edge", "_base"), F.col("_s").eqNullSafe(F.col("_e")),
                     "left").join(last.withColumnRenamed("_s", "_l"), F.col("_s").eqNullSafe(F.col("_l")), "left")
    none = F.array().cast("array<bigint>")
    plan = cut(plan.select("_s", "source_size", "target", "whole", F.col("_edge").alias("edge"), "last",
                           none.alias("extra"), (F.col("_rest") - F.coalesce("_used", "_base", "_rest")).alias("gap")),
               "mix-plan")
    # What is missing then is filled by the documents that come nearest to it.
    for _ in range(TOP_UPS):
        off = F.abs(F.col("gap") - F.col("size"))
        open_docs = sized.join(_small(plan, n), same).where(
            (F.col("size") > 0) & (off < F.col("gap")) & ~_sampled("u", "doc_id", "size", "rid", ""))
        best = open_docs.groupBy("_s").agg(F.min(F.struct(off.alias("off"), "size", "u", "doc_id", "rid")).alias("_best"))
        one = F.array("_best.rid")
        plan = plan.join(best.withColumnRenamed("_s", "_l"), F.col("_s").eqNullSafe(F.col("_l")), "left").select(
            "_s", "source_size", "target", "whole", "edge", "last",
            F.when(F.col("_best").isNull(), F.col("extra")).otherwise(F.concat("extra", one)).alias("extra"),
            (F.col("gap") - F.coalesce("_best.size", F.lit(0))).alias("gap"))
        plan = cut(plan, "mix-plan")
    return plan, n


def _sampled(u: str, doc_id: str, size: str, rid: str, prefix: str) -> Column:
    """Is the document in its source's fractional sample?  Plan columns are behind ``prefix``."""
    edge, last, extra = (F.col(prefix + c) for c in ("edge", "last", "extra"))
    me = F.struct(F.col(u).alias("u"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(size).alias("size"),
                  F.col(rid).alias("rid"))
    bucket = F.pmod(F.col(u), F.lit(BUCKETS))
    inside = F.when(edge.isNull(), False).when(bucket < edge, True).when(bucket > edge, False).otherwise(
        F.coalesce(me <= last, F.lit(False)))
    return inside | F.coalesce(F.array_contains(extra, F.col(rid)), F.lit(False))


def with_copies(sized: DataFrame, plan: DataFrame, n: int, prefix: str = "") -> DataFrame:
    """Join the plan to rows with doc_id, source and ``prefix`` + size, u, rid; add ``prefix`` + copies."""
    p = plan.select(*[F.col(c).alias(f"{prefix}_{c}") for c in plan.columns])
    d = sized.join(_small(p, n), F.col("source").eqNullSafe(F.col(f"{prefix}__s")), "left")
    more = _sampled(prefix + "u", "doc_id", prefix + "size", prefix + "rid", prefix + "_")
    copies = F.when(F.col(prefix + "size") > 0, F.col(f"{prefix}_whole") + more.cast("int")).otherwise(0)
    return d.withColumn(prefix + "copies", copies.cast("bigint"))


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, u (seeded hash), rid (the row's number in the input) of every document."""
    d = docs.select(F.col("doc_id").cast("bigint"), "source", word_count(F.col("text")).alias("size"),
                    F.monotonically_increasing_id().alias("rid"))
    return d.withColumn("u", F.xxhash64(F.lit(seed), "doc_id"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3.0,
        seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every document.

    ``docs`` needs doc_id, text and source.  ``copies`` says how often the mix
    repeats the whole document.
    """
    sized = cut(sizes(docs, seed), "mix-sizes")
    plan, n = mix_plan(sized, weights, max_epochs)
    return with_copies(sized, plan, n).select(
        "doc_id", "source", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: float = 3.0,
          seed: int = 17) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is repeated."""
    plan, n = mix_plan(cut(sizes(docs, seed), "mix-sizes"), weights, max_epochs)
    prefix = free_prefix(docs.columns)
    d = docs.withColumn(prefix + "size", word_count(F.col("text"))).withColumn(
        prefix + "u", F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint"))).withColumn(
        prefix + "rid", F.monotonically_increasing_id())
    d = with_copies(d, plan, n, prefix).where(F.col(prefix + "copies") > 0)
    return d.withColumn(prefix + "copy", F.explode(F.sequence(F.lit(1), F.col(prefix + "copies").cast("int")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents by the weights 5, 2, 1 in turn, at most three epochs."""
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")
