"""Sorts, global positions and top-N operators.

Design notes (scale):

* A window without ``partitionBy`` funnels every row into one task, so it is
  only used on inputs whose size is bounded by a parameter (``n`` rows,
  partition counts).  Global positions use :func:`with_position`, which keeps
  the sort distributed (range partitioning) and only moves one row per
  partition through the driver-side offset table.
* Top-N per group uses ``row_number`` with a ``rn <= n`` filter; Spark turns
  this into a partial ``WindowGroupLimit`` before the shuffle, so a group that
  holds a third of the data sends at most ``n`` rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import written

SortRule = Sequence[str | tuple[str, str]]

#: Rows sampled for every range of a global order.
SAMPLE_PER_RANGE = 32
#: Copies of a tied row that one task makes again.
COPIES = 1_000_000


def order_columns(rule: SortRule) -> list[Column]:
    """``[("fv", "desc"), ("age", "asc"), "name"]`` -> sort expressions."""
    out = []
    for item in rule:
        name, direction = (item, "asc") if isinstance(item, str) else item
        d = direction.lower()
        if d not in ("asc", "desc"):
            raise ValueError(f"direction must be asc or desc, got {direction!r}")
        out.append(F.col(name).desc() if d == "desc" else F.col(name).asc())
    return out


def sort_by_rule(df: DataFrame, rule: SortRule) -> DataFrame:
    """Multi-key sort, e.g. face value descending then age ascending.

    One operator for every spelling of a custom ordering (self-ordering type,
    ordering object, tuple key with negation, ordering by projection): the
    rule is data, and comparisons never overflow.
    """
    return df.orderBy(*order_columns(rule))


def with_position(df: DataFrame, rule: SortRule, name: str = "pos") -> DataFrame:
    """Add the 1-based position of each row in the total order ``rule``.

    The sort is range-partitioned and written once to the shared scratch folder:
    Spark samples the range bounds anew in every run, so they must be fixed
    before partitions are counted.  A row's position is ``rows in earlier
    partitions + index within its partition``; counting reads one column.
    Only one row per partition reaches the single-task offset window.  Make the
    rule a total order (end with a unique column) for a deterministic result.
    """
    cols = df.columns
    p, m = "_skein_part", "_skein_mono"
    s = df.orderBy(*order_columns(rule)).select(
        *cols, F.spark_partition_id().alias(p), F.monotonically_increasing_id().alias(m)
    )
    s = written(s, "positions")
    sizes = s.groupBy(p).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(p, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    index_in_part = F.col(m) - F.shiftleft(F.col(p).cast("bigint"), 33)
    return s.join(F.broadcast(offsets), p).select(
        *cols, (F.col("_off") + index_in_part + F.lit(1)).alias(name)
    )


def _precedes(rule: SortRule, bound: Column) -> Column:
    """Whether a row stands before ``bound`` (a struct of the rule's columns); never null."""
    out, same = F.lit(False), F.lit(True)
    for k, item in enumerate(rule):
        name, direction = (item, "asc") if isinstance(item, str) else item
        mine, other = F.struct(F.col(name).alias("v")), F.struct(bound[f"k{k}"].alias("v"))
        # Inside a struct null is the smallest value, as it is in a sort.
        out = out | (same & ((mine > other) if direction.lower() == "desc" else (mine < other)))
        same = same & F.col(name).eqNullSafe(bound[f"k{k}"])
    return out


def _bounds(df: DataFrame, rule: SortRule, ranges: int) -> list[tuple[tuple, int]]:
    """At most ``ranges - 1`` distinct bounds in order, each with the number of quantiles it is."""
    rows = df.count()
    if ranges < 2 or rows < 2:
        return []
    keys = [i if isinstance(i, str) else i[0] for i in rule]
    part = df.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keys)])
    part = part.sample(min(1.0, SAMPLE_PER_RANGE * ranges / rows), seed=17)
    plain = [(f"k{k}", "asc" if isinstance(i, str) else i[1]) for k, i in enumerate(rule)]
    # A sample of about SAMPLE_PER_RANGE rows a range: small enough for one task.
    step = max(1, min(SAMPLE_PER_RANGE, rows // ranges))
    place = F.row_number().over(Window.orderBy(*order_columns(plain)))
    found = part.withColumn("_place", place).where(F.col("_place") % step == 0).groupBy(
        *[n for n, _ in plain]).agg(F.count(F.lit(1)).alias("_times")).orderBy(*order_columns(plain)).collect()
    return [(tuple(r)[:-1], r["_times"]) for r in found]


def position_in_ranges(df: DataFrame, rule: SortRule, name: str = "pos", ranges: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in the total order ``rule``.

    Nothing is sorted as a whole and nothing is written.  A sample of about 32 rows for each of
    ``ranges`` ranges (default: the session's shuffle partitions) gives bounds, which are fixed in
    the plan as literals; a row finds its range by a binary search in them.  Its position is
    ``rows in earlier ranges + its rank within its range``; one row per range goes through the
    single-task offset window.

    A bound that is several quantiles stands for a hot tie.  Its rows are counted by their whole
    content before they are shuffled, dealt by a hash into as many ranges as it has quantiles, and
    made again from their counts, so that neither a tie nor a row with many copies fills one task.

    The answer is that of :func:`with_position`, which writes the sorted table once and is quicker
    where the table is small; this one needs no scratch space and holds when a third of the rows tie.
    The input is read for its count, the sample, the ranges' counts and the ranks, and must give the
    same rows every time.  Columns of the rule are of atomic types, and none is a map.  Make the rule a
    total order (end with a unique column) for a deterministic result.
    """
    cols = df.columns
    base = "_skein"
    while any(c.lower().startswith(base) for c in cols):
        base += "_"
    at, sub, n, off, rank = (f"{base}{k}" for k in ("at", "sub", "n", "off", "rank"))
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(df, rule, ranges)
    placed = df.withColumn(at, F.lit(0)).withColumn(sub, F.lit(-1))
    if bounds:
        types = {f.name: f.dataType for f in df.schema.fields}
        keys = [i if isinstance(i, str) else i[0] for i in rule]
        table = F.array(*[
            F.struct(*[F.lit(v).cast(types[c]).alias(f"k{k}") for k, (c, v) in enumerate(zip(keys, bound))])
            for bound, _ in bounds])
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])

        def move(seen: Column, step: Column) -> Column:
            to = seen + step
            inside = F.when(to <= len(bounds), ~_precedes(rule, F.get(table, F.least(to, F.lit(len(bounds))) - 1)))
            return F.when(inside, to).otherwise(seen)

        placed = df.withColumn(at, F.aggregate(steps, F.lit(0), move))
        # Tied rows stand at the front of their bound's range, in parts of their own.
        tied = {k + 1: times for k, (_, times) in enumerate(bounds) if times > 1}
        part = F.lit(None).cast("int")
        if tied:
            parts = F.get(F.array(F.lit(0), *[F.lit(t if t > 1 else 0) for _, t in bounds]), F.col(at))
            last = F.get(table, F.col(at) - 1)
            same = F.lit(True)
            for k, c in enumerate(keys):
                same = same & F.col(c).eqNullSafe(last[f"k{k}"])
            part = F.when((parts > 0) & same, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), parts).cast("int"))
        placed = placed.withColumn(sub, F.coalesce(part, F.lit(1 << 30)))
    counts = placed.groupBy(at, sub).agg(F.count(F.lit(1)).alias(n))
    before = Window.orderBy(at, sub).rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select(at, sub, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(off)))
    own = [F.col(f"`{c}`") for c in cols]
    single = placed if not (bounds and tied) else placed.where(F.col(sub) == 1 << 30)
    ranked = single.withColumn(rank, F.row_number().over(Window.partitionBy(at, sub).orderBy(*order_columns(rule))))
    out = ranked.join(offsets, [at, sub]).select(*own, (F.col(off) + F.col(rank)).cast("bigint").alias(name))
    if not (bounds and tied):
        return out
    alike = placed.where(F.col(sub) < 1 << 30).groupBy(*own, at, sub).agg(F.count(F.lit(1)).alias(n))
    running = Window.partitionBy(at, sub).orderBy(*own).rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn(rank, F.coalesce(F.sum(n).over(running), F.lit(0))).join(offsets, [at, sub])
    # A row with very many copies is dealt in blocks of them before they are made.
    blocks = alike.withColumn(sub, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1, F.lit(COPIES).cast("bigint"))))
    blocks = blocks.repartition(F.col(off), F.col(rank), F.col(sub))
    copy = F.explode(F.sequence(F.col(sub), F.least(F.col(sub) + COPIES, F.col(n)) - 1))
    return out.unionByName(blocks.withColumn(at, copy).select(
        *own, (F.col(off) + F.col(rank) + F.col(at) + 1).cast("bigint").alias(name)))


def top_n(df: DataFrame, n: int, rule: SortRule) -> DataFrame:
    """First ``n`` rows of the whole table in ``rule`` order (``TakeOrderedAndProject``)."""
    return df.orderBy(*order_columns(rule)).limit(int(n))


# --------------------------------------------------------------------------- #
# top-N per group
# --------------------------------------------------------------------------- #

def _top_n_window(df: DataFrame, group: list[str], n: int, rule: SortRule, rn: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order_columns(rule))
    return (
        df.withColumn(rn, F.row_number().over(w))
        .where(F.col(rn) <= int(n))
        .withColumn(rn, F.col(rn).cast("bigint"))
    )


def _top_n_key_partitions(df: DataFrame, group: str, n: int, rule: SortRule, rn: str,
                          max_partitions: int) -> DataFrame:
    """The first ``n`` rows of each group, placed one partition per group value.

    The input is read once and cut to ``n`` rows per group by the window (with
    its partial limit before the shuffle); only that cut, written once, is asked
    for its keys and placed.
    """
    from skein.operators.partitioning import partition_per_key

    first = written(_top_n_window(df, [group], n, rule, rn), "topn")
    return partition_per_key(first, group, max_partitions, keys_from=first.where(F.col(rn) == 1))


def top_n_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    n: int,
    rule: SortRule,
    strategy: str = "window",
    groups: Sequence[str] | None = None,
    rn: str = "rn",
    max_partitions: int = 4096,
) -> DataFrame:
    """First ``n`` rows of every group in ``rule`` order, with their rank ``rn``.

    strategy
      ``window``          row_number per group (default; bounded per-task memory)
      ``listed``          only the values in ``groups`` (the per-group loop of
                          ordered takes, as one filtered scan and window)
      ``key_partitions``  the same cut, then one partition per group value (at
                          most ``max_partitions`` of them, else ValueError)
    All strategies give the same rows for the same rule; make the rule a total
    order (e.g. count descending, then name) for a deterministic answer.
    """
    gcols = [group] if isinstance(group, str) else list(group)
    if strategy == "window":
        if groups is not None:
            df = df.where(F.col(gcols[0]).isin(list(groups)))
        return _top_n_window(df, gcols, n, rule, rn)
    if strategy == "listed":
        if groups is None or len(gcols) != 1:
            raise ValueError("strategy 'listed' needs one group column and the list of values")
        # One scan for all listed values: the ``isin`` filter is on a grouping
        # key, so Catalyst pushes it below the aggregate towards the scan.
        return _top_n_window(df.where(F.col(gcols[0]).isin(list(groups))), gcols, n, rule, rn)
    if strategy == "key_partitions":
        if len(gcols) != 1:
            raise ValueError("strategy 'key_partitions' needs one group column")
        if groups is not None:
            df = df.where(F.col(gcols[0]).isin(list(groups)))
        return _top_n_key_partitions(df, gcols[0], n, rule, rn, max_partitions)
    raise ValueError(f"unknown strategy {strategy!r}")


# --------------------------------------------------------------------------- #
# top-N over distinct count values
# --------------------------------------------------------------------------- #

def top_n_distinct_counts(counts: DataFrame, n: int, key: str = "word", cnt: str = "cnt") -> DataFrame:
    """The ``n`` highest distinct counts, one representative key each.

    The representative is the greatest key with that count (the original kept
    whichever key arrived last).  ``groupBy(cnt)`` has few groups (a total of
    N rows allows at most ~sqrt(2N) distinct counts) and combines map-side.
    """
    return (
        counts.groupBy(cnt).agg(F.max(key).alias(key))
        .orderBy(F.col(cnt).desc()).limit(int(n))
    )


def top_counts_all_keys(counts: DataFrame, n: int, key: str = "word", cnt: str = "cnt") -> DataFrame:
    """The ``n`` highest distinct counts with *all* their keys: rows (cnt, position, key).

    ``position`` numbers the keys of a count from 1 in key order.  One row per
    key at any size; :func:`skein.sinks.files.write_joined_text` joins them.
    The top counts are found first (``n`` rows, broadcast).
    """
    top = counts.select(cnt).distinct().orderBy(F.col(cnt).desc()).limit(int(n))
    chosen = counts.join(F.broadcast(top), cnt, "left_semi")
    pos = with_position(chosen.select(cnt, key), [(cnt, "desc"), (key, "asc")], name="_pos")
    first = pos.groupBy(cnt).agg(F.min("_pos").alias("_first"))
    return pos.join(F.broadcast(first), cnt).select(
        cnt, (F.col("_pos") - F.col("_first") + 1).alias("position"), key)
