"""Range lookup: attach the rule whose closed interval ``[lo, hi]`` holds a number.

Spark plans a pure range condition (``n BETWEEN lo AND hi``) as a nested loop,
costing rows x rules.  Here the interval table is turned into an equi-join:

* numbers are cut into buckets of ``2**bits`` values (``n >> bits``);
* each rule is exploded into the buckets it touches and joined on the bucket,
  with ``BETWEEN`` kept as the residual condition.

A rule spanning very many buckets would explode into very many rows, so rules
are spread over *levels*: a rule goes to the finest level (``bits``,
``bits+8``, ``bits+16`` ...) at which it spans at most ``max_span`` buckets.
Each non-empty level is one left join; since rules must not overlap, a number
matches at most one rule over all levels, and the payload is the first
non-NULL one.

Rules are checked unless the caller says otherwise: an empty interval
(``lo > hi``), a NULL bound or two overlapping rules raise.  Unchecked, rules
with a NULL bound or an empty interval match nothing.

With ``overlapping=True`` rules may overlap, and a number gives one row per rule that
holds it (one row with the defaults if none does), as SQL's left join.  Should they
overlap, the gaps between rules become entries without payload.  Each number between the
first and the last rule is then held by some entry, so that one join over all levels,
with a number's bucket of each level as its keys, finds every rule and drops no number.

Per level the exploded rule side is measured (rows and bytes, payload
included).  Up to ``broadcast_bytes`` it is broadcast (no shuffle of the facts).
Beyond that the join shuffles both sides on the bucket; AQE splits a skewed
bucket, and ``salts > 1`` also spreads a hot bucket over ``salts`` tasks by
copying rules ``salts`` times; a fact's salt is a hash of its row, so a task
that runs again deals its rows the same way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import ColumnOrName, _col
from skein.session import written

MAX_LEVELS = 8


def choose_bits(rules: DataFrame, lo: str = "lo", hi: str = "hi") -> int:
    """Bucket width from the median rule width (one tiny aggregate)."""
    return _bits_for(rules.select(F.percentile_approx(F.col(hi) - F.col(lo) + 1, 0.5).alias("m")).first()["m"])


def _bits_for(median: int | None) -> int:
    return 0 if not median or median <= 1 else min(62, int(math.ceil(math.log2(median))))


def _level_of(lo: Column, hi: Column, bits: int, max_span: int) -> Column:
    """Smallest ladder step whose bucket span fits ``max_span`` (rules have ``lo <= hi``)."""
    expr = None
    for i in reversed(range(MAX_LEVELS)):
        b = min(63, bits + 8 * i)
        fits = F.try_subtract(F.shiftright(hi, b), F.shiftright(lo, b)) < F.lit(max_span)
        expr = F.when(fits, F.lit(b)) if expr is None else F.when(fits, F.lit(b)).otherwise(expr)
    return F.coalesce(expr, F.lit(63))


#: Rules up to which their order is checked in one partition (24 bytes each).
FEW_RULES = 100_000
#: Buckets that a gap between rules spans, at most: gaps are disjoint, so a wide bucket holds few.
GAP_SPAN = 16


def _in_order(rules: DataFrame, lo: str, hi: str, few: bool) -> DataFrame:
    """lo, hi, p: rules dealt over partitions p by ``lo`` (one partition, if there are few)."""
    r = rules.select(F.col(lo).cast("bigint").alias("lo"), F.col(hi).cast("bigint").alias("hi"))
    return (r.coalesce(1) if few else r.repartitionByRange("lo")).withColumn("p", F.spark_partition_id())


def _gaps(rules: DataFrame, lo: str, hi: str, few: bool) -> DataFrame:
    """lo, hi: the gaps between the rules (all with bounds, ``lo <= hi``) that no rule covers."""
    placed = written(_in_order(rules, lo, hi, few), "rules-placed")
    before = Window.partitionBy("p").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    tops = placed.groupBy("p").agg(F.max("hi").alias("top")).select("p", F.max("top").over(earlier).alias("top"))
    prev = placed.withColumn("prev", F.max("hi").over(before)).join(F.broadcast(tops), "p").select(
        "lo", F.greatest("prev", "top").alias("prev"))
    return prev.where("prev < lo and prev + 1 < lo").select(
        (F.col("prev") + 1).alias("lo"), (F.col("lo") - 1).alias("hi"))


def _overlaps(rules: DataFrame, lo: str, hi: str, few: bool) -> int:
    """Rules (with both bounds) whose ``lo`` is not above every ``hi`` before them, in order of ``lo``.

    The running maximum of ``hi`` is a window inside each partition of a range-partitioned
    order; across partitions only one summary row per partition is compared.
    """
    placed = _in_order(rules, lo, hi, few)
    before = Window.partitionBy("p").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    per = placed.withColumn("prev", F.max("hi").over(before)).groupBy("p").agg(
        F.min("lo").alias("first_lo"), F.max("hi").alias("max_hi"), F.count_if(F.col("lo") <= F.col("prev")).alias("bad"))
    earlier = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    return int(per.select((F.col("bad") + F.coalesce((F.col("first_lo") <= F.max("max_hi").over(earlier)).cast("int"), F.lit(
        0))).alias("bad")).agg(F.coalesce(F.sum("bad"), F.lit(0))).first()[0])


def rule_violations(rules: DataFrame, lo: str = "lo", hi: str = "hi") -> dict[str, int]:
    """Counts of NULL bounds, empty intervals (``lo > hi``) and overlapping neighbours."""
    no_bound = F.col(lo).isNull() | F.col(hi).isNull()
    nulls, empty, n = rules.agg(F.count_if(no_bound), F.count_if(F.col(lo) > F.col(hi)), F.count(F.lit(1))).first()
    overlaps = _overlaps(rules.where(~no_bound), lo, hi, n <= FEW_RULES)
    return {"nulls": int(nulls), "empty": int(empty), "overlaps": overlaps}


def _invalid(v: dict[str, int]) -> None:
    if any(v.values()):
        raise ValueError(f"invalid interval rules: {v}")


def check_rules(rules: DataFrame, lo: str = "lo", hi: str = "hi") -> None:
    """Raise when a rule has no bounds, is empty, or overlaps another (which would duplicate rows)."""
    _invalid(rule_violations(rules, lo, hi))


def _free(columns: Sequence[str], base: str = "_skein") -> str:
    """A prefix that no given column name starts with, ignoring case."""
    names = [c.lower() for c in columns]
    while any(c.startswith(base) for c in names):
        base += "_"
    return base


class RangeIndex:
    """Interval rules prepared once for many lookups (e.g. one per stream batch).

    Preparing reads only the rule table: it is written once, one aggregate counts what
    is wrong with single rules and gives the bucket width, one compares neighbours,
    and one gives the levels in use with the size of their exploded rule side (which
    decides broadcast or shuffle).  :meth:`lookup` then only builds the join plan.
    """

    def __init__(
        self,
        rules: DataFrame,
        payload: Sequence[str] = ("province",),
        lo: str = "lo",
        hi: str = "hi",
        bits: int | None = None,
        max_span: int = 256,
        broadcast_bytes: int = 32 << 20,
        salts: int = 1,
        validate: bool = True,
        overlapping: bool = False,
    ):
        self.payload = list(payload)
        self.types = {c: rules.schema[c].dataType for c in self.payload}
        self.salts = int(salts)
        # Every rule is used by the check, the measuring and the joins: write it once.
        r = written(rules.select(
            F.col(lo).cast("bigint").alias("_lo"), F.col(hi).cast("bigint").alias("_hi"),
            *[F.col(c).alias(f"_v{k}") for k, c in enumerate(self.payload)]), "rules")
        no_bound = F.col("_lo").isNull() | F.col("_hi").isNull()
        good = F.col("_lo") <= F.col("_hi")
        nulls, empty, n, median = r.agg(
            F.count_if(no_bound), F.count_if(F.col("_lo") > F.col("_hi")), F.count(F.lit(1)),
            F.percentile_approx(F.when(good, F.col("_hi") - F.col("_lo") + 1), 0.5)).first()
        few = n <= FEW_RULES
        overlaps = 0
        if validate and (nulls or empty):
            _invalid({"nulls": int(nulls), "empty": int(empty), "overlaps": 0})
        if validate or overlapping:
            overlaps = _overlaps(r.where(good), "_lo", "_hi", few)
        if not overlapping:
            _invalid({"nulls": 0, "empty": 0, "overlaps": overlaps})
        #: Whether a number can be held by more than one rule.
        self.several = overlaps > 0
        self.bits = _bits_for(median) if bits is None else int(bits)
        r = r.where(good).withColumn("_lvl", _level_of(F.col("_lo"), F.col("_hi"), self.bits, max_span))
        if self.several:
            gaps = _gaps(r, "_lo", "_hi", few).toDF("_lo", "_hi")
            r = written(r.unionByName(gaps.withColumn("_lvl", _level_of(
                F.col("_lo"), F.col("_hi"), self.bits, GAP_SPAN)), allowMissingColumns=True), "rules-gaps")
        # One aggregate gives every level in use and the size of its exploded side
        # (at most MAX_LEVELS rows reach the driver).
        span = F.expr("shiftright(_hi, _lvl) - shiftright(_lo, _lvl) + 1")
        width = F.lit(64)
        values = [f"_v{k}" for k in range(len(self.payload))]
        for c in values:
            width = width + 16 + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
        stats = sorted(tuple(row) for row in r.groupBy("_lvl").agg(
            F.sum(span * width).alias("size"), F.min("_lo").alias("first"), F.max("_hi").alias("last")).collect())
        self.sides: list[tuple[int, DataFrame, bool, list[str]]] = []
        for lv, size, _, _ in stats:
            side = r.where(F.col("_lvl") == lv).select(
                F.explode(F.sequence(F.shiftright("_lo", lv), F.shiftright("_hi", lv))).alias("_b"), "_lo", "_hi", *values)
            self.sides.append((lv, side, size <= broadcast_bytes, values))
        if self.several:
            #: Levels in use with their first and last number.
            self.levels = [(lv, first, last) for lv, _, first, last in stats]
            self.whole = r.select("_lvl", F.explode(F.expr(
                "sequence(shiftright(_lo, _lvl), shiftright(_hi, _lvl))")).alias("_b"), "_lo", "_hi", *values)
            self.small = sum(size for _, size, _, _ in stats) <= broadcast_bytes

    def lookup(self, facts: DataFrame, number: ColumnOrName, default: dict[str, object] | None = None,
               names: dict[str, str] | None = None) -> DataFrame:
        """``facts`` plus the payload of the rule holding ``number`` (or ``default``).

        ``names`` gives payload columns other names in the result; a name that ``facts`` has
        already (ignoring case) raises ``ValueError``.  Any other column of ``facts`` is kept as it
        is, whatever its name.
        """
        default, names = dict(default or {}), dict(names or {})
        out_names = [names.get(c, c) for c in self.payload]
        taken = {c.lower() for c in facts.columns}
        clash = [c for c in out_names if c.lower() in taken]
        if clash:
            raise ValueError(f"facts have columns named like the rules' payload: {clash}; rename them by names={{...}}")
        p = _free(facts.columns)
        n = f"{p}_n"
        out = facts.withColumn(n, _col(number).cast("bigint"))
        # A fact's salt: a hash of its row.
        salt = F.xxhash64(*[F.col(f"`{c.name}`") for c in facts.schema if not c.dataType.typeName() == "map"])
        if self.several:
            out = self._every(out, p, salt)
            found = [F.coalesce(F.col(f"{p}_0_v{k}"), *[F.lit(default[c])] * (c in default)).cast(
                self.types[c]).alias(name) for k, (c, name) in enumerate(zip(self.payload, out_names))]
            return out.select(*[F.col(f"`{c}`") for c in facts.columns], *found)
        for i, (lv, side, small, values) in enumerate(self.sides):
            own = side.toDF(f"{p}_b", f"{p}_lo", f"{p}_hi", *[f"{p}_{i}{v}" for v in values])
            inside = F.col(n).between(F.col(f"{p}_lo"), F.col(f"{p}_hi"))
            on_bucket = F.shiftright(F.col(n), lv) == F.col(f"{p}_b")
            if small:
                out = out.join(F.broadcast(own), on_bucket & inside, "left")
            elif self.salts > 1:
                salted = own.withColumn(f"{p}_s", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
                left = out.withColumn(f"{p}_ls", F.pmod(salt, F.lit(self.salts)).cast("int"))
                out = left.join(salted, on_bucket & (F.col(f"{p}_ls") == F.col(f"{p}_s")) & inside, "left")
                out = out.drop(f"{p}_ls", f"{p}_s")
            else:
                out = out.join(own, on_bucket & inside, "left")
            out = out.drop(f"{p}_b", f"{p}_lo", f"{p}_hi")
        found = []
        for k, (c, name) in enumerate(zip(self.payload, out_names)):
            parts = [F.col(f"{p}_{i}_v{k}") for i in range(len(self.sides))]
            if c in default:
                parts.append(F.lit(default[c]))
            found.append((F.coalesce(*parts) if parts else F.lit(None)).cast(self.types[c]).alias(name))
        return out.select(*[F.col(f"`{c}`") for c in facts.columns], *found)

    def _every(self, facts: DataFrame, p: str, salt: Column) -> DataFrame:
        """``facts`` (their number named ``p``_n) once for every rule or gap that holds the number,
        and once if it lies outside all of them."""
        n, values = F.col(f"{p}_n"), [f"_v{k}" for k in range(len(self.payload))]

        def key(level: int, bucket: Column) -> Column:
            return F.struct(F.lit(level).alias("l"), bucket.alias("b"))

        keys = F.array_compact(F.array(*[F.when(n.between(first, last), key(lv, F.shiftright(n, lv)))
                                         for lv, first, last in self.levels]))
        # No entry has level -1: numbers outside all rules, and NULLs, are dealt by their hash.
        keys = F.when(F.size(keys) > 0, keys).otherwise(F.array(key(-1, salt)))
        left = facts.withColumn(f"{p}_s", F.pmod(salt, F.lit(max(1, self.salts))).cast("int")).withColumn(f"{p}_k", F.explode(keys))
        left = left.withColumn(f"{p}_l", F.col(f"{p}_k.l")).withColumn(f"{p}_b", F.col(f"{p}_k.b")).drop(f"{p}_k")
        own = self.whole.toDF(f"{p}_el", f"{p}_eb", f"{p}_lo", f"{p}_hi", *[f"{p}_0{v}" for v in values])
        on = (F.col(f"{p}_l") == F.col(f"{p}_el")) & (F.col(f"{p}_b") == F.col(f"{p}_eb")) & n.between(
            F.col(f"{p}_lo"), F.col(f"{p}_hi"))
        if self.small:
            own = F.broadcast(own)
        elif self.salts > 1:
            own = own.withColumn(f"{p}_es", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
            on = on & (F.col(f"{p}_s") == F.col(f"{p}_es"))
        return left.join(own, on, "left").where(F.col(f"{p}_lo").isNotNull() | (F.col(f"{p}_l") == -1))


def range_lookup(
    facts: DataFrame,
    number: ColumnOrName,
    rules: DataFrame,
    payload: Sequence[str] = ("province",),
    default: dict[str, object] | None = None,
    **options,
) -> DataFrame:
    """Left range join of ``facts`` to closed intervals ``[lo, hi]``, which must not overlap
    unless ``overlapping=True``.

    Returns ``facts`` plus the ``payload`` columns of the matching rule (with
    ``overlapping``, once per matching rule), or ``default`` values where no rule holds the
    number.  ``options`` go to :class:`RangeIndex`.
    """
    return RangeIndex(rules, payload, **options).lookup(facts, number, default)
