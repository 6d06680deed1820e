"""Near-duplicate join on word n-gram sets with adaptive multi-match prefixes.

A document's set holds its distinct ``width``-word shingles as 64-bit hashes;
hash order is the global order.  Documents with equal sets are one node.  Two
nodes link when ``100 |x & y| >= percent |x | y|``.

Prefixes.  A partner of x shares at least ``a = ceil(percent n / 100)`` shingles,
so at most ``n - a`` of x's are not shared, and the first l shared shingles of a
pair lie among the first ``n - a + l`` of either.  A shingle met in more than
``common`` stored prefixes is expensive.  Each document lengthens its prefix
(raises l) until every partner must share ``r = l - (expensive ones in the
prefix)`` cheap ones with it, r reaching ``matches`` if possible, at least 1.  A pair is
verified only if it shares as many cheap prefix shingles as the shorter-prefixed
document requires.  Cheap shingles have at most ``common`` holders, so the pairs
they propose grow with the input, not with the square of a group.

Documents that find no such prefix consist mostly of shingles that very many
documents share: members of large groups of near copies.  Two of them that link
hold a common expensive shingle in their shortest prefixes, so both are members
of its list's leader (the smallest node of the list).  Members of a leader are
described by their difference from a reference set R, D(x) = x ^ R, where R holds
the shingles of most of the leader's ``REFERENCE`` smallest members (any set
would do; near a group's common text the differences are short):

* ``|x ^ y| <= |D(x)| + |D(y)|``, and a link means ``|x ^ y| <= c (|x| + |y|)`` with
  c = (100 - percent) / (100 + percent).  With f(x) = |D(x)| - c |x|, members with
  f(x) + f(y) <= 0 link for certain, and then both link to the member of least
  f: one link each joins all of them;
* any other linked pair shares at least (f(x) + f(y)) / 2 of its differences.  So
  prefixes of the differences (shingles that R lacks first, of these the ones that
  several of the ``VOTERS`` smallest members hold last, the most frequent at the end, so that
  prefixes hold what few share) must meet; only members of different components are proposed, and
  one of a pair is always a member that isn't linked to the one of least f;
* of R's own shingles a group's members can lack only a few kinds, so lists of them
  are long.  A pair may share nothing else only if it needs no more differences than
  either lacks, (f(x) + f(y)) / 2 <= lacking(x), lacking(y).  Such a shingle is listed only
  by members for which a partner in a band of f can fulfil that, and met only by
  partners of that band;
* a list with more than ``common`` members on both sides, and more than ``LIST`` in all, becomes
  a group of its own, whose members share a difference and are described anew by their
  difference from a reference set of that list (a leader again), up to ``ROUNDS``
  times.  The other lists give at most ``LIST`` pairs per member of the longer side;
* a group whose members are all in another one adds nothing and is left out, as are the rows
  of a list for which the other side's least and largest f, n and component leave no partner;
* near copies of each other meet in as many lists as they share differences.  Each member names
  the longest list it is in; two that name the same one are in it both, and a pair is
  formed there only.

So a group of m near copies costs a few comparisons per member and no link between
components is lost; the last round lists all pairs of what is left.

Which shingles count as expensive is kept as a bitmap of sixteen bits for each of
them; a false hit only lengthens prefixes.  A bitmap of more than ``bitmap_bytes`` isn't
broadcast: the documents' shingles then meet the expensive ones by a join.
All counts cover all documents; verification intersects whole sets.

Defined results
* null text, or no words: empty set, n_shingles 0, linked with nothing;
* fewer words than ``width``: one shingle, the whole sequence;
* repeated rows: equal sets are linked; an empty table gives no rows;
* a row without doc_id can't be named by a component: it is linked with nothing and
  its component_id is null;
* other input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, slices, table
from skein.llm.components import components

#: Rounds of describing long lists anew; the last one lists all pairs.
ROUNDS = 4
#: Members of a list, on both sides together, up to which its pairs are formed.
LIST = 128
#: Bands of f in a group, at most (about).
BANDS = 16
#: Ids up to which a list of documents to read again is broadcast (8 bytes each).
BROADCAST_IDS = 500_000
#: Members of a leader that vote on its reference set, and on the order of the differences.
REFERENCE, VOTERS = 7, 32
#: Shingles with a place in that order, at most.
ORDERED = 4096
#: Groups, the largest of a member's, that are tried for whether they hold all of another.
WIDER = 4
_CACHE_WORDS = 100_000
_HASHES: dict[bytes, int] = {}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Distinct shingle hashes as ascending signed 64-bit integers."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    if len(_HASHES) > _CACHE_WORDS:
        _HASHES.clear()
    found = list(map(_HASHES.get, words))
    if None in found:
        for k, h in enumerate(found):
            if h is None:
                found[k] = _HASHES[words[k]] = xxhash.xxh3_64_intdigest(words[k])
    h = np.array(found, dtype=np.uint64)
    n = len(h) - width + 1
    out = h[:n].copy()
    for k in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * _MIX + h[k:k + n]
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return np.unique((out ^ (out >> np.uint64(29))).view(np.int64))


def least_shared(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any partner, at least."""
    return -(-percent * n // 100)


def stored(n: int, percent: int) -> int:
    """Length of the prefix that is kept for a set of n."""
    return min(n, n - least_shared(n, percent) + max(32, n // 5))


def sets_of(docs: DataFrame, width: int, percent: int, whole: bool = False) -> DataFrame:
    """doc_id, n, node (digest of the set; null if empty), tokens (prefix, or the whole set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ns, nodes, tokens = [], [], []
            for text in part.column(1).to_pylist():
                s = shingles(text, width)
                ns.append(len(s))
                nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                tokens.append(s if whole else s[:stored(len(s), percent)])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ns, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(tokens, pa.list_(pa.int64()))], ["doc_id", "n", "node", "tokens"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n bigint, node binary, tokens array<bigint>")


class Expensive:
    """Which shingles are expensive: a bitmap by hash, or a table where it would be too large."""

    def __init__(self, sets: DataFrame, common: int, bitmap_bytes: int):
        counts = sets.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c"))
        self.table = cut(counts.where(F.col("c") > common).select("t"), "join-expensive")
        bits = max(16, math.ceil(math.log2(16 * max(1, self.table.count()))))
        self.bitmap = None
        if 1 << bits <= 8 * bitmap_bytes:
            at = self.table.select(F.col("t").bitwiseAND(F.lit((1 << bits) - 1)).alias("at"))
            # Eight bits of the map in a row: at most 2 ** (bits - 3) rows reach the driver.
            byte = at.groupBy(F.shiftright("at", 3).alias("k")).agg(
                F.bit_or(F.expr("shiftright(128, cast(at & 7 as int))")).cast("int").alias("v"))
            found = byte.toArrow()
            self.bitmap = np.zeros(1 << (bits - 3), np.uint8)
            self.bitmap[found.column("k").to_numpy()] = found.column("v").to_numpy()

    def reader(self):
        """A function for tasks: the flags (1 for expensive) of every ``tokens`` list of an Arrow batch."""
        if self.bitmap is None:
            return lambda part: [np.frombuffer(x, np.uint8).astype(bool) for x in part.column("costly").to_pylist()]
        shared = self.table.sparkSession.sparkContext.broadcast(self.bitmap)
        mask = 8 * len(self.bitmap) - 1

        def read(part: pa.RecordBatch) -> list[np.ndarray]:
            bits, out = shared.value, []
            for tokens in part.column("tokens"):
                at = tokens.values.to_numpy() & mask
                out.append((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)
            return out

        return read

    def prepare(self, sets: DataFrame) -> DataFrame:
        """``sets`` for tasks that use :meth:`reader`: as they are, or with ``costly``, a byte per token."""
        if self.bitmap is not None:
            return sets
        # One row per set and token; equal sets are marked once.
        known = self.table.select("t", F.lit(1).alias("hit"))
        flat = sets.select("node", "tokens").dropDuplicates(["node"]).select("node", F.posexplode("tokens").alias("at", "t"))
        flags = flat.join(known, "t", "left").where("hit is not null").groupBy("node").agg(
            F.array_sort(F.collect_list("at")).alias("_at"))
        names = sets.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, 1024):
                flags = []
                for tokens, hits in zip(part.column(names.index("tokens")), part.column(len(names)).to_pylist()):
                    own = np.zeros(len(tokens.values), np.uint8)
                    own[hits or []] = 1
                    flags.append(own.tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(flags, pa.binary())], [*names, "costly"])

        return cut(sets.join(flags, "node", "left").select(*names, "_at").mapInArrow(
            run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sets.schema) + ", costly binary"), "join-marked")


def choose_level(costly: np.ndarray, n: int, percent: int, matches: int) -> tuple[int, int]:
    """(l, r): the shortest prefix level that requires the most cheap matches up to ``matches``."""
    spare = n - least_shared(n, percent)
    levels = np.arange(1, len(costly) - spare + 1)
    required = levels - np.cumsum(costly)[spare:]
    best = min(matches, int(required.max()))
    if best < 1:
        return int(levels[-1]), 0
    k = int(np.argmax(required >= best))
    return int(levels[k]), int(required[k])


def prefix_rows(sets: DataFrame, expensive: Expensive, percent: int, matches: int, heavy: bool) -> DataFrame:
    """t, node, n, l, r: the cheap prefix shingles of every node, or (``heavy``) the
    expensive ones in the shortest prefix of the nodes without a usable level.

    ``sets`` are prepared by ``expensive``.
    """
    read = expensive.reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            out: list[list] = [[], [], [], [], []]
            for n, node, tokens, costly in zip(part.column("n").to_pylist(), part.column("node").to_pylist(),
                                               part.column("tokens"), read(part)):
                t = tokens.values.to_numpy()
                level, r = choose_level(costly, n, percent, matches)
                spare = n - least_shared(n, percent)
                if heavy:
                    rows = t[:spare + 1][costly[:spare + 1]] if r < 1 else t[:0]
                else:
                    rows = t[:spare + level][~costly[:spare + level]]
                out[0].append(rows)
                for c, v in zip(out[1:], (node, n, level, r)):
                    c.extend([v] * len(rows))
            flat = np.concatenate(out[0]) if out[0] else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), pa.array(out[1], pa.binary()), *(pa.array(c, pa.int64()) for c in out[2:])],
                ["t", "node", "n", "l", "r"])

    return sets.where("n > 0").drop("doc_id").mapInArrow(
        run, "t bigint, node binary, n bigint, l bigint, r bigint")


def _length_ok(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def cheap_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: node pairs that share as many cheap prefix shingles as required."""
    one = F.struct("node", "n", "l", "r")
    lists = rows.groupBy("t").agg(F.array_sort(F.collect_set(one)).alias("m")).where(F.size("m") > 1)
    pairs = F.flatten(F.transform("m", lambda x, i: F.transform(
        F.filter(F.slice("m", i + 2, F.size("m")), lambda y: _length_ok(x["n"], y["n"], percent)),
        lambda y: F.struct(x.alias("x"), y.alias("y")))))
    p = lists.select(F.explode(pairs).alias("p")).select("p.x", "p.y")
    need = F.when(F.col("x.l") < F.col("y.l"), F.col("x.r")).when(
        F.col("y.l") < F.col("x.l"), F.col("y.r")).otherwise(F.greatest("x.r", "y.r"))
    return p.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(
        F.count(F.lit(1)).alias("c"), F.first(need).alias("need")).where("c >= need").select("a", "b")


def leader_pairs(rows: DataFrame) -> DataFrame:
    """grp, node: every holder of an expensive shingle with the smallest holder of it, the leader
    that names the group (a leader is a member of its own)."""
    first = rows.groupBy("t").agg(F.min("node").alias("leader"))
    return rows.join(first, "t").select(F.xxhash64("leader").alias("grp"), "node").distinct()


def widest(members: DataFrame) -> DataFrame:
    """The members (grp, node) of the groups that can add a pair: those of two members or more, one of
    equal groups, and none of which all members are found in a wider one.

    A wider group holds the member that is in the fewest groups too, so its ``WIDER`` largest are
    tried; a group that is kept for that bound costs time, no pair.
    """
    # Equal groups by 128 bits of hash.
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                       F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")).where("m > 1")
    one = sizes.groupBy("m", "x", "y").agg(F.min("grp").alias("grp")).select("grp", "m")
    mine = Window.partitionBy("node")
    kept = cut(members.join(one, "grp").withColumn("g", F.count(F.lit(1)).over(mine)).withColumn(
        "at", F.row_number().over(mine.orderBy(F.desc("m"), "grp"))), "join-groups")
    fewest = kept.groupBy("grp").agg(F.min(F.struct("g", "node"))["node"].alias("node"))
    wider = kept.where(F.col("at") <= WIDER).select("node", F.col("grp").alias("wider"), F.col("m").alias("more"))
    tried = fewest.join(wider, "node").join(one, "grp").where("more > m").select("grp", "wider")
    inside = kept.join(tried, "grp").join(kept.select(F.col("grp").alias("wider"), "node"), ["wider", "node"])
    gone = inside.groupBy("grp", "wider").agg(F.count(F.lit(1)).alias("k"), F.first("m").alias("m")).where("k = m")
    return cut(kept.join(gone.select("grp").distinct(), "grp", "left_anti").select("grp", "node"), "join-members")


def references(members: DataFrame, sets: DataFrame) -> DataFrame:
    """grp, ref, often: the shingles of more than half of the group's ``REFERENCE`` smallest members, and
    the others that several of the ``VOTERS`` smallest hold, the most frequent first."""
    small = Window.partitionBy("grp").orderBy("node")
    few = members.withColumn("_r", F.row_number().over(small)).where(F.col("_r") <= VOTERS).withColumn(
        "_r", (F.col("_r") <= REFERENCE).cast("int"))
    votes = few.join(sets, "node").select("grp", "_r", F.explode("tokens").alias("t")).groupBy("grp", "t").agg(
        F.sum("_r").alias("votes"), F.count(F.lit(1)).alias("holders"))
    voters = few.groupBy("grp").agg(F.sum("_r").alias("voters"))
    most = votes.join(voters, "grp").where("2 * votes > voters or holders > 1").withColumn("_m", F.expr("2 * votes > voters"))
    ref = most.groupBy("grp").agg(
        F.array_sort(F.collect_list(F.when(F.col("_m"), F.col("t")))).alias("ref"),
        F.sort_array(F.collect_list(F.when(~F.col("_m"), F.struct("holders", "t"))), asc=False).alias("often"))
    none = F.array().cast("array<bigint>")
    return voters.join(ref, "grp", "left").select(
        "grp", F.coalesce("ref", none).alias("ref"), F.coalesce(F.slice("often", 1, ORDERED)["t"], none).alias("often"))


def places(tokens: np.ndarray, often: np.ndarray) -> np.ndarray:
    """0 for tokens that aren't among ``often``, else the higher the further ahead they stand there."""
    if not len(often):
        return np.zeros(len(tokens), np.int64)
    order = np.argsort(often)
    at = order[np.minimum(np.searchsorted(often, tokens, sorter=order), len(often) - 1)]
    return np.where(often[at] == tokens, len(often) - at, 0)


def differences(members: DataFrame, sets: DataFrame, expensive: Expensive, percent: int) -> DataFrame:
    """grp, node, n, d, own, tokens: each member's differences from its group's reference - their number,
    how many of them the reference lacks, and as many as a prefix can need, in an order that
    is the same for the whole group.

    ``sets`` are whole and prepared by ``expensive``.
    """
    read = expensive.reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 512):
            ds, owns, tokens = [], [], []
            for n, mine, costly, theirs, often in zip(part.column("n").to_pylist(), part.column("tokens"), read(part),
                                                      part.column("ref"), part.column("often")):
                x, y = mine.values.to_numpy(), theirs.values.to_numpy()
                lacking = ~np.isin(x, y, assume_unique=True)
                missing = np.setdiff1d(y, x, assume_unique=True)
                rare_first = np.lexsort((costly[lacking], places(x[lacking], often.values.to_numpy())))
                ordered = np.concatenate([x[lacking][rare_first], missing])
                ds.append(len(ordered))
                owns.append(int(lacking.sum()))
                tokens.append(ordered[:(100 - percent) * n // percent + 2])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("grp", "node", "n")), pa.array(ds, pa.int64()), pa.array(owns, pa.int64()),
                 pa.array(tokens, pa.list_(pa.int64()))], ["grp", "node", "n", "d", "own", "tokens"])

    return members.join(sets, "node").join(references(members, sets), "grp").mapInArrow(
        run, "grp bigint, node binary, n bigint, d bigint, own bigint, tokens array<bigint>")


def certain_links(diff: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) links of members to their group's member of least f, and ``diff`` with f
    and ``least`` (minus that least f), both times (100 + percent)."""
    f = F.col("d") * (100 + percent) - F.col("n") * (100 - percent)
    rows = diff.withColumn("f", f)
    best = rows.groupBy("grp").agg(F.min(F.struct("f", "node")).alias("_b"))
    rows = rows.join(best, "grp").select(
        "grp", "node", "n", "d", "own", "tokens", "f", (-F.col("_b.f")).alias("least"), F.col("_b.node").alias("best"))
    links = rows.where((F.col("f") <= F.col("least")) & (F.col("node") != F.col("best")))
    return links.select(F.least("node", "best").alias("a"), F.greatest("node", "best").alias("b")).distinct(), rows


def listed(rows: DataFrame, of_node: DataFrame, percent: int) -> DataFrame:
    """grp, t, band, probe, node, n, f, c, reach: the differences by which members can meet a member of
    another component (c).  A partner with an f above ``reach`` must agree in more differences than
    follow from here on, so a pair's first common difference is within the reach of both.

    Of a pair the one with the larger f probes; it isn't linked to the member of least f, so its f
    is above ``least``.  It probes with as many differences as its least agreement allows, the
    other is indexed by as many as its own allows.  Differences that the reference lacks have no
    band; those it has stand in the bands of f of the partners that may share nothing else.
    """
    unit = 100 + percent  # f and least are in these units, agreement in two of them
    f, least, d, n, own = (F.col(c) for c in ("f", "least", "d", "n", "own"))
    above = F.greatest(f, least + 1)
    share = F.greatest(F.lit(1), F.ceil((f + above) / (2.0 * unit) - 1e-6))
    nearest = d * unit - n * ((100 - percent) * (1 + 200.0 / percent))
    asked = F.greatest(F.lit(1), F.ceil((f + F.greatest(-least, nearest)) / (2.0 * unit) - 1e-6))
    # The largest f of a partner with which all agreement can lie in the reference's shingles.
    cap = (d - own) * (2 * unit) - f
    r = rows.join(of_node, "node", "left").withColumn("c", F.coalesce("component", "node")).withColumn(
        "cap", cap).withColumn("above", above)
    # Groups whose members are in one component already have nothing to find.
    span = r.groupBy("grp").agg(F.greatest(F.lit(unit), F.ceil((F.max("cap") + F.max("least")) / BANDS)).alias("wide"),
                                F.min("c").alias("_c"), F.max("c").alias("_d")).where("_c != _d")
    r = cut(r.join(span.select("grp", "wide"), "grp"), "join-open")

    def rows_of(agree: Column, probe: bool, bands: Column) -> DataFrame:
        length = F.greatest(F.lit(0), d - agree + 1)
        at = F.least(length, F.size("tokens")).cast("int")
        mine = F.transform(F.slice("tokens", F.lit(1), at), lambda t, i: F.struct(
            t.alias("t"), (i < own).alias("lacked"), ((d - i) * (2 * unit) - f).alias("reach")))
        flat = r.where(f > least) if probe else r
        flat = flat.select("grp", "node", "n", "f", "c", bands.alias("bands"), F.explode(mine).alias("m"))
        every = F.when(F.col("m.lacked"), F.array(F.lit(None).cast("bigint"))).otherwise(F.col("bands"))
        return flat.select("grp", F.col("m.t").alias("t"), F.explode(every).alias("band"), F.lit(probe).alias("probe"),
                           "node", "n", "f", "c", F.col("m.reach").alias("reach"))

    none = F.array().cast("array<bigint>")
    to = F.when(F.col("cap") >= F.col("above"), F.sequence(
        F.floor(F.col("above") / F.col("wide")), F.floor(F.col("cap") / F.col("wide")))).otherwise(none)
    mine = F.when(F.col("cap") >= -least, F.array(F.floor(f / F.col("wide")))).otherwise(none)
    out = rows_of(share, False, to).unionByName(rows_of(asked, True, mine))
    return out.withColumn("band", F.coalesce("band", F.lit(-(1 << 60))))


def met(rows: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs of the given lists (grp, t, band, k: their length), those in which both name the
    same longest list only from that list."""
    key = ["grp", "t", "band"]
    own = Window.partitionBy("grp", "node", "probe")
    mine = cut(rows.join(lists, key).withColumn("longest", F.max(F.struct("k", "t", "band")).over(own)).withColumn(
        "here", (F.col("longest.t") == F.col("t")) & (F.col("longest.band") == F.col("band"))).drop("k"), "join-met")
    x, y = mine.where("not probe").alias("x"), mine.where("probe").alias("y")
    once = F.col("x.here") | (F.col("x.longest") != F.col("y.longest"))
    j = x.join(y, key).where(once & (F.col("x.c") != F.col("y.c")) & (F.col("x.f") <= F.col("y.f"))).where(
        _length_ok(F.col("x.n"), F.col("y.n"), percent))
    return j.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def facing(rows: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The rows in ``lists`` that can have a partner on the list's other side, as far as the extremes of
    that side's f, n and c tell."""
    probe = F.col("probe")

    def other(side: str) -> Column:
        near = (F.col("n") * 100 >= F.col(f"{side}_n0") * percent) & (F.col(f"{side}_n1") * 100 >= F.col("n") * percent)
        alone = (F.col(f"{side}_c0") == F.xxhash64("c")) & (F.col(f"{side}_c1") == F.xxhash64("c"))
        return near & ~alone

    f, reach = F.col("f"), F.col("reach")
    met_by = F.when(probe, other("i") & (F.col("i_f0") <= F.least(f, reach))).otherwise(
        other("p") & (F.col("p_f1") >= f) & (F.col("p_f0") <= reach))
    return rows.join(lists, ["grp", "t", "band"]).where(met_by).select(*rows.columns).drop("reach")


def meetings(rows: DataFrame, common: int, last: bool, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b pairs of the lists with at most ``common`` members on a side or ``LIST`` in all; grp, node
    of the groups that the longer lists become).  ``last``: the pairs of all lists."""
    key = ["grp", "t", "band"]

    def side(name: str, mine: Column) -> list[Column]:
        n, c, f = (F.when(mine, x) for x in (F.col("n"), F.xxhash64("c"), F.col("f")))
        return [F.min(n).alias(f"{name}_n0"), F.max(n).alias(f"{name}_n1"),
                F.min(c).alias(f"{name}_c0"), F.max(c).alias(f"{name}_c1"),
                F.min(f).alias(f"{name}_f0"), F.max(f).alias(f"{name}_f1")]

    # One component on both sides, or no f of a prober that reaches the least one listed: nothing to find.
    lists = cut(rows.groupBy(*key).agg(*side("i", ~F.col("probe")), *side("p", F.col("probe"))).where(
        "i_f0 <= p_f1 and (i_c0 != p_c1 or i_c1 != p_c0)"), "join-lists")
    near = cut(facing(rows, lists, percent), "join-facing")
    count = lambda mine: F.sum(mine.cast("int"))
    sizes = near.groupBy(*key).agg(
        count(~F.col("probe")).alias("i"), count(F.col("probe")).alias("p"), F.bit_xor(F.xxhash64("node", "probe")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "node", "probe")).alias("y")).where("i > 0 and p > 0")
    # Copies share whole passages: of a group's lists with the same members (by 128 bits of hash) one is enough.
    one = sizes.groupBy("grp", "i", "p", "x", "y").agg(F.min(F.struct("t", "band")).alias("_o"))
    k = F.col("i") + F.col("p")
    lists = cut(one.select("grp", "_o.t", "_o.band", k.alias("k"), (
        (F.least("i", "p") <= common) | (k <= LIST) | F.lit(last)).alias("short")), "join-lists")
    pairs = met(near, lists.where("short").drop("short"), percent).distinct()
    longer = lists.where("not short").select(*key)
    return pairs, near.join(longer, key).select(F.xxhash64(*key).alias("grp"), "node").distinct()


def whole_sets(nodes: DataFrame, docs: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """node, n, tokens: whole sets of the given nodes, made again from one text of each."""
    wanted = cut(reps.join(nodes, "node").select(F.col("rep").alias("doc_id")).distinct(), "join-wanted")
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").join(ids, "doc_id", "left_semi")
    return cut(sets_of(texts, width, percent, whole=True).where("n > 0").dropDuplicates(["node"]).select(
        "node", "n", "tokens"), "join-sets")


def group_links(members: DataFrame, whole: DataFrame, links: DataFrame, expensive: Expensive, common: int,
                percent: int, rounds: int = ROUNDS) -> DataFrame:
    """``links`` and those that join the components of the groups' members (grp, node)."""
    for k in range(rounds):
        members = widest(members)
        if members.isEmpty():
            break
        certain, rows = certain_links(cut(differences(members, whole, expensive, percent), "join-differences"), percent)
        links = cut(links.unionByName(certain), "join-links")
        near = listed(cut(rows, "join-differences"), components(links).toDF("node", "component"), percent)
        pairs, members = meetings(cut(near, "join-listed"), common, k == rounds - 1, percent)
        links = links.unionByName(cut(verify(cut(pairs, "join-pairs"), whole, percent), "join-links"))
    return links


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs that link, by their whole sets."""
    own = sets.select("node", "n", "tokens")
    j = pairs.join(own.toDF("a", "na", "sa"), "a").join(own.toDF("b", "nb", "sb"), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return j.where(both * 100 >= (F.col("na") + F.col("nb") - both) * percent).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, common: int = 16,
                    matches: int = 2, bitmap_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, n_shingles, component_id for every document (doc_id, text)."""
    sets = cut(sets_of(docs, width, percent), "join-sets")
    named = sets.where("n > 0 and doc_id is not null")
    expensive = Expensive(named, common, bitmap_bytes)
    marked = expensive.prepare(named)
    reps = cut(named.groupBy("node").agg(F.min("doc_id").alias("rep")), "join-nodes")
    pairs = cut(cheap_pairs(prefix_rows(marked, expensive, percent, matches, heavy=False), percent), "join-pairs")
    links = cut(verify(pairs, whole_sets(_ends(pairs), docs, reps, width, percent), percent), "join-links")
    heavy = cut(prefix_rows(marked, expensive, percent, matches, heavy=True).select("t", "node").distinct(), "join-heavy")
    if not heavy.isEmpty():
        whole = expensive.prepare(whole_sets(heavy.select("node").distinct(), docs, reps, width, percent))
        links = group_links(cut(leader_pairs(heavy), "join-leaders"), whole, links, expensive, common, percent)
    parts = components(links)
    named = parts.join(reps.toDF("id", "rep"), "id")
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_node = named.join(smallest, "component").select(F.col("id").alias("node"), "component_id")
    own = reps.join(of_node, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    return sets.select("doc_id", "n", "node").join(own, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word shingles and a Jaccard similarity of 0.9."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=90)
