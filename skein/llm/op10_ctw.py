"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

A text is scored as the byte string of its lower-cased words, one blank between
them and a line feed behind the last.  Each byte is eight binary decisions; each
decision has its own context tree over the ``depth`` bytes before it.  A node
holds the zeros and ones seen in its context; with the Krichevsky-Trofimov block
probability Pe, the weighted probability is Pw = Pe at full depth and
Pw = (Pe + prod Pw(children)) / 2 above.  The trained model predicts with the
mixture those weights define: a node stops with weight Pe / (2 Pw) and otherwise
asks the deeper context.  A context never seen predicts as its parent.

Counting: every task counts its (context, byte) pairs and words, Spark sums
them.  The distinct codes are dealt by their context's nearest three bytes, so that
whole subtrees meet: a bucket computes its levels in arrays, the deepest
first, and hands up only the counts and weights of its three-byte contexts.
The levels above (at most 256 ** 3 contexts) are Spark aggregates of the level below,
and their predictions come back by joins; the buckets then finish the prediction of every
distinct code of the corpus, held-out texts included.  No context is dropped; a
code is shuffled twice and only three-byte contexts are written.  At most
``top_codes`` codes, the most frequent, are broadcast; a text's other codes are looked
up by a join, so the tree may grow with the corpus.

Beside it a word unigram base: log10((c + 0.5) / (N + 0.5 (V + 1))) per token.
At most ``top_words`` words, the most frequent, are broadcast; all other words are
looked up by a join, so the vocabulary may grow with the corpus.

Defined results
* null or empty text: the end token alone; a null doc_id belongs to training;
* repeated rows are counted and scored as often as they occur, one result each;
* without training documents every decision has probability 1/2 and the base is 1;
* an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import cut, slices, table

#: Distinct words and codes that a task holds before it hands them over.
FLUSH_WORDS, FLUSH_CODES = 200_000, 800_000
#: Texts whose codes are listed at once.
SLICE = 256
#: The end token in the table of words; no word holds a blank.
END = " "


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 5; 0 for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def byte_codes(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, starts): for each byte its ``depth`` predecessors, nearest first, and itself.

    code = c1 << 8 depth | c2 << 8 (depth - 1) | ... | byte; before a text stand line feeds.
    """
    pad = b"\n" * depth
    joined = np.frombuffer(pad + pad.join(texts), dtype=np.uint8).astype(np.int64)
    n = len(joined)
    codes = joined[depth:].copy()
    for d in range(1, depth + 1):
        codes |= joined[depth - d:n - d] << (8 * (depth + 1 - d))
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + depth)[:-1]])
    keep = np.ones(len(codes), dtype=bool)
    for d in range(depth):
        keep[(starts[1:] - 1 - d)] = False
    return codes[keep], np.concatenate([[0], np.cumsum(lengths)[:-1]])


def _stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + b"\n"


def _counts(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        codes: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def add(texts: list[bytes], weight: int) -> None:
            if texts:
                uniq, n = _unique(byte_codes(texts, depth)[0])
                codes.append(uniq)
                times.append(n * weight)
            if sum(map(len, codes)) > FLUSH_CODES:
                merge()

        def merge() -> None:
            uniq, n = _sums(np.concatenate(codes), np.concatenate(times))
            codes[:], times[:] = [uniq], [n]

        def hand_over() -> Iterator[pa.RecordBatch]:
            if words:
                keys, ns = zip(*words.items())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.decode("utf-8", "replace") for k in keys], pa.string()),
                     pa.nulls(len(keys), pa.int64()), pa.array(ns, pa.int64())], ["word", "code", "n"])
                words.clear()
            if codes:
                merge()
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(codes[0]), pa.string()), pa.array(codes[0]), pa.array(times[0])],
                    ["word", "code", "n"])
                codes.clear()
                times.clear()

        for part in slices(batches, SLICE):
            texts, asked = [], []
            for text, held in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = (text or "").encode("utf-8", "replace").lower().split()
                if held:
                    asked.append(_stream(own))
                else:
                    words.update(own)
                    texts.append(_stream(own))
            if texts:
                words[END.encode()] += len(texts)
            add(texts, 1)
            add(asked, 0)
            if len(words) > FLUSH_WORDS or sum(map(len, codes)) > FLUSH_CODES * 3 // 4:
                yield from hand_over()
        yield from hand_over()

    return run


def _unique(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inverse, uniq = pd.factorize(codes)
    return uniq, np.bincount(inverse, minlength=len(uniq)).astype(np.int64)


def count_corpus(docs: DataFrame, depth: int, held_out: Column | None = None) -> DataFrame:
    """word or code, n: all words (and ends) and all (context, byte) codes of the training texts.

    Codes that only ``held_out`` texts have come with n = 0.
    """
    held_out = F.lit(False) if held_out is None else held_out
    parts = docs.select("text", held_out.alias("_held")).mapInArrow(
        _counts(depth), "word string, code bigint, n bigint")
    return cut(parts.groupBy("word", "code").agg(F.sum("n").alias("n")), "ctw-counts")


def log_gamma(x):
    """Natural log of gamma for x >= 1/2 to about 1e-9: Stirling's series at x + 6, stepped down.

    For a column, or for an array of numbers.
    """
    log = F.log if isinstance(x, Column) else np.log
    y = x + 6.0
    stirling = (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12.0 * y) - 1 / (
        360.0 * y * y * y) + 1 / (1260.0 * y * y * y * y * y)
    return stirling - log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def log_estimate(a, b):
    """Natural log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


class Level:
    """The decisions of all contexts of one length: ``key`` = context << 8 | node, ascending, where a node
    is the byte's leading bits behind a leading one; their zeros, ones and log weight ``pw``;
    the weight ``stop`` with which each predicts by itself, and ``go``, the rest."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deep: np.ndarray | None):
        self.key, self.zeros, self.ones = key, zeros, ones
        pe = log_estimate(zeros.astype(np.float64), ones.astype(np.float64))
        if deep is None:
            self.pw, self.stop, self.go = pe, np.ones(len(key)), np.zeros(len(key))
        else:
            self.pw = np.logaddexp(pe, deep) - math.log(2)
            # Each weight from its own exponent: neither is formed as one minus the other.
            with np.errstate(over="ignore"):
                self.stop, self.go = 1 / (1 + np.exp(deep - pe)), 1 / (1 + np.exp(pe - deep))

    def down(self, zero, one, rest, p_zero, p_one) -> tuple[np.ndarray, ...]:
        """What these contexts and those above have said, from what those above have: the mixtures
        so far, the weight left, and the prediction of the deepest context with observations."""
        seen = self.zeros + self.ones
        kt_zero, kt_one = (self.zeros + 0.5) / (seen + 1.0), (self.ones + 0.5) / (seen + 1.0)
        return (zero + rest * self.stop * kt_zero, one + rest * self.stop * kt_one, rest * self.go,
                np.where(seen > 0, zero + rest * kt_zero, p_zero), np.where(seen > 0, one + rest * kt_one, p_one))


def _decision(codes: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, bit) of the i-th decision of every code in its longest context."""
    byte = codes & 255
    return (codes >> 8 << 8) | (1 << i) | (byte >> (8 - i)), (byte >> (7 - i)) & 1


def _sums(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, ascending, and the sums of the values at each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return [key[first], *(np.add.reduceat(v[order], first) if len(key) else v for v in values)]


def _parent(key: np.ndarray) -> np.ndarray:
    return (key >> 16 << 8) | (key & 255)


def lower_levels(codes: np.ndarray, n: np.ndarray, depth: int, split: int) -> list[Level]:
    """Levels ``split`` to ``depth`` of the codes (ascending, distinct) of whole contexts of length ``split``."""
    parts = []
    for i in range(8):
        key, bit = _decision(codes, i)
        # Codes ascend, so the keys of one decision do.
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        parts.append([key[first], np.add.reduceat((1 - bit) * n, first), np.add.reduceat(bit * n, first)])
    out = [Level(*_sums(*(np.concatenate(x) for x in zip(*parts))), None)]
    for _ in range(depth - split):
        below = out[0]
        out.insert(0, Level(*_sums(_parent(below.key), below.zeros, below.ones, below.pw)))
    return out


def _grouped(codes: DataFrame, depth: int, split: int, bucket_codes: int) -> DataFrame:
    """The codes with the bucket of their context of length ``split``: its codes stay together."""
    buckets = max(1, -(-codes.count() // bucket_codes))
    ctx = F.shiftright("code", 8 * (depth - split) + 8)
    return codes.select("code", "n", F.pmod(F.xxhash64(ctx), F.lit(buckets)).cast("int").alias("bucket"))


def upper_state(lower: DataFrame, split: int) -> DataFrame:
    """bucket, key, zero, one, rest, p_zero, p_one: what the contexts shorter than ``split`` say on
    every decision of level ``split`` (bucket, key, zeros, ones, pw).

    The levels are aggregates of the level below; the predictions go back down by joins.
    """
    node = F.col("key").bitwiseAND(F.lit(255))
    a, b, rest = F.col("zeros"), F.col("ones"), F.col("rest")
    level = lower.select(F.shiftright("key", 8).alias("ctx"), node.alias("node"), "zeros", "ones", "pw")
    levels: list[DataFrame] = []
    for d in range(split - 1, -1, -1):
        up = level.groupBy(F.shiftright("ctx", 8).alias("ctx"), "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("pw").alias("deep"))
        up = up.withColumn("pe", log_estimate(a, b))
        top = F.greatest("pe", "deep")
        pw = top + F.log(F.exp(F.col("pe") - top) + F.exp(F.col("deep") - top)) - math.log(2)
        level = cut(up.select("ctx", "node", "zeros", "ones", pw.alias("pw"),
                              (1 / (1 + F.exp(F.col("deep") - F.col("pe")))).alias("stop"),
                              (1 / (1 + F.exp(F.col("pe") - F.col("deep")))).alias("go")), f"ctw-level{d}")
        levels.insert(0, level)
    start = {"zero": 0.0, "one": 0.0, "rest": 1.0, "p_zero": 0.5, "p_one": 0.5}
    kt = {"zero": (a + 0.5) / (a + b + 1.0), "one": (b + 0.5) / (a + b + 1.0)}
    above = None
    for level in levels:
        own = level.withColumn("up", F.shiftright("ctx", 8))
        if above is None:
            met = own.select("*", *[F.lit(v).alias(k) for k, v in start.items()])
        else:
            met = own.join(above.withColumnRenamed("ctx", "up"), ["up", "node"])
        seen = a + b > 0
        above = met.select(
            "ctx", "node", *[(F.col(x) + rest * F.col("stop") * kt[x]).alias(x) for x in kt],
            (rest * F.col("go")).alias("rest"),
            *[F.when(seen, F.col(x) + rest * kt[x]).otherwise(F.col("p_" + x)).alias("p_" + x) for x in kt])
    mine = lower.select("bucket", "key", F.shiftright("key", 16).alias("ctx"), node.alias("node"))
    if above is None:
        return mine.select("bucket", "key", *[F.lit(v).alias(k) for k, v in start.items()])
    return mine.join(above, ["ctx", "node"]).select("bucket", "key", *start)


def code_probabilities(codes: DataFrame, depth: int, split: int = 3, bucket_codes: int = 300_000) -> DataFrame:
    """code, n, log10: the probability of every code's byte in its context, by the whole tree of
    the codes (code, n); codes with n = 0 are predicted, and count for nothing.

    The levels from ``split`` down are computed per bucket of whole contexts of that
    length, in arrays; those above, at most 256 ** ``split`` contexts, by Spark aggregates and joins.
    """
    split = min(split, depth)
    grouped = cut(_grouped(codes, depth, split, bucket_codes), "ctw-grouped")

    def sorted_codes(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        code, n = t.column("code").to_numpy(), t.column("n").to_numpy()
        order = np.argsort(code)
        return code[order], n[order]

    def up(t: pa.Table) -> pa.Table:
        top = lower_levels(*sorted_codes(t), depth, split)[0]
        bucket = np.full(len(top.key), t.column("bucket")[0].as_py(), np.int32)
        return pa.table({"bucket": bucket, "key": top.key, "zeros": top.zeros, "ones": top.ones, "pw": top.pw})

    def down(t: pa.Table, state: pa.Table) -> pa.Table:
        code, n = sorted_codes(t)
        levels = lower_levels(code, n, depth, split)
        order = np.argsort(state.column("key").to_numpy())
        said = [state.column(c).to_numpy()[order] for c in ("zero", "one", "rest", "p_zero", "p_one")]
        for k, level in enumerate(levels):
            if k:
                at = np.searchsorted(levels[k - 1].key, _parent(level.key))
                said = [v[at] for v in said]
            said = list(level.down(*said))
        total = np.zeros(len(code))
        for i in range(8):
            key, bit = _decision(code, i)
            at = np.searchsorted(levels[-1].key, key)
            total += np.log10(np.where(bit == 1, said[4][at], said[3][at]))
        return pa.table({"code": code, "n": n, "log10": total})

    lower = cut(grouped.groupBy("bucket").applyInArrow(
        up, "bucket int, key bigint, zeros bigint, ones bigint, pw double"), "ctw-lower")
    state = upper_state(lower, split)
    return cut(grouped.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(
        down, "code bigint, n bigint, log10 double"), "ctw-codes")


class Known:
    """The probabilities of the broadcast codes; NaN for any other code."""

    def __init__(self, depth: int, codes: pa.Table):
        self.depth = depth
        code, value = (codes.column(c).to_numpy() for c in ("code", "log10"))
        order = np.argsort(code)
        self.code, self.value = code[order], value[order]

    def log10(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.code):
            return np.full(len(codes), np.nan)
        at = np.minimum(np.searchsorted(self.code, codes), len(self.code) - 1)
        return np.where(self.code[at] == codes, self.value[at], np.nan)


def least_count(df: DataFrame, count: Column, most: int) -> float:
    """The smallest threshold 2^(k/4) that at most ``most`` rows' counts reach, from exact
    counts per quarter power: no sort, and nothing but the histogram leaves the executors."""
    k = F.floor(F.log2(count) * 4 + 1e-9)
    sizes = df.groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    kept = 0
    for k, n in sorted(((r["k"], r["n"]) for r in sizes), reverse=True):
        kept += n
        if kept > most:
            return 2.0 ** ((k + 1) / 4) * (1 - 1e-9)
    return 0.0


def score(docs: DataFrame, depth: int = 5, top_words: int = 200_000, top_codes: int = 2_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    # The row number of the scan keeps rows of equal ids apart (a scan gives it again on a retry).
    d = docs.select(F.col("doc_id").cast("bigint"), "text", (fold_of(F.col("doc_id")) == 1).alias("held_out"),
                    F.monotonically_increasing_id().alias("row"))
    counts = count_corpus(d, depth, F.col("held_out"))
    words = counts.where("word is not null").select("word", F.col("n").alias("c"))
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    norm = math.log10(total + 0.5 * (distinct + 1))
    top = words.where(F.col("c") >= least_count(words, F.col("c"), top_words))
    frequent = {r["word"].encode(): math.log10(r["c"] + 0.5) - norm for r in top.toLocalIterator()}
    unseen = math.log10(0.5) - norm
    codes = code_probabilities(counts.where("code is not null").select("code", "n"), depth)
    # n + 1, so that codes of held-out texts alone have a place in the histogram too.
    often = F.col("n") + 1 >= least_count(codes, F.col("n") + 1, top_codes)
    best = Known(depth, codes.where(often).select("code", "log10").toArrow())
    others = codes.where(~often).select(F.col("code").alias("_code"), "log10")
    shared = spark.sparkContext.broadcast((best, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value
        end = END.encode()
        for part in slices(batches, SLICE):
            ids, _, held, at = (c.to_pylist() for c in part.columns)
            rows, texts = [], []
            tail: list[tuple] = []
            for k, text in enumerate(part.column(1).to_pylist()):
                own = (text or "").encode("utf-8", "replace").lower().split()
                texts.append(_stream(own))
                found = list(map(known.get, own))
                found.append(known.get(end))
                rare = found.count(None)
                base = sum(x for x in found if x is not None) if rare else sum(found)
                if rare:
                    tf = Counter(w for w, x in zip(own, found) if x is None)
                    if found[-1] is None:
                        tf[end] += 1
                    tail += [(k, w.decode("utf-8", "replace"), n) for w, n in tf.items()]
                rows.append((len(own) + 1, len(own) + 1 - rare, base))
            codes, starts = byte_codes(texts, model.depth)
            inverse, uniq = pd.factorize(codes)
            value = model.log10(uniq)
            rest = np.isnan(value)
            bits = np.add.reduceat(np.where(rest, 0.0, value)[inverse], starts)
            # Codes that are not broadcast: one row per text and code.
            where = np.flatnonzero(rest[inverse])
            owner = np.searchsorted(starts, where, side="right") - 1
            pairs, n = _unique(owner * len(uniq) + inverse[where])
            c_at, c_code = pairs // max(1, len(uniq)), uniq[pairs % max(1, len(uniq))]
            n_tokens, n_known, base = zip(*rows)
            t_at, t_words, t_n = zip(*tail) if tail else ((), (), ())
            t, c = len(tail), len(pairs)
            who = [*range(len(rows)), *t_at, *c_at.tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[k] for k in who], pa.int64()), pa.array([at[k] for k in who], pa.int64()),
                pa.array([held[k] for k in who], pa.bool_()),
                pa.array([None] * len(rows) + list(t_words) + [None] * c, pa.string()),
                pa.array([None] * (len(rows) + t) + c_code.tolist(), pa.int64()),
                pa.array([0] * len(rows) + list(t_n) + n.tolist(), pa.int64()),
                pa.array([*n_tokens, *[0] * (t + c)], pa.int64()), pa.array([*n_known, *[0] * (t + c)], pa.int64()),
                pa.array([*base, *[0.0] * (t + c)], pa.float64()), pa.array([*bits, *[0.0] * (t + c)], pa.float64()),
                pa.array([len(x) for x in texts] + [0] * (t + c), pa.int64()),
            ], ["doc_id", "row", "held_out", "word", "code", "tf", "n_tokens", "n_known", "base", "score", "bytes"])

    # Written once: the three branches below read it, and the texts are scored once.
    parts = cut(d.mapInArrow(run, "doc_id bigint, row bigint, held_out boolean, word string, code bigint, tf bigint, "
                                  "n_tokens bigint, n_known bigint, base double, score double, bytes bigint"),
                "ctw-parts")
    own = parts.where("word is null and code is null")
    tails = parts.where("word is not null").join(words.withColumnRenamed("word", "_w"), F.col("word") == F.col("_w"), "left")
    c = F.coalesce("c", F.lit(0))
    of_word = F.col("tf") * F.when(c > 0, F.log10(c + 0.5) - norm).otherwise(unseen)
    sums = ["n_tokens", "n_known", "base", "score", "bytes"]
    keys = ["row", "doc_id", "held_out"]
    tails = tails.select(*keys, "n_tokens", F.when(c > 0, F.col("tf")).otherwise(0).alias("n_known"),
                         of_word.alias("base"), "score", "bytes")
    # Every code of every text is in the table, so the inner join loses none.
    deep = parts.where("code is not null").join(others, F.col("code") == F.col("_code")).select(
        *keys, "n_tokens", "n_known", "base", (F.col("tf") * F.col("log10")).alias("score"), "bytes")
    out = own.select(*keys, *sums).unionByName(tails).unionByName(deep).groupBy(*keys).agg(
        *[F.sum(x).alias(x) for x in sums])
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
        (-F.col("score") / math.log10(2) / F.col("bytes")).alias("bits_per_byte"))


def op10_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; train on those outside the held-out fold."""
    return score(table(spark, sf_dir, "documents", spread=False))
