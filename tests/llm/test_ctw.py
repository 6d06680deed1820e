import functools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import op10_ctw as C
from tests.conftest import SF001
from tests.llm.helpers import docs, prose


def tokens(text):
    return (text or "").encode().lower().split()


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def test_codes_hold_each_byte_and_its_context():
    codes, starts = C.byte_codes([b"ab\n", b"\n", b"xyz\n"], 2)
    want = []
    for t in (b"ab\n", b"\n", b"xyz\n"):
        p = b"\n\n" + t
        want += [p[i - 1] << 16 | p[i - 2] << 8 | p[i] for i in range(2, len(p))]
    assert codes.tolist() == want and starts.tolist() == [0, 3, 4]


def test_log_gamma(spark):
    xs = [0.5, 1.0, 1.5, 2.5, 10.5, 1e3, 1e7 + 0.5]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(C.log_gamma(F.col("x"))).collect()]
    assert got == pytest.approx([math.lgamma(x) for x in xs], rel=1e-8, abs=1e-8)


class Plain:
    """Context-tree weighting by its definition, one decision's tree at a time."""

    def __init__(self, texts, depth):
        self.depth, self.count = depth, Counter()
        for t in texts:
            p = b"\n" * depth + t
            for i in range(depth, len(p)):
                past = tuple(reversed(p[i - depth:i]))
                for k in range(8):
                    node, bit = (1 << k) | (p[i] >> (8 - k)), (p[i] >> (7 - k)) & 1
                    for d in range(depth + 1):
                        self.count[past[:d], node, bit] += 1

    def pe(self, ctx, node):
        a, b = self.count[ctx, node, 0], self.count[ctx, node, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def pw(self, ctx, node):
        if not (self.count[ctx, node, 0] + self.count[ctx, node, 1]):
            return 0.0
        if len(ctx) == self.depth:
            return self.pe(ctx, node)
        deep = sum(self.pw((*ctx, c), node) for c in range(256) if self.count[(*ctx, c), node, 0] + self.count[(*ctx, c), node, 1])
        return np.logaddexp(self.pe(ctx, node), deep) - math.log(2)

    def bit(self, past, node, bit):
        p = None
        for d in range(self.depth, -1, -1):
            ctx = past[:d]
            a, b = self.count[ctx, node, 0], self.count[ctx, node, 1]
            if not a + b:
                continue
            kt = ((b if bit else a) + 0.5) / (a + b + 1)
            stop = 1.0 if d == self.depth else math.exp(self.pe(ctx, node) - math.log(2) - self.pw(ctx, node))
            p = stop * kt + (1 - stop) * (kt if p is None else p)
        return 0.5 if p is None else p

    def log10(self, text):
        p, total = b"\n" * self.depth + text, 0.0
        for i in range(self.depth, len(p)):
            past = tuple(reversed(p[i - self.depth:i]))
            for k in range(8):
                total += math.log10(self.bit(past, (1 << k) | (p[i] >> (8 - k)), (p[i] >> (7 - k)) & 1))
        return total


ROWS = [(i, prose(i, 3 + i % 9)) for i in range(25)] + [(100, None), (101, ""), (102, "Zq 日本 zq"), (103, " \n"), (None, "alpha"), (7, prose(7, 4)), (7, prose(7, 4))]


@pytest.fixture(scope="module")
def scored(spark):
    return C.score(docs(spark, ROWS), depth=2, top_words=5).collect()


def test_scores_equal_the_definition(scored):
    model = Plain([b" ".join(tokens(t)) + b"\n" for i, t in ROWS if not held_out(i)], 2)
    want = sorted((i is None, i, model.log10(b" ".join(tokens(t)) + b"\n")) for i, t in ROWS)
    got = sorted((r.doc_id is None, r.doc_id, r.score) for r in scored)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], rel=1e-5)


def test_base_equals_the_definition(scored):
    count = Counter()
    for i, t in ROWS:
        if not held_out(i):
            count.update([*tokens(t), None])
    total, distinct = sum(count.values()), len(count)
    want = {}
    for i, t in ROWS:
        own = [*tokens(t), None]
        want[i, len(own)] = (held_out(i), sum(count[w] > 0 for w in own),
                             sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own))
    assert len(scored) == len(ROWS)
    for r in scored:
        h, known, base = want[r.doc_id, r.n_tokens]
        assert (r.held_out, r.n_known, r.train_tokens) == (h, known, total) and r.base_score == pytest.approx(base)


@pytest.mark.parametrize("bucket_codes", [300_000, 40])
def test_probabilities_of_a_context_sum_to_one(spark, bucket_codes):
    counts = C.count_corpus(docs(spark, ROWS), 3).where("code is not null").select("code", "n")
    asked = [ctx[0] << 24 | ctx[1] << 16 | ctx[2] << 8 | b for ctx in (b"\n\n\n", b"eht", b"\xff\x00q", b"a \n") for b in range(256)]
    more = spark.createDataFrame([(c, 0) for c in asked], "code bigint, n bigint")
    whole = counts.unionByName(more).groupBy("code").agg(F.sum("n").alias("n"))
    got = {r.code: r.log10 for r in C.code_probabilities(whole, 3, bucket_codes=bucket_codes).collect()}
    assert len(got) == whole.count()
    for k in range(0, len(asked), 256):
        assert sum(10 ** got[c] for c in asked[k:k + 256]) == pytest.approx(1.0, rel=1e-9)


@pytest.mark.parametrize("split", [0, 1, 2, 3])
def test_where_the_tree_is_split_changes_nothing(spark, split):
    counts = C.count_corpus(docs(spark, ROWS), 3).where("code is not null").select("code", "n")
    want = {r.code: r.log10 for r in C.code_probabilities(counts, 3).collect()}
    got = {r.code: r.log10 for r in C.code_probabilities(counts, 3, split=split, bucket_codes=100).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_without_training_rows_and_empty(spark):
    only = [(i, "a b") for i in range(40) if held_out(i)]
    for r in C.score(docs(spark, only), depth=2).collect():
        assert r.train_tokens == 0 and r.base_score == 0 and r.score == pytest.approx(4 * 8 * math.log10(0.5))
    assert C.score(docs(spark, ROWS).limit(0)).count() == 0


def test_held_out_texts_are_predicted(spark):
    out = C.op10_ctw(spark, SF001).where("held_out").agg(F.sum("score"), F.sum("bits_per_byte") / F.count("*"), F.count("*")).first()
    assert out[2] > 10 and out[1] < 3.2  # far below 8 bits, and below an order-0 model's 4


class Quick(Plain):
    pw = functools.cache(Plain.pw)


def test_no_context_is_dropped_however_few_codes_are_broadcast(spark):
    """Scores by the whole tree, held-out codes included, whether codes are broadcast or joined."""
    model = Quick([b" ".join(tokens(t)) + b"\n" for i, t in ROWS if not held_out(i)], 3)
    want = sorted((i is None, i, model.log10(b" ".join(tokens(t)) + b"\n")) for i, t in ROWS)
    for most in (0, 50):
        got = sorted((r.doc_id is None, r.doc_id, r.score)
                     for r in C.score(docs(spark, ROWS), depth=3, top_words=5, top_codes=most).collect())
        assert [x[:2] for x in got] == [x[:2] for x in want]
        assert [x[2] for x in got] == pytest.approx([x[2] for x in want], rel=1e-7)


def test_a_zero_beside_very_many_ones_keeps_its_probability(spark):
    n, byte = 10**9, 255
    # Byte 255 alone is seen after "aa"; byte 127 differs in the first decision, 254 in the last.
    ctx = ord("a") << 16 | ord("a") << 8
    codes = spark.createDataFrame([(ctx | byte, n), (ctx | 127, 0), (ctx | 254, 0)], "code bigint, n bigint")
    got = {r.code & 255: r.log10 for r in C.code_probabilities(codes, 2).collect()}
    rare = math.log10(0.5 / (n + 1))
    assert got[254] == pytest.approx(rare, abs=1e-6) and got[127] == pytest.approx(rare + 7 * math.log10(0.5), abs=1e-6)
