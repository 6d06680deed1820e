import pytest
from pyspark.sql import functions as F

from skein.llm.op2_mix import mix, mixed, op2_mix, water_fill
from tests.conftest import SF001
from tests.llm.helpers import docs, prose


def plain_targets(sizes, weights, cap, total):
    clamped = {}
    while True:
        rest = total - sum(clamped.values())
        open_w = sum(w for s, w in weights.items() if s not in clamped)
        t = {s: clamped.get(s, rest * w / open_w if open_w else 0) for s, w in weights.items()}
        over = {s: cap * sizes[s] for s in sizes if s not in clamped and t[s] > cap * sizes[s]}
        if not over:
            return t
        clamped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 1000], [1000, 1, 1, 5], [3, 0, 7], [100000, 1, 2, 3, 4, 5, 600]])
def test_water_filling_equals_the_rounds(spark, sizes):
    weights = {f"s{i}": [5.0, 2.0, 1.0][i % 3] for i in range(len(sizes))}
    table = {f"s{i}": n for i, n in enumerate(sizes)}
    df = spark.createDataFrame([(s, n, weights[s]) for s, n in table.items()], "source string, source_size bigint, weight double")
    got = {r.source: r.target for r in water_fill(df, 3.0).collect()}
    want = plain_targets(table, weights, 3.0, sum(sizes))
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(i, 1 + i % 40), "en", ["a", "b", "B", "é", None][i % 5] if i % 7 else "a") for i in range(1500)]
    return docs(spark, rows + [(2000, None, "en", "a"), (2001, "", "en", None), (2002, " \n", "en", "lonely"), (3, prose(3, 4), "en", "b")])


def test_sources_in_code_point_order_reach_their_targets(spark, corpus):
    out = mix(corpus).collect()
    assert len(out) == 1504
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    order = ["B", "a", "b", "lonely", "é", None]
    want = plain_targets(sizes, {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}, 3, sum(sizes.values()))
    for s in order:
        own = [r for r in out if r.source == s]
        assert own[0].source_size == sizes[s] and own[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in own) - want[s]) <= 3
        assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in own)
    assert [r.taken for r in out if r.doc_id in (2000, 2001, 2002)] == [0, 0, 0]


def test_reruns_agree_in_any_layout(spark, corpus):
    a = {(r.doc_id, r.size): r.taken for r in mix(corpus.repartition(3)).collect()}
    b = {(r.doc_id, r.size): r.taken for r in mix(corpus.repartition(9, "text")).collect()}
    assert a == b


def test_the_mix_repeats_rows_with_all_columns(spark, corpus):
    out = mixed(corpus)
    assert out.schema == corpus.schema
    want = sum(r.copies for r in mix(corpus).collect())
    assert out.count() == want
    assert mixed(corpus.limit(0)).count() == 0 and mix(corpus.limit(0)).count() == 0


def test_query_on_the_table(spark):
    out = op2_mix(spark, SF001)
    assert out.count() == 200
    # Whole documents: no source is further off than half of its largest document.
    off = out.groupBy("source").agg((F.abs(F.sum("taken") - F.first("target")) - F.max("size") / 2).alias("e"))
    assert max(r.e for r in off.collect()) <= 0


def check_targets(out, most):
    """Every source's taken words are off its target by half of its largest document at most."""
    by = {}
    for r in out:
        t = by.setdefault(r.source, [r.target, 0, 0])
        t[1], t[2] = t[1] + r.taken, max(t[2], r.size)
    assert all(abs(taken - target) <= largest / 2 + 1e-6 for target, taken, largest in by.values()), by
    assert all(r.taken <= 3 * r.size for r in out) and len(out) == most


@pytest.mark.parametrize("ids", ["null", "one", "own"])
def test_equal_rows_are_separate_documents(spark, ids):
    same = {"null": lambda i: None, "one": lambda i: 5, "own": lambda i: i}[ids]
    rows = [(same(i), "ten words are in this text for each of rows", "en", "a") for i in range(1000)]
    rows += [(2000 + i, prose(i, 7), "en", "b") for i in range(400)] + [(None, prose(1, 3), "en", None)] * 50
    out = mix(docs(spark, rows).repartition(6)).collect()
    check_targets(out, 1450)
    assert 0 < sum(r.taken for r in out if r.source == "a") < 10_000 * 3


def test_a_table_five_times_over(spark):
    rows = [(i, prose(i, 1 + i % 50), "en", "abc"[i % 3]) for i in range(200)]
    table = docs(spark, rows * 5)
    check_targets(mix(table).collect(), 1000)
    from skein.llm.common import cut

    stored = cut(table, "t-mix")
    assert mixed(stored).count() == sum(r.copies for r in mix(stored).collect())
    words = {r.source: r.n for r in mixed(stored).groupBy("source").agg(
        F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    assert words == {r.source: r.n for r in mix(stored).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
