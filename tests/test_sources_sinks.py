import os

from skein.session import fresh_dir
from skein.sinks.files import read_tuple_text, write_tuple_text
from skein.sinks.files import read_tuple_text_in_order
from skein.sinks.totals import read_totals, totals_store
from skein.sources.jdbc import range_bounds, range_predicates
from skein.sources.kafka import starting_offsets_json


def test_jdbc_inclusive_split():
    assert range_bounds(1, 5, 2) == [(1, 2), (3, 5)]
    assert range_predicates("id", 1, 5, 2) == ["id >= 1 AND id <= 2", "id >= 3 AND id <= 5"]
    assert range_bounds(100, 4999, 4)[0] == (100, 1324) and range_bounds(100, 4999, 4)[-1][1] == 4999
    assert range_bounds(5, 1, 3) == []
    assert range_bounds(1, 2, 5) == [(1, 1), (2, 2)]


def test_offsets_json():
    assert starting_offsets_json("t", {2: 30001, 0: 10001}) == '{"t": {"0": 10001, "2": 30001}}'


def test_tuple_text_roundtrip(spark):
    df = spark.createDataFrame([("a,b", 3), ("c", 10), ("d", 1)], "word string, cnt bigint")
    path = fresh_dir(spark, "t-tuple")
    write_tuple_text(df, path, ["word", "cnt"], [("cnt", "desc"), ("word", "asc")])
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sorted(lines) == sorted(["(a,b,3)", "(c,10)", "(d,1)"])
    back = sorted(map(tuple, read_tuple_text(spark, path, ["word", "cnt"], ["string", "bigint"]).collect()))
    assert back == [("a,b", 3), ("c", 10), ("d", 1)]


def test_tuple_text_keeps_order_nulls_and_line_marks(spark):
    rows = [("w%03d" % i, i % 17) for i in range(300)] + [("a\u2028b", 99), ("c\u0085d", 98), ("e", None)]
    df = spark.createDataFrame(rows, "word string, cnt bigint")
    path = fresh_dir(spark, "t-order")
    write_tuple_text(df.repartition(5), path, ["word", "cnt"], [("cnt", "desc"), ("word", "asc")])
    got = read_tuple_text_in_order(spark, path, ["word", "cnt"], ["string", "bigint"]).orderBy("pos").collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r.word, r.cnt) for r in got] == want and [r.pos for r in got] == list(range(1, len(rows) + 1))
    assert "(e,null)" in {r.value for r in spark.read.option("lineSep", "\n").text(path).collect()}


DELTA = "metric string, key string, amount double"


def _delta(spark, amount):
    return spark.createDataFrame([("total", "T", amount), ("item", "x", amount / 2)], DELTA)


def test_totals_replay_compaction_and_owner(spark):
    import pytest

    root = fresh_dir(spark, "t-totals")
    store = totals_store(spark, root, compact_every=3)
    store.claim("query-a")
    for i in range(8):
        store.write(_delta(spark, 2.0), i)
        store.write(_delta(spark, 50.0), i)  # a replay of a finished batch adds nothing
        assert sorted(map(tuple, read_totals(spark, root).collect())) == [
            ("item", "x", 1.0 * (i + 1)), ("total", "T", 2.0 * (i + 1))]
    store.write(_delta(spark, 50.0), 0)  # merged into a later part
    assert sorted(map(tuple, read_totals(spark, root).collect()))[1][2] == 16.0
    tiers = [n.split("-")[0] for n in os.listdir(os.path.join(root, "data"))]
    assert len(tiers) <= 7 and "1" in tiers
    totals_store(spark, root).claim("query-a")
    with pytest.raises(ValueError):
        totals_store(spark, root).claim("query-b")


def test_half_written_batches_are_not_read(spark):
    root = fresh_dir(spark, "t-half")
    store = totals_store(spark, root)
    store.write(_delta(spark, 2.0), 0)
    # A crash in the middle of output leaves a part that no manifest names.
    half = os.path.join(root, "data", "0-1-1-dead", "rows")
    _delta(spark, 9.0).selectExpr("*", "1L AS batch_id").write.parquet(half)
    assert sorted(map(tuple, read_totals(spark, root).collect())) == [("item", "x", 1.0), ("total", "T", 2.0)]
    store.write(_delta(spark, 3.0), 1)
    assert sorted(map(tuple, read_totals(spark, root).collect())) == [("item", "x", 2.5), ("total", "T", 5.0)]
