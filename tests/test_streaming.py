import os

from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from skein.operators import RangeIndex
from skein.session import fresh_dir
from skein.sinks.totals import read_totals
from skein.streaming import counts_after, per_batch_counts, read_batch_counts, running_counts
from skein.streaming.orders import order_totals_stream

ONCE = {"availableNow": True}
DROPS = ["a b a", "b c", "a"]


def _replay_text(spark, start):
    root = fresh_dir(spark, "t-stream")
    inp = os.path.join(root, "in")
    for i, line in enumerate(DROPS):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(inp)
        start(inp, root).awaitTermination()
    return root


def test_per_batch_counts_do_not_carry_over(spark):
    root = _replay_text(spark, lambda inp, root: per_batch_counts(
        spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, "ck"), trigger=ONCE))
    got = sorted(map(tuple, read_batch_counts(spark, os.path.join(root, "out")).collect()))
    assert got == [(0, "a", 2), (0, "b", 1), (1, "b", 1), (1, "c", 1), (2, "a", 1)]


def test_running_counts_accumulate(spark):
    root = _replay_text(spark, lambda inp, root: running_counts(
        spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, "ck"), trigger=ONCE))
    out = os.path.join(root, "out")
    snap = [sorted(map(tuple, counts_after(spark, out, b).collect())) for b in range(3)]
    assert snap == [[("a", 2), ("b", 1)], [("a", 2), ("b", 2), ("c", 1)], [("a", 3), ("b", 2), ("c", 1)]]


def test_running_counts_complete_mode(spark):
    root = _replay_text(spark, lambda inp, root: running_counts(
        spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, "ck"),
        output_mode="complete", trigger=ONCE))
    rows = read_batch_counts(spark, os.path.join(root, "out")).where(F.col("batch_id") == 1).collect()
    assert sorted((r.word, r.cnt) for r in rows) == [("a", 2), ("b", 2), ("c", 1)]


SCHEMA = "key binary, value binary, topic string, partition int, offset bigint"


def _orders_run(spark, crash_at=None, charset="UTF-8"):
    from skein.sources.kafka import allow_java_charsets

    allow_java_charsets(spark)
    # A = 1.0.0.0/8; unknown = 9.9.9.9
    rules = spark.createDataFrame([(1 << 24, (2 << 24) - 1, "A")], "lo bigint, hi bigint, province string")
    index = RangeIndex(rules, ["province"])
    batches = [["t1 1.2.3.4 手机 x 10.5", "t2 1.9.9.9 书 x 2.0"], [], ["t3 9.9.9.9 书 x 1.5"]]
    root = fresh_dir(spark, "t-orders")
    inp, out, ck = (os.path.join(root, x) for x in ("in", "totals", "ck"))
    crashed = []

    def hook(batch_id):
        if batch_id == crash_at and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("boom")

    def start():
        return order_totals_stream(spark.readStream.schema(SCHEMA).parquet(inp), index, out, ck,
                                   charset=charset, trigger=ONCE, after_write=hook)

    for i, lines in enumerate(batches):
        msgs = [(None, bytearray(l.encode(charset)), "orders", 0, i * 10 + j) for j, l in enumerate(lines)]
        spark.createDataFrame(msgs, SCHEMA).coalesce(1).write.mode("append").parquet(inp)
        try:
            start().awaitTermination()
        except StreamingQueryException:
            start().awaitTermination()
    return sorted(map(tuple, read_totals(spark, out).collect())), crashed


WANT = [("item", "书", 3.5), ("item", "手机", 10.5), ("province", "A", 12.5), ("province", "未知", 1.5),
        ("total", "TOTAL_INCOME", 14.0)]


def test_order_totals(spark):
    got, _ = _orders_run(spark)
    assert got == WANT


def test_order_totals_replayed_batch_counts_once(spark):
    got, crashed = _orders_run(spark, crash_at=0)
    assert crashed == [0]
    assert got == WANT


def test_order_totals_gb2312_messages(spark):
    got, _ = _orders_run(spark, charset="GB2312")
    assert got == WANT


def test_message_word_count_and_offsets(spark):
    from skein.sources.kafka import message_values
    from skein.streaming import batch_offsets

    root = fresh_dir(spark, "t-msg")
    inp, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    msgs = [(None, bytearray(b"hello tom hello jerry"), "t", 0, 0)]
    spark.createDataFrame(msgs, SCHEMA).write.parquet(inp)
    q = per_batch_counts(message_values(spark.readStream.schema(SCHEMA).parquet(inp)), out, ck, trigger=ONCE)
    q.awaitTermination()
    got = sorted((r.word, r.cnt) for r in read_batch_counts(spark, out).collect())
    assert got == [("hello", 2), ("jerry", 1), ("tom", 1)]
    offs = batch_offsets(q)
    assert offs and offs[0]["batch_id"] == 0 and offs[0]["rows"] >= 1


def test_console_sink_runs(spark, capsys):
    from skein.streaming import to_console

    root = fresh_dir(spark, "t-console")
    inp = os.path.join(root, "in")
    spark.createDataFrame([("a b a",)], "value string").write.text(inp)
    from skein.functions.text import tokens
    from skein.operators import count_by

    counts = count_by(spark.readStream.text(inp).select(tokens("value").alias("word")), "word")
    q = to_console(counts, num_rows=5, trigger=ONCE)
    q.awaitTermination()
    assert q.exception() is None


def test_state_update_function(spark):
    from skein.streaming import latest_counts, running_state

    def update(key, batches, old):
        return (sum(len(b) for b in batches) + (old[0] if old else 0),)

    root = _replay_text(spark, lambda inp, root: running_state(
        spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, "ck"), update, trigger=ONCE,
        compact_every=2))
    got = sorted(map(tuple, latest_counts(spark, os.path.join(root, "out")).collect()))
    assert got == [("a", 3), ("b", 2), ("c", 1)]


def test_state_partitions_stay_fixed_over_a_restart(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    n = iter(["8", "3", "5"])

    def start(inp, root):
        spark.conf.set("spark.sql.shuffle.partitions", next(n))
        return running_counts(spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, "ck"), trigger=ONCE)

    try:
        root = _replay_text(spark, start)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    state = os.path.join(root, "ck", "state", "0")
    assert sum(x.isdigit() for x in os.listdir(state)) == 8


def test_rows_reach_a_writer_per_partition(spark):
    from skein.streaming import for_each_partition

    root = fresh_dir(spark, "t-foreach")
    inp, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    os.makedirs(out)
    spark.createDataFrame([(f"w{i}",) for i in range(20)], "value string").repartition(3).write.text(inp)

    class Writer:
        def __init__(self, partition, batch_id):
            self.f = open(os.path.join(out, f"{batch_id}-{partition}"), "w")

        def write(self, row):
            self.f.write(row.value + "\n")

        def close(self):
            self.f.close()

    for_each_partition(spark.readStream.text(inp), Writer, ck, trigger=ONCE).awaitTermination()
    got = sorted(x for f in os.listdir(out) for x in open(os.path.join(out, f)).read().split())
    assert got == sorted(f"w{i}" for i in range(20)) and len(os.listdir(out)) >= 1


def test_default_trigger_is_five_seconds(spark):
    root = fresh_dir(spark, "t-trigger")
    inp = os.path.join(root, "in")
    spark.createDataFrame([("a b",)], "value string").write.text(inp)
    q = per_batch_counts(spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, "ck"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_batch_counts(spark, os.path.join(root, "out")).count() == 2


def test_a_store_belongs_to_one_query(spark):
    import pytest

    root = fresh_dir(spark, "t-owner")
    inp = os.path.join(root, "in")
    spark.createDataFrame([("a",)], "value string").write.text(inp)
    run = lambda ck: per_batch_counts(spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, ck), trigger=ONCE)
    run("ck1").awaitTermination()
    with pytest.raises(ValueError):
        run("ck2")


def test_state_of_many_keys_by_frames(spark):
    from skein.streaming import latest_counts, running_states

    def update(new, old):
        total = new.groupby("word", sort=False)["n"].sum()
        before = old.set_index("word")["cnt"].reindex(total.index).fillna(0)
        return (total + before).astype("int64").rename("cnt").reset_index()

    for buckets in (1, 64):
        root = _replay_text(spark, lambda inp, root, b=buckets: running_states(
            spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, "ck"), update, trigger=ONCE,
            compact_every=2, buckets=b))
        got = sorted(map(tuple, latest_counts(spark, os.path.join(root, "out")).collect()))
        assert got == [("a", 3), ("b", 2), ("c", 1)]


def test_offsets_are_committed_with_order_totals(spark):
    from skein.sinks.totals import totals_store

    rules = spark.createDataFrame([(1 << 24, (2 << 24) - 1, "A")], "lo bigint, hi bigint, province string")
    index = RangeIndex(rules, ["province"])
    root = fresh_dir(spark, "t-orders")
    inp, out, ck = (os.path.join(root, x) for x in ("in", "totals", "ck"))
    for i in range(2):
        msgs = [(None, bytearray(b"t 1.2.3.4 x y 1.0"), "orders", p, 10 * i + p) for p in (0, 4)]
        spark.createDataFrame(msgs, SCHEMA).write.mode("append").parquet(inp)
        order_totals_stream(spark.readStream.schema(SCHEMA).parquet(inp), index, out, ck, trigger=ONCE,
                            with_offsets=True).awaitTermination()
    got = sorted(map(tuple, totals_store(spark, out).offsets().collect()))
    assert got == [(0, "orders", 0, 0, 1), (0, "orders", 4, 4, 5), (1, "orders", 0, 10, 11), (1, "orders", 4, 14, 15)]


def test_state_partitions_come_from_the_metadata(spark):
    from skein.streaming import state_partitions, stored_state

    root = _replay_text(spark, lambda inp, root: running_counts(
        spark.readStream.text(inp), os.path.join(root, "out"), os.path.join(root, "ck"), trigger=ONCE))
    ck = os.path.join(root, "ck")
    assert state_partitions(spark, ck) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = stored_state(spark, ck).select("key.word", "value.count", "partition_id").collect()
    assert sorted((r[0], r[1]) for r in got) == [("a", 3), ("b", 2), ("c", 1)]
    assert max(r.partition_id for r in got) < state_partitions(spark, ck)
