import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from skein.session import fresh_dir
from skein.sources.messages import MessageStream, append_messages, message_stream
from skein.streaming.counts import for_each_partition

ONCE = {"availableNow": True}
PARTS = (0, 3, 70)


def _append(spark, path, first, n):
    """Offsets ``first`` .. ``first + n - 1`` of every partition."""
    rows = spark.range(first, first + n).select(F.explode(F.array(*[F.lit(p) for p in PARTS])).alias("partition"),
                                                F.col("id").alias("offset"))
    append_messages(rows.select(F.lit(None).cast("binary").alias("key"), F.encode(F.concat_ws(
        ":", "partition", "offset"), "UTF-8").alias("value"), F.lit("t").alias("topic"), "partition", "offset"), path)


def _read(spark, path, ck, out, **options):
    stream = message_stream(spark, path, **options).select(F.decode("value", "UTF-8").alias("v"), "partition", "offset")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(**ONCE).start()
    q.awaitTermination()
    return sorted((r.partition, r.offset) for r in spark.read.schema("v string, partition int, offset bigint").parquet(out).collect())


def _dirs(spark):
    root = fresh_dir(spark, "t-log")
    return [os.path.join(root, x) for x in ("log", "ck", "out")]


def test_start_from_a_map_with_sparse_partitions_then_resume(spark):
    log, ck, out = _dirs(spark)
    _append(spark, log, 0, 50)
    got = _read(spark, log, ck, out, saved_offsets={3: 40, 70: 50})
    assert got == [(0, o) for o in range(50)] + [(3, o) for o in range(40, 50)]
    _append(spark, log, 50, 5)
    # The checkpoint is followed, not the map.
    got = _read(spark, log, ck, out, saved_offsets={3: 0})
    assert got == [(0, o) for o in range(55)] + [(3, o) for o in range(40, 55)] + [(70, o) for o in range(50, 55)]


def test_default_start_latest(spark):
    log, ck, out = _dirs(spark)
    _append(spark, log, 0, 10)
    assert _read(spark, log, ck, out, saved_offsets={0: 8}, default_start="latest") == [(0, 8), (0, 9)]
    _append(spark, log, 10, 2)
    assert _read(spark, log, ck, out) == [(0, 8), (0, 9), (0, 10), (0, 11), (3, 10), (3, 11), (70, 10), (70, 11)]
    with pytest.raises(ValueError):
        message_stream(spark, log, default_start="middle")


def test_offsets_that_are_gone_fail_the_query(spark):
    log, ck, out = _dirs(spark)
    _append(spark, log, 100, 5)
    with pytest.raises(StreamingQueryException, match="is gone"):
        _read(spark, log, ck, out, saved_offsets={0: 7})


def test_planned_ranges_open_only_the_files_they_need(spark):
    log, *_ = _dirs(spark)
    for k in range(4):
        _append(spark, log, 10 * k, 10)
    r = MessageStream({"path": f"file:{log}", "startingOffsets": json.dumps({"0": 15, "3": 40, "70": 40})})
    assert r.initialOffset() == {"0": 15, "3": 40, "70": 40} and r.latestOffset() == {"0": 40, "3": 40, "70": 40}
    planned = r.partitions({"0": 15, "3": 40, "70": 40}, {"0": 25, "3": 40, "70": 40})
    assert sorted((s.low, s.high) for s in planned) == [(15, 20), (20, 25)]


def test_an_aborted_append_is_not_seen(spark):
    log, ck, out = _dirs(spark)
    _append(spark, log, 0, 3)
    bad = spark.range(0, 40, 1, 4).select(F.lit(None).cast("binary").alias("key"), F.when(
        F.col("id") < 30, F.lit("x")).otherwise(F.raise_error(F.lit("bad"))).alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), (F.col("id") + 3).alias("offset"))
    with pytest.raises(Exception, match="bad"):
        append_messages(bad, log)
    assert [o for p, o in _read(spark, log, ck, out) if p == 0] == [0, 1, 2]


def test_partition_writer_refuses_replays_and_aborts(spark):
    from skein.sinks.partition_files import PartitionFile, partition_files, read_partition_files

    root = fresh_dir(spark, "t-ledger")
    inp, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    spark.range(200).selectExpr("cast(id AS string) value").write.text(inp)
    flag, log = os.path.join(root, "failed"), os.path.join(root, "log")
    os.makedirs(log)

    def make(partition, epoch, inner=partition_files(spark, out)):
        class Failing:
            def __init__(self):
                self.file = inner(partition, epoch)

            def open(self):
                ready = self.file.open()
                open(os.path.join(log, f"{partition}-{ready}-{os.urandom(4).hex()}"), "w").close()
                return ready

            def write(self, row):
                if partition == 1 and not os.path.exists(flag):
                    open(flag, "w").close()
                    raise RuntimeError("row refused")
                self.file.write(row)

            def commit(self):
                self.file.commit()

            def abort(self, error):
                self.file.abort(error)

        return Failing()

    stream = spark.readStream.text(inp).repartition(4, "value")
    with pytest.raises(StreamingQueryException):
        for_each_partition(stream, make, ck, trigger=ONCE).awaitTermination()
    for_each_partition(stream, make, ck, trigger=ONCE).awaitTermination()
    got = read_partition_files(spark, out, "value string").collect()
    assert sorted(int(r.value) for r in got) == list(range(200)) and {r.epoch for r in got} == {0}
    calls = [n.rsplit("-", 1)[0] for n in os.listdir(log)]
    assert calls.count("1-True") == 2 and not [n for n in os.listdir(os.path.join(out, "epoch=0")) if "staged" in n]
    assert all(calls.count(f"{p}-True") == 1 or calls.count(f"{p}-False") == 0 for p in (0, 2, 3))
    assert PartitionFile(f"file:{out}", 1, 0).open() is False
