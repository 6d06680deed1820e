import os
import random

import pytest
from pyspark.sql import functions as F

from skein.session import fresh_dir
from skein.sinks.store import OFFSET_SCHEMA, BatchStore, offset_ranges
from skein.sources import allow_java_charsets, read_id_ranges, read_lines_in
from tests.conftest import SF001


def _sum(rows):
    return rows.groupBy("k").agg(F.sum("v").alias("v"), F.max("batch_id").alias("batch_id"))


def _ranges(spark, b):
    return spark.createDataFrame([("t", p, 10 * b, 10 * b + 10) for p in (0, 5)],
                                 "topic string, partition int, from_offset bigint, until_offset bigint")


def test_150_batches_keep_all_offsets_and_few_parts(spark):
    root = fresh_dir(spark, "t-store")
    store = BatchStore(spark, root, "k string, v bigint", _sum, compact_every=10)
    store.claim("q")
    row = spark.createDataFrame([("a", 1)], "k string, v bigint").coalesce(1)
    for b in range(150):
        assert store.write(row, b, _ranges(spark, b) if b % 3 == 0 else None)
    assert not store.write(row, 149) and store.last_batch() == 149
    assert [(r.k, r.v) for r in store.current().collect()] == [("a", 150)]
    got = sorted(map(tuple, store.offsets().collect()))
    assert got == [(b, "t", p, 10 * b, 10 * b + 10) for b in range(0, 150, 3) for p in (0, 5)]
    assert len(store._state()[1]["parts"]) <= 3 * 10
    assert sum(n.endswith(".json") for n in os.listdir(os.path.join(root, "manifest"))) <= 6
    # Tiers of 10 and 100: 100 + 10 x 4 + 10 left, and what the last merge replaced.
    assert len(os.listdir(os.path.join(root, "data"))) <= 40


def test_rows_and_offsets_count_together_or_not_at_all(spark, monkeypatch):
    root = fresh_dir(spark, "t-store")
    store = BatchStore(spark, root, "k string, v bigint", _sum)
    store.claim("q")
    row = spark.createDataFrame([("a", 1)], "k string, v bigint")
    store.write(row, 0, _ranges(spark, 0))
    monkeypatch.setattr(BatchStore, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("crash before the manifest")))
    with pytest.raises(RuntimeError):
        store.write(row, 1, _ranges(spark, 1))
    monkeypatch.undo()
    again = BatchStore(spark, root, "k string, v bigint", _sum)
    assert again.current().first().v == 1 and again.offsets().count() == 2
    assert len(os.listdir(os.path.join(root, "data"))) == 2
    again.claim("q")
    assert len(os.listdir(os.path.join(root, "data"))) == 1
    again.write(row, 1, _ranges(spark, 1))
    assert again.current().first().v == 2 and again.offsets().count() == 4


def test_a_second_writer_is_refused(spark):
    root = fresh_dir(spark, "t-store")
    a, b = (BatchStore(spark, root, "k string, v bigint", _sum) for _ in range(2))
    a.claim("q")
    number, state = b._state()
    a.write(spark.createDataFrame([("a", 1)], "k string, v bigint"), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        b._commit(number + 1, state)


def test_offset_ranges_and_empty_store(spark):
    m = spark.createDataFrame([("t", 3, 7), ("t", 3, 9), ("t", 0, 1)], "topic string, partition int, offset bigint")
    assert sorted(map(tuple, offset_ranges(m).collect())) == [("t", 0, 1, 2), ("t", 3, 7, 10)]
    store = BatchStore(spark, fresh_dir(spark, "t-store"), "k string, v bigint", _sum)
    assert store.offsets().schema.simpleString() == spark.createDataFrame([], OFFSET_SCHEMA).schema.simpleString()
    assert store.current().count() == 0 and store.last_batch() == -1


def test_id_ranges_are_pushed_down_one_partition_each(spark):
    path = f"{SF001}/events.parquet"
    df = read_id_ranges(spark, path, "event_id", 101, 700, 4, number="part").select("event_id", "part")
    rows = df.withColumn("p", F.spark_partition_id()).collect()
    assert sorted(r.event_id for r in rows) == list(range(101, 701))
    assert len({r.p for r in rows}) == 4 and len({(r.p, r.part) for r in rows}) == 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(event_id") == 4 and plan.count("LessThanOrEqual(event_id") == 4
    assert "ReadSchema: struct<event_id:bigint>" in plan
    assert read_id_ranges(spark, path, "event_id", 5, 4, 2).count() == 0
    assert read_id_ranges(spark, path, "event_id", 1, 5, 2).count() == 5


def test_row_groups_outside_a_range_are_not_read(spark):
    path = fresh_dir(spark, "t-ranges")
    spark.range(0, 200_000, 1, 1).write.option("parquet.block.size", 64 << 10).parquet(path)
    df = read_id_ranges(spark, path, "id", 1000, 1999, 2)
    assert df.count() == 1000
    metrics = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in metrics


TEXT = "plain\nnaïve é\r\n\r\n广东省\rĊ਍ ꀊ਍ഊ\n\n\U0001F600 end"
LINES = ["plain", "naïve é", "", "广东省", "Ċ਍ ꀊ਍ഊ", "", "\U0001F600 end"]


@pytest.mark.parametrize("charset, codec, mark", [
    ("UTF-16", "utf-16-le", "﻿"), ("UTF-16", "utf-16-be", "﻿"), ("UTF-16", "utf-16-be", ""),
    ("UTF-16LE", "utf-16-le", ""), ("UTF-16BE", "utf-16-be", ""), ("UTF-32", "utf-32-le", "﻿"),
    ("UTF-8", "utf-8", ""), ("GB18030", "gb18030", "")])
@pytest.mark.parametrize("end", ["", "\n", "\r", "\r\n"])
def test_lines_of_any_charset(spark, charset, codec, mark, end):
    allow_java_charsets(spark)
    path = fresh_dir(spark, "t-charset")
    os.makedirs(path)
    with open(os.path.join(path, "a.txt"), "wb") as f:
        f.write((mark + TEXT + end).encode(codec))
    for step in (64 << 20, 6) if charset.startswith("UTF-16") and end == "\r\n" else (64 << 20,):
        got = sorted(r.value for r in read_lines_in(spark, path, charset, range_bytes=step).collect())
        assert got == sorted(LINES)


def test_ranges_of_a_wide_file_lose_and_repeat_no_line(spark, tmp_path):
    from skein.sources.charset import _lines

    r = random.Random(4)
    for _ in range(60):
        text = "".join(r.choice(["a", "bc", "\n", "\r", "\r\n", "ਊ", "഍", "é"]) for _ in range(r.randint(0, 60)))
        f = tmp_path / "x"
        f.write_bytes(text.encode("utf-16-le"))
        want = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        want = want[:-1] if want[-1] == "" else want
        n = len(text.encode("utf-16-le"))
        for step in (2, 4, 10, 1000):
            got = [x for s in range(0, n, step) for x in _lines(str(f), n, s, min(s + step, n), 2, "utf-16-le")]
            assert got == want, (text, step)
