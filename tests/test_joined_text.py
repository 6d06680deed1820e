import os

import pytest
from pyspark.sql import functions as F

from skein.session import fresh_dir
from skein.sinks.joined import JoinedText, JoinedTextWriter, read_joined_parts, write_joined


def _text(spark, path, folder=""):
    rows = read_joined_parts(spark, path).where(F.col("folder") == folder).orderBy("file").collect()
    return b"".join(bytes(r.content) for r in rows).decode()


@pytest.mark.parametrize("sep", ["", "|", "\n", "-→-"])
def test_files_joined_in_name_order_are_mkstring(spark, sep):
    df = spark.range(0, 500).select(F.format_string("w%03d", "id").alias("w")).repartition(7)
    path = fresh_dir(spark, "t-joined")
    write_joined(df, path, "w", ["w"], sep=sep)
    assert _text(spark, path) == sep.join(f"w{i:03d}" for i in range(500))


def test_groups_nulls_empty_values_and_odd_names(spark):
    rows = [("a/b", "x"), ("a/b", None), ("a/b", ""), (None, "n"), ("ü", "q"), ("ü", "p")]
    df = spark.createDataFrame([(g, k, v) for k, (g, v) in enumerate(rows)], "g string, k int, v string")
    path = fresh_dir(spark, "t-joined")
    write_joined(df, path, "v", ["k"], sep=",", by="g")
    assert _text(spark, path, "g=a%2Fb") == "x,,"
    assert _text(spark, path, "g=null") == "n" and _text(spark, path, "g=%C3%BC") == "q,p"


def test_modes_and_no_rows(spark):
    df = spark.createDataFrame([("x",)], "v string")
    path = fresh_dir(spark, "t-joined")
    write_joined(df.limit(0), path, "v", ["v"])
    assert _text(spark, path) == ""
    with pytest.raises(FileExistsError):
        write_joined(df, path, "v", ["v"])
    write_joined(df, path, "v", ["v"], mode="overwrite")
    write_joined(df.union(df), path, "v", ["v"], mode="overwrite")
    assert _text(spark, path) == "xx"
    with pytest.raises(ValueError):
        write_joined(df, path, "v", ["v"], mode="append")


def test_a_crash_before_the_commit_leaves_nothing_to_read(spark):
    class Broken(JoinedTextWriter):
        def commit(self, messages):
            raise RuntimeError("crash before commit")

    class BrokenText(JoinedText):
        @classmethod
        def name(cls):
            return "skein_broken_text"

        def writer(self, schema, overwrite):
            return Broken(dict(self.options), overwrite)

    spark.dataSource.register(BrokenText)
    path = fresh_dir(spark, "t-joined")
    df = spark.range(100).selectExpr("cast(id AS string) value")
    with pytest.raises(Exception, match="crash before commit"):
        df.write.format("skein_broken_text").mode("append").option("path", f"file:{path}").option("by", "").save()
    assert [n for n in os.listdir(path) if not n.startswith("_staging")] == [] if os.path.exists(path) else True
    with pytest.raises(FileNotFoundError):
        read_joined_parts(spark, path)
    write_joined(df, path, "value", ["value"], mode="overwrite")
    assert os.listdir(path) and not [n for n in os.listdir(path) if n.startswith("_staging")]


def test_a_failed_task_leaves_nothing_to_read(spark):
    path = fresh_dir(spark, "t-joined")
    df = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 90, F.col("id").cast("string")).otherwise(
        F.raise_error(F.lit("bad row"))).alias("value"), "id")
    with pytest.raises(Exception, match="bad row"):
        write_joined(df, path, "value", ["id"])
    with pytest.raises(FileNotFoundError):
        read_joined_parts(spark, path)
