"""Database append: batched inserts, one connection per partition (Spark's JDBC writer)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                batch_size: int = 1000) -> None:
    """``INSERT INTO table`` every row of ``df``; connection options are arguments."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.mode("append").jdbc(url, table, properties=props)
