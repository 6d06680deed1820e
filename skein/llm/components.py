"""Connected components of a link table by contraction, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id in links (a, b).

    Each round lets every component point to the smallest among itself and its
    neighbours, follows the pointers to their ends, and renames the links; links
    inside a component vanish, so the table shrinks from round to round.  A hub
    with very many links is aggregated per task before the shuffle.
    """
    ids = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).distinct()
    label = cut(ids.withColumn("component", F.col("id")), "components")
    open_links = cut(links.select("a", "b").where("a != b").distinct(), "links")
    while not open_links.isEmpty():
        both = open_links.unionByName(open_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to")), "pointers")
        while True:
            nxt = to.select(F.col("a").alias("to"), F.col("to").alias("then"))
            jumped = cut(to.join(nxt, "to", "left").select(
                "a", F.coalesce("then", "to").alias("to"), (F.col("then") < F.col("to")).alias("moved")), "pointers")
            to = jumped.select("a", "to")
            if jumped.where("moved").isEmpty():
                break
        label = cut(label.join(to, F.col("component") == F.col("a"), "left").select(
            "id", F.coalesce("to", "component").alias("component")), "components")
        pa, pb = to.toDF("a", "ta"), to.toDF("b", "tb")
        open_links = cut(open_links.join(pa, "a").join(pb, "b").select(
            F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a != b").distinct(), "links")
    return label
