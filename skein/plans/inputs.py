"""Record-shaped inputs derived, by Spark, from the driver tables.

The original jobs read plain text records (text, URL logs, ``#``-logs,
``name age fv`` users, blank-separated orders, ``|``-separated IP rules).
Each function here renders such lines from a driver table, column by column,
so every query runs over whole tables and its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.records import join_fields
from skein.functions.text import text_lines
from skein.sources.files import read_table
from skein.streaming.orders import UNKNOWN_REGION  # noqa: F401

# Fixed values for the IP-rule table built from ``nation``: nation k owns the
# first octets 8k+1 .. 8k+6; octets 8k+7 and 8k+8 are gaps.
RULE_STRIDE = 8
RULE_FIRST = 1
RULE_LAST_EXCL = 7

# Fixed value: the order IP is ``{custkey % 200 + 1}.{orderkey % 256}.0.7``.
IP_FIRST_OCTETS = 200


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document text, column ``value``."""
    return read_table(spark, sf_dir, "documents", spread=True).select(text_lines("text").alias("value"))


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One URL per row (``pages.url``), column ``value``."""
    return read_table(spark, sf_dir, "pages").select(F.col("url").alias("value"))


def hash_log_word(user_id: F.Column) -> F.Column:
    return F.concat(F.lit("u"), (user_id % 40).cast("string"))


def hash_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id#-#user#word#status#size`` lines from ``events``.

    word = ``u{user_id % 40}``, status = ``event_type``, size = ``floor(value)``.
    """
    e = read_table(spark, sf_dir, "events", spread=True)
    return e.select(
        join_fields("#", "event_id", F.lit("-"), "user_id", hash_log_word(F.col("user_id")),
                    "event_type", F.floor("value")).alias("value")
    )


def hash_log_lines_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log lines with an empty and a blank-only line behind every tenth event."""
    e = read_table(spark, sf_dir, "events", spread=True)
    line = join_fields("#", "event_id", F.lit("-"), "user_id", hash_log_word(F.col("user_id")),
                       "event_type", F.floor("value"))
    lines = F.when(F.col("event_id") % 10 == 0, F.array(line, F.lit(""), F.lit(" \t "))).otherwise(F.array(line))
    return e.select(F.explode(lines).alias("value"))


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name age fv`` lines from ``customer``: age = nation key, fv = floor(balance)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        join_fields(" ", "c_name", "c_nationkey", F.floor("c_acctbal")).alias("value")
    )


def order_ip(orderkey: F.Column, custkey: F.Column) -> F.Column:
    return join_fields(".", custkey % IP_FIRST_OCTETS + 1, orderkey % 256, F.lit("0"), F.lit("7"))


def order_line() -> F.Column:
    """``orderkey ip item custkey price`` of an ``orders`` row (item = order status)."""
    return join_fields(" ", "o_orderkey", order_ip(F.col("o_orderkey"), F.col("o_custkey")),
                       "o_orderstatus", "o_custkey", "o_totalprice")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, column ``value``."""
    return read_table(spark, sf_dir, "orders", spread=True).select(order_line().alias("value"))


def ip_rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key|region|lo|hi|-|-|name`` rule lines from ``nation``."""
    n = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("bigint")
    lo = F.shiftleft(k * RULE_STRIDE + RULE_FIRST, 24)
    hi = F.shiftleft(k * RULE_STRIDE + RULE_LAST_EXCL, 24) - 1
    return n.select(
        join_fields("|", "n_nationkey", "n_regionkey", lo, hi, F.lit("-"), F.lit("-"), "n_name").alias("value")
    )


# Fixed values of the multi-level rules: customer c owns 64 numbers in octet
# 8k+7 of its nation k (a gap of the nation rules); one rule covers all from octet 250 up to 2^40.
NARROW_WIDTH = 64
WIDE_FIRST = 250


def multilevel_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow (customer), wide (nation) and one very wide rule: ``lo, hi, province``."""
    n = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("bigint")
    wide = n.select(F.shiftleft(k * RULE_STRIDE + RULE_FIRST, 24).alias("lo"),
                    (F.shiftleft(k * RULE_STRIDE + RULE_LAST_EXCL, 24) - 1).alias("hi"), F.col("n_name").alias("province"))
    c = read_table(spark, sf_dir, "customer")
    at = F.shiftleft(F.col("c_nationkey").cast("bigint") * RULE_STRIDE + RULE_LAST_EXCL, 24) + (
        F.col("c_custkey").cast("bigint") * NARROW_WIDTH)
    narrow = c.select(at.alias("lo"), (at + NARROW_WIDTH - 1).alias("hi"), F.col("c_name").alias("province"))
    rest = spark.range(1).select(F.lit(WIDE_FIRST << 24).cast("bigint").alias("lo"),
                                 F.lit(1 << 40).cast("bigint").alias("hi"), F.lit("rest").alias("province"))
    return wide.unionByName(narrow).unionByName(rest)


def multilevel_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, n``: numbers of all orders spread over every kind of rule and the gaps."""
    o = read_table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint")
    octet = F.when(key % 3 == 0, cust % 25 * RULE_STRIDE + RULE_LAST_EXCL).otherwise(key % 260)
    return o.select("o_orderkey", (F.shiftleft(octet, 24) + cust * NARROW_WIDTH + key % 100).alias("n"))
