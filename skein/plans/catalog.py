"""The registered batch queries: each is ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (through :mod:`skein.plans.inputs`) and
is built from the package operators only, so Catalyst sees one declarative
plan per query.  Output columns are named to match the SQL oracle.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import (
    host_label,
    ip_to_long,
    join_fields,
    last_segment,
    not_blank,
    parse_hash_logs,
    parse_ip_rules,
    parse_orders,
    parse_users,
    render_tuple,
    render_user,
    subject_teacher,
    tokens,
)
from skein.operators import (
    RangeIndex,
    combine_by_key,
    combine_placed,
    count_by,
    distinct_keys,
    field_stats,
    grand_total,
    map_partitions,
    position_in_ranges,
    sort_by_rule,
    sum_by,
    top_counts_all_keys,
    top_n,
    top_n_batches,
    top_n_distinct_counts,
    top_n_per_group,
    with_position,
)
from skein.plans import inputs
from skein.session import fresh_dir
from skein.sinks.files import read_tuple_text, read_tuple_text_in_order, write_tuple_text
from skein.sinks.joined import read_joined_parts, write_joined
from skein.sources.charset import read_lines_in
from skein.sources.files import read_id_ranges, read_table
from skein.sources.kafka import allow_java_charsets, decode_value

# Fixed query parameters.
TOP_WORDS = 100
N_PER_GROUP = 3
LISTED_SUBJECTS = ("blog", "www", "m")
TOP_COUNTS = 5
COUNT_RULE = [("cnt", "desc"), ("word", "asc")]
TEACHER_RULE = [("cnt", "desc"), ("teacher", "asc")]
USER_RULE = [("fv", "desc"), ("age", "asc"), ("name", "asc")]
MONEY_DIGITS = 2
PART_CLASSES = 16
ID_RANGES = 8


# ----------------------------------------------------------------- C1 words --

def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.doc_lines(spark, sf_dir).select(tokens("value", " ").alias("word"))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank-separated tokens of all document lines, counted, count descending."""
    return sort_by_rule(count_by(words(spark, sf_dir), "word"), COUNT_RULE)


def word_count_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 most frequent tokens (ties by token)."""
    return top_n(count_by(words(spark, sf_dir), "word"), TOP_WORDS, COUNT_RULE)


def hash_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``#``-separated tokens of the event log lines, counted."""
    t = inputs.hash_log_lines(spark, sf_dir).select(tokens("value", "#").alias("word"))
    return sort_by_rule(count_by(t, "word"), COUNT_RULE)


def word_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts rendered as ``(word,cnt)`` text lines."""
    c = count_by(words(spark, sf_dir), "word")
    return c.select(render_tuple("word", "cnt").alias("line"))


def text_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts written as sorted tuple text, then read back and parsed."""
    path = fresh_dir(spark, "tuple-text")
    write_tuple_text(count_by(words(spark, sf_dir), "word"), path, ["word", "cnt"], COUNT_RULE)
    return read_tuple_text(spark, path, ["word", "cnt"], ["string", "bigint"])


def text_sink_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written tuple text read back with each line's position over the part files."""
    path = fresh_dir(spark, "tuple-text")
    write_tuple_text(count_by(words(spark, sf_dir), "word"), path, ["word", "cnt"], COUNT_RULE)
    return read_tuple_text_in_order(spark, path, ["word", "cnt"], ["string", "bigint"])


def decode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of the document lines after a round trip through GB18030 text files."""
    allow_java_charsets(spark)
    path = fresh_dir(spark, "gb18030-lines")
    # The text sink writes the bytes of a string as they are.
    inputs.doc_lines(spark, sf_dir).select(F.encode("value", "GB18030").cast("string").alias("value")).write.text(path)
    return count_by(read_lines_in(spark, path, "GB18030").select(tokens("value", " ").alias("word")), "word")


def _decoded(spark: SparkSession, sf_dir: str, charset: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    msgs = d.select(F.col("doc_id").cast("string").alias("key"), F.encode("text", charset).alias("value"))
    return msgs.select(F.col("key").cast("bigint").alias("doc_id"), decode_value(msgs, "value", charset).alias("text"),
                       F.octet_length("value").cast("bigint").alias("bytes"))


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as message bytes (``key``/``value``), decoded back to text."""
    return _decoded(spark, sf_dir, "UTF-8").select("doc_id", "text")


def decode_messages_gb18030(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a multi-byte charset of the JVM, with the messages' sizes."""
    allow_java_charsets(spark)
    return _decoded(spark, sf_dir, "GB18030")


# ------------------------------------------------------------- C2 web log --

def subject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.access_log(spark, sf_dir).select(*subject_teacher("value"))
    return count_by(log, ["subject", "teacher"])


def url_pair_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits per (host label, last segment)."""
    return subject_counts(spark, sf_dir)


def topn_per_group_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 per host label with the counts placed by label before the window."""
    log = inputs.access_log(spark, sf_dir).select(*subject_teacher("value"))
    counts = count_by(log, ["subject", "teacher"], partition_by="subject")
    return top_n_per_group(counts, "subject", N_PER_GROUP, TEACHER_RULE)


def url_segment_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits per last URL segment, count descending."""
    t = inputs.access_log(spark, sf_dir).select(last_segment("value").alias("teacher"))
    return sort_by_rule(count_by(t, "teacher"), TEACHER_RULE)


def topn_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 last segments per host label (window strategy)."""
    return top_n_per_group(subject_counts(spark, sf_dir), "subject", N_PER_GROUP, TEACHER_RULE)


def topn_listed_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 for the listed host labels only (the filter reaches the scan)."""
    return top_n_per_group(subject_counts(spark, sf_dir), "subject", N_PER_GROUP, TEACHER_RULE,
                           strategy="listed", groups=LISTED_SUBJECTS)


def topn_group_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 per host label with one partition per label."""
    return top_n_per_group(subject_counts(spark, sf_dir), "subject", N_PER_GROUP, TEACHER_RULE,
                           strategy="key_partitions")


def topn_partition_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 3 per host label by a function per partition, one partition per label."""
    return map_partitions(subject_counts(spark, sf_dir), top_n_batches("subject", N_PER_GROUP, TEACHER_RULE),
                          "subject string, teacher string, cnt bigint, rn bigint", key="subject", one_key_each=True)


def distinct_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct host labels."""
    return distinct_keys(inputs.access_log(spark, sf_dir).select(host_label("value").alias("subject")), "subject")


# ------------------------------------------------------------ C3 sorting --

def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_users(inputs.user_lines(spark, sf_dir))


def multi_key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users by face value descending, age ascending (name last), with positions."""
    u = with_position(users(spark, sf_dir), USER_RULE, "pos")
    return u.withColumn("rendered", render_user("name", "age", "fv"))


def multi_key_sort_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same order and positions from ranges, without a sorted table."""
    u = position_in_ranges(users(spark, sf_dir), USER_RULE, "pos")
    return u.withColumn("rendered", render_user("name", "age", "fv"))


# ------------------------------------------------------ C4 log profiling --

def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_hash_logs(inputs.hash_log_lines_with_blanks(spark, sf_dir).where(not_blank("value")))


def log_status_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per response status."""
    return count_by(log_records(spark, sf_dir), "status")


def log_size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Max, min and two-decimal mean of the size field."""
    return field_stats(log_records(spark, sf_dir), "size")


def log_size_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Max and min of the size field only."""
    return field_stats(log_records(spark, sf_dir), "size", with_avg=False)


def combine_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word: sum and count of the sizes in one user-combined state."""

    def create(rows: pd.DataFrame) -> pd.DataFrame:
        g = rows.groupby("word", sort=False)["size"]
        return pd.DataFrame({"total": g.sum().astype("int64"), "n": g.size().astype("int64")}).reset_index()

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"word": [states["word"].iloc[0]], "total": [states["total"].sum()], "n": [states["n"].sum()]})

    sizes = log_records(spark, sf_dir).select("word", "size")
    return combine_by_key(sizes, "word", create, merge, "word string, total bigint, n bigint")


def combine_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part of ``lineitem``: quantity, lines and dearest line in one user state, placed by a class of parts."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("bigint").alias("part"), F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("price"))

    def create(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby("part", sort=False).agg(
            quantity=("quantity", "sum"), lines=("quantity", "size"), dearest=("price", "max")).reset_index()

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        return states.groupby("part", sort=False).agg(
            {"quantity": "sum", "lines": "sum", "dearest": "max"}).reset_index()

    return combine_placed(lines, "part", create, merge, "part bigint, quantity bigint, lines bigint, dearest double",
                          place_by=F.col("part") % PART_CLASSES)


def id_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the middle half of the ids, read by one scan partition per id range."""
    path = os.path.join(sf_dir, "events.parquet")
    last = spark.read.parquet(path).agg(F.max("event_id")).first()[0]
    rows = read_id_ranges(spark, path, "event_id", last // 4, last // 4 * 3, ID_RANGES, number="range_no")
    return rows.select("event_id", "user_id", "event_type", "range_no")


def joined_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest distinct word counts with their words joined without separator, through files.

    A count's words are one text, as the original prints it; its length is the answer's own.
    """
    path = fresh_dir(spark, "joined-words")
    write_joined(topn_counts_all_words(spark, sf_dir), path, "word", ["position"], sep="", by="cnt")
    parts = read_joined_parts(spark, path).groupBy("folder").agg(
        F.array_sort(F.collect_list(F.struct("file", "content"))).alias("p"))
    text = F.concat_ws("", F.transform("p", lambda x: F.decode(x["content"], "UTF-8")))
    return parts.select(F.regexp_extract("folder", "cnt=(.*)", 1).cast("bigint").alias("cnt"), text.alias("words"))


def log_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per word field."""
    return count_by(log_records(spark, sf_dir), "word")


def topn_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest distinct word counts, one word each."""
    return top_n_distinct_counts(log_word_count(spark, sf_dir), TOP_COUNTS, "word", "cnt")


def topn_counts_all_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest distinct word counts with all their words, one row per word."""
    return top_counts_all_keys(log_word_count(spark, sf_dir), TOP_COUNTS, "word", "cnt")


# ------------------------------------------------------ C5 IP enrichment --

def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_orders(inputs.order_lines(spark, sf_dir))


def ip_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ip_rules(inputs.ip_rule_lines(spark, sf_dir))


def ip_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order IPs and their numbers."""
    return order_records(spark, sf_dir).select("ip", ip_to_long("ip").alias("n"))


def ip_to_long_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of three-part addresses, the last part up to 399."""
    o = read_table(spark, sf_dir, "orders")
    ip = join_fields(".", F.col("o_custkey") % inputs.IP_FIRST_OCTETS + 1, F.col("o_orderkey") % 256,
                     F.col("o_orderkey") % 400)
    return o.select("o_orderkey", ip.alias("ip")).select("o_orderkey", "ip", ip_to_long("ip").alias("n"))


def _region_lookup(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    index = RangeIndex(ip_rules(spark, sf_dir), ["province"], **options)
    return index.lookup(ip_numbers(spark, sf_dir), "n", {"province": inputs.UNKNOWN_REGION})


def ip_region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region of every order IP; both sides shuffled on the bucket, salted."""
    return _region_lookup(spark, sf_dir, broadcast_bytes=0, salts=4)


def ip_region_lookup_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same rows with the rule side broadcast (its bytes are checked)."""
    return _region_lookup(spark, sf_dir)


def ip_region_lookup_multilevel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of all orders against narrow, wide and very wide rules, nothing broadcast.

    From key 2^18 on, a customer's numbers reach into the next nation's rule: both hold them.
    """
    index = RangeIndex(inputs.multilevel_rules(spark, sf_dir), ["province"], broadcast_bytes=0, overlapping=True)
    return index.lookup(inputs.multilevel_numbers(spark, sf_dir), "n", {"province": inputs.UNKNOWN_REGION})


def income_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total order income."""
    t = grand_total(order_records(spark, sf_dir), "price", "total_income")
    return t.select(F.round("total_income", MONEY_DIGITS).alias("total_income"))


def income_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income per item."""
    s = sum_by(order_records(spark, sf_dir), "item", "price", "income")
    return s.withColumn("income", F.round("income", MONEY_DIGITS))


def regional_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = order_records(spark, sf_dir).withColumn("n", ip_to_long("ip"))
    index = RangeIndex(ip_rules(spark, sf_dir), ["province"])
    return index.lookup(o, "n", {"province": inputs.UNKNOWN_REGION})


def income_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income per region of the order IP."""
    s = sum_by(regional_orders(spark, sf_dir), "province", "price", "income")
    return s.withColumn("income", F.round("income", MONEY_DIGITS))


BATCH_QUERIES = {
    "word_count": word_count,
    "word_count_top": word_count_top,
    "hash_token_count": hash_token_count,
    "word_count_lines": word_count_lines,
    "text_sink_roundtrip": text_sink_roundtrip,
    "text_sink_order": text_sink_order,
    "decode_messages": decode_messages,
    "decode_messages_gb18030": decode_messages_gb18030,
    "decode_lines": decode_lines,
    "url_segment_count": url_segment_count,
    "url_pair_count": url_pair_count,
    "topn_per_group": topn_per_group,
    "topn_per_group_colocated": topn_per_group_colocated,
    "topn_listed_groups": topn_listed_groups,
    "topn_group_partitions": topn_group_partitions,
    "topn_partition_function": topn_partition_function,
    "distinct_groups": distinct_groups,
    "multi_key_sort": multi_key_sort,
    "multi_key_sort_ranges": multi_key_sort_ranges,
    "log_status_count": log_status_count,
    "log_size_stats": log_size_stats,
    "log_size_range": log_size_range,
    "combine_by_key": combine_sizes,
    "combine_by_key_placed": combine_parts,
    "id_range_read": id_range_read,
    "joined_words": joined_words,
    "log_word_count": log_word_count,
    "topn_distinct_counts": topn_distinct_counts,
    "topn_counts_all_words": topn_counts_all_words,
    "ip_to_long": ip_numbers,
    "ip_to_long_odd": ip_to_long_odd,
    "ip_region_lookup": ip_region_lookup,
    "ip_region_lookup_broadcast": ip_region_lookup_broadcast,
    "ip_region_lookup_multilevel": ip_region_lookup_multilevel,
    "income_total": income_total,
    "income_by_item": income_by_item,
    "income_by_region": income_by_region,
}
