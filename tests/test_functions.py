import pytest
from pyspark.sql import functions as F

from skein.functions import (
    fixed2,
    host_label,
    ip_to_long,
    jvm_split,
    last_segment,
    not_blank,
    parse_hash_logs,
    parse_ip_rules,
    parse_orders,
    parse_users,
    render_tuple,
    render_user,
    text_lines,
)


def one_col(spark, values, expr, name="v"):
    df = spark.createDataFrame([(v,) for v in values], f"{name} string")
    return [r[0] for r in df.select(expr(F.col(name))).collect()]


def test_jvm_split_edges(spark):
    got = one_col(spark, ["a b", "", " ", "a  b ", " a", "  ", "a", "a b  "], lambda c: jvm_split(c, " "))
    assert got == [["a", "b"], [""], [], ["a", "", "b"], ["", "a"], [], ["a"], ["a", "b"]]


def test_jvm_split_hash(spark):
    got = one_col(spark, ["x#y##", "#", "##a", "a#b"], lambda c: jvm_split(c, "#"))
    assert got == [["x", "y"], [], ["", "", "a"], ["a", "b"]]


def test_text_lines(spark):
    df = spark.createDataFrame([("a b\nc\n",), ("x\r\ny",), ("",)], "t string")
    got = [r[0] for r in df.select(text_lines("t")).collect()]
    assert got == ["a b", "c", "x", "y", ""]


def test_url_parts(spark):
    urls = ["http://bigdata.example.cn/tom", "http://a.b/x/", "http://host", "nourl",
            "http://a_b.c/x", "http://u@h.z:80/t"]
    subj = one_col(spark, urls, host_label)
    teach = one_col(spark, urls, last_segment)
    assert list(zip(subj, teach)) == [("bigdata", "tom"), ("a", ""), ("", "host"), ("", "nourl"),
                                      ("a_b", "x"), ("h", "t")]


def test_host_label_strict_raises(spark):
    import pytest

    df = spark.createDataFrame([("nourl",)], "u string")
    with pytest.raises(Exception):
        df.select(host_label("u", strict=True)).collect()


def test_ip_to_long(spark):
    got = one_col(spark, ["114.215.43.42", "1.2.3", "1.2.3.300", "0.0.0.0", "255.255.255.255"], ip_to_long)
    assert got == [1926703914, 66051, 16909100, 0, 4294967295]


def test_not_blank(spark):
    got = one_col(spark, ["a", "", " ", "\t", " x "], not_blank)
    assert got == [True, False, False, False, True]


def test_fixed2(spark):
    df = spark.createDataFrame([(5 / 3,), (0.125,), (2.0,), (1234567.891,)], "x double")
    assert [r[0] for r in df.select(fixed2("x")).collect()] == ["1.67", "0.13", "2.00", "1234567.89"]


def test_parse_user_and_render(spark):
    df = parse_users(spark.createDataFrame([("ann 30 99 extra",)], "l string"), "l")
    r = df.first()
    assert (r.name, r.age, r.fv) == ("ann", 30, 99)
    assert df.select(render_user("name", "age", "fv")).first()[0] == "name: ann, age: 30, fv: 99"


def test_parse_user_strict_and_lenient(spark):
    import pytest

    df = spark.createDataFrame([("bob x 1",)], "l string")
    with pytest.raises(Exception):
        parse_users(df, "l").collect()
    r = parse_users(df, "l", strict=False).first()
    assert (r.name, r.age, r.fv) == ("bob", None, 1)


def test_parse_hash_log_dash_strip(spark):
    import pytest

    df = spark.createDataFrame([("1#-#2#w#200#7",)], "l string")
    r = parse_hash_logs(df, "l").first()
    assert (r.word, r.status, r.size) == ("w", "200", 7)
    bad = spark.createDataFrame([("1#2#w-#200#7",)], "l string")
    with pytest.raises(Exception):
        parse_hash_logs(bad, "l").collect()
    r2 = parse_hash_logs(bad, "l", strict=False).first()
    assert (r2.word, r2.status, r2.size) == ("w200", "7", None)


def test_parse_order_and_rule(spark):
    df = spark.createDataFrame([("t1 1.2.3.4 phone x 10.5",)], "l string")
    r = parse_orders(df, "l").first()
    assert (r.ip, r.item, r.price) == ("1.2.3.4", "phone", 10.5)
    rules = spark.createDataFrame([("a|b|16777216|33554431|c|d|P1|z",)], "l string")
    r = parse_ip_rules(rules, "l").first()
    assert (r.lo, r.hi, r.province) == (16777216, 33554431, "P1")


def test_render_tuple(spark):
    df = spark.createDataFrame([("w", 3, "s")], "a string, n long, s string")
    assert df.select(render_tuple("a", "n")).first()[0] == "(w,3)"
    assert df.select(render_tuple(render_tuple("s", "a"), "n")).first()[0] == "((s,w),3)"


def test_gb2312_decode(spark):
    from skein.sources.kafka import JAVA_CHARSETS, allow_java_charsets, decode_value

    spark.conf.unset(JAVA_CHARSETS)
    with pytest.raises(ValueError):
        decode_value(spark.createDataFrame([(bytearray(b"x"),)], "value binary"), "value", "GB2312")
    allow_java_charsets(spark)
    raw = "广东".encode("gb2312")
    df = spark.createDataFrame([(bytearray(raw),)], "value binary")
    assert df.select(decode_value(df, "value", "GB2312")).first()[0] == "广东"


def _java_split(s, d):
    """Reference behaviour of the JVM's String.split(regex) with limit 0."""
    import re

    if s == "":
        return [""]
    parts = re.split(d, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_jvm_split_matches_java_rules_on_random_lines(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(["a", "b", " ", "#", "é"])
    lines = st.lists(st.text(alphabet=alphabet, max_size=8), min_size=1, max_size=60)

    @settings(max_examples=5, deadline=None)
    @given(lines)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "v string")
        got = df.select(jvm_split("v", " ").alias("s"), jvm_split("v", "#").alias("h")).collect()
        for v, r in zip(values, got):
            assert r.s == _java_split(v, " "), v
            assert r.h == _java_split(v, "#"), v

    check()


def test_read_ip_rules(spark, tmp_path):
    from skein.sources import read_ip_rules

    p = tmp_path / "ip.txt"
    p.write_text("1.0.0.0|1.0.0.255|16777216|16777471|亚洲|中国|广东|x\n", encoding="utf-8")
    r = read_ip_rules(spark, str(p)).first()
    assert (r.lo, r.hi, r.province) == (16777216, 16777471, "广东")


def test_split_fast_paths_keep_semantics(spark):
    vals = ["1.2.3.", "a|b||", "..", "x", "", "a.b.c"]
    got = one_col(spark, vals, lambda c: jvm_split(c, "[.]"))
    assert got == [_java_split(v, r"\.") for v in vals]
    got = one_col(spark, vals, lambda c: jvm_split(c, "[|]"))
    assert got == [_java_split(v, r"\|") for v in vals]


def test_text_lines_lone_cr_and_final_break(spark):
    df = spark.createDataFrame([("a\rb\r",), ("c\n\n",), ("\n",)], "t string")
    got = [r[0] for r in df.select(text_lines("t")).collect()]
    assert got == ["a", "b", "c", "", ""]
