"""Positional record parsers and renderers.

A line is split once into a column of its own (:func:`split_lines`); the
``*_fields`` functions then take named, typed columns from that array, so no
field repeats the split.  With ``strict=True`` (the default, as in the reference
jobs) a missing field or a non-numeric number raises; with ``strict=False`` such
values become NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import ColumnOrName, _col, jvm_split

PARTS = "_skein_parts"


def split_lines(df: DataFrame, line: ColumnOrName, delimiter: str, fields: Callable[..., list[Column]],
                strict: bool = True) -> DataFrame:
    """Split ``line`` once, then select ``fields`` of the parts.

    Catalyst keeps the two steps apart because the array is used several times.
    """
    return df.select(jvm_split(line, delimiter).alias(PARTS)).select(*fields(F.col(PARTS), strict))


def field(parts: Column, i: int, strict: bool = True) -> Column:
    """0-based field ``i`` of a split array."""
    v = F.try_element_at(parts, F.lit(i + 1))
    if not strict:
        return v
    return F.when(F.size(parts) > i, v).otherwise(
        F.raise_error(F.lit(f"record has no field {i}"))
    )


def number_field(parts: Column, i: int, dtype: str, strict: bool = True) -> Column:
    """Field ``i`` as ``dtype``; raise on bad text when ``strict``."""
    v = F.try_element_at(parts, F.lit(i + 1))
    t = v.try_cast(dtype)
    if not strict:
        return t
    return F.when(t.isNotNull(), t).otherwise(
        F.raise_error(F.concat(F.lit(f"field {i} is not a {dtype}: "), F.coalesce(v, F.lit("missing")))))


def user_fields(f: Column, strict: bool = True) -> list[Column]:
    """Parts of ``"name age fv"`` -> ``name STRING, age INT, fv INT`` (extra fields ignored)."""
    return [
        field(f, 0, strict).alias("name"),
        number_field(f, 1, "int", strict).alias("age"),
        number_field(f, 2, "int", strict).alias("fv"),
    ]


def hash_log_fields(f: Column, strict: bool = True) -> list[Column]:
    """Parts of a ``#``-log line -> ``word, status, size INT`` (fields 2, 3, 4)."""
    return [
        field(f, 2, strict).alias("word"),
        field(f, 3, strict).alias("status"),
        number_field(f, 4, "int", strict).alias("size"),
    ]


def order_fields(f: Column, strict: bool = True) -> list[Column]:
    """Parts of an order record -> ``ip, item, price DOUBLE`` (fields 1, 2, 4)."""
    return [
        field(f, 1, strict).alias("ip"),
        field(f, 2, strict).alias("item"),
        number_field(f, 4, "double", strict).alias("price"),
    ]


def ip_rule_fields(f: Column, strict: bool = True) -> list[Column]:
    """Parts of an IP rule -> ``lo BIGINT, hi BIGINT, province`` (fields 2, 3, 6)."""
    return [
        number_field(f, 2, "bigint", strict).alias("lo"),
        number_field(f, 3, "bigint", strict).alias("hi"),
        field(f, 6, strict).alias("province"),
    ]


def parse_users(df: DataFrame, line: ColumnOrName = "value", strict: bool = True) -> DataFrame:
    """Blank-separated user lines."""
    return split_lines(df, line, " ", user_fields, strict)


def parse_hash_logs(df: DataFrame, line: ColumnOrName = "value", strict: bool = True) -> DataFrame:
    """``#``-log lines.  Every literal ``-#`` is removed first (a dash field and its
    separator, so later fields shift left)."""
    clean = df.select(F.replace(_col(line), F.lit("-#"), F.lit("")).alias("_skein_line"))
    return split_lines(clean, "_skein_line", "#", hash_log_fields, strict)


def parse_orders(df: DataFrame, line: ColumnOrName = "value", strict: bool = True) -> DataFrame:
    """Blank-separated order lines."""
    return split_lines(df, line, " ", order_fields, strict)


def parse_ip_rules(df: DataFrame, line: ColumnOrName = "value", strict: bool = True) -> DataFrame:
    """``|``-separated IP rule lines."""
    return split_lines(df, line, "[|]", ip_rule_fields, strict)


def render_user(name: ColumnOrName, age: ColumnOrName, fv: ColumnOrName) -> Column:
    """``name: <name>, age: <age>, fv: <fv>``."""
    return F.format_string("name: %s, age: %d, fv: %d", _col(name), _col(age), _col(fv))


def join_fields(sep: str, *cols: ColumnOrName, null: str = "") -> Column:
    """Fields joined by ``sep``; a NULL keeps its place as ``null``."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null)) for c in cols]
    return F.concat_ws(sep, *parts)


def render_tuple(*cols: ColumnOrName) -> Column:
    """Tuple text ``(a,b)``, NULL as ``null``; pass a nested tuple column first for ``((s,t),n)``."""
    return F.concat(F.lit("("), join_fields(",", *cols, null="null"), F.lit(")"))
