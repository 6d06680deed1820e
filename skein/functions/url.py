"""URL parts of an access-log line: the last path segment and the host label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import ColumnOrName, _col

# Fixed value: scheme, optional user info, then the host up to the first dot.
HOST_LABEL_PATTERN = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:.]*)"


def last_segment(url: ColumnOrName) -> Column:
    """Text after the final ``/`` (query and fragment kept); the whole line if none."""
    return F.substring_index(_col(url), "/", -1)


def before_last_slash(url: ColumnOrName) -> Column:
    """Text before the final ``/``; empty when the line has no ``/``."""
    c = _col(url)
    return F.left(c, F.greatest(F.length(c) - F.length(last_segment(c)) - F.lit(1), F.lit(0)))


def host_label(url: ColumnOrName, strict: bool = False) -> Column:
    """First dot-separated label of the host of the part before the final ``/``.

    ``http://bigdata.example.cn/tom`` -> ``bigdata``.  Lines whose prefix is
    not ``scheme://host...`` give ``''``; with ``strict=True`` they raise.
    """
    prefix = before_last_slash(url)
    label = F.regexp_extract(prefix, HOST_LABEL_PATTERN, 1)
    if not strict:
        return label
    return F.when(prefix.rlike(HOST_LABEL_PATTERN), label).otherwise(
        F.raise_error(F.concat(F.lit("not a URL: "), _col(url)))
    )


def subject_teacher(url: ColumnOrName, strict: bool = False) -> list[Column]:
    """``[subject, teacher]`` columns for an access-log URL."""
    return [host_label(url, strict).alias("subject"), last_segment(url).alias("teacher")]
