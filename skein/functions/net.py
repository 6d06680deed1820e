"""Dotted IP text to a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import ColumnOrName, jvm_split


def ip_to_long(ip: ColumnOrName) -> Column:
    """Fold the dot-separated parts as ``part | acc << 8`` (no range checks).

    ``114.215.43.42`` -> 1926703914; ``1.2.3`` -> 66051; an octet above 255
    spills into the next byte (``1.2.3.300`` -> 16909100).  The usual
    four-part case is unrolled so it stays in generated code; other lengths
    use the general fold.
    """
    parts = jvm_split(ip, "[.]")

    def p(i: int) -> Column:
        return F.element_at(parts, i).cast("bigint")

    def step(acc: Column, x: Column) -> Column:
        return x.bitwiseOR(F.shiftleft(acc, 8))

    four = step(step(step(p(1), p(2)), p(3)), p(4))
    general = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, x: step(acc, x.cast("bigint")))
    return F.when(F.size(parts) == 4, four).otherwise(general)
