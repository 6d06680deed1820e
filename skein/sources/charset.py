"""Text files in any charset: lines are cut as bytes, then decoded.

Charsets whose line marks are the ASCII bytes (all but UTF-16 and UTF-32 among the
usual ones) are cut by Spark's text reader, which splits large files, and decoded in the
JVM.  UTF-16 and UTF-32 have line marks of two or four bytes, whose halves occur in other
characters too: their files are dealt in ranges of whole units, and a task reads the
lines that begin in its range, so large files are split here as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.sources.kafka import decode_value
from skein.storage import store_of

#: Unit width and Python codec; without a named byte order a mark decides, else big-endian.
WIDE = {
    "UTF-16": (2, None), "UTF-16LE": (2, "utf-16-le"), "UTF-16BE": (2, "utf-16-be"),
    "UTF-32": (4, None), "UTF-32LE": (4, "utf-32-le"), "UTF-32BE": (4, "utf-32-be"),
}
RANGE_BYTES = 64 << 20
_CHUNK = 1 << 20


def read_lines_in(spark: SparkSession, path: str, charset: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of the text file(s) as column ``value``; marks are ``\\n``, ``\\r`` and ``\\r\\n``.

    Bytes that are no character become U+FFFD.  A byte order mark is dropped only for
    ``UTF-16`` and ``UTF-32`` (as the JVM does).  JVM charsets beyond the standard
    ones need :func:`skein.sources.allow_java_charsets`.
    """
    if charset.upper() not in WIDE:
        raw = spark.read.text(path).select(F.col("value").cast("binary").alias("value"))
        return raw.select(decode_value(raw, "value", charset).alias("value"))
    unit, codec = WIDE[charset.upper()]
    step = max(unit, range_bytes // unit * unit)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select(
        "path", "length")
    ranges = files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(step).cast("bigint"))).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, length, first in zip(*(c.to_pylist() for c in batch.columns)):
                lines: list[str] = []
                for line in _lines(uri, length, first, min(first + step, length), unit, codec):
                    lines.append(line)
                    if len(lines) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
                        lines = []
                if lines:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])

    return ranges.repartition("path", "first").mapInArrow(run, "value string")


def _lines(uri: str, length: int, first: int, end: int, unit: int, codec: str | None) -> Iterator[str]:
    """The lines of one file that begin in [first, end)."""
    store, path = store_of(uri)
    with store.open_input_file(path) as f:
        skip = 0
        if codec is None:
            mark = f.read(unit)
            little = mark == b"\xff\xfe" + b"\0" * (unit - 2)
            skip = unit if little or mark == b"\0" * (unit - 2) + b"\xfe\xff" else 0
            codec = f"utf-{8 * unit}-{'le' if little else 'be'}"
        kind = f"{'<' if codec.endswith('le') else '>'}u{unit}"
        # One unit earlier tells whether a line begins at ``first``.
        at = max(skip, first - unit)
        begun = at == skip and first <= skip
        f.seek(at)
        held, held_at, carry_cr = b"", at, False
        while True:
            chunk = f.read(_CHUNK // unit * unit)
            done = not chunk
            data = held + chunk
            whole = len(data) // unit * unit
            units = np.frombuffer(data[:whole], kind)
            marks = np.flatnonzero((units == 10) | (units == 13)).tolist()
            start = 0
            for m in marks:
                if units[m] == 10 and m == start and carry_cr:
                    start, carry_cr = m + 1, False
                    continue
                if units[m] == 13 and m + 1 == len(units) and not done:
                    break
                if begun and held_at + start * unit >= first:
                    if held_at + start * unit >= end:
                        return
                    yield data[start * unit:m * unit].decode(codec, "replace")
                begun, start, carry_cr = True, m + 1, units[m] == 13
            if done:
                at = held_at + start * unit
                if begun and first <= at < end and start * unit < len(data):
                    yield data[start * unit:].decode(codec, "replace")
                return
            if begun and held_at + start * unit >= end:
                return
            held, held_at = data[start * unit:], held_at + start * unit
            if start < len(units):
                carry_cr = carry_cr and units[start] == 10
