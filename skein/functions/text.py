"""Text column expressions: JVM-style split, blank-line test, fixed formatting.

All helpers return Catalyst ``Column`` expressions, so they stay inside
whole-stage code generation and are pushed through the optimizer like any
built-in function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


_REGEX_META = set(".$|()[]{}^?*+\\")


def _literal_char(delimiter: str) -> str | None:
    """The single literal character a delimiter regex stands for, if it is one."""
    if len(delimiter) == 1 and delimiter not in _REGEX_META:
        return delimiter
    if len(delimiter) == 3 and delimiter[0] == "[" and delimiter[2] == "]" and delimiter[1] not in "^\\]":
        return delimiter[1]
    if len(delimiter) == 2 and delimiter[0] == "\\" and not delimiter[1].isalnum():
        return delimiter[1]
    return None


def jvm_split(line: ColumnOrName, delimiter: str = " ") -> Column:
    """``line.split(delimiter)`` with the JVM's limit-0 rules, as an array column.

    * leading and inner empty tokens are kept, trailing empty tokens dropped;
    * the empty string gives ``[""]``;
    * a line of delimiters only gives ``[]``.

    ``delimiter`` is a Java regular expression (``" "``, ``"#"``, ``"[.]"``,
    ``"[|]"``).  Spark's own ``split`` keeps trailing empties, so they are
    stripped first: by ``rtrim`` for a delimiter that is one literal character
    (which also splits without the regex engine), else by an end-anchored
    ``regexp_replace``.  The input is named three times, so give it as a column
    of its own, not as a long expression.
    """
    c = _col(line)
    ch = _literal_char(delimiter)
    if ch is None:
        stripped, pattern = F.regexp_replace(c, f"(?:{delimiter})+\\z", ""), delimiter
    else:
        stripped = F.rtrim(c, F.lit(ch))
        pattern = ch if ch not in _REGEX_META else "\\" + ch
    return (
        F.when(c == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, pattern, -1))
    )


def tokens(line: ColumnOrName, delimiter: str = " ") -> Column:
    """One row per token of :func:`jvm_split` (the ``flatMap(_.split(d))`` step)."""
    return F.explode(jvm_split(line, delimiter))


def text_lines(text: ColumnOrName) -> Column:
    """One row per line of a text value (``\\n``, ``\\r\\n`` or ``\\r`` breaks).

    A final line break does not open an extra empty line, as with a text file.
    Text without ``\\r`` takes a plain single-character split.
    """
    c = _col(text)
    any_break = F.regexp_replace(c, "(?:\\r\\n|\\r|\\n)\\z", "")
    lf_only = F.when(F.substring(c, -1, 1) == F.lit("\n"), F.left(c, F.length(c) - F.lit(1))).otherwise(c)
    lines = F.when(
        F.instr(c, "\r") > 0, F.split(any_break, "\\r\\n|\\r|\\n", -1)
    ).otherwise(F.split(lf_only, "\n", -1))
    return F.explode(lines)


def not_blank(line: ColumnOrName) -> Column:
    """``line.trim().length() > 0`` where trim removes every char <= U+0020."""
    return F.regexp_replace(_col(line), "[\\x00-\\x20]+", "") != F.lit("")


def fixed2(x: ColumnOrName) -> Column:
    """``f"$x%1.2f"``: two decimals, HALF_UP, no grouping separators."""
    return F.format_string("%1.2f", _col(x))
