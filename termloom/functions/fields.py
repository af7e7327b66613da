"""Fields of tab-separated lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that would end a field or a line, and the letters for them.
_LETTERS = {"\t": "t", "\n": "n", "\r": "r"}


def escape_field(value: Column) -> Column:
    """Tab, line feed and carriage return as a backslash and a letter, a backslash as two."""
    escaped = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for mark, letter in _LETTERS.items():
        escaped = F.replace(escaped, F.lit(mark), F.lit("\\" + letter))
    return F.when(F.rlike(value, F.lit(r"[\\\t\n\r]")), escaped).otherwise(value)


def unescape_field(value: Column) -> Column:
    """The inverse of ``escape_field``; a backslash before any other character stays as it is."""

    def letters(part: Column) -> Column:
        for mark, letter in _LETTERS.items():
            part = F.replace(part, F.lit("\\" + letter), F.lit(mark))
        return part

    parts = F.transform(F.split(value, r"\\\\"), letters)
    return F.when(F.contains(value, F.lit("\\")), F.array_join(parts, "\\")).otherwise(value)
