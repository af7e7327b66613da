"""Splitting text into lines and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of letters, a run of digits, or a run of one and the same
# other character; white space and separators only part tokens.
TOKEN_RE = r"\p{L}+|\p{Nd}+|([^\p{L}\p{Nd}\p{Z}\t-\r\x1c-\x1f])\1*"
LINE_RE = r"\r\n|\r|\n"


def tokenize(text: Column | str) -> Column:
    """Tokens of ``text`` in order, as ``array<string>``."""
    return F.regexp_extract_all(text, F.lit(TOKEN_RE), F.lit(0))


def split_lines(text: Column | str) -> Column:
    """Lines of ``text`` without their line ends, as ``array<string>``."""
    return F.split(text, LINE_RE, -1)
