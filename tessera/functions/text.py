"""Line and word splitting with the semantics of a Java text pipeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line terminators of a text-file reader, tried in this order.
LINE_BREAK = r"\r\n|\n|\r"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text) -> Column:
    """Cut a text into lines at CR LF, LF or CR.

    A final terminator does not open another line and the empty text has no
    line at all, as when the text is read from a file line by line.
    """
    t = _col(text)
    parts = F.split(t, LINE_BREAK, -1)
    last = F.substring(t, -1, 1)
    return (
        F.when(t == "", F.array().cast("array<string>"))
        .when(last.isin("\n", "\r"), F.slice(parts, 1, F.size(parts) - 1))
        .otherwise(parts)
    )


def split_words(line) -> Column:
    """Words of a line split on the single space character.

    Matches ``String.split(" ")``: inner and leading empty words are kept,
    trailing ones are dropped; the empty line holds one empty word, a line of
    spaces holds none. Tabs and punctuation stay inside words; case is kept.
    """
    s = _col(line)
    trimmed = F.rtrim(s)  # trims the space character only
    return (
        F.when(s == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " ", -1))
    )


def char_length(word, units: str = "codepoints") -> Column:
    """Length of a string in code points, or in UTF-16 units as Java counts."""
    w = _col(word)
    if units == "codepoints":
        return F.length(w)
    if units == "utf16":
        return (F.octet_length(F.encode(w, "UTF-16BE")) / 2).cast("long")
    raise ValueError(f"units must be 'codepoints' or 'utf16', not {units!r}")
