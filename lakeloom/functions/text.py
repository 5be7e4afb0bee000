"""String expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mobile-number pattern the jobs validate against
# (mainland China numbering plan). A class written "[0-3,5-9]" would also
# admit a literal comma; it is written "[0-35-9]" here on purpose.
MOBILE_PATTERN = r"^(13[0-9]|14[579]|15[0-35-9]|16[6]|17[0135678]|18[0-9]|19[89])[0-9]{8}$"
# Whole-string match: "$" would also accept a trailing line terminator.
_MOBILE_FULL = MOBILE_PATTERN[:-1] + r"\z"
# Line terminators of text files: LF, CR LF or CR.
LINE_BREAK = r"\r\n|\r|\n"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(line: str | Column, sep: str = " ") -> Column:
    """Split on a single literal character with Java ``String.split`` rules.

    Interior and leading empty tokens are kept, trailing empty tokens are
    dropped, ``""`` gives ``[""]`` and a line of separators gives ``[]``.
    Spark's ``split`` keeps trailing empties, so they are trimmed first.
    """
    if len(sep) != 1:
        raise ValueError("java_split takes a single-character separator")
    line = _col(line)
    pattern = "\\" + sep if not sep.isalnum() else sep
    trimmed = F.regexp_replace(line, pattern + "+\\z", "") if sep != " " else F.rtrim(line)
    return (
        F.when(line == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, pattern))
    )


def lines(text: str | Column) -> Column:
    """Text → array of lines, as a text file is read: LF, CR LF and CR end a
    line, a final terminator does not start another line, and empty text
    has no lines."""
    t = _col(text)
    # Common case, no CR: single-character split (fast path) after dropping
    # one final LF. Texts with CR take the regular-expression split.
    lf_body = F.when(t.endswith("\n"), t.substr(F.lit(1), F.length(t) - 1)).otherwise(t)
    any_body = F.regexp_replace(t, "(" + LINE_BREAK + ")\\z", "")
    return (F.when(t == F.lit(""), F.array().cast("array<string>"))
            .when(F.instr(t, "\r") > 0, F.split(any_body, LINE_BREAK))
            .otherwise(F.split(lf_body, "\n")))


def valid_mobile(phone: str | Column) -> Column:
    """Full-match test of an 11-digit mobile number."""
    return _col(phone).rlike(_MOBILE_FULL)


def phone_prefix(phone: str | Column, n: int = 7) -> Column:
    """First ``n`` characters (``substr(1, n)``; a start of 0 acts as 1)."""
    return F.substring(_col(phone), 1, n)
