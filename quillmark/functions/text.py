"""Python's string semantics in Spark expressions.

The rules are defined over Python strings. These classes and helpers give the
same answers on the JVM: ``WS`` is what ``str.strip`` and ``\\s`` take, ``LT``
where ``str.splitlines`` parts lines, ``W`` what ``\\w`` takes. All are written
with ``\\x{...}`` escapes, so the SQL that queries are held against shares them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same characters, one by one.
BLANK_CHARS = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WS = f"[{BLANKS}]"
NWS = f"[^{BLANKS}]"
LT = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}])"
#: One character that parts lines, and a blank that doesn't.
BREAK = r"[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
INNER = f"[{BLANKS}&&[^{BREAK[1:-1]}]]"
WORD = r"\p{L}\p{N}_"
W = f"[{WORD}]"
NW = f"[^{WORD}]"
D = r"\p{Nd}"
# Look-behind steps over whole characters beyond U+FFFF only if the pattern itself holds one.
AFTER_WORD = f"(?<=[{WORD}\U00010000])"
NOT_AFTER_WORD = f"(?<![{WORD}\U00010000])"
NOT_AFTER_DIGIT = f"(?<![{D}\U0001d7ce])"
#: A word character on one side only.
WB = f"(?:{AFTER_WORD}(?!{W})|{NOT_AFTER_WORD}(?={W}))"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def text_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def ends_in(c: Column, chars) -> Column:
    """Whether the last character is one of these; the characters before are not counted."""
    out = F.lit(False)
    for x in chars:
        out = out | c.endswith(x)
    return out


def _blank_at(c: Column, last: bool) -> Column:
    """Whether the first or last character is a blank."""
    return ends_in(c, BLANK_CHARS) if last else F.substring(c, 1, 1).isin(*BLANK_CHARS)


def py_strip(c: Column) -> Column:
    """Linear in the text, and only a look at both ends where there is nothing to strip."""
    return F.when(_blank_at(c, False) | _blank_at(c, True), F.btrim(c, F.lit(BLANK_CHARS))).otherwise(c)


def py_rstrip(c: Column) -> Column:
    return F.when(_blank_at(c, True), F.rtrim(c, F.lit(BLANK_CHARS))).otherwise(c)


def py_lines(c: Column) -> Column:
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, rf"{LT}\z", ""), LT, -1))


def py_count(c: Column, mark: str) -> Column:
    """Non-overlapping occurrences of a literal; one look where there is none."""
    n = ((F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)).cast("int")
    return F.when(~c.contains(mark), 0).otherwise(n)


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def chars_of(c: Column, cls: str) -> Column:
    """Characters of a class ``[...]``; what lies between is dropped by runs.

    A text of ASCII alone isn't searched for a class without ASCII characters.
    """
    n = F.length(F.regexp_replace(c, f"[^{cls[1:-1]}]+", ""))
    return n if "A-Z" in cls else F.when(F.octet_length(c) == F.length(c), 0).otherwise(n)


def last_line(c: Column) -> Column:
    """The last of :func:`py_lines`, for a text without a line break at its end."""
    return F.regexp_replace(c, rf"(?s)\A.*{LT}", "")


def contains_any(c: Column, marks) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | c.contains(m)
    return out


def folded(lower: Column) -> Column:
    """A lower-cased text with the letters that match s or i without being lower-cased to them: long s, and i with or without a dot."""
    return F.replace(F.replace(F.replace(lower, F.lit("ſ"), F.lit("s")), F.lit("i\u0307"), F.lit("i")), F.lit("ı"), F.lit("i"))


def blank(c: Column) -> Column:
    """Nothing but blanks."""
    return ~c.rlike(NWS)


def tally(hits: Column, total: Column) -> Column:
    return F.concat(F.format_number(hits, 0), F.lit(" / "), F.format_number(total, 0))
