"""Markdown structure: prose without code, tables, headings, emphasis, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.text import BLANKS, LT, WS, count_of, let, py_count, py_lines

_FENCE = f"^{WS}*```"
_INLINE = r"`[^`\n]*`"
DELIMITER = rf"^{WS}*\|?[{BLANKS}:|-]*-[{BLANKS}:|-]*\|?{WS}*$"


def _outside_fences(lines: Column) -> Column:
    """Lines with those of code blocks emptied: what lies between fences is taken in slices, so the work is linear in the lines."""

    def cut(ls: Column) -> Column:
        at = F.filter(F.transform(ls, lambda x, i: F.when(x.rlike(_FENCE), i)), lambda i: i.isNotNull())

        def pieces(fences: Column) -> Column:
            n = F.size(ls)

            def piece(k: Column) -> Column:
                begin = F.coalesce(F.get(fences, 2 * k - 1) + 1, F.lit(0))
                end = F.coalesce(F.get(fences, 2 * k), n)
                closed = F.coalesce(F.get(fences, 2 * k + 1) + 1, n)
                prose = F.transform(F.slice(ls, begin + 1, end - begin), lambda x: F.regexp_replace(x, _INLINE, ""))
                return F.concat(prose, F.array_repeat(F.lit(""), closed - end))

            # with an even number of fences the last piece follows the last of them
            return F.flatten(F.transform(F.sequence(F.lit(0), F.floor(F.size(fences) / 2).cast("int")), piece))

        return let(at, pieces)

    return let(lines, cut)


def prose_of(c: Column) -> Column:
    """The text with code blanked out, line by line; an unclosed fence runs to the end."""
    plain = F.array_join(py_lines(c), "\n")
    fenced = F.array_join(_outside_fences(py_lines(c)), "\n")
    return F.when(c.contains("```"), fenced).when(c.contains("`"), F.regexp_replace(plain, _INLINE, "")).otherwise(plain)


def corrupt(c: Column) -> Column:
    """Replacement characters, control characters, or escapes that never became line breaks."""
    return c.contains("�") | c.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]") | (~c.contains("\n") & (count_of(c, r"\\[nt]") >= 2))


def broken_table(prose: Column) -> Column:
    """Some run of two or more lines with pipes has uneven rows or no delimiter row."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("n"), F.lit(False).alias("bad"))

    def step(s: Column, line: Column) -> Column:
        pipes = py_count(F.replace(line, F.lit("\\|"), F.lit("")), "|")
        wrong = ((s["i"] >= 1) & (pipes != s["n"])) | ((s["i"] == 1) & ~line.rlike(DELIMITER))
        inside = F.struct((s["i"] + 1).alias("i"), F.when(s["i"] == 0, pipes).otherwise(s["n"]).alias("n"), (s["bad"] | wrong).alias("bad"))
        return F.when(line.contains("|"), inside).otherwise(F.struct(F.lit(0).alias("i"), F.lit(0).alias("n"), s["bad"].alias("bad")))

    return prose.contains("|") & F.aggregate(py_lines(prose), start, step, lambda s: s["bad"])


def broken_heading(prose: Column) -> Column:
    return prose.rlike(rf"(?:\A|{LT})(?:#{{1,6}}(?:[^#{BLANKS}])|#{{7,}})")


def unpaired_emphasis(prose: Column) -> Column:
    odd = lambda mark: py_count(prose, mark) % 2 == 1
    return odd("**") | odd("`") | odd("~~")


def broken_link(prose: Column) -> Column:
    return prose.rlike(r"\]\([^)\n]*(?:\n|\z)") | (py_count(prose, "[") != py_count(prose, "]"))


def broken(prose: Column) -> Column:
    return let(prose, lambda p: broken_table(p) | broken_heading(p) | unpaired_emphasis(p) | broken_link(p))
