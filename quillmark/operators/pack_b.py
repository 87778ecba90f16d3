"""Pack B: seven flag checks of a question and an answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions import language, links, pii
from quillmark.functions.text import BLANK_CHARS, BREAK, INNER, NWS, WS, D, blank, chars_of, contains_any, ends_in, last_line, let, py_count, py_rstrip, py_strip, text_of
from quillmark.plans.registry import ANSWER, QUERY, Pack, Rule

QUERY_HEAD = 100

# Keywords, signs and endings of the checks.
NO_INFORMATION = ("정보가 없", "제공되지 않아")
ENDS = ".?!…。？！；;:"
PAUSES = ",、，·-"
CLOSING = ")]}\"'’”」』〕】>*_`"
KOREAN_ENDINGS = ("습니다", "합니다", "입니다", "됩니다", "봅니다", "세요", "해요", "예요", "이에요", "네요", "어요", "아요", "지요", "죠", "있다", "없다", "이다")

# Instructions that name a format.
ASKS_TABLE = rf"(?iu)(?:표로|표{WS}*형식|테이블로|table{WS}*(?:형식|form)|as{WS}+a{WS}+table|in{WS}+a{WS}+table)"
ASKS_LINE = rf"(?iu)(?:한{WS}*줄로|한{WS}*문장으로|one{WS}*line|single{WS}*line|in{WS}+one{WS}+sentence)"
ASKS_BULLETS = rf"(?iu)(?:bullet|불릿|글머리|목록으로|리스트로|list{WS}*형식|as{WS}+a{WS}+list)"
ASKS_NUMBERS = rf"(?iu)(?:번호를?{WS}*매겨|번호로|numbered{WS}*list|1\.{WS}*2\.{WS}*3\.)"
ASKS_JSON = "(?iu)(?:json|제이슨)"


def no_information(text: Column, keywords=NO_INFORMATION) -> Column:
    return contains_any(text, keywords)


def truncated(text: Column) -> Column:
    """Whether an answer seems to stop in the middle; most are decided by their last character."""

    def of(raw: Column) -> Column:
        tail = F.when(ends_in(raw, CLOSING), F.rtrim(raw, F.lit(CLOSING + BLANK_CHARS))).otherwise(raw)
        by_its_end = ends_in(raw, "|-*+") | (raw.endswith(".") & F.substring(raw, -2, 1).rlike(D))

        def end(t: Column) -> Column:
            more = lambda a, b: py_count(t, a) > py_count(t, b)
            whole = F.lit(False)
            for e in KOREAN_ENDINGS:
                whole = whole | t.endswith(e)
            return (
                F.when(t == "", False)
                .when(ends_in(t, ENDS), False)
                .when(ends_in(t, PAUSES), True)
                .when(more("(", ")") | more("[", "]") | more("{", "}"), True)
                .otherwise(~whole)
            )

        def by_line(line: Column) -> Column:
            return F.when(line.startswith("|") & line.endswith("|"), False).when(line.rlike(rf"^(?:[-*+]|{D}+\.){WS}*\z"), True)

        # null where the last line, which only such ends can make matter, doesn't decide
        line = F.when(by_its_end, let(let(last_line(raw), py_strip), by_line))
        return F.when(raw == "", False).when(py_count(raw, "```") % 2 == 1, True).otherwise(F.coalesce(line, let(tail, end)))

    return let(py_rstrip(text), of)


def mixed(clean: Column, lang: Column, east: Column, han_share: float = 0.02, han_count: int = 4) -> Column:
    """Kana or unexplained Han characters in a Korean answer; ``clean`` is without noise, ``east`` whether it has any such character or Hangul."""

    def of(t: Column) -> Column:
        han = chars_of(t, language.HAN)
        letters = chars_of(t, language.HANGUL) + han + chars_of(t, language.LATIN)
        return (han >= han_count) & (letters > 0) & (han > 0) & (han >= han_share * letters)

    bare = F.regexp_replace(clean, r"[(（][^)）]{0,20}[)）]", " ")
    return F.when(~east, False).when(lang != "ko", False).when(clean.rlike(language.KANA), True).otherwise(let(bare, of))


def _two_lines(text: Column, line: str) -> Column:
    """Two lines of a form that begins at a line's first character and stays on the line."""
    one = rf"(?:\A|{BREAK}){INNER}*+{line}"
    return text.rlike(f"{one}(?s:.*?){one}")


def is_table(text: Column) -> Column:
    tag = text.contains("<") & text.rlike(rf"(?iu)<table(?:{WS}|>)")
    return tag | (text.contains("|") & _two_lines(text, rf"\|(?:[^{BREAK[1:-1]}]*\|)?{INNER}*+(?={BREAK}|\z)"))


def is_single_line(text: Column) -> Column:
    """At most one line that isn't blank."""
    return let(py_strip(text), lambda t: ~t.contains("\n") & ~t.rlike(BREAK))


def is_bulleted(text: Column) -> Column:
    return _two_lines(text, rf"(?:[-*•·▪]|{D}++[.)]){INNER}++{NWS}")


def is_numbered(text: Column) -> Column:
    return _two_lines(text, rf"{D}++[.)]{INNER}++{NWS}")


def is_json(text: Column) -> Column:
    """By its shape alone."""
    bare = lambda t: py_strip(F.regexp_replace(t, r"(?md)^```(?:json)?|```$", ""))
    shaped = lambda t: t.rlike(r"^[\[{]") & t.rlike(r"[\]}]\z")
    return let(py_strip(text), lambda t: F.substring(t, 1, 1).isin("[", "{", "`") & let(bare(t), shaped))


def breaks_format(head: Column, text: Column) -> Column:
    asked = ((ASKS_TABLE, is_table), (ASKS_LINE, is_single_line), (ASKS_BULLETS, is_bulleted), (ASKS_NUMBERS, is_numbered), (ASKS_JSON, is_json))
    out = F.lit(False)
    for pattern, done in asked:
        out = out | (head.rlike(pattern) & ~done(text))
    return ~blank(head) & ~blank(text) & out


def _clean_again(c: dict[str, Column]) -> Column:
    """The language once noise is stripped twice; a second pass finds more only where marks of noise are left."""
    again = let(language.strip_noise(c["clean"]), lambda x: F.when(x == c["clean"], c["lang"]).otherwise(language.detect_clean(x)))
    return F.when(language.noisy(c["clean"]), again).otherwise(c["lang"])


def _prepare(raw: dict[str, Column]) -> list:
    return [
        {"text": text_of(raw[ANSWER]), "head": F.substring(text_of(raw[QUERY]), 1, QUERY_HEAD)},
        lambda c: {"clean": language.strip_noise(c["text"]), "head_lang": language.detect_language(c["head"])},
        lambda c: {"east": language.has_east(c["clean"])},
        lambda c: {"lang": language.detect_clean(c["clean"], c["east"])},
    ]


#: The order is that of the tags.
RULES = (
    Rule("include_error_keyword", (ANSWER,), lambda c: no_information(c["text"])),
    Rule("truncated_answer", (ANSWER,), lambda c: truncated(c["text"])),
    Rule("language_mixing", (ANSWER,), lambda c: mixed(c["clean"], _clean_again(c), c["east"])),
    Rule("format_violation", (QUERY, ANSWER), lambda c: breaks_format(c["head"], c["text"])),
    Rule("contains_pii", (ANSWER,), lambda c: pii.contains_pii(c["text"])),
    Rule("qa_language_mismatch", (QUERY, ANSWER), lambda c: (c["head_lang"] != "unknown") & (c["lang"] != "unknown") & (c["head_lang"] != c["lang"])),
    Rule("invalid_link", (ANSWER,), lambda c: links.invalid_link_b(c["text"])),
)

PACK = Pack("flags", RULES, _prepare)
