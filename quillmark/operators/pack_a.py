"""Pack A: eleven yes-or-no features of a turn.

A text is the stripped column; an empty text is no hit unless a rule says so.
Branches that are cheap come first, as ``CASE`` stops at the first that holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import language, links, markdown
from quillmark.functions.pii import SECRET_WORDS, SENSITIVE
from quillmark.functions.text import BLANKS, NOT_AFTER_WORD, WS, W, contains_any, count_of, folded, last_line, py_count, py_strip, text_of
from quillmark.plans.registry import ANSWER, QUERY, RETRIEVED_DOCS, SEARCH_QUERY, Pack, Rule

# Words, marks and tokens of the rules.
ERRORS = ("error", "errors", "exception", "failed", "failure", "crash", "crashed", "bug", "wrong", "incorrect", "invalid", "undefined", "traceback")
ERRORS_KO = ("오류", "실패", "예외", "잘못")
CUT_MARKS = ("[truncated]", "[incomplete]", "[cut off]", "[더보기]")
CLOSERS = (".", "!", "?", "다", "요", "음", "」", "”", '"', ")", "]", "}", ">")
NO_DOCS = ("", "-", "[]", "{}", "none", "null", "n/a", "na", "no results", "no documents", "없음")
NO_QUERY = ("", "-", "[]", '""', "''", "none", "null", "n/a", "없음")
DANGLING = ("wait", "hmm", "actually", "but", "so", "그런데", "하지만", "그래서")
DIRECTIVES = ("삽입", "입력", "기재", "작성", "추가", "여기에", "채워")

# The patterns of the rules.
ERROR_WORD = f"(?iu){NOT_AFTER_WORD}(?:{'|'.join(ERRORS)})(?!{W})"
_ERROR_STEMS = tuple(w for w in ERRORS if not any(o != w and w.startswith(o) for o in ERRORS))
STRUCTURED = rf"^{WS}*(?:[|\-*>+]|\p{{Nd}}+[.)]|#{{1,6}}{WS})"
NOTHING_FOUND = rf"(?iu)^{WS}*0+{WS}*(?:건|개|docs?|documents?|results?)?{WS}*\z"
THINK, THOUGHT = "(?iu)<think(?:ing)?>", "(?iu)</think(?:ing)?>"
DANGLES = rf"(?iu)(?:{'|'.join(DANGLING)})[{BLANKS},]*\z"
_TOKEN = "[A-Z][A-Z0-9_ ]{2,}"
CURLY, ANGLE, SQUARE = r"\{\{[^{}]+\}\}", f"<{_TOKEN}>", rf"\[{_TOKEN}\](?!\()"
DIRECTIVE = rf"\[[^\[\]]*(?:{'|'.join(DIRECTIVES)})[^\[\]]*\](?!\()"


def _prepare(raw: dict[str, Column]) -> list:
    return [
        {"text": py_strip(text_of(raw[ANSWER])), "query": py_strip(text_of(raw[QUERY]))},
        lambda c: {"prose": markdown.prose_of(c["text"]), "lower": F.lower(c["text"])},
    ]


def _on(build):
    """A rule of the answer alone: never on an empty one."""
    return lambda c: (c["text"] != "") & build(c)


def _error_keyword(c: dict[str, Column]) -> Column:
    some = contains_any(folded(c["lower"]), _ERROR_STEMS)
    return (some & c["text"].rlike(ERROR_WORD)) | contains_any(c["text"], ERRORS_KO)


def _answer_truncated(c: dict[str, Column]) -> Column:
    t = c["text"]
    last = last_line(t)
    return (
        F.when(t.endswith("...") | t.endswith("…"), True)
        .when(contains_any(c["lower"], CUT_MARKS), True)
        .when(t.contains("```") | F.right(t, F.lit(1)).isin(*CLOSERS), False)
        .when(t == "", False)
        .otherwise(~last.rlike(STRUCTURED))
    )


def _format_broken(c: dict[str, Column]) -> Column:
    return F.when(py_count(c["text"], "```") % 2 == 1, True).when(markdown.corrupt(c["text"]), True).otherwise(markdown.broken(c["prose"]))


def _sensitive_info(c: dict[str, Column]) -> Column:
    t = c["text"]
    s = SENSITIVE
    numbers = t.rlike(s["phone"]) | t.rlike(s["rrn"]) | t.rlike(s["card"])
    secret = contains_any(folded(c["lower"]), SECRET_WORDS) & t.rlike(s["secret"])
    return (t.contains("@") & (t.rlike(s["email"]) | t.rlike(s["url_auth"]))) | secret | numbers


def _empty_docs(c: dict[str, Column]) -> Column:
    t = py_strip(text_of(c[RETRIEVED_DOCS]))
    return F.lower(t).isin(*NO_DOCS) | t.rlike(NOTHING_FOUND)


def _empty_query(c: dict[str, Column]) -> Column:
    return F.lower(py_strip(text_of(c[SEARCH_QUERY]))).isin(*NO_QUERY)


def _language_mismatch(c: dict[str, Column]) -> Column:
    return F.coalesce(language.dominant_script(c["query"]) != language.dominant_script(c["text"]), F.lit(False))


def _thinking_stopped(c: dict[str, Column]) -> Column:
    t = c["text"]
    opened, closed = count_of(t, THINK), count_of(t, THOUGHT)
    return F.when(t == "", c["query"] != "").otherwise((t.contains("<") & (opened > closed)) | t.rlike(DANGLES))


def _placeholder_leak(c: dict[str, Column]) -> Column:
    p = c["prose"]
    return p.rlike(CURLY) | p.rlike(ANGLE) | (p.contains("[") & (p.rlike(SQUARE) | p.rlike(DIRECTIVE)))


#: The order is part of the contract.
RULES = (
    Rule("error_keyword", (ANSWER,), _on(_error_keyword)),
    Rule("answer_truncated", (ANSWER,), _on(_answer_truncated)),
    Rule("language_mixing", (ANSWER,), _on(lambda c: language.n_scripts(c["text"]) > 1)),
    Rule("format_broken", (ANSWER,), _on(_format_broken)),
    Rule("sensitive_info", (ANSWER,), _on(_sensitive_info)),
    Rule("empty_retrieved_docs", (RETRIEVED_DOCS,), _empty_docs),
    Rule("empty_search_query", (SEARCH_QUERY,), _empty_query),
    Rule("language_mismatch", (QUERY, ANSWER), _language_mismatch),
    Rule("invalid_link", (ANSWER,), _on(lambda c: links.invalid_link_a(c["text"]))),
    Rule("model_thinking_stopped", (QUERY, ANSWER), _thinking_stopped),
    Rule("placeholder_leak", (ANSWER,), _on(_placeholder_leak)),
)

PACK = Pack("features", RULES, _prepare, optional=(RETRIEVED_DOCS, SEARCH_QUERY))


def any_null(df: DataFrame) -> Column:
    """Prototype of a rule over all columns: whether any is null."""
    from quillmark.operators.contract import is_null

    out = F.lit(False)
    for c in df.columns:
        out = out | is_null(F.col(f"`{c}`"))
    return out
