"""The rules in SQL, for holding queries against another engine.

RE2 has no look-around: where a rule needs it, the neighbouring character is part
of the pattern, which decides the same for "is there any".
"""

from __future__ import annotations

from quillmark.fixtures import QUESTION, TURNS

# Fixed values, written down here once more and not taken from the expressions that are checked: character classes.
BLANKS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS, NWS = f"[{BLANKS}]", f"[^{BLANKS}]"
LT = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}])"
WORD = r"\p{L}\p{N}_"
W, NW = f"[{WORD}]", f"[^{WORD}]"
D = r"\p{Nd}"
DELIMITER = rf"^{WS}*\|?[{BLANKS}:|-]*-[{BLANKS}:|-]*\|?{WS}*$"


class lang:
    """Scripts of pack A in order, classes of pack B."""

    SCRIPTS = {"hangul": "[가-힣]", "latin": "[a-zA-Z]", "cjk": r"[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}]", "cyrillic": r"[\x{0400}-\x{04ff}]", "arabic": r"[\x{0600}-\x{06ff}]"}
    HANGUL = r"[가-힣\x{1100}-\x{11ff}\x{3130}-\x{318f}]"
    HAN = r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{f900}-\x{faff}]"
    KANA = r"[\x{3040}-\x{309f}\x{30a0}-\x{30ff}\x{31f0}-\x{31ff}]"
    LATIN = r"[a-zA-Z\x{00c0}-\x{024f}\x{1e00}-\x{1eff}]"
    VIETNAMESE = r"[ăâđêôơưàáảãạèéẻẽẹìíỉĩịòóỏõọùúủũụỳýỷỹỵ\x{1ea0}-\x{1ef9}]"


class a:
    """Fixed values of pack A."""

    ERRORS = ["error", "errors", "exception", "failed", "failure", "crash", "crashed", "bug", "wrong", "incorrect", "invalid", "undefined", "traceback"]
    ERRORS_KO = ["오류", "실패", "예외", "잘못"]
    CUT_MARKS = ["[truncated]", "[incomplete]", "[cut off]", "[더보기]"]
    CLOSERS = [".", "!", "?", "다", "요", "음", "」", "”", '"', ")", "]", "}", ">"]
    NO_DOCS = ["", "-", "[]", "{}", "none", "null", "n/a", "na", "no results", "no documents", "없음"]
    NO_QUERY = ["", "-", "[]", '""', "''", "none", "null", "n/a", "없음"]
    DANGLING = ["wait", "hmm", "actually", "but", "so", "그런데", "하지만", "그래서"]
    DIRECTIVES = ["삽입", "입력", "기재", "작성", "추가", "여기에", "채워"]
    STRUCTURED = rf"^{WS}*(?:[|*>+-]|{D}+[.)]|#{{1,6}}{WS})"


class b:
    """Fixed values of pack B."""

    NO_INFORMATION = ["정보가 없", "제공되지 않아"]
    ENDS = [".", "?", "!", "…", "。", "？", "！", "；", ";", ":"]
    PAUSES = [",", "、", "，", "·", "-"]
    CLOSING = r"\)\]\}\"'’”」』〕】>*_`"
    KOREAN_ENDINGS = ["습니다", "합니다", "입니다", "됩니다", "봅니다", "세요", "해요", "예요", "이에요", "네요", "어요", "아요", "지요", "죠", "있다", "없다", "이다"]
    ASKS_TABLE = rf"(?i)(?:표로|표{WS}*형식|테이블로|table{WS}*(?:형식|form)|as{WS}+a{WS}+table|in{WS}+a{WS}+table)"
    ASKS_LINE = rf"(?i)(?:한{WS}*줄로|한{WS}*문장으로|one{WS}*line|single{WS}*line|in{WS}+one{WS}+sentence)"
    ASKS_BULLETS = rf"(?i)(?:bullet|불릿|글머리|목록으로|리스트로|list{WS}*형식|as{WS}+a{WS}+list)"
    ASKS_NUMBERS = rf"(?i)(?:번호를?{WS}*매겨|번호로|numbered{WS}*list|1\.{WS}*2\.{WS}*3\.)"
    ASKS_JSON = "(?i)(?:json|제이슨)"


class links:
    """Marks of placeholders in addresses."""

    PLACEHOLDER_HOSTS = ["example.com", "example.org", "example.net", "yourdomain", "localhost", "127.0.0.1", "test.com", "abc.com", "url.com"]
    PLACEHOLDER_MARKS = ["<", ">", "{", "}", "링크", "url_here", "insert", "your-", "xxx"]


def lit(s: str | None) -> str:
    if s is None:
        return "null::varchar"
    out, plain = [], ""
    for c in s:
        if ord(c) < 32 or c in "\x85\u2028":
            out += ["'" + plain.replace("'", "''") + "'", f"chr({ord(c)})"]
            plain = ""
        else:
            plain += c
    return "(" + " || ".join([*out, "'" + plain.replace("'", "''") + "'"]) + ")"


def m(x: str, pattern: str) -> str:
    pattern = pattern.replace("(?iu)", "(?i)").replace("'", "''")
    return f"regexp_matches({x}, '{pattern}')"


def sub(x: str, pattern: str, by: str = "") -> str:
    pattern = pattern.replace("(?iu)", "(?i)").replace("'", "''")
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def strip(x: str) -> str:
    return sub(x, f"^{WS}+|{WS}+$")


def lines(x: str) -> str:
    return f"case when {x} = '' then []::varchar[] else regexp_split_to_array(regexp_replace({x}, '{LT}$', ''), '{LT}') end"


def n(x: str, pattern: str) -> str:
    """Characters of a class."""
    return f"(length({x}) - length({sub(x, pattern)}))"


def marks(x: str, mark: str) -> str:
    return f"((length({x}) - length(replace({x}, '{mark}', ''))) // {len(mark)})"


def has(x: str, words) -> str:
    return "(" + " or ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def one_of(x: str, words) -> str:
    return f"{x} in ({', '.join(lit(w) for w in words)})"


def _turns() -> str:
    rows = ", ".join(f"({-i - 1}, {lit(q)}, {lit(t)}, {lit(s)}, {lit(d)})" for i, (q, t, s, d) in enumerate(TURNS))
    return f"""turns(id, query, answer, search_query, retrieved_docs) as (
  select doc_id, {lit(QUESTION)}, text, 'x', 'x' from documents
  union all select 1000000000000 + 1000 * conv_id + turn, text, case when next_role = 'assistant' then next_text end, substr(text, 1, 20), case when last_role = 'system' then last_text end
  from (select *, lead(role) over o as next_role, lead(text) over o as next_text, lag(role) over o as last_role, lag(text) over o as last_text
    from conversations window o as (partition by conv_id order by turn, role, text)) where role = 'user'
  union all values {rows}),
t as (select id, coalesce(answer, '') as raw, {strip("coalesce(answer, '')")} as text, {strip("coalesce(query, '')")} as q,
  substr(coalesce(query, ''), 1, 100) as head, {strip("coalesce(search_query, '')")} as sq, {strip("coalesce(retrieved_docs, '')")} as rd from turns)"""


_PROSE = f"""pl as (select id, unnest(ls) as line, unnest(range(len(ls))) as i from (select id, {lines("text")} as ls from t)),
pf as (select *, {m("line", f"^{WS}*```")} as fence, sum({m("line", f"^{WS}*```")}::int) over (partition by id order by i) as c from pl),
pk as (select id, i, case when fence or c % 2 = 1 then '' else {sub("line", "`[^`" + chr(92) + "n]*`")} end as line from pf),
p as (select t.id, text, coalesce(string_agg(line, chr(10) order by i), '') as prose from t left join pk using (id) group by t.id, text),
pipes as (select id, i, line, length(replace(line, '{chr(92)}|', '')) - length(replace(replace(line, '{chr(92)}|', ''), '|', '')) as np,
  i - row_number() over (partition by id order by i) as g from pk where contains(line, '|')),
runs as (select id, g, count(*) as rows, count(distinct np) as widths, count(*) filter (where k = 2 and not {m("line", DELIMITER)}) as nodelim
  from (select *, row_number() over (partition by id, g order by i) as k from pipes) group by id, g),
tables as (select id, bool_or(rows >= 2 and (widths > 1 or nodelim > 0)) as bad from runs group by id)"""

_HEADING = m("prose", rf"(?m)(^|\n)(?:#{{1,6}}[^#{BLANKS}]|#{{7,}})")
_EMPHASIS = "(" + " or ".join(f"{marks('prose', x)} % 2 = 1" for x in ("**", "`", "~~")) + ")"
_LINK = f"({m('prose', r'\]\([^)\n]*(\n|$)')} or {marks('prose', '[')} <> {marks('prose', ']')})"
_TABLE = "coalesce(bad, false)"
_CORRUPT = f"(contains(text, {lit(chr(0xFFFD))}) or {m('text', r'[\x00-\x08\x0b\x0c\x0e-\x1f]')} or (not contains(text, chr(10)) and (length(text) - length({sub('text', r'\\[nt]')})) // 2 >= 2))"


def _dominant(x: str) -> str:
    counts = [n(x, p) for p in lang.SCRIPTS.values()]
    best = f"greatest({', '.join(counts)})"
    cases = " ".join(f"when {c} = {best} then '{name}'" for c, name in zip(counts, lang.SCRIPTS, strict=True))
    return f"case when {best} < 3 then null {cases} end"


def strip_noise(x: str) -> str:
    x = sub(x, "(?s)```.*?```", " ")
    x = sub(x, r"`[^`\n]+`", " ")
    return sub(x, rf"(?i)(?:https?://|www\.){NWS}+", " ")


def detect(x: str) -> str:
    """Of a column name, already without noise."""
    ko, ja, zh, la = (n(x, p) for p in (lang.HANGUL, lang.KANA, lang.HAN, lang.LATIN))
    total = f"({ko} + {ja} + {zh} + {la})"
    return f"""case when not {m(x, NWS)} or {total} = 0 then 'unknown'
  when {ja} >= 2 or ({ja} >= 1 and {ko} = 0 and {la} < 3) then 'ja' when 10 * {ko} >= 3 * {total} then 'ko'
  when 10 * {zh} >= 3 * {total} then 'zh' when 10 * {la} >= 3 * {total} then case when {m(x, "(?i)" + lang.VIETNAMESE)} then 'vi' else 'en' end
  when {ko} > 0 then 'ko' else 'unknown' end"""


_A = {
    "error_keyword": f"({m('text', f'(?i)(^|{NW})(?:' + '|'.join(a.ERRORS) + f')({NW}|$)')} or {has('text', a.ERRORS_KO)})",
    "answer_truncated": f"""case when text = '' then false when text like '%...' or text like '%…' then true when {has("lower(text)", a.CUT_MARKS)} then true
  when contains(text, '```') then false when {m(f"list_extract({lines('text')}, -1)", a.STRUCTURED)} then false else not {one_of("right(text, 1)", a.CLOSERS)} end""",
    "language_mixing": "(" + " + ".join(f"{m('text', x)}::int" for x in lang.SCRIPTS.values()) + ") > 1",
    "format_broken": f"(text <> '' and ({marks('text', '```')} % 2 = 1 or {_CORRUPT} or {_TABLE} or {_HEADING} or {_EMPHASIS} or {_LINK}))",
    "sensitive_info": "("
    + " or ".join(
        m("text", x)
        for x in (
            rf"{W}[{WORD}.%+-]*@[{WORD}.-]+\.[A-Za-z]{{2,}}({NW}|$)",
            rf"(^|{NW})0{D}{{1,2}}[{BLANKS}.-]{D}{{3,4}}[{BLANKS}.-]{D}{{4}}({NW}|$)",
            rf"(^|{NW}){D}{{6}}-[1-8]{D}{{6}}({NW}|$)",
            rf"(^|{NW}){D}{{4}}[{BLANKS}-]{D}{{4}}[{BLANKS}-]{D}{{4}}[{BLANKS}-]{D}{{4}}({NW}|$)",
            rf"(?i)(?:api[_-]?key|secret|token|password){WS}*[:=]{WS}*{NWS}{{12,}}",
            rf"https?://[^{BLANKS}:/@]+:[^{BLANKS}:/@]+@",
        )
    )
    + ")",
    "empty_retrieved_docs": f"({one_of('lower(rd)', a.NO_DOCS)} or {m('rd', rf'(?i)^{WS}*0+{WS}*(?:건|개|docs?|documents?|results?)?{WS}*$')})",
    "empty_search_query": one_of("lower(sq)", a.NO_QUERY),
    "language_mismatch": f"coalesce({_dominant('q')} <> {_dominant('text')}, false)",
    "model_thinking_stopped": f"""case when text = '' then q <> '' else len(regexp_extract_all(text, '(?i)<think(?:ing)?>')) > len(regexp_extract_all(text, '(?i)</think(?:ing)?>'))
  or {m("text", f"(?i)(?:{'|'.join(a.DANGLING)})[{BLANKS},]*$")} end""",
    "placeholder_leak": "(text <> '' and ("
    + " or ".join(m("prose", x) for x in (r"\{\{[^{}]+\}\}", "<[A-Z][A-Z0-9_ ]{2,}>", r"\[[A-Z][A-Z0-9_ ]{2,}\]([^(]|$)", rf"\[[^\[\]]*(?:{'|'.join(a.DIRECTIVES)})[^\[\]]*\]([^(]|$)"))
    + "))",
}

_VALID_A = """(regexp_matches(u, '^[/#]') or (regexp_matches(u, '^https?://') and contains(host, '.') and host not like '.%' and host not like '%.'))"""
_URLS_A = f"""ua as (
  select id, {strip("u")} as u from (select id, unnest(regexp_extract_all(text, '{chr(92)}[[^{chr(92)}]]*{chr(92)}]{chr(92)}(([^)]*){chr(92)})', 1)) as u from t)
  union all select id, {sub("u", "[.,;:!?)]+$")} from (select id, unnest(regexp_extract_all(text, '(^|[^{WORD}(])(https?://{NWS}+)', 2)) as u from t)),
badlink as (select distinct id from (select id, u, string_split(regexp_replace(u, '^https?://', ''), '/')[1] as host from ua) where not {_VALID_A})"""
_A["invalid_link"] = "badlink.id is not null"

_TAIL = sub("raw2", rf"[{b.CLOSING}{BLANKS}]+$")


def _b_trunc() -> str:
    more = lambda x, y: f"{marks('tail', x)} > {marks('tail', y)}"
    whole = " or ".join(f"suffix(tail, {lit(e)})" for e in b.KOREAN_ENDINGS)
    return f"""case when raw2 = '' then false when {marks("raw2", "```")} % 2 = 1 then true
  when last like '|%' and last like '%|' then false when {m("last", f"^(?:[-*+]|{D}+[.]){WS}*$")} then true
  when tail = '' then false when {one_of("right(tail, 1)", b.ENDS)} then false when {one_of("right(tail, 1)", b.PAUSES)} then true
  when {more("(", ")")} or {more("[", "]")} or {more("{", "}")} then true else not ({whole}) end"""


def _count_lines(test: str) -> str:
    return f"len([x for x in ls if {test}])"


def _b_format() -> str:
    bare = strip(sub(strip("raw"), "(?m)^```(?:json)?|```$"))
    checks = (
        (b.ASKS_TABLE, f"({_count_lines("x like '|%' and x like '%|'")} >= 2 or {m('raw', f'(?i)<table(?:{WS}|>)')})"),
        (b.ASKS_LINE, "len(ls) <= 1"),
        (b.ASKS_BULLETS, f"{_count_lines(m('x', f'^(?:[-*•·▪]|{D}+[.)]){WS}+'))} >= 2"),
        (b.ASKS_NUMBERS, f"{_count_lines(m('x', f'^{D}+[.)]{WS}+'))} >= 2"),
        (b.ASKS_JSON, f"({m(bare, r'^[\[{]')} and {m(bare, r'[\]}]$')})"),
    )
    return f"({m('head', NWS)} and {m('raw', NWS)} and (" + " or ".join(f"({m('head', p)} and not {ok})" for p, ok in checks) + "))"


def _b_mix() -> str:
    bare = sub("clean", r"[(（][^)）]{0,20}[)）]", " ")
    han, letters = n(bare, lang.HAN), f"({n(bare, lang.HANGUL)} + {n(bare, lang.HAN)} + {n(bare, lang.LATIN)})"
    return f"case when clean_lang <> 'ko' then false when {m('clean', lang.KANA)} then true else {han} >= 4 and {han} >= 0.02 * {letters} end"


_SEP = "[-. ]"
_FREE = f"(^|[^{D}])", f"([^{D}]|$)"
PII = {
    "email": rf"{W}[{WORD}.+-]*@[{WORD}-]+\.(?:[{WORD}.-]+{W}({NW}|$)|[{WORD}.-]+[.-]{W})",
    "phone": rf"{_FREE[0]}(?:\+?82{_SEP}?)?0?1[016789]{_SEP}?{D}{{3,4}}{_SEP}?{D}{{4}}{_FREE[1]}",
    "phone_landline": rf"{_FREE[0]}0{D}{{1,2}}{_SEP}{D}{{3,4}}{_SEP}{D}{{4}}{_FREE[1]}",
    "rrn": rf"{_FREE[0]}{D}{{6}}[{BLANKS}-]?[1-4]{D}{{6}}{_FREE[1]}",
    "account": rf"{_FREE[0]}{D}{{2,6}}-{D}{{2,6}}-{D}{{2,7}}{_FREE[1]}",
    "passport": rf"(^|{NW})[MSRODmsrod]{D}{{8}}({NW}|$)",
    "biz_no": rf"{_FREE[0]}{D}{{3}}-{D}{{2}}-{D}{{5}}{_FREE[1]}",
}
#: Candidates for the two kinds that are checked further; other characters are doubled so that neighbours don't use up each other's edges.
_IPV4 = f"[x for x in regexp_extract_all({sub('raw', f'([^{D}.])', chr(92) + '1' + chr(92) + '1')}, '{_FREE[0]}((?:{D}{{1,3}}[.]){{3}}{D}{{1,3}}){_FREE[1]}', 2) if list_max([y::int for y in string_split(x, '.')]) <= 255]"
_CARD = f"[x for x in [{sub('y', f'[^{D}]')} for y in regexp_extract_all({sub('raw', f'([^{BLANKS}{D}-])', chr(92) + '1' + chr(92) + '1')}, '{_FREE[0]}((?:{D}{{4}}[{BLANKS}-]?){{3}}{D}{{4}}){_FREE[1]}', 2)] if list_sum([case when k % 2 = 1 then case when 2 * x[k]::int > 9 then 2 * x[k]::int - 9 else 2 * x[k]::int end else x[k]::int end for k in range(1, 17)]) % 10 = 0]"
_PII = "(" + " or ".join(m("raw", p) for p in PII.values()) + f" or len({_IPV4}) > 0 or len({_CARD}) > 0)"

_HOST_B = "split_part(split_part(split_part(regexp_replace(low, '^https?://', ''), '/', 1), '?', 1), '#', 1)"
_INVALID_B = f"""(u = '' or {has("low", links.PLACEHOLDER_MARKS)} or {has("low", links.PLACEHOLDER_HOSTS)} or not {m("low", "^(?:https?://|www[.]|/)")}
  or {m("low", "^(?:htt?ps?:/([^/]|$)|htt?ps?//|ht+ps?:)")} or {_HOST_B} = '' or contains(u, ' ') or not {m(_HOST_B + " || '/'", "(?i)[.][a-z]{2,24}(?:$|[/:?#])")}
  or {_HOST_B} like '.%' or {_HOST_B} like '%.' or contains({_HOST_B}, '..') or rtrim(low, '/') in ('http://', 'https://', 'www.'))"""
_MD = r"\[[^\]]*\]\(([^)]*)\)"
_BARE_CLASS = rf"[^{BLANKS}<>""''`" + r")\]]"
_URLS_B = f"""ub as (
  select id, {strip("u")} as u from (select id, unnest(regexp_extract_all(raw, '{_MD}', 1)) as u from t
    union all select id, unnest(regexp_extract_all({sub("raw", _MD, " ")}, '(?i)(^|[^{WORD}({chr(92)}]])((?:https?://|www[.])[^{BLANKS}<>"''`){chr(92)}]]+)', 2)) from t)),
badurl as (select distinct id from (select id, u, lower(u) as low from ub) where {_INVALID_B})"""

_B = {
    "include_error_keyword": has("raw", b.NO_INFORMATION),
    "truncated_answer": _b_trunc(),
    "language_mixing": _b_mix(),
    "format_violation": _b_format(),
    "contains_pii": _PII,
    "qa_language_mismatch": "(head_lang <> 'unknown' and lang <> 'unknown' and head_lang <> lang)",
    "invalid_link": f"({m('raw', NWS)} and (badurl.id is not null or {m('raw', r'\[[^\]]*\]\([^)]*$')}))",
}

_CLEAN = f"""c0 as (select *, {sub("raw", f"{WS}+$")} as raw2, {strip_noise("raw")} as clean, {strip_noise("head")} as head_clean,
  [{strip("x")} for x in {lines("raw")} if {m("x", NWS)}] as ls from t),
c1 as (select *, {_TAIL} as tail, {strip(f"list_extract({lines('raw2')}, -1)")} as last, {strip_noise("clean")} as clean2 from c0),
c as (select *, {detect("clean")} as lang, {detect("clean2")} as clean_lang, {detect("head_clean")} as head_lang from c1)"""


def base_a() -> str:
    """CTEs that end with ``ha``: a boolean for each pack-A rule."""
    flags = ", ".join(f"{sql} as {name}" for name, sql in _A.items())
    return f"with {_turns()}, {_PROSE}, {_URLS_A}, ha as (select t.id, {flags} from t join p using (id, text) left join tables using (id) left join badlink using (id))"


def base_b() -> str:
    """CTEs that end with ``hb``: a boolean for each pack-B rule."""
    flags = ", ".join(f"{sql} as {name}" for name, sql in _B.items())
    return f"with {_turns()}, {_CLEAN}, {_URLS_B}, hb as (select c.id, {flags} from c left join badurl using (id))"


def rule_a(name: str) -> str:
    return f"{base_a()} select id, {name} as hit from ha"


def rule_b(name: str) -> str:
    return f"{base_b()} select id, {name} as hit from hb"


def prose_part(value: str, name: str) -> str:
    return f"with {_turns()}, {_PROSE} select p.id, {value} as {name} from p left join tables using (id)"


def clean_part(value: str, name: str) -> str:
    return f"with {_turns()}, {_CLEAN} select id, {value} as {name} from c"


def turns_part(value: str, name: str) -> str:
    return f"with {_turns()} select id, {value} as {name} from t"


PARTS = {"table": _TABLE, "heading": _HEADING, "emphasis": _EMPHASIS, "link": _LINK, "corrupt": _CORRUPT, "dominant": _dominant, "format": _b_format}
B_ORDER = list(_B)
A_ORDER = list(_A)
